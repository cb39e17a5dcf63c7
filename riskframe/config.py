"""Column names, rule sets and configuration objects.

Everything in this module is plain driver-side configuration: rule sets are
compiled into aggregate expressions by the operators, never evaluated row by
row in Python.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# ---------------------------------------------------------------------------
# These must equal the reference's feature contract, thresholds
# and defaults for results to match. Listed in their natural order.
# ---------------------------------------------------------------------------
TARGET_COL = "defaulted_30d"
GROUP_ID_COL = "cust_id"
KEY_COL = "loan_id"
DATE_COL = "draw_date"

RAW_FEATURE_COLUMNS: list[str] = [
    "tenure_months",
    "monthly_txn_count",
    "avg_txn_value_kes",
    "send_receive_ratio",
    "unique_counterparties_30d",
    "agent_cashin_freq_30d",
    "airtime_bundle_freq_30d",
    "savings_activity_score",
    "crb_flagged",
    "voice_data_spend_idx",
    "income_regularity",
    "assigned_limit_kes",
    "draw_amount_kes",
    "utilization_rate",
    "overdraw_to_inflow_ratio",
    "prior_overdraw_count",
    "prior_cleared_within_24h_count",
    "prior_rolled_past_30d_count",
]
DERIVED_FEATURE_COLUMNS: list[str] = ["prior_cleared_rate", "prior_roll_rate"]
FEATURE_COLUMNS: list[str] = RAW_FEATURE_COLUMNS + DERIVED_FEATURE_COLUMNS
FAIRNESS_PROXY_COLUMNS: list[str] = ["tenure_months", "crb_flagged"]
METADATA_COLUMNS: list[str] = ["loan_id", "cust_id", "draw_date", "county", "channel", "product_code"]
FORBIDDEN_FEATURES: list[str] = ["defaulted_30d", "fee_to_principal_ratio"]

INT_FEATURES: set[str] = {
    "tenure_months", "monthly_txn_count", "unique_counterparties_30d", "agent_cashin_freq_30d",
    "airtime_bundle_freq_30d", "crb_flagged", "prior_overdraw_count",
    "prior_cleared_within_24h_count", "prior_rolled_past_30d_count",
}

NULL_THRESHOLD = 0.01
DEFAULT_RATE_MIN = 0.005
DEFAULT_RATE_MAX = 0.5
PSI_WARN = 0.10
PSI_ALERT = 0.25
PSI_BINS = 10
PSI_EDGE_PAD = 1e-6
PSI_FLOOR = 1e-6
LEAKAGE_CORR = 0.95
MISSING_ERROR_RATE = 0.01
MIN_AUC = 0.65
MAX_TRAIN_OOT_GAP = 0.15
DI_LOWER_BOUND = 0.80
MAX_FPR_RATIO = 2.0
MAX_FNR_RATIO = 2.0
THIN_FILE_TENURE = 12
CONFIGURED_THRESHOLD = 0.30
VAL_CUTOFF = "2023-07-01"
OOT_CUTOFF = "2024-01-01"
COST_FP = 0.20
COST_FN = 1.0
REASON_TOP_N = 3
SPLIT_FRACTIONS = (0.70, 0.15, 0.15)
RANDOM_STATE = 42
# Exploratory band edges (notebook): tenure bands and prior-clear-rate bands.
TENURE_BAND_EDGES = [0, 12, 24, 36, 60, 250]
TENURE_BAND_LABELS = ["<1 yr", "1-2 yr", "2-3 yr", "3-5 yr", ">5 yr"]
CLEAR_RATE_BAND_EDGES = [0.0, 0.25, 0.5, 0.75, 1.001]
CLEAR_RATE_BAND_LABELS = ["0-25%", "25-50%", "50-75%", "75-100%"]
# Policy tier described in prose: scores in [0.10, 0.17) approved at half limit.
TIER_REDUCED_LOW = 0.10
TIER_REDUCED_LIMIT_SHARE = 0.5
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnRule:
    """Declarative per-column constraint (inclusive bounds, allowed set, missing budget)."""

    name: str
    min_val: float | None = None
    max_val: float | None = None
    allowed_values: tuple[Any, ...] | None = None
    max_missing_rate: float = 0.0
    nullable: bool = False  # declared for parity; never read by the checks


def _rng(name: str, lo: float | None = None, hi: float | None = None) -> ColumnRule:
    return ColumnRule(name, min_val=lo, max_val=hi)


# Batch bounds of the raw features (fixed values).
FEATURE_RULES: list[ColumnRule] = [
    _rng("tenure_months", 0.0, 240.0),
    _rng("monthly_txn_count", 0.0),
    _rng("avg_txn_value_kes", 0.0),
    _rng("send_receive_ratio", 0.0),
    _rng("unique_counterparties_30d", 0.0),
    _rng("agent_cashin_freq_30d", 0.0),
    _rng("airtime_bundle_freq_30d", 0.0),
    _rng("savings_activity_score", 0.0, 1.0),
    ColumnRule("crb_flagged", allowed_values=(0, 1)),
    _rng("voice_data_spend_idx", 0.0, 1.0),
    _rng("income_regularity", 0.0, 1.0),
    _rng("assigned_limit_kes", 0.0),
    _rng("draw_amount_kes", 0.0),
    _rng("utilization_rate", 0.0, 1.0),
    _rng("overdraw_to_inflow_ratio", 0.0),
    _rng("prior_overdraw_count", 0.0),
    _rng("prior_cleared_within_24h_count", 0.0),
    _rng("prior_rolled_past_30d_count", 0.0),
]


@dataclass(frozen=True)
class RequestRule:
    """Per-row request bound: `op` is one of ge, gt, le."""

    name: str
    op: str
    bound: float


# Scoring-request bounds (fixed values): money must be strictly positive.
_GE0 = ["tenure_months", "monthly_txn_count", "unique_counterparties_30d", "agent_cashin_freq_30d",
        "airtime_bundle_freq_30d", "overdraw_to_inflow_ratio", "prior_overdraw_count",
        "prior_cleared_within_24h_count", "prior_rolled_past_30d_count"]
_GT0 = ["avg_txn_value_kes", "send_receive_ratio", "assigned_limit_kes", "draw_amount_kes"]
_UNIT = ["savings_activity_score", "crb_flagged", "voice_data_spend_idx", "income_regularity",
         "utilization_rate"]
REQUEST_RULES: list[RequestRule] = (
    [RequestRule(c, "ge", 0.0) for c in _GE0]
    + [RequestRule(c, "gt", 0.0) for c in _GT0]
    + [r for c in _UNIT for r in (RequestRule(c, "ge", 0.0), RequestRule(c, "le", 1.0))]
)


@dataclass(frozen=True)
class CostConfig:
    cost_fp: float = COST_FP
    cost_fn: float = COST_FN
    description: str = ""


@dataclass(frozen=True)
class FairnessConfig:
    group_col: str
    group_a_label: Any = 1
    group_b_label: Any = 0
    di_lower_bound: float = DI_LOWER_BOUND
    max_fpr_ratio: float = MAX_FPR_RATIO
    max_fnr_ratio: float = MAX_FNR_RATIO


@dataclass(frozen=True)
class ModelValidationConfig:
    min_auc: float = MIN_AUC
    max_train_oot_gap: float = MAX_TRAIN_OOT_GAP
    fairness_configs: tuple[FairnessConfig, ...] = (
        FairnessConfig("thin_file"), FairnessConfig("crb_flagged"))
    forbidden_feature_names: tuple[str, ...] = tuple(FORBIDDEN_FEATURES)


@dataclass(frozen=True)
class SplitConfig:
    val_cutoff: str = VAL_CUTOFF
    oot_cutoff: str = OOT_CUTOFF
    fractions: tuple[float, float, float] = SPLIT_FRACTIONS
    seed: int = RANDOM_STATE


@dataclass(frozen=True)
class GBTParams:
    """MLlib boosted-tree parameters mapped from the reference's booster settings."""

    step_size: float = 0.03
    max_depth: int = 6
    min_instances_per_node: int = 30
    feature_subset: str = "0.8"
    subsampling_rate: float = 0.8
    max_iter: int = 1000
    patience: int = 50
    max_bins: int = 64
    seed: int = RANDOM_STATE


@dataclass(frozen=True)
class TrainingConfig:
    threshold: float = CONFIGURED_THRESHOLD
    split: SplitConfig = field(default_factory=SplitConfig)
    cost: CostConfig = field(default_factory=CostConfig)
    gbt: GBTParams = field(default_factory=GBTParams)
    validation: ModelValidationConfig = field(default_factory=ModelValidationConfig)
