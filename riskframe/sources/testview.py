"""Episode view over the driver's TPC-H-style tables.

The test tables hold no loans, so one order becomes one overdraft episode
(mapping in FIXTURES.md section 3). The same view is written twice: as a lazy
Spark plan (`episodes`) and as a DuckDB CTE (`EPISODES_CTE`) for the oracle.

Plan shape: lineitem is dealt by order, aggregated per order where it lands,
left-joined to orders on the order key (co-partitioned), joined to customer
on the customer key (sort-merge, AQE splits a hot customer) and to nation
(25 rows; Catalyst broadcasts it from its file size). Prior-history counters
use the two-level window of `operators.history.prior_history`, bucketed by
draw day so one heavy borrower never lands in a single task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prims import round_dp, sql_round_dp
from ..operators.history import RANGES, prior_history


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _clamp01(c):
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def raw_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes with outcomes (default, cleared-within-24h) but without prior counters."""
    # dealt by order first: the aggregates (supplier sets too) then hash one order's few lines, without the sort
    # of all lines per input file that collect_set falls back to, which spills more than in proportion
    li = (table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull())
          .select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
          .repartition("l_orderkey")
          .groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("li_n"),
               F.avg("l_extendedprice").alias("li_avg_price"),
               F.countDistinct("l_suppkey").alias("li_n_supp"),
               F.count_if(F.col("l_returnflag") == "R").alias("li_n_r"),
               F.count_if(F.col("l_returnflag") == "A").alias("li_n_a"),
               F.count_if(F.col("l_linestatus") == "F").alias("li_n_f"),
               F.count_if(F.col("l_linestatus") == "O").alias("li_n_o"),
               F.avg("l_discount").alias("li_avg_disc"),
               F.avg("l_tax").alias("li_avg_tax"),
               F.min("l_shipdate").alias("li_first_ship")))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (o.join(li, o.o_orderkey == li.l_orderkey, "left")
          .join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey))
    draw = F.to_date("o_orderdate")
    lag = F.datediff(F.to_date("li_first_ship"), draw)
    limit = (F.ceil(F.col("o_totalprice") / 100000) * 100000).cast("double")
    return j.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("cust_id"),
        draw.alias("draw_date"),
        F.col("n_name").alias("county"),
        F.col("o_orderpriority").alias("channel"),
        F.col("c_mktsegment").alias("product_code"),
        (F.col("o_custkey") % 60).cast("int").alias("tenure_months"),
        F.coalesce(F.col("li_n"), F.lit(0)).cast("int").alias("monthly_txn_count"),
        round_dp(F.coalesce(F.col("li_avg_price"), F.lit(0.0)), 6).alias("avg_txn_value_kes"),
        (F.coalesce(F.col("li_n_r"), F.lit(0)) / (F.coalesce(F.col("li_n_a"), F.lit(0)) + 1))
        .cast("double").alias("send_receive_ratio"),
        F.coalesce(F.col("li_n_supp"), F.lit(0)).cast("int").alias("unique_counterparties_30d"),
        F.coalesce(F.col("li_n_f"), F.lit(0)).cast("int").alias("agent_cashin_freq_30d"),
        F.coalesce(F.col("li_n_o"), F.lit(0)).cast("int").alias("airtime_bundle_freq_30d"),
        _clamp01((F.col("c_acctbal") + 1000) / 11000).alias("savings_activity_score"),
        (F.col("c_acctbal") < 0).cast("int").alias("crb_flagged"),
        _clamp01(round_dp(F.coalesce(F.col("li_avg_disc"), F.lit(0.0)), 6) * 10)
        .alias("voice_data_spend_idx"),
        _clamp01(F.lit(1.0) - round_dp(F.coalesce(F.col("li_avg_tax"), F.lit(0.0)), 6) / 0.08)
        .alias("income_regularity"),
        limit.alias("assigned_limit_kes"),
        F.col("o_totalprice").alias("draw_amount_kes"),
        (F.col("o_totalprice") / limit).alias("utilization_rate"),
        (F.col("o_totalprice") / (F.greatest(F.col("c_acctbal"), F.lit(0.0)) + 1000))
        .alias("overdraw_to_inflow_ratio"),
        F.when(F.col("li_n").isNull() | (lag > 30), 1).otherwise(0).alias("defaulted_30d"),
        F.when(lag <= 1, 1).otherwise(0).alias("cleared_24h"),
    )


def fixed_score():
    """Fixed scorecard: logit rounded (half up) to 2 dp so ties occur, mapped into (0, 1)
    by the rational sigmoid 0.5 + 0.5 z / (1 + |z|). Only +, -, *, / and abs are used, so
    Spark and the SQL oracle produce bit-identical scores."""
    z = (F.lit(-1.2) - F.lit(0.12) * F.col("monthly_txn_count") + F.lit(1.5) * F.col("utilization_rate")
         + F.lit(0.4) * F.col("crb_flagged"))
    zr = F.floor(z * 100 + 0.5) / 100
    return F.lit(0.5) + F.lit(0.5) * zr / (F.lit(1.0) + F.abs(zr))


def split_expr(val_cutoff: str = "1999-01-01", oot_cutoff: str = "2000-04-01"):
    d = F.col("draw_date")
    return (F.when(d < F.lit(val_cutoff).cast("date"), "train")
             .when(d < F.lit(oot_cutoff).cast("date"), "val")
             .when(d.isNotNull(), "oot"))


TEST_VAL_CUTOFF = "1999-01-01"
TEST_OOT_CUTOFF = "2000-04-01"


def episodes(spark: SparkSession, sf_dir: str, with_score: bool = True, base: DataFrame | None = None) -> DataFrame:
    """Full episode table: raw columns, point-in-time prior counters, split, fixed score.

    `base` may be a materialized copy of `raw_episodes`: the history operator
    reads its input in two branches (rows and per-bucket totals), so a written
    base keeps the lineitem aggregation and joins from running twice.
    """
    base = raw_episodes(spark, sf_dir) if base is None else base
    hist = prior_history(base, key="cust_id", order_cols=["draw_date", "loan_id"],
                         outcomes={"prior_cleared_within_24h_count": "cleared_24h",
                                   "prior_rolled_past_30d_count": "defaulted_30d"},
                         count_name="prior_overdraw_count",
                         bucket=RANGES)
    hist = hist.withColumns({c: F.col(c).cast("int") for c in
                             ("prior_cleared_within_24h_count", "prior_rolled_past_30d_count")})
    out = hist.withColumn("split", split_expr(TEST_VAL_CUTOFF, TEST_OOT_CUTOFF))
    if with_score:
        out = out.withColumn("score", fixed_score())
    return out


# --------------------------------------------------------------------------
# DuckDB form of the same view (oracle side). Literals are cast to DOUBLE so
# both engines evaluate the same IEEE operations in the same order.
# --------------------------------------------------------------------------
EPISODES_CTE = """
li AS (
  SELECT l_orderkey,
         COUNT(*) AS li_n,
         AVG(l_extendedprice) AS li_avg_price,
         COUNT(DISTINCT l_suppkey) AS li_n_supp,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS li_n_r,
         COUNT(*) FILTER (WHERE l_returnflag = 'A') AS li_n_a,
         COUNT(*) FILTER (WHERE l_linestatus = 'F') AS li_n_f,
         COUNT(*) FILTER (WHERE l_linestatus = 'O') AS li_n_o,
         AVG(l_discount) AS li_avg_disc,
         AVG(l_tax) AS li_avg_tax,
         MIN(l_shipdate) AS li_first_ship
  FROM lineitem GROUP BY l_orderkey
),
ep0 AS (
  SELECT o.o_orderkey AS loan_id,
         o.o_custkey AS cust_id,
         CAST(o.o_orderdate AS DATE) AS draw_date,
         n.n_name AS county,
         o.o_orderpriority AS channel,
         c.c_mktsegment AS product_code,
         CAST(o.o_custkey % 60 AS INTEGER) AS tenure_months,
         CAST(COALESCE(li.li_n, 0) AS INTEGER) AS monthly_txn_count,
         RND(COALESCE(li.li_avg_price, 0.0::DOUBLE), 6) AS avg_txn_value_kes,
         CAST(COALESCE(li.li_n_r, 0) AS DOUBLE) / CAST(COALESCE(li.li_n_a, 0) + 1 AS DOUBLE) AS send_receive_ratio,
         CAST(COALESCE(li.li_n_supp, 0) AS INTEGER) AS unique_counterparties_30d,
         CAST(COALESCE(li.li_n_f, 0) AS INTEGER) AS agent_cashin_freq_30d,
         CAST(COALESCE(li.li_n_o, 0) AS INTEGER) AS airtime_bundle_freq_30d,
         LEAST(GREATEST((c.c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS savings_activity_score,
         CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS crb_flagged,
         LEAST(GREATEST(RND(COALESCE(li.li_avg_disc, 0.0::DOUBLE), 6) * 10.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS voice_data_spend_idx,
         LEAST(GREATEST(1.0::DOUBLE - RND(COALESCE(li.li_avg_tax, 0.0::DOUBLE), 6) / 0.08::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS income_regularity,
         CAST(CEIL(o.o_totalprice / 100000.0::DOUBLE) * 100000 AS DOUBLE) AS assigned_limit_kes,
         o.o_totalprice AS draw_amount_kes,
         o.o_totalprice / CAST(CEIL(o.o_totalprice / 100000.0::DOUBLE) * 100000 AS DOUBLE) AS utilization_rate,
         o.o_totalprice / (GREATEST(c.c_acctbal, 0.0::DOUBLE) + 1000.0::DOUBLE) AS overdraw_to_inflow_ratio,
         CASE WHEN li.li_n IS NULL OR date_diff('day', CAST(o.o_orderdate AS DATE), CAST(li.li_first_ship AS DATE)) > 30
              THEN 1 ELSE 0 END AS defaulted_30d,
         CASE WHEN date_diff('day', CAST(o.o_orderdate AS DATE), CAST(li.li_first_ship AS DATE)) <= 1
              THEN 1 ELSE 0 END AS cleared_24h
  FROM orders o
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
ep1 AS (
  SELECT *,
         CAST(COALESCE(COUNT(*) OVER w, 0) AS INTEGER) AS prior_overdraw_count,
         CAST(COALESCE(SUM(cleared_24h) OVER w, 0) AS INTEGER) AS prior_cleared_within_24h_count,
         CAST(COALESCE(SUM(defaulted_30d) OVER w, 0) AS INTEGER) AS prior_rolled_past_30d_count
  FROM ep0
  WINDOW w AS (PARTITION BY cust_id ORDER BY draw_date, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
ep AS (
  SELECT *,
         CASE WHEN draw_date < DATE '1999-01-01' THEN 'train'
              WHEN draw_date < DATE '2000-04-01' THEN 'val'
              WHEN draw_date IS NOT NULL THEN 'oot' END AS split,
         0.5::DOUBLE + 0.5::DOUBLE * z / (1.0::DOUBLE + ABS(z)) AS score
  FROM (SELECT *, FLOOR((-1.2::DOUBLE - 0.12::DOUBLE * monthly_txn_count + 1.5::DOUBLE * utilization_rate
                         + 0.4::DOUBLE * crb_flagged) * 100 + 0.5::DOUBLE) / 100 AS z FROM ep1) s
)"""


def expand_rnd(sql: str) -> str:
    """Expand the pseudo-function RND(expr, dp) into the SQL form of `round_dp`."""
    out, i = [], 0
    while True:
        j = sql.find("RND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k, comma = 0, j + 4, -1
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        expr = expand_rnd(sql[j + 4:comma])
        dp = int(sql[comma + 1:k].strip())
        out.append(sql_round_dp(expr, dp))
        i = k + 1


def with_episodes(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix an oracle query with the episode CTE chain (RND expanded)."""
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return expand_rnd(f"WITH {EPISODES_CTE.strip()}{extra}\n{sql_body}")
