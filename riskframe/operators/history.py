"""Point-in-time history operators.

Per-borrower windows are the skew hazard here: a single borrower (or user)
may own a large share of all rows. Every operator therefore works in two
levels: a window inside (key, bucket) plus small per-bucket offsets carried
across buckets, so no task ever holds a whole key. With `bucket=RANGES` the
buckets are range partitions by key and order: a key with a third of all rows
is cut into as many of them as its rows need, even where all its rows carry
the same day, and a small key stays in one.

Nulls are as in SQL windows: rows with a null key are one key, and null times
(and buckets) come last. The rows and the offsets of a (key, bucket) meet by a
struct of both, which is not null and equal to itself when its fields are null.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Value of `bucket` that cuts keys into range partitions of about equal size.
RANGES = "ranges"


def in_ranges(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], name: str = "_range") -> DataFrame:
    """`df` with the number of each row's range partition by (keys, order).

    Along the order of one key the number never falls, so it serves as a bucket.
    There are spark.sql.shuffle.partitions ranges. The rows are written with their
    number, because another run of the range shuffle could draw other bounds. Rows
    equal in all keys and order columns share a range.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_last() for c in (*keys, *order_cols)]
    return stored(df.repartitionByRange(n, *by).withColumn(name, F.spark_partition_id()), "ranges")


def prior_history(df: DataFrame, key: str, order_cols: Sequence[str],
                  outcomes: Mapping[str, str], count_name: str = "prior_count",
                  bucket: Column | str | None = None) -> DataFrame:
    """Counters over a key's strictly earlier rows (rows unbounded preceding .. 1 preceding).

    `outcomes` maps output name -> 0/1 (or numeric) source column to sum.
    `bucket` must be non-decreasing in `order_cols` (e.g. the draw month); when
    given, the window runs per (key, bucket) and each bucket is shifted by the
    totals of the key's earlier buckets, which keeps every task bounded by
    one bucket of one key. RANGES takes range partitions for buckets, which bounds
    a task whatever the keys and times. Without it a plain per-key window is used.
    """
    if isinstance(bucket, str):
        ranged = in_ranges(df, [key], order_cols)
        return prior_history(ranged, key, order_cols, outcomes, count_name, F.col("_range")).drop("_range")
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    if bucket is None:
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*", F.count(F.lit(1)).over(w).cast("int").alias(count_name),
            *[F.coalesce(F.sum(src).over(w), F.lit(0)).alias(name)
              for name, src in outcomes.items()])

    srcs = list(outcomes.items())
    b = df.withColumn("_g", F.struct(F.col(key).alias("k"), bucket.alias("b")))
    w_in = Window.partitionBy("_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = b.select(
        "*", F.count(F.lit(1)).over(w_in).alias("_n_loc"),
        *[F.coalesce(F.sum(src).over(w_in), F.lit(0)).alias(f"_s{i}_loc") for i, (_, src) in enumerate(srcs)])
    # bucket totals come from the rows themselves (map-side partial sums), not from the windowed rows
    per_bucket = b.groupBy("_g").agg(
        F.count(F.lit(1)).alias("_n_bk"),
        *[F.coalesce(F.sum(src), F.lit(0)).alias(f"_s{i}_bk") for i, (_, src) in enumerate(srcs)])
    w_b = Window.partitionBy("_g.k").orderBy(F.col("_g.b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "_g", F.coalesce(F.sum("_n_bk").over(w_b), F.lit(0)).alias("_n_off"),
        *[F.coalesce(F.sum(f"_s{i}_bk").over(w_b), F.lit(0)).alias(f"_s{i}_off") for i in range(len(srcs))])
    j = local.join(offsets, "_g")
    return j.select(
        *df.columns,
        (F.col("_n_loc") + F.col("_n_off")).cast("int").alias(count_name),
        *[(F.col(f"_s{i}_loc") + F.col(f"_s{i}_off")).alias(name)
          for i, (name, _) in enumerate(srcs)])


def episode_gaps(df: DataFrame, key: str = "cust_id", date_col: str = "draw_date",
                 tie: str = "loan_id", bucket: Column | str | None = None) -> DataFrame:
    """Days since the key's previous episode (null for the first), two-level like prior_history.

    Inside a (key, bucket) partition `lag` gives the previous row; the first row
    of a bucket takes the date of the last row in the key's nearest earlier
    non-empty bucket (one row per bucket, carried forward over a small table).
    """
    if isinstance(bucket, str):
        return episode_gaps(in_ranges(df, [key], [date_col, tie]), key, date_col, tie, F.col("_range")).drop("_range")
    order = [F.col(date_col).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    if bucket is None:
        w = Window.partitionBy(key).orderBy(*order)
        prev = F.lag(date_col).over(w)
        return df.withColumn("prev_date", prev).withColumn(
            "gap_days", F.datediff(F.col(date_col), F.col("prev_date")))
    b = df.withColumn("_g", F.struct(F.col(key).alias("k"), bucket.alias("b")))
    w_in = Window.partitionBy("_g").orderBy(*order)
    local = b.select("*", F.lag(date_col).over(w_in).alias("_prev_loc"), F.row_number().over(w_in).alias("_at"))
    # the date of the bucket's last row: null dates come last
    last = b.groupBy("_g").agg(F.when(F.count(date_col) == F.count(F.lit(1)), F.max(date_col)).alias("_last"))
    w_b = Window.partitionBy("_g.k").orderBy(F.col("_g.b").asc_nulls_last())
    carry = last.select("_g", F.lag("_last").over(w_b).alias("_prev_bk"))
    j = local.join(carry, "_g")
    prev = F.when(F.col("_at") == 1, F.col("_prev_bk")).otherwise(F.col("_prev_loc"))
    return j.select(*df.columns, prev.alias("prev_date")).withColumn(
        "gap_days", F.datediff(F.col(date_col), F.col("prev_date")))


def episode_gap_check(df: DataFrame, min_days: int = 30, key: str = "cust_id",
                      date_col: str = "draw_date", tie: str = "loan_id",
                      bucket: Column | str | None = None) -> DataFrame:
    """One row: episodes with a predecessor, violations of the minimum gap, smallest gap."""
    g = episode_gaps(df, key, date_col, tie, bucket)
    return g.agg(
        F.count("gap_days").cast("long").alias("n_with_prior"),
        F.count_if(F.col("gap_days") < min_days).cast("long").alias("n_violations"),
        F.min("gap_days").cast("long").alias("min_gap_days"),
        F.count_if(F.col("gap_days") == 0).cast("long").alias("n_same_day"))


#: Sums are kept as decimals in two parts, so that what leaves a window cancels exactly:
#: each value to six places, and what is left of it to 24 places.
HIGH_TYPE, LOW_TYPE = "decimal(28,6)", "decimal(28,24)"
VALUE_LIMIT = 1e22


def _next_of_type(base: DataFrame) -> DataFrame:
    """Adds `_next`: the time of the user's next event of the same type (null for the last one).

    Two-level like prior_history: a lead inside (user, type, range); a range's
    last row takes the first time of the next range that has rows.
    """
    keys = ["_u", "_ty", "_range"]
    b = in_ranges(base, ["_u", "_ty"], ["_t", "_eid"])
    local = b.withColumn("_next_in", F.lead("_t").over(Window.partitionBy(*keys).orderBy("_t", "_eid")))
    firsts = b.groupBy(*keys).agg(F.min("_t").alias("_first"))
    carry = firsts.select(*keys, F.lead("_first").over(Window.partitionBy("_u", "_ty").orderBy("_range")).alias("_next_bk"))
    return local.join(carry, keys, "left").select(*base.columns, F.coalesce("_next_in", "_next_bk").alias("_next"))


def activity_window(events: DataFrame, window_seconds: int = 30 * 86400, user: str = "user_id",
                    ts: str = "ts", event_id: str = "event_id", type_col: str = "event_type",
                    value_col: str = "value", types: Sequence[str] = ()) -> DataFrame:
    """Trailing-window activity per event (W3): for each event at time t, the same
    user's events with t - W <= ts < t (the event itself excluded).

    Sweep formulation: every event contributes +1 at ts and -1 at ts + W, and the
    anchor sums the contributions strictly before it. That is a running sum, run
    with `prior_history` over range partitions of (user, time) plus carried totals,
    so a user owning a large share of events, or one whose events share a day, is
    split across tasks.
    A type is counted as distinct over (ts, min(ts + W, next event of that type)]:
    these intervals never overlap, so their sum is the number of types present,
    for any number of types. `types` only names the types that get a column of
    their own.
    Defined results: null and NaN values count as 0 in the sum, null types are
    events but no type; infinities in a window make its sum infinite (NaN where both
    signs meet); otherwise a finite value of 1e22 or more in size makes the sums of
    the windows that hold it null, because the exact sum could not hold it; what a
    value has beyond 24 places is left out; an event without a user or a time has
    no earlier events and is none for others.
    """
    types = list(types)
    secs = F.unix_micros(F.col(ts).cast("timestamp"))
    w_us = window_seconds * 1_000_000
    v = F.col(value_col).cast("double")
    inf = float("inf")
    v = F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v)
    fits = F.abs(v) < VALUE_LIMIT
    high = F.when(fits, v).otherwise(F.lit(0.0)).cast(HIGH_TYPE)
    low = F.when(fits, v - high.cast("double")).otherwise(F.lit(0.0)).cast(LOW_TYPE)
    base = events.select(F.col(event_id).alias("_eid"), F.col(user).alias("_u"), secs.alias("_t"),
                         F.col(type_col).alias("_ty"), high.alias("_w_v"), low.alias("_w_l"),
                         (v == inf).cast("int").alias("_w_up"), (v == -inf).cast("int").alias("_w_down"),
                         (~fits & (F.abs(v) < inf)).cast("int").alias("_w_big"))
    sums = {"_w_v": HIGH_TYPE, "_w_l": LOW_TYPE, "_w_up": "int", "_w_down": "int", "_w_big": "int"}

    # `_w_d` leaves at the end of the window or at the type's next event, whichever comes first
    known = F.col("_u").isNotNull() & F.col("_t").isNotNull()
    rest = base.where(~known)
    base = stored(_next_of_type(base.where(known)).withColumn(
        "_cut", F.coalesce(F.col("_next") < F.col("_t") + w_us, F.lit(False))), "activity")
    is_type = F.col("_ty").isNotNull().cast("int")
    weights = {"_w_n": F.lit(1)} | {f"_w_t{i}": F.coalesce((F.col("_ty") == t).cast("int"), F.lit(0))
                                    for i, t in enumerate(types)}
    zero = {k: F.lit(0) for k in weights} | {"_w_d": F.lit(0)} | {k: F.lit(0).cast(t) for k, t in sums.items()}

    def rows(frame: DataFrame, time: Column, kind: int, ws: Mapping[str, Column]) -> DataFrame:
        return frame.select("_eid", "_u", time.alias("_time"), F.lit(kind).alias("_kind"),
                            *[(zero | ws)[k].alias(k) for k in zero])
    end = F.col("_t") + w_us
    enter = rows(base, F.col("_t"), 1, weights | {"_w_d": is_type} | {k: F.col(k) for k in sums})
    leave = rows(base, end, 1, {k: -w for k, w in weights.items()} | {
        "_w_d": F.when(F.col("_cut"), F.lit(0)).otherwise(-is_type)} | {k: (-F.col(k)).cast(t) for k, t in sums.items()})
    replaced = rows(base.where("_cut"), F.col("_next"), 1, {"_w_d": -is_type})
    stream = rows(base, F.col("_t"), 0, {}).unionByName(enter).unionByName(leave).unionByName(replaced)
    out = prior_history(stream, key="_u", order_cols=["_time", "_kind", "_eid"],
                        outcomes={f"s{k}": k for k in zero}, count_name="_rows", bucket=RANGES)
    a = out.where(F.col("_kind") == 0)
    cols = ["_eid", "_u", *[f"s{k}" for k in zero]]
    a = a.select(*cols).unionByName(rest.select("_eid", "_u", *[c.alias(f"s{k}") for k, c in zero.items()]))
    type_cols = [F.col(f"s_w_t{i}").cast("long").alias(f"n_{t}_30d") for i, t in enumerate(types)]
    up, down = F.col("s_w_up") > 0, F.col("s_w_down") > 0
    total = (F.when(up & down, F.lit(float("nan"))).when(up, F.lit(inf)).when(down, F.lit(-inf))
              .when(F.col("s_w_big") == 0, F.col("s_w_v").cast("double") + F.col("s_w_l").cast("double")))
    return a.select(F.col("_eid").alias(event_id), F.col("_u").alias(user),
                    F.col("s_w_n").cast("long").alias("n_events_30d"), *type_cols,
                    F.col("s_w_d").cast("long").alias("distinct_types_30d"),
                    total.alias("value_sum_30d"))
