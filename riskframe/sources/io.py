"""Episode readers and writers.

Readers always use an explicit schema (no inference pass over the data) and
normalise NaN to null once (K1), so every operator downstream deals with
null only. Writers produce Parquet keyed by loan_id, optionally partitioned
by a low-cardinality column (split, draw month) so later filters prune files.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.prims import clean_nan
from ..session import path_exists, stored

_INT = T.IntegerType()
_DBL = T.DoubleType()

EPISODE_SCHEMA = T.StructType(
    [T.StructField("loan_id", T.LongType()), T.StructField("cust_id", T.LongType()),
     T.StructField("draw_date", T.DateType()), T.StructField("county", T.StringType()),
     T.StructField("channel", T.StringType()), T.StructField("product_code", T.StringType())]
    + [T.StructField(c, _INT if c in C.INT_FEATURES else _DBL) for c in C.RAW_FEATURE_COLUMNS]
    + [T.StructField(C.TARGET_COL, _INT)])

FEATURE_SCHEMA = T.StructType(
    [T.StructField("loan_id", T.LongType())]
    + [T.StructField(c, _INT if c in C.INT_FEATURES else _DBL) for c in C.FEATURE_COLUMNS]
    + [T.StructField(C.TARGET_COL, _INT)])


def read_episodes(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType = EPISODE_SCHEMA) -> DataFrame:
    """Scan an episode table (CSV with header, or Parquet) with the explicit schema + K1."""
    if fmt == "csv":
        df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    else:
        df = spark.read.schema(schema).parquet(path)
    return clean_nan(df)


def read_episodes_checked(spark: SparkSession, path: str,
                          schema: T.StructType = EPISODE_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a CSV with header, from one pass over the files.

    A row whose fields don't parse as the schema's types, or that has too few or too
    many of them, is bad whole: (source_file, record) with the line as read. `good`
    has the schema's columns (K1 applied); an empty field is null and not bad. A
    header that names other columns raises. The parsed rows are written first: read
    with fewer columns, the parser would not look at the others and miss their faults.
    """
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = (spark.read.schema(marked).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)
            .select("*", F.col("_metadata.file_path").alias("_source_file")))
    parsed = stored(rows, "csv-rows")
    bad = F.col("_corrupt_record").isNotNull()
    return (clean_nan(parsed.where(~bad).select(*schema.names)),
            parsed.where(bad).select(F.col("_source_file").alias("source_file"), F.col("_corrupt_record").alias("record")))


def quarantine_csv(spark: SparkSession, path: str, out: str, schema: T.StructType = EPISODE_SCHEMA) -> DataFrame:
    """Write the good rows of a CSV to `out`/good and the bad ones to `out`/bad.

    Returns one row: n_good, n_bad and bad_share (null without rows).
    """
    for name, rows in zip(("good", "bad"), read_episodes_checked(spark, path, schema)):
        write_table(rows, f"{out}/{name}")
    counts = [spark.read.parquet(f"{out}/{name}").agg(F.count(F.lit(1)).alias(f"n_{name}")) for name in ("good", "bad")]
    return counts[0].crossJoin(counts[1]).withColumn(
        "bad_share", F.try_divide(F.col("n_bad").cast("double"), F.col("n_good") + F.col("n_bad")))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Scan a feature table, projecting key + 20 features + target (pruned at the scan)."""
    return clean_nan(spark.read.parquet(path).select("loan_id", *C.FEATURE_COLUMNS, C.TARGET_COL))


def read_metadata(spark: SparkSession, path: str) -> DataFrame | None:
    """Optional metadata table; None when absent (callers then fall back, e.g. in splitting)."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


PROFILE_SCHEMA = "feature string, edges array<double>, n_ref bigint, ref_n array<bigint>"


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """A reference profile saved with `write_table` (see `operators.drift.reference_profile`)."""
    return spark.read.schema(PROFILE_SCHEMA).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """Write a result table; partitioning by a low-cardinality column enables pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "json":
        w.json(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_report_json(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved JSON report back (one JSON object per line)."""
    return spark.read.json(path)


def drift_columns(df: DataFrame, target: str = C.TARGET_COL) -> list[str]:
    """Columns compared by the drift job: every column except the target."""
    return [c for c in df.columns if c != target]


def with_month(df: DataFrame, date_col: str = C.DATE_COL) -> DataFrame:
    return df.withColumn("draw_month", F.date_format(F.col(date_col), "yyyy-MM"))
