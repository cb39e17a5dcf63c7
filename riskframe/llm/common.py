"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskframe.session import scratch_path

#: Rows per Arrow batch: long texts make default batches of 10,000 rows too large for a worker.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from whatever store holds it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of one Arrow batch by its row count."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage with columns kept prunable. A lost executor costs nothing
    that is already written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The named columns of an Arrow batch as Python tuples, row by row."""
    return zip(*(batch.column(n).to_pylist() for n in names))


def own_names(operate: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return the columns of `docs` (their first argument): working columns start
    with `__`, so columns of the caller that do so get other names meanwhile, and theirs back after."""
    @functools.wraps(operate)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        taken, theirs = {c.lower() for c in docs.columns}, {}
        for c in docs.columns:
            if c.startswith("__"):
                name = f"c{len(theirs)}"
                while name in taken:
                    name += "_"
                taken.add(name)
                theirs[c] = name
        out = operate(docs.withColumnsRenamed(theirs), *args, **kwargs)
        return out.withColumnsRenamed({name: c for c, name in theirs.items()})

    return run
