"""Registry of named queries: a Spark callable and (optionally) its DuckDB oracle SQL."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prims import round_dp


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, sql, note)
        return fn
    return deco


def normalize(df: DataFrame, dp: int = 6) -> DataFrame:
    """Output normalisation shared with the oracle: doubles rounded, dates as ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_dp(c.cast("double"), dp).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
