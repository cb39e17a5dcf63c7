"""Isotonic calibration by parallel pool-adjacent-violators (M3).

The fit starts from the distinct-score table (K4). Scores are dealt into ranges;
each range pools its own adjacent violators in one sorted pass, and the blocks of
FAN_IN neighbouring ranges are pooled again until one range is left. Pooling in
any order gives the same blocks, so the result is that of one pass over all
scores. Means are compared by cross-multiplied integers, and equal neighbours are
pooled, so blocks are unique. Labels of 0 and 1 bound what the last task reads:
blocks of one range have different rates pos/n that add up to its rows, and there
are at most of the order of rows^(2/3) of them, whatever the scores are.

A calibrator is a table of tiles of at most TILE blocks. A score inside a block
takes the block's rate, one between two blocks is interpolated, one beyond the
ends takes the end's rate. No part of it is held by the driver but the first score
of each tile.

Defined results: rows without a score (null, NaN) or a label teach nothing; a null
or NaN score is calibrated to null; a table without usable rows gives a calibrator
without blocks, which calibrates every score to null.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prims import bin_index, score_hist, with_bin_index
from ..session import stored

FAN_IN = 8
#: Blocks per tile: what a row is searched in once its tile is known.
TILE = 1024
#: Tiles that are broadcast (24 KB each); more are joined on their number.
BROADCAST_TILES = 256

BLOCKS = "x_lo double, x_hi double, pos long, n long"
TILES = "tile int, lo array<double>, hi array<double>, pos array<long>, n array<long>, next_lo double, next_rate double"


def _pooled(batches: Iterable[pa.RecordBatch]) -> list[list]:
    """The blocks of rows that come in order of x_lo, as columns."""
    lo, hi, pos, n = [], [], [], []
    for b in batches:
        for a, z, p, w in zip(*(b.column(c).to_pylist() for c in ("x_lo", "x_hi", "pos", "n"))):
            while n and pos[-1] * w >= p * n[-1]:
                a, p, w = lo.pop(), p + pos.pop(), w + n.pop()
                hi.pop()
            lo.append(a)
            hi.append(z)
            pos.append(p)
            n.append(w)
    return [lo, hi, pos, n]


def _as_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cols = _pooled(batches)
    for i in range(0, len(cols[0]), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 10_000], t) for c, t in zip(
            cols, (pa.float64(), pa.float64(), pa.int64(), pa.int64()))], names=["x_lo", "x_hi", "pos", "n"])


def _as_tiles(size: int):
    def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi, pos, n = _pooled(batches)
        for t, i in enumerate(range(0, len(lo), size)):
            j = i + size
            after = (lo[j], pos[j] / n[j]) if j < len(lo) else (None, None)
            row = [t, lo[i:j], hi[i:j], pos[i:j], n[i:j], *after]
            kinds = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                             names=["tile", "lo", "hi", "pos", "n", "next_lo", "next_rate"])
    return tiles


@dataclass
class IsotonicTable:
    """A fitted calibrator: its tiles, the first score of each and the blocks of the largest."""
    tiles: DataFrame
    starts: list[float]
    width: int

    @classmethod
    def of(cls, tiles: DataFrame) -> IsotonicTable:
        rows = tiles.select("tile", F.col("lo")[0].alias("a"), F.size("lo").alias("n")).orderBy("tile").collect()   # one row per tile
        return cls(tiles, [r.a for r in rows], max((r.n for r in rows), default=0))

    def blocks(self) -> DataFrame:
        """(x_lo, x_hi, pos, n, rate): one row per block of equal rate."""
        return self.tiles.select(F.explode(F.arrays_zip("lo", "hi", "pos", "n")).alias("b")).select(
            F.col("b.lo").alias("x_lo"), F.col("b.hi").alias("x_hi"), "b.pos", "b.n", (F.col("b.pos") / F.col("b.n")).alias("rate"))

    def transform(self, df: DataFrame, raw: str, out: str) -> DataFrame:
        """`df` plus `out`, the calibrated `raw`; works on batch and streaming frames."""
        keep = [F.col(f"`{c}`") for c in df.columns]
        if not self.starts:
            return df.select(*keep, F.lit(None).cast("double").alias(out))
        x = F.nanvl(F.col(f"`{raw}`").cast("double"), F.lit(None).cast("double"))
        d = df.withColumn("__x", x)
        tile = F.lit(0) if len(self.starts) == 1 else F.greatest(F.lit(0), bin_index(
            F.col("__x"), F.lit(self.starts), len(self.starts)) - 1)
        t = self.tiles.select(F.col("tile").alias("__tile"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                              F.zip_with("pos", "n", lambda p, n: p / n).alias("__rate"),
                              F.col("next_lo").alias("__next_lo"), F.col("next_rate").alias("__next_rate"))
        t = F.broadcast(t) if len(self.starts) <= BROADCAST_TILES else t
        d = d.withColumn("__tile", F.when(F.col("__x").isNotNull(), tile)).join(t, "__tile", "left")
        d = with_bin_index(d, "__x", "__lo", self.width, "__at")
        i, v = F.col("__at"), F.col("__x")
        a, ya = F.try_element_at("__hi", i), F.try_element_at("__rate", i)
        b = F.coalesce(F.try_element_at("__lo", i + 1), "__next_lo")
        yb = F.coalesce(F.try_element_at("__rate", i + 1), "__next_rate")
        y = (F.when(v.isNull(), F.lit(None).cast("double")).when(i == 0, F.element_at("__rate", 1))
             .when((v <= a) | b.isNull(), ya).otherwise(ya + (yb - ya) * (v - a) / (b - a)))
        return d.select(*keep, y.alias(out))

    def save(self, path: str) -> None:
        self.tiles.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsotonicTable:
        return cls.of(spark.read.schema(TILES).parquet(path))


def fit_isotonic(scored: DataFrame, raw: str = "raw_score", label: str = "label", ranges: int | None = None,
                 size: int = TILE) -> IsotonicTable:
    """Calibrator of `scored` rows: non-decreasing rates of `label` over `raw`, nearest in squares.

    `ranges` (by default the session's shuffle partitions) is where pooling starts.
    """
    spark = scored.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = F.nanvl(F.col(f"`{raw}`").cast("double"), F.lit(None).cast("double"))
    blocks = score_hist(scored.select(x.alias("x_lo"), F.col(f"`{label}`").alias("y")), "x_lo", "y").select(
        "x_lo", F.col("x_lo").alias("x_hi"), "pos", "n")

    def ordered(n: int) -> DataFrame:
        return blocks.repartitionByRange(n, "x_lo").sortWithinPartitions("x_lo")
    while ranges > 1:
        blocks = stored(ordered(ranges).mapInArrow(_as_blocks, BLOCKS), "isotonic")
        ranges = -(-ranges // FAN_IN)
    return IsotonicTable.of(stored(ordered(1).mapInArrow(_as_tiles(size), TILES), "isotonic"))
