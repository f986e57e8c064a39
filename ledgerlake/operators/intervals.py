"""Sets of numbers as runs (lo, hi): ledgers and spines of a billion numbers without a billion rows.

A ledger of block numbers is nearly one run, so what is missing is found by interval difference and
numbers are generated for the gaps alone.

* `number_runs` packs numbers into one bitmap per stretch of 32,768 (combined before the shuffle),
  reads runs off the bitmaps and joins runs that meet;
* `subtract_runs` cuts both sides at multiples of `STRETCH`, so that a group of the comparison holds no
  more than half a stretch of runs a side, however long or dense the sets are;
* `newest_numbers` takes the n largest from the n last runs at most.

Runs are inclusive on both ends and, within one frame, disjoint. Null numbers take no part.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS = "lo bigint, hi bigint"
STRETCH = 1 << 20
_BITS = 32_768  # numbers of one of Spark's bitmaps


def _read_bitmaps(batches):
    for b in batches:
        los, his = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k, raw in zip(b.column("k").to_pylist(), b.column("bits").to_pylist()):
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
            edge = np.diff(np.concatenate([[0], bits, [0]]).astype(np.int8))
            los.append(np.flatnonzero(edge == 1) + k * _BITS)
            his.append(np.flatnonzero(edge == -1) - 1 + k * _BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(los)), pa.array(np.concatenate(his))], names=["lo", "hi"])


def number_runs(df: DataFrame, col: str) -> DataFrame:
    """The numbers of a column as merged runs; repeated numbers count once."""
    n = F.col(col).cast("bigint")
    maps = (df.where(n.isNotNull()).select(F.floor(n / _BITS).alias("k"), F.pmod(n, F.lit(_BITS)).alias("bit"))
            .groupBy("k").agg(F.bitmap_construct_agg("bit").alias("bits")))
    return merge_runs(maps.mapInArrow(_read_bitmaps, RUNS))


def _join_in_order(batches):
    """Runs of one partition in order of lo -> merged runs, the first and last of them marked as edges."""
    first = last = None
    for b in batches:
        lo, hi = b.column("lo").to_numpy(), b.column("hi").to_numpy()
        if last is not None:
            lo, hi = np.concatenate([[last[0]], lo]), np.concatenate([[last[1]], hi])
        if not len(lo):
            continue
        reach = np.maximum.accumulate(hi)
        new = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1] + 1]))
        los, his = lo[new], reach[np.append(new[1:] - 1, len(lo) - 1)]
        last = (los[-1], his[-1])
        if first is None and len(los) > 1:
            first = (los[0], his[0])
            yield _runs([first[0]], [first[1]], True)
            los, his = los[1:], his[1:]
        if len(los) > 1:
            yield _runs(los[:-1], his[:-1], False)
    if last is not None:
        yield _runs([last[0]], [last[1]], True)


def _runs(lo, hi, edge: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(lo, np.int64)), pa.array(np.asarray(hi, np.int64)),
                                       pa.array(np.full(len(lo), edge))], names=["lo", "hi", "edge"])


def merge_runs(runs: DataFrame) -> DataFrame:
    """Runs that overlap or meet made one. One range shuffle; only the edges of partitions, two a partition, meet in one task."""
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = (runs.where("hi >= lo").repartitionByRange(n, "lo").sortWithinPartitions("lo", "hi")
             .mapInArrow(_join_in_order, f"{RUNS}, edge boolean").checkpoint())
    w = Window.orderBy("lo", "hi")
    edges = parts.where("edge").withColumn("reach", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    edges = edges.withColumn("g", F.sum(F.when(F.col("lo") <= F.col("reach") + 1, 0).otherwise(1)).over(w))
    joined = edges.groupBy("g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", "hi")
    return parts.where("not edge").select("lo", "hi").union(joined)


def _cut(runs: DataFrame, stretch: int) -> DataFrame:
    at = F.explode(F.sequence(F.floor(F.col("lo") / stretch), F.floor(F.col("hi") / stretch))).alias("k")
    return runs.where("hi >= lo").select("lo", "hi", at).select(
        "k", F.greatest("lo", F.col("k") * stretch).alias("lo"), F.least("hi", (F.col("k") + 1) * stretch - 1).alias("hi"))


def _difference(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Runs of a less those of b, within one stretch: the starts and ends of both, swept once."""
    n, m = len(a), len(b)
    at = np.concatenate([a["lo"], a["hi"] + 1, b["lo"], b["hi"] + 1]).astype(np.int64)
    in_a = np.concatenate([np.ones(n, int), -np.ones(n, int), np.zeros(2 * m, int)])
    in_b = np.concatenate([np.zeros(2 * n, int), np.ones(m, int), -np.ones(m, int)])
    order = np.argsort(at, kind="stable")
    at, only = at[order], (np.cumsum(in_a[order]) > 0) & (np.cumsum(in_b[order]) == 0)
    if not len(at):
        return pd.DataFrame({"lo": at, "hi": at})
    settled = np.append(at[1:] != at[:-1], True)  # what holds after the last event at a place
    at, only = at[settled], only[settled]
    lo = at[:-1][only[:-1]]
    return pd.DataFrame({"lo": lo, "hi": at[1:][only[:-1]] - 1})


def subtract_runs(a: DataFrame, b: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The numbers of `a` that are not in `b`, as runs (cut at multiples of `stretch`; see merge_runs)."""
    left, right = _cut(a, stretch), _cut(b, stretch)
    return left.groupBy("k").cogroup(right.groupBy("k")).applyInPandas(_difference, RUNS)


def numbers(runs: DataFrame, name: str = "block_number") -> DataFrame:
    """One row per number of the runs."""
    return runs.where("hi >= lo").select(F.explode(F.sequence("lo", "hi")).alias(name))


def newest_numbers(runs: DataFrame, n: int | None, name: str = "block_number") -> DataFrame:
    """The n largest numbers of disjoint runs; None takes all. Every run holds a number, so the n last runs suffice."""
    if n is None:
        return numbers(runs, name)
    last = runs.where("hi >= lo").orderBy(F.col("hi").desc()).limit(n)
    before = F.coalesce(F.sum(F.col("hi") - F.col("lo") + 1).over(
        Window.orderBy(F.col("hi").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # n rows at most
    cut = last.withColumn("_left", F.lit(n) - before).where("_left > 0")
    return numbers(cut.select(F.greatest("lo", F.col("hi") - F.col("_left") + 1).alias("lo"), "hi"), name)


def count_numbers(runs: DataFrame) -> DataFrame:
    """One row: how many numbers the runs hold."""
    return runs.where("hi >= lo").agg(F.coalesce(F.sum(F.col("hi") - F.col("lo") + 1), F.lit(0)).alias("n"))


def one_run(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    return spark.range(1).select(F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi"))


def ledger_backlog(spine: DataFrame, ledger: DataFrame, cap: int | None, name: str = "block_number") -> DataFrame:
    """The `cap` newest numbers of the spine's runs that the ledger's runs lack (T6, L1), or all of them."""
    return newest_numbers(subtract_runs(spine, ledger), cap, name)
