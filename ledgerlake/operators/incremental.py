"""Incremental reads, healing and running counters.

High-water marks are evaluated first and passed on as *literals*, so Catalyst
pushes them into the parquet scan (row-group and partition pruning) instead of
planning a scalar subquery per run.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import lit_ts
from .joins import join_keys
from .latest import latest_per_key
from .stored import read_keys, read_table, upsert_table, version_info

EPOCH = dt.datetime(1970, 1, 1)


def high_water(target: DataFrame | None, col: str, default=EPOCH):
    """COALESCE(MAX(col), default) of the target, as a Python value (one row)."""
    if target is None:
        return default
    v = target.agg(F.max(col).alias("m")).first()["m"]
    return default if v is None else v


def since(df: DataFrame, col: str, mark, inclusive: bool = True, overlap: dt.timedelta | None = None,
          day_floor: bool = False) -> DataFrame:
    """Rows newer than `mark` (minus `overlap`; `day_floor`: date(mark) - overlap days)."""
    if mark is None:
        return df
    m = mark
    if day_floor and isinstance(m, dt.datetime):
        m = dt.datetime(m.year, m.month, m.day)
    if overlap is not None:
        m = m - overlap
    c = F.col(col)
    lit = lit_ts(m) if isinstance(m, dt.datetime) else F.lit(m)
    return df.where(c >= lit if inclusive else c > lit)


def heal(target: DataFrame, is_missing: Column, refill) -> DataFrame:
    """Re-emit target rows whose lookups were missing, re-joined now.

    `refill(rows) -> DataFrame` recomputes the looked-up columns for the rows
    (typically `lookup` joins); the result replaces those rows through the
    winner rule of the caller (N3/N4) and a keyed upsert.
    """
    return refill(target.where(is_missing))


def union_new_and_healed(new: DataFrame, healed: DataFrame | None, keys, order) -> DataFrame:
    """UNION ALL of new and healed rows, one winner per key (U1 + N3/N4)."""
    allrows = new if healed is None else new.unionByName(healed, allowMissingColumns=True)
    return latest_per_key(allrows, keys, order)


def add_totals(prev: DataFrame | None, batch: DataFrame, key: str, counts: list[str],
               latest: dict[str, str] | None = None) -> DataFrame:
    """Running totals (A8/T5): previous total + batch count per key.

    `counts` are summed; `latest` maps output columns to batch columns combined
    with GREATEST (the reference takes the batch value; a maximum cannot go back).
    Both sides are one row per key, so this is a keyed full outer join.
    """
    latest = latest or {}
    if prev is None:
        return batch.select(key, *counts, *latest.keys())
    p = prev.select(key, *[F.col(c).alias(f"__p_{c}") for c in [*counts, *latest.keys()]])
    j = join_keys(batch.select(key, *counts, *latest.keys()), p, [key], "full_outer")
    out = [F.col(key)]
    for c in counts:
        out.append((F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"__p_{c}"), F.lit(0))).alias(c))
    for c in latest:
        out.append(F.greatest(F.col(c), F.col(f"__p_{c}")).alias(c))
    return j.select(*out)


def count_once(spark: SparkSession, path: str, batch: DataFrame, key: str, counts: list[str], latest: dict[str, str] | None = None, *,
               run_id: str, buckets: int = 64) -> DataFrame:
    """Running totals kept as a stored table; a run is counted exactly once, however often it is repeated.

    The run id goes into the version that holds its totals, in one step: a run that died before
    is counted when it is repeated, one that was complete changes nothing. Only the totals of
    the batch's keys are read and written.
    """
    info = version_info(spark, path)
    if info is None or run_id not in info["applied"]:
        totals = add_totals(read_keys(spark, path, batch, key), batch, key, counts, latest)
        totals = totals.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        upsert_table(spark, path, totals, key, "bucket", run_id=run_id)
    return read_table(spark, path).drop("bucket")
