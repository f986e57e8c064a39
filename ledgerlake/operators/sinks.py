"""Keyed sinks (W1-W4) as pure DataFrame functions; `stored.py` keeps their results as tables.

`upsert(target, batch, key, mode)` returns the new table content:

* replace_key : drop every target row whose key occurs in the batch, add the batch
                (delete+insert of the reference);
* merge       : same with a batch unique on the key; `keep_existing` columns keep
                the target's value on a match (inserted_timestamp survives);
* prune_on    : restrict the target side to the batch's [min, max] of a column
                first (one tiny aggregate) so file and partition pruning apply.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hexnum import bucket1000
from .joins import join_keys
from .latest import latest_per_key


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_bounds(batch: DataFrame, col: str):
    """(min, max) of a batch column: one aggregate row, collected as literals."""
    r = batch.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def upsert(target: DataFrame | None, batch: DataFrame, key, mode: str = "replace_key",
           keep_existing: list[str] | None = None, prune_on: str | None = None, order=None, checked: bool = False) -> DataFrame:
    """New content of `target` after applying `batch` by `key` (see module doc).

    A batch that repeats a key is refused, unless `order` says which of its rows counts;
    `checked` says that the caller has seen to that.
    """
    keys = _keys(key)
    if order is not None:
        batch = latest_per_key(batch, keys, order)
    elif not checked and not batch.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch repeats a key of {keys}: name the order that picks one row")
    if target is None:
        return batch
    touched_target = target
    if prune_on is not None:
        lo, hi = key_bounds(batch, prune_on)
        if lo is None:
            return target
        in_range = F.col(prune_on).between(F.lit(lo), F.lit(hi))
        untouched_outside = target.where(~in_range | F.col(prune_on).isNull())
        touched_target = target.where(in_range)
    batch_keys = batch.select(*keys).distinct()
    kept = join_keys(touched_target, batch_keys, keys, "left_anti", null_safe=True)
    incoming = batch
    if mode == "merge" and keep_existing:
        old = touched_target.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in keep_existing])
        incoming = join_keys(batch, old, keys, "left", null_safe=True)
        for c in keep_existing:
            incoming = incoming.withColumn(c, F.coalesce(F.col(f"__old_{c}"), F.col(c))).drop(f"__old_{c}")
    elif mode not in ("replace_key", "merge"):
        raise ValueError(mode)
    out = kept.unionByName(incoming.select(*[c for c in incoming.columns]), allowMissingColumns=True)
    if prune_on is not None:
        out = untouched_outside.unionByName(out, allowMissingColumns=True)
    return out


def add_buckets(df: DataFrame, col: str = "block_number", name: str = "partition_key") -> DataFrame:
    """Thousand-block bucket used as the physical partition column."""
    return df.withColumn(name, bucket1000(col).cast("bigint")) if name not in df.columns else df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_within: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write parquet; with partition columns only the touched partitions are replaced."""
    w = df
    if sort_within:
        w = w.sortWithinPartitions(*sort_within)
    writer = w.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
