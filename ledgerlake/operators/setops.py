"""Unions, differences and the remaining join shapes."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import join_keys


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def anti(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows of df whose key is absent from other (NOT EXISTS)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return join_keys(df, other.select(*keys), keys, "left_anti")


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """SQL `key NOT IN (SELECT key FROM other)`: a NULL on either side excludes.

    The "other has a NULL" fact is a one-row aggregate evaluated as a scalar
    subquery inside the same plan, not collected to the driver.
    """
    has_null = other.agg(F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).scalar()
    kept = anti(df.where(F.col(key).isNotNull()), other.where(F.col(key).isNotNull()), key)
    return kept.where(has_null == 0)


def with_constants(df: DataFrame, rows: list[dict]) -> DataFrame:
    """Each row of df once per constant row (J8: the 3 selector reads).

    Written as an explode of a literal array, so no join is planned at all.
    """
    names = list(rows[0])
    arr = F.array(*[F.struct(*[F.lit(r[n]).alias(n) for n in names]) for r in rows])
    return df.select("*", F.inline(arr))


def full_outer_norm(a: DataFrame, b: DataFrame, key_a: str, key_b: str, norm=F.lower) -> DataFrame:
    """Full outer join on normalised keys (J9); both original key columns kept."""
    la = a.withColumn("__ka", norm(F.col(key_a)))
    lb = b.withColumn("__kb", norm(F.col(key_b)))
    return la.join(lb, la["__ka"] == lb["__kb"], "full_outer").drop("__ka", "__kb")


def spine_join(spine: DataFrame, frames: list[DataFrame], key: str) -> DataFrame:
    """Distinct key spine, then one left join per frame."""
    out = spine.select(key).distinct()
    for f in frames:
        out = join_keys(out, f, [key], "left")
    return out


def reemit_groups(target: DataFrame, keys_df: DataFrame, key: str) -> DataFrame:
    """Whole target groups whose key occurs in keys_df (J13): a semi join."""
    return join_keys(target, keys_df.select(key), [key], "left_semi")


def run_if_any(df: DataFrame, fn):
    """Skip work when the batch is empty."""
    return None if df.isEmpty() else fn(df)


def in_list(col, values) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isin(list(values))
