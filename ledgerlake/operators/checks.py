"""Data-quality checks (Q1-Q14): each returns the failing rows as a DataFrame.

A suite passes when every check returns no rows (or fewer than its threshold);
`evaluate` turns a failure frame into a verdict with one count.
"""
from __future__ import annotations

import datetime as dt
import operator
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import lit_ts
from .joins import join_keys


def _where(df: DataFrame, where) -> DataFrame:
    return df if where is None else df.where(where)


def not_null(df: DataFrame, col: str, where=None) -> DataFrame:
    return _where(df, where).where(F.col(col).isNull())


def unique_on(df: DataFrame, cols) -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def type_in(df: DataFrame, col: str, types: list[str]) -> DataFrame:
    """Metadata check: one failing row when the column type is not in the list."""
    spark = df.sparkSession
    actual = df.schema[col].dataType.simpleString()
    bad = not any(actual.lower().startswith(t.lower()) for t in types)
    return spark.createDataFrame([(col, actual)] if bad else [], "column_name string, data_type string")


def matches(df: DataFrame, col: str, regex: str, where=None) -> DataFrame:
    """Rows whose value has no match of the (unanchored) regex; NULL passes."""
    return _where(df, where).where(~F.col(col).rlike(regex))


def fresh(df: DataFrame, ts: str, now: dt.datetime, within: dt.timedelta) -> DataFrame:
    """One failing row when the newest value is older than now - within (or no rows)."""
    newest = df.agg(F.max(ts).alias("newest"))
    return newest.where(F.col("newest").isNull() | (F.col("newest") < lit_ts(now - within)))


GAP_BUCKET = 100_000


def sequence_gaps(df: DataFrame, col: str, partition_by: list[str] | None = None, where=None,
                  bucket: int = GAP_BUCKET) -> DataFrame:
    """Adjacent distinct values (per partition) that differ by more than 1.

    Values are compared inside buckets of `bucket` consecutive numbers, which bounds every
    window whatever one partition holds; then the ends of neighbouring buckets are compared,
    one row per bucket. One shuffle serves the distinct values and the windows.
    Output: partition..., <col>_previous, <col>, gap (count of missing values).
    """
    p = list(partition_by or [])
    v = F.col("_v")
    vals = (_where(df, where).where(F.col(col).isNotNull())
            .select(*p, F.col(col).alias("_v"), F.floor(F.col(col) / F.lit(bucket)).alias("_b"))
            .repartition(*p, "_b").dropDuplicates([*p, "_b", "_v"]))
    inside = Window.partitionBy(*p, "_b").orderBy("_v")
    near = vals.withColumn("_prev", F.lag("_v").over(inside)).where(v - F.col("_prev") > 1)
    ends = vals.groupBy(*p, "_b").agg(F.min("_v").alias("_v"), F.max("_v").alias("_hi"))
    across = Window.partitionBy(*p).orderBy("_b")
    far = ends.withColumn("_prev", F.lag("_hi").over(across)).where(v - F.col("_prev") > 1)
    return near.select(*p, "_prev", "_v").union(far.select(*p, "_prev", "_v")).select(
        *p, F.col("_prev").alias(f"{col}_previous"), v.alias(col), (v - F.col("_prev") - 1).alias("gap"))


def counts_match(children: DataFrame, parents: DataFrame, key: str, expected: str) -> DataFrame:
    """Parents whose child count differs from their declared count (Q8)."""
    got = children.groupBy(key).agg(F.count(F.lit(1)).alias("actual"))
    j = join_keys(parents.select(key, F.col(expected).alias("expected")), got, [key], "full_outer")
    return j.where(~F.coalesce(F.col("expected"), F.lit(0)).eqNullSafe(F.coalesce(F.col("actual"), F.lit(0))))


def orphans(child: DataFrame, parent: DataFrame, keys) -> DataFrame:
    """Child rows without a parent (Q9)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return join_keys(child, parent.select(*keys).distinct(), keys, "left_anti")


def childless(parent: DataFrame, child: DataFrame, keys) -> DataFrame:
    """Parent rows without any child (Q10)."""
    return orphans(parent, child, keys)


def one_parent(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Keys seen under more than one parent (Q11)."""
    return (df.select(key, parent).distinct().groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_parents")).where("n_parents > 1"))


_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "!=": operator.ne, "<>": operator.ne, "=": operator.eq, "==": operator.eq}


def evaluate(failures: DataFrame, error_if: str = "!=0") -> dict:
    """{'failures': n, 'status': 'error'|'pass'} with a threshold like '>10' (Q12)."""
    return judge(failures.count(), error_if)


def judge(n: int, error_if: str = "!=0") -> dict:
    """The same for a number of failures that is known."""
    m = re.match(r"^\s*(>=|<=|!=|<>|==|=|>|<)\s*(\d+)\s*$", error_if)
    if not m:
        raise ValueError(error_if)
    return {"failures": n, "status": "error" if _OPS[m.group(1)](n, int(m.group(2))) else "pass"}


def store_failures(failures: DataFrame, path: str) -> None:
    """Keep failing rows for inspection (Q13)."""
    failures.write.mode("overwrite").parquet(path)


def scope(df: DataFrame, kind: str, boundary: int | None = None, col: str = "block_number") -> DataFrame:
    """'full' or 'recent' (after the lookback block) test scope."""
    if kind == "full":
        return df
    if kind == "recent":
        return df.where(F.col(col) > F.lit(boundary or 0))
    raise ValueError(kind)
