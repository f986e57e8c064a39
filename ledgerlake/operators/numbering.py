"""Row numbering that survives skew (N6, N7, Q7 helpers).

`row_number() OVER (PARTITION BY g ORDER BY o)` puts a whole group in one task.
That is fine while groups are bounded (a transaction's call tree, a block's
transactions) but not when one group may hold a third of the table. Two forms:

* window : the plain window (one hash shuffle + sort), for bounded groups;
* split  : a global range sort on (g, o) splits any group over many tasks; every
           row gets its global position (partition offset + position inside the
           partition), and the group's first position is subtracted. Offsets are
           one row per shuffle partition (a proven bound, safe to broadcast); the
           per-group minimum is a partial aggregate joined back, which AQE plans
           as a broadcast when small or a skew-split sort-merge join otherwise.

The split form is the default at every size; callers name the window where groups are bounded by nature.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .joins import join_keys
from .latest import sort_columns


def _n_parts(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_position(df: DataFrame, order, name: str = "row_num", n: int | None = None,
                    start: int = 1) -> DataFrame:
    """Number all rows by `order` without a single-task window: one range shuffle."""
    sort = sort_columns(order)
    parts = _n_parts(df, n)
    s = (df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_lpos", F.monotonically_increasing_id()
                     - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    # range bounds come from sampling and the id from row order: materialise the
    # tagged rows once (stored, compressed) so counts and rows agree exactly
    s = store(s, "numbered")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: the running offset is a tiny single-task window
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0))).select("_pid", "_off")
    return (s.join(F.broadcast(offs), "_pid")
            .select(*df.columns, (F.col("_off") + F.col("_lpos") + F.lit(start)).alias(name)))


def number_within(df: DataFrame, group: list[str], order, name: str = "row_num", mode: str = "split",
                  start: int = 1, n: int | None = None) -> DataFrame:
    """row_number() per group, `start`-based; mode "window" for groups that are bounded by nature."""
    group = [group] if isinstance(group, str) else list(group)
    if mode == "window":
        w = Window.partitionBy(*group).orderBy(*sort_columns(order))
        return df.withColumn(name, F.row_number().over(w) + F.lit(start - 1))
    if mode != "split":
        raise ValueError(mode)
    order_terms = [f"{g} asc nulls first" for g in group] + ([order] if isinstance(order, str) else list(order))
    pos = global_position(df, order_terms, "_gpos", n=n, start=0)
    first = pos.groupBy(*group).agg(F.min("_gpos").alias("_gmin"))
    return (join_keys(pos, first, group, "inner", null_safe=True)
            .select(*df.columns, (F.col("_gpos") - F.col("_gmin") + F.lit(start)).alias(name)))


def with_lag(df: DataFrame, group: list[str], order_col: str, name: str, mode: str = "split") -> DataFrame:
    """Previous value of `order_col` inside the group, via numbering + self join."""
    numbered = number_within(df, group, [f"{order_col} asc"], "_i", mode=mode)
    prev = numbered.select(*group, (F.col("_i") + 1).alias("_i"), F.col(order_col).alias(name))
    return join_keys(numbered, prev, [*group, "_i"], "left", null_safe=True).drop("_i")
