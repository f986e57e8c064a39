"""Join helpers that stay unambiguous on self-joins."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, on: dict | list, how: str = "inner",
              null_safe: bool = False) -> DataFrame:
    """Equi-join with `on` = [names] or {left_name: right_name}; right key columns are dropped.

    The right side is re-projected with private names first, so joining a frame
    with one derived from it (a self join) never resolves to the wrong side.
    """
    pairs = list(on.items()) if isinstance(on, dict) else [(k, k) for k in on]
    rkeys = {r for _, r in pairs}
    renamed = right.select(*[F.col(r).alias(f"__r{i}") for i, (_, r) in enumerate(pairs)],
                           *[F.col(c) for c in right.columns if c not in rkeys])
    cond = None
    for i, (lk, _) in enumerate(pairs):
        c = left[lk].eqNullSafe(renamed[f"__r{i}"]) if null_safe else left[lk] == renamed[f"__r{i}"]
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    if how in ("full", "full_outer", "outer", "fullouter", "right", "right_outer"):
        # the key of a row found only on the right lives in the right column
        for i, (lk, _) in enumerate(pairs):
            out = out.withColumn(lk, F.coalesce(left[lk], F.col(f"__r{i}")))
    return out.drop(*[f"__r{i}" for i in range(len(pairs))])


def lookup(df: DataFrame, parent: DataFrame, on, cols: list[str] | None = None,
           parent_filter=None) -> DataFrame:
    """Left join fact -> parent (J1-J3, J11): optional pre-filter on the parent only,
    which equals the reference's extra ON condition on the right side."""
    if parent_filter is not None:
        parent = parent.where(parent_filter)
    keys = list(on.values()) if isinstance(on, dict) else list(on)
    if cols is not None:
        parent = parent.select(*keys, *[c for c in cols if c not in keys])
    return join_keys(df, parent, on, "left")
