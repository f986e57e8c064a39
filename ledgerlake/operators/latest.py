"""Latest record per key.

`row_number() = 1` over a window. Spark plans it with a group limit before the
shuffle (one candidate per key and input partition goes on), so a key that holds
a third of the rows costs no more than any other, and one sort after it.

Order terms are strings: "col", "col desc", "col desc nulls last", ...
Defaults follow the reference dialect: DESC puts NULLs first, ASC puts them last.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TERM = re.compile(r"^\s*(?P<col>[^\s]+)(?:\s+(?P<dir>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?\s*$", re.I)

_ORDERABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BinaryType)


def parse_order(terms) -> list[tuple[str, bool, bool]]:
    """-> [(column, descending, nulls_first)]"""
    out = []
    for t in ([terms] if isinstance(terms, str) else terms):
        if isinstance(t, tuple):
            col, desc, nulls_first = t
        else:
            m = _TERM.match(t)
            if not m:
                raise ValueError(f"bad order term {t!r}")
            col = m.group("col")
            desc = (m.group("dir") or "asc").lower() == "desc"
            nf = m.group("nulls")
            nulls_first = desc if nf is None else nf.lower() == "first"
        out.append((col, desc, nulls_first))
    return out


def sort_columns(terms) -> list[Column]:
    cols = []
    for c, desc, nf in parse_order(terms):
        col = F.col(c)
        if desc:
            cols.append(col.desc_nulls_first() if nf else col.desc_nulls_last())
        else:
            cols.append(col.asc_nulls_first() if nf else col.asc_nulls_last())
    return cols


def latest_per_key(df: DataFrame, keys, order, tiebreak: str | list[str] = "all") -> DataFrame:
    """Keep one row per key: the first under `order` (ties broken by `tiebreak`).

    tiebreak="all" appends every other column, descending (VARIANT columns by a hash of
    their text), which makes the choice a total order and the result deterministic.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    terms = parse_order(order)
    used = {c for c, _, _ in terms} | set(keys)
    ties = [f for f in df.schema.fields if f.name not in used and (tiebreak == "all" or f.name in (tiebreak or []))]
    extra = [F.xxhash64(F.to_json(f.name)).desc() if isinstance(f.dataType, T.VariantType) else F.col(f.name).desc()
             for f in ties if isinstance(f.dataType, (*_ORDERABLE, T.VariantType))]
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order), *extra)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_per_key(df: DataFrame, keys, order_col: str, value_cols: list[str]) -> DataFrame:
    """Top row only via max_by, without a sort (used for bounds and winners)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), F.col(order_col)).alias("_t")).select(*keys, "_t.*")
