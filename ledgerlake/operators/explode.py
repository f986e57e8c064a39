"""Flatten JSON arrays to rows.

`explode_json` is LATERAL FLATTEN over an array at a path: one row per element,
with its zero-based position. Empty arrays, NULLs and non-arrays give no rows
(an object is not an array here, unlike a recursive FLATTEN).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import jarray


def explode_json(df: DataFrame, col: str, path: str = "$", keep: list[str] | None = None,
                 pos: str = "index", value: str = "value", outer: bool = False) -> DataFrame:
    """One row per element of the JSON array `col:path` -> (keep..., pos, value VARIANT)."""
    keep = [c for c in (keep if keep is not None else df.columns) if c not in (pos, value)]
    arr = jarray(col, path)
    # outer in any case: for a plain one Spark infers a filter that reads the array a second time
    out = df.select(*keep, F.posexplode_outer(arr).alias(pos, value))
    return out if outer else out.where(F.col(pos).isNotNull())


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that is computed once per row: Spark moves a filter on an ordinary one below it, with a copy
    of its expression, which is dear where that takes a document apart."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def posexplode_json(df: DataFrame, col: str, path: str = "$", keep: list[str] | None = None,
                    pos: str = "array_index", value: str = "value") -> DataFrame:
    """Whole-block documents to one row per element with its position."""
    return explode_json(df, col, path, keep, pos=pos, value=value)


def explode_array(df: DataFrame, col: str, keep: list[str] | None = None, pos: str = "index",
                  value: str = "value") -> DataFrame:
    """Same for a typed Spark array column."""
    keep = [c for c in (keep if keep is not None else df.columns) if c not in (pos, value, col)]
    return df.select(*keep, F.posexplode(col).alias(pos, value))
