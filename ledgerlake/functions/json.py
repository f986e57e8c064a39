"""JSON (VARIANT) access with the null rules of the reference dialect.

Presence tests use `variant_get` without a cast: a present JSON null is *not*
SQL NULL. Value reads cast first, so a JSON null reads as SQL NULL.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_variant(x) -> Column:
    """String JSON -> VARIANT (NULL on malformed text); VARIANT passes through."""
    return F.try_parse_json(_c(x))


def jget(v, path: str, type_: str = "string") -> Column:
    """Typed read of a JSON path; NULL when absent, JSON null or not castable."""
    return F.try_variant_get(_c(v), path, type_)


def jnode(v, path: str) -> Column:
    """Untyped read: SQL NULL only when the path is absent (JSON null stays a value)."""
    return F.try_variant_get(_c(v), path, "variant")


def jpresent(v, path: str) -> Column:
    """True when the path exists, even if its value is JSON null."""
    return jnode(v, path).isNotNull()


def jabsent(v, path: str) -> Column:
    """`v:path IS NULL` of the reference dialect: the key is missing."""
    return jnode(v, path).isNull()


def jsize(v, path: str = "$") -> Column:
    """Length of a JSON array (NULL when not an array)."""
    return F.array_size(F.try_variant_get(_c(v), path, "array<variant>"))


def jarray(v, path: str, elem: str = "variant") -> Column:
    return F.try_variant_get(_c(v), path, f"array<{elem}>")


def jstr_at(v, path: str, i: int) -> Column:
    """Element i of a JSON array as string; NULL when out of range."""
    return F.try_variant_get(_c(v), f"{path}[{i}]", "string")


def json_text(v) -> Column:
    """VARIANT -> JSON text at query edges."""
    return F.to_json(_c(v))
