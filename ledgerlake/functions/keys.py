"""Small scalar helpers: keys, flags, selectors, request payloads, batching."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The surrogate-key convention of the dbt_utils package
# (separator and the stand-in for NULL parts).
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(*cols) -> Column:
    """md5 over the stringified columns joined by '-', NULL parts replaced."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def status_bool(x) -> Column:
    """'0x1' -> true, '0x0' -> false, anything else -> NULL."""
    x = _c(x)
    return F.when(x == "0x1", F.lit(True)).when(x == "0x0", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def selector(x) -> Column:
    """Function selector: first 10 characters of the call input."""
    return F.substring(_c(x), 1, 10)


def nullif_empty(x) -> Column:
    x = _c(x)
    return F.when(x == "", F.lit(None).cast("string")).otherwise(x)


def non_empty_hex(x) -> Column:
    """Predicate: not NULL, not '' and not the empty '0x' payload."""
    x = _c(x)
    return x.isNotNull() & (x != "") & (x != "0x")


def json_str(x) -> Column:
    """A string column as a JSON string literal (quoted, escaped)."""
    return F.regexp_replace(F.to_json(F.array(_c(x))), r"^\[|\]$", "")


def json_obj(**fields) -> Column:
    """JSON object text with the given fields in order; NULL fields are written as null."""
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def json_array(*texts) -> Column:
    """JSON array text from JSON texts (heterogeneous elements allowed)."""
    return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))


def rpc_payload(method: str, params_json, id_col) -> Column:
    """JSON-RPC 2.0 request text {id, jsonrpc, method, params}; params is JSON text."""
    head = F.to_json(F.struct(_c(id_col).alias("id"), F.lit("2.0").alias("jsonrpc"), F.lit(method).alias("method")))
    return F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"params":'), params_json, F.lit("}"))


def batch_no(row_num, size: int) -> Column:
    """1-based batch number of a 1-based row number."""
    return F.ceil(_c(row_num) / F.lit(size)).cast("bigint")


def row_in_batch(row_num, size: int) -> Column:
    return (F.pmod(_c(row_num) - 1, F.lit(size)) + 1).cast("bigint")


def path_partition_key(path, segment: int = -1) -> Column:
    """Leading number of a path segment (from the end: -1 is the file name), as INT: 12000_3.json gives 12000."""
    seg = F.split_part(_c(path), F.lit("/"), F.lit(segment))
    return F.split_part(seg, F.lit("_"), F.lit(1)).try_cast("int")


def lit_ts(value) -> Column:
    """A Python datetime as a TIMESTAMP_NTZ literal, independent of any time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def greatest_ts(*cols, floor: str = "2000-01-01 00:00:00") -> Column:
    """GREATEST with a NULL floor per argument."""
    return F.greatest(*[F.coalesce(_c(c), F.lit(floor).cast("timestamp_ntz")) for c in cols])
