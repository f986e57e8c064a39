"""Expose the column functions to Spark SQL as session functions.

The bodies below are the SQL spelling of the Column expressions in `hexnum`
and `keys`; tests/test_functions.py checks that both give identical results.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from .keys import SURROGATE_NULL

_HEX_TO_INT = r"""
CASE
  WHEN x IS NULL OR NOT (lower(regexp_replace(x, '^0[xX]', '')) RLIKE '^[0-9a-f]+$') THEN CAST(NULL AS STRING)
  WHEN length(regexp_replace(lower(regexp_replace(x, '^0[xX]', '')), '^0+', '')) > 64 THEN CAST(NULL AS STRING)
  WHEN length(regexp_replace(lower(regexp_replace(x, '^0[xX]', '')), '^0+', '')) <= 15
    THEN conv(coalesce(nullif(regexp_replace(lower(regexp_replace(x, '^0[xX]', '')), '^0+', ''), ''), '0'), 16, 10)
  ELSE transform(array(regexp_replace(lower(regexp_replace(x, '^0[xX]', '')), '^0+', '')), s ->
    regexp_replace(array_join(transform(reverse(
      aggregate(
        transform(sequence(0, CAST(ceil(length(s) / 7) AS INT) - 1),
                  i -> CAST(conv(substr(lpad(s, CAST(ceil(length(s) / 7) AS INT) * 7, '0'), i * 7 + 1, 7), 16, 10) AS BIGINT)),
        array_repeat(CAST(0 AS BIGINT), 9),
        (limbs, c) -> aggregate(sequence(0, 8),
                                named_struct('out', CAST(array() AS ARRAY<BIGINT>), 'carry', c),
                                (acc, j) -> named_struct(
                                   'out', array_append(acc.out, (get(limbs, j) * 268435456 + acc.carry) % 1000000000),
                                   'carry', (get(limbs, j) * 268435456 + acc.carry) div 1000000000),
                                acc -> acc.out))),
      d -> lpad(CAST(d AS STRING), 9, '0')), ''), '^0+(?=[0-9])', ''))[0]
END
"""

_DECIMAL_ADJUST = r"""
CASE WHEN CAST(x AS STRING) RLIKE '^-?[0-9]+$' THEN concat(
  CASE WHEN startswith(CAST(x AS STRING), '-') AND NOT (CAST(x AS STRING) RLIKE '^-0*$') THEN '-' ELSE '' END,
  regexp_replace(regexp_replace(
    lpad(regexp_replace(regexp_replace(CAST(x AS STRING), '^-', ''), '^0+(?=[0-9])', ''),
         greatest(length(regexp_replace(regexp_replace(CAST(x AS STRING), '^-', ''), '^0+(?=[0-9])', '')), {n1}), '0'),
    '([0-9]{{{n}}})$', '.$1'), '\\.?0*$', ''))
END
"""

_BODIES = {
    "hex_to_int": ("x STRING", "STRING", _HEX_TO_INT),
    "int_to_hex": ("x BIGINT", "STRING", "CASE WHEN x IS NULL THEN NULL ELSE concat('0x', lower(hex(x))) END"),
    "hex_to_string": ("x STRING", "STRING",
                      "regexp_replace(try_validate_utf8(CAST(unhex(regexp_replace(x, '^0[xX]', '')) AS STRING)), '\\u0000+$', '')"),
    "status_bool": ("x STRING", "BOOLEAN", "CASE WHEN x = '0x1' THEN true WHEN x = '0x0' THEN false END"),
    "surrogate_key2": ("a STRING, b STRING", "STRING",
                       f"md5(concat_ws('-', coalesce(a, '{SURROGATE_NULL}'), coalesce(b, '{SURROGATE_NULL}')))"),
}


def register_sql_functions(spark: SparkSession, decimal_shifts=(2, 9, 18)) -> list[str]:
    """CREATE TEMPORARY FUNCTION for the hex/decimal helpers; returns their names."""
    bodies = dict(_BODIES)
    for n in decimal_shifts:
        bodies[f"decimal_adjust_{n}"] = ("x STRING", "STRING", _DECIMAL_ADJUST.format(n=n, n1=n + 1))
    for name, (params, ret, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    return list(bodies)
