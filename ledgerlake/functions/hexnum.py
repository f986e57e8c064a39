"""Exact number handling for chain values: hex <-> decimal text, decimal shifts.

Chain quantities are unsigned 256-bit integers (up to 78 decimal digits), wider
than DECIMAL(38). They stay decimal *strings*; every function here is a plain
Column expression evaluated in the JVM (no Python per row).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wide conversion.
_CHUNK_HEX = 7                 # hex digits folded per step: 28 bits
_CHUNK_MUL = 1 << 28           # 2^28
_LIMB = 10 ** 9                # decimal limb base
_LIMB_BITS = 29                # a limb holds 29.9 bits: 9 limbs for 256 bits, 5 for 128
MAX_HEX_DIGITS = 64            # widest accepted value: 256 bits
_FAST_HEX_DIGITS = 15          # conv() is exact up to 60 bits
_MID_HEX_DIGITS = 31           # two conv() results fit DECIMAL(38)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _wide_hex_to_dec(body: Column, n: Column) -> Column:
    """Fold 28-bit chunks into base-10^9 limbs (little endian), all in BIGINT."""
    n_chunks = F.ceil(n / F.lit(_CHUNK_HEX)).cast("int")
    padded = F.lpad(body, n_chunks * F.lit(_CHUNK_HEX), "0")
    chunks = F.transform(
        F.sequence(F.lit(0), n_chunks - 1),
        lambda i: F.conv(F.substr(padded, i * _CHUNK_HEX + 1, F.lit(_CHUNK_HEX)), 16, 10).cast("bigint"),
    )
    n_limbs = F.floor(n * 4 / F.lit(_LIMB_BITS)).cast("int") + 1
    zero_limbs = F.array_repeat(F.lit(0).cast("bigint"), n_limbs)
    limb_idx = F.sequence(F.lit(0), n_limbs - 1)

    def times_2_28_plus(limbs: Column, chunk: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("out"), chunk.alias("carry"))

        def limb_step(acc: Column, i: Column) -> Column:
            v = F.get(limbs, i) * F.lit(_CHUNK_MUL) + acc["carry"]
            low = v % F.lit(_LIMB)
            carry = F.call_function("div", v, F.lit(_LIMB).cast("bigint"))  # whole numbers, no decimals
            return F.struct(F.array_append(acc["out"], low).alias("out"), carry.alias("carry"))

        return F.aggregate(limb_idx, start, limb_step, lambda acc: acc["out"])

    limbs = F.aggregate(chunks, zero_limbs, times_2_28_plus)
    digits = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    return F.regexp_replace(digits, r"^0+(?=[0-9])", "")


def _mid_hex_to_dec(sig: Column, n: Column) -> Column:
    """16 to 31 digits: two conv() halves put together in DECIMAL(38,0) (below 2^124)."""
    high = F.conv(F.substr(sig, F.lit(1), n - _FAST_HEX_DIGITS), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substr(sig, n - (_FAST_HEX_DIGITS - 1)), 16, 10).cast("decimal(20,0)")
    scale = F.lit(str(1 << 4 * _FAST_HEX_DIGITS)).cast("decimal(19,0)")
    return ((high * scale).cast("decimal(38,0)") + low).cast("decimal(38,0)").cast("string")


def hex_to_int(h) -> Column:
    """`0x`-hex (any case, up to 256 bits) to its decimal string; NULL on NULL,
    empty, invalid or wider input."""
    h = _c(h)
    # each sub-expression refers to its input once: copies would multiply when calls nest
    sig = F.lower(F.ltrim(h, F.lit("0xX")))
    n = F.length(sig)
    valid = h.rlike(r"^(0[xX])?[0-9a-fA-F]+$")
    fast = F.conv(F.when(n == 0, F.lit("0")).otherwise(sig), 16, 10)
    return (
        F.when(h.isNull() | ~valid | (n > MAX_HEX_DIGITS), F.lit(None).cast("string"))
        .when(n <= _FAST_HEX_DIGITS, fast)
        .when(n <= _MID_HEX_DIGITS, _mid_hex_to_dec(sig, n))
        # the wide branch runs inside one lambda: its variable is referenced, not
        # re-inlined, which keeps generated code far below the 64 KB method limit
        .otherwise(F.get(F.transform(F.array(sig), lambda s: _wide_hex_to_dec(s, F.length(s))), 0))
    )


def hex_to_bigint(h) -> Column:
    """hex_to_int as BIGINT (NULL when it does not fit)."""
    return hex_to_int(h).try_cast("bigint")


def hex_to_decimal(h) -> Column:
    """hex_to_int as DECIMAL(38,0) (NULL when wider than 38 digits)."""
    return hex_to_int(h).try_cast("decimal(38,0)")


def int_to_hex(x) -> Column:
    """Non-negative integer to `0x` hex without padding."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(F.concat(F.lit("0x"), F.lower(F.hex(x))))


def hex_to_string(h) -> Column:
    """Hex bytes to UTF-8 text with trailing NULs removed; NULL on bad hex or bad UTF-8."""
    body = F.regexp_replace(_c(h), r"^0[xX]", "")
    text = F.try_validate_utf8(F.unhex(body).cast("string"))
    return F.regexp_replace(text, "\u0000+$", "")


def decimal_adjust(s, n: int) -> Column:
    """Shift the decimal point of an integer string `n` places left, exactly.

    "1500000000000000000", 18 -> "1.5";  "5", 2 -> "0.05";  "0", 18 -> "0".
    Written with few sub-expression references so generated code stays small.
    """
    s = _c(s).cast("string")
    digits = F.regexp_replace(F.regexp_replace(s, r"^-", ""), r"^0+(?=[0-9])", "")
    if n == 0:
        out = digits
    else:
        padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(n + 1)), "0")
        pointed = F.regexp_replace(padded, f"([0-9]{{{n}}})$", ".$1")
        out = F.regexp_replace(pointed, r"\.?0*$", "")
    return F.when(s.rlike(r"^-?[0-9]+$"),
                  F.concat(F.when(s.startswith("-") & ~s.rlike(r"^-0*$"), F.lit("-")).otherwise(F.lit("")), out))


def amount_cols(hex_value, decimals: int, prefix: str = "value", default_zero: bool = False) -> list[Column]:
    """The amount triple: raw decimal string, precise shifted string, DOUBLE."""
    raw = hex_to_int(hex_value)
    if default_zero:
        raw = F.coalesce(raw, F.lit("0"))
    precise = decimal_adjust(raw, decimals)
    return [raw.alias(f"{prefix}_precise_raw"), precise.alias(f"{prefix}_precise"),
            precise.cast("double").alias(prefix)]


def to_gwei(hex_value) -> Column:
    """Tolerant wei -> gwei as DOUBLE (NULL beyond 38 digits)."""
    d = hex_to_decimal(hex_value)
    return d.cast("double") / F.lit(1e9)


def tx_fee_precise(price, used, shift: int = 18) -> Column:
    """price x used (DECIMAL(38,0), NULL on overflow) shifted `shift` places."""
    prod = F.try_multiply(_c(price).cast("decimal(38,0)"), _c(used).cast("decimal(38,0)"))
    return decimal_adjust(prod.cast("decimal(38,0)").cast("string"), shift)


def epoch_ts(seconds) -> Column:
    """Epoch seconds (integer or hex string) to TIMESTAMP_NTZ, time-zone free."""
    x = _c(seconds)
    secs = x.cast("bigint")
    return F.timestamp_add("SECOND", secs, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def hex_epoch_ts(h) -> Column:
    return epoch_ts(hex_to_int(h).try_cast("bigint"))


def bucket1000(x) -> Column:
    """Round to the nearest thousand, half up (partition key of a block)."""
    return F.round(_c(x), -3)
