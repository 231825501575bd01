"""Number coercion, rendering and byte decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(value: Column, kind: str = "double", default: float | None = 0) -> Column:
    """Lenient cast; values that do not parse, nulls and NaN become ``default``."""
    number = nan_to_null(value.try_cast("double")).try_cast(kind)
    if kind in ("int", "bigint"):
        # Whole numbers keep all their digits instead of passing through double.
        number = F.coalesce(value.try_cast(kind), number)
    return number if default is None else F.coalesce(number, F.lit(default).cast(kind))


def nan_to_null(value: Column) -> Column:
    """NaN counts as missing in every aggregate of this package."""
    return F.when(~F.isnan(value), value)


def two_decimals(value: Column) -> Column:
    # Rounded first, so that the formatter never meets a half.
    return F.format_string("%.2f", F.round(value, 2))


def float_text(value: Column) -> Column:
    """Plain decimal digits from 1e-4 up to 1e16, as in ``12345678.5`` and ``0.0005``;
    whole numbers end in ``.0``. Beyond that, and for NaN, the cast's own form."""
    value = value.cast("double")
    size = F.abs(value)
    whole = (value == F.floor(value)) & (size < F.lit(1e16))
    plain = (size >= F.lit(1e-4)) & (size < F.lit(1e16))
    digits = value.cast("string").try_cast("decimal(38,21)").cast("string")
    return (
        F.when(whole, F.concat(value.cast("bigint").cast("string"), F.lit(".0")))
        .when(plain, F.rtrim(digits, F.lit("0")))
        .otherwise(value.cast("string"))
    )


def _reversed_pairs(digits: Column) -> Column:
    """Sixteen hex digits with the order of their eight bytes turned round."""
    return F.concat(*[F.substring(digits, spot, 2) for spot in range(15, 0, -2)])


def decode_little_endian(blob: Column) -> Column:
    """Unsigned little-endian bytes to bigint; null where they exceed it."""
    digits = F.rpad(F.hex(blob), 16, "0")
    number = F.conv(_reversed_pairs(digits), 16, 10).cast("decimal(20,0)").try_cast("bigint")
    # Bytes beyond the eighth count only if they are not zero.
    beyond = F.ltrim(F.substr(F.hex(blob), F.lit(17)), F.lit("0"))
    return F.when(beyond == "", number)


def encode_little_endian(value: Column) -> Column:
    """Bigint to its eight little-endian bytes."""
    return F.unhex(_reversed_pairs(F.lpad(F.hex(value), 16, "0")))


def fingerprint(*columns: Column) -> Column:
    """52-bit non-negative number from md5, exact as a double and portable to SQL."""
    text = F.concat_ws("|", *columns)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def pick(key: Column, choices: list[str]) -> Column:
    """Deterministic member of ``choices`` for ``key``."""
    spot = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(len(choices)))
    return F.element_at(F.array(*[F.lit(c) for c in choices]), spot.cast("int") + 1)
