"""Masks as column expressions. Null and "" pass through every mask but the null mask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


class MaskError(ValueError):
    """A mask type that no rule defines; nothing is passed through unmasked."""


def _show_last(n: int) -> Callable[[Column], Column]:
    return lambda s: F.when(F.length(s) > n, F.concat(F.repeat(F.lit("*"), F.length(s) - n), F.right(s, F.lit(n)))).otherwise(F.repeat(F.lit("*"), F.length(s)))


def _show_first(n: int) -> Callable[[Column], Column]:
    return lambda s: F.when(F.length(s) > n, F.concat(F.left(s, F.lit(n)), F.repeat(F.lit("*"), F.length(s) - n))).otherwise(s)


#: Decimal digits, and the digit-like superscripts and subscripts.
DIGITS = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"


def _shape(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"\p{L}", "x"), DIGITS, "n")


RULES: dict[str, Callable[[Column], Column]] = {
    "NONE": lambda s: s,
    "MASK_NONE": lambda s: s,
    "MASK_NULL": lambda s: F.lit(None).cast("string"),
    "MASK_HASH": lambda s: F.sha2(s, 256),
    "MASK_SHOW_LAST_4": _show_last(4),
    "MASK_SHOW_FIRST_4": _show_first(4),
    "MASK_SHOW_FIRST_8": _show_first(8),
    "MASK_DATE_SHOW_YEAR": lambda s: F.concat(F.left(s, F.lit(4)), F.lit("-01-01")),
    "MASK": _shape,
}


def apply_mask(mask: str, value: Column) -> Column:
    if mask not in RULES:
        raise MaskError(f"no rule for mask {mask!r}")
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), text).otherwise(RULES[mask](text))


def register_sql(spark: SparkSession) -> list[str]:
    """The masks as SQL functions of one string, named as the mask types; pure SQL, so no Python worker runs."""
    bodies = {
        "MASK_HASH": "sha2(s, 256)",
        "MASK_SHOW_LAST_4": "CASE WHEN length(s) > 4 THEN concat(repeat('*', length(s) - 4), right(s, 4)) ELSE repeat('*', length(s)) END",
        "MASK_SHOW_FIRST_4": "CASE WHEN length(s) > 4 THEN concat(left(s, 4), repeat('*', length(s) - 4)) ELSE s END",
        "MASK_SHOW_FIRST_8": "CASE WHEN length(s) > 8 THEN concat(left(s, 8), repeat('*', length(s) - 8)) ELSE s END",
        "MASK_DATE_SHOW_YEAR": "concat(left(s, 4), '-01-01')",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN CASE WHEN s IS NULL OR s = '' THEN s ELSE {body} END")
    return sorted(bodies)
