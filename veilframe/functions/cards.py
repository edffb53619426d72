"""Payment card numbers: check digits, splitting, and valid test numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX, SUFFIX = 6, 4


def digits(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), "[^0-9]", "")


def is_card_number(value: Column) -> Column:
    """13 to 19 digits, whatever stands between them, with a valid check digit; false for null."""
    d = digits(value)
    return F.coalesce(F.length(d).between(13, 19) & F.call_function("luhn_check", d), F.lit(False))


def split(value: Column) -> Column:
    """struct(prefix, middle, suffix) of the digits; ten digits or fewer are all prefix, null is ''."""
    d = F.coalesce(digits(value), F.lit(""))
    n = F.length(d)
    long = n > PREFIX + SUFFIX
    return F.struct(
        F.when(long, F.left(d, F.lit(PREFIX))).otherwise(d).alias("prefix"),
        F.when(long, F.substr(d, F.lit(PREFIX + 1), n - PREFIX - SUFFIX)).otherwise("").alias("middle"),
        F.when(long, F.right(d, F.lit(SUFFIX))).otherwise("").alias("suffix"),
    )


def with_check_digit(body: Column) -> Column:
    """The digits of ``body`` and the Luhn digit that makes the whole valid."""
    order = F.reverse(F.split(body, ""))
    doubled = F.transform(order, lambda d, i: F.when(i % 2 == 0, d.cast("int") * 2).otherwise(d.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return F.concat(body, F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))
