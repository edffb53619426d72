"""Artifacts held against each other: order-free digests by bucket of the key first, rows only of the buckets that differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in key)), F.lit(buckets)).cast("int")


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row; where its nulls are is hashed too, as a hash passes over them."""
    values = [F.col(f"`{c}`") for c in columns]
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(F.lit(seed), *values, *nulls) for seed in (1, 2)]


def digests(df: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n, a, b: rows and two sums of row hashes for each bucket of the key.

    Equal multisets of rows have equal digests whatever their order and partitions; one aggregate
    that combines before its shuffle, so at most ``buckets`` rows leave a task.
    """
    a, b = _row_hashes(columns or df.columns)
    return df.groupBy(_bucket(key, buckets).alias("bucket")).agg(F.count("*").alias("n"), F.sum(a.cast("decimal(20,0)")).alias("a"), F.sum(b.cast("decimal(20,0)")).alias("b"))


def unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """bucket of the digests that differ, or that one side lacks."""
    one, other = (d.select("bucket", F.struct("n", "a", "b").alias(name)) for d, name in ((left, "one"), (right, "other")))
    return one.join(other, "bucket", "full_outer").where(~F.col("one").eqNullSafe(F.col("other"))).select("bucket")


def differences(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """columns, surplus: how many more copies of a row the left side has, below 0 where the right one has more.

    The same as EXCEPT ALL in both directions; nulls are equal to each other. Only rows of buckets whose digests
    differ are shuffled; the list of these, ``buckets`` numbers at most, is broadcast. Copies are counted before
    the shuffle, so a row that is there often, or a frequent key, is no one task's. Columns must have the same types on both sides.
    """
    columns = list(columns or left.columns)
    types = [{c: t for c, t in df.dtypes if c in columns} for df in (left, right)]
    if types[0] != types[1] or set(types[0]) != set(columns):
        raise ValueError(f"the sides differ in their columns: {types[0]} and {types[1]}")
    bad = F.broadcast(unequal(digests(left, key, columns, buckets), digests(right, key, columns, buckets)).withColumnRenamed("bucket", "__bucket"))

    def counted(df: DataFrame, sign: int) -> DataFrame:
        return df.join(bad, _bucket(key, buckets) == F.col("__bucket"), "left_semi").select(*(F.col(f"`{c}`") for c in columns), F.lit(sign).alias("__copies"))

    both = counted(left, 1).unionByName(counted(right, -1))
    return both.groupBy(*(F.col(f"`{c}`") for c in columns)).agg(F.sum("__copies").alias("surplus")).where("surplus <> 0")


def chain(artifacts: dict[str, DataFrame], key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """left_side, right_side, columns, surplus of each artifact against the next one, in their order."""
    found = [
        differences(a, b, key, columns, buckets).select(F.lit(x).alias("left_side"), F.lit(y).alias("right_side"), *(F.col(f"`{c}`") for c in columns), "surplus")
        for (x, a), (y, b) in pairwise(artifacts.items())
    ]
    return reduce(DataFrame.unionByName, found)
