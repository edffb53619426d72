"""Profiles kept as one small state for each slot and column, and merged over slots without reading their rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS = 12  # relative standard error of a distinct count: 1.04 / sqrt(2 ** 12) = 1.6 %
KLL_SIZE = 400  # rank error of a quantile: 0.7 % of the rows at 99 % confidence
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def is_numeric(kind: str) -> bool:
    return kind in NUMERIC or kind.startswith("decimal")


def states(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """by, column, rows, filled, distinct, low, high, total, quantiles: a row for each slot and column, in one pass over ``df``.

    ``distinct`` and ``quantiles`` are sketches of some kilobytes. Numeric measures leave
    NaN out and are null for columns of other types; ``total`` is exact in millionths, so it does not
    depend on the order of merging. A null slot is a slot; a table without rows has no states.
    """
    kinds = dict(df.dtypes)
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    if clash := {"column", "rows", "filled", "distinct", "low", "high", "total", "quantiles"} & set(by):
        raise ValueError(f"slots by {sorted(clash)} would hide what a state holds")

    def state(c: str) -> Column:
        value = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) if is_numeric(kinds[c]) else F.lit(None).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(f"`{c}`").alias("filled"), F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), F.lit(HLL_BITS)).alias("distinct"),
            F.min(value).alias("low"), F.max(value).alias("high"), F.sum(value.try_cast("decimal(28,6)")).alias("total"), F.kll_sketch_agg_double(value, F.lit(KLL_SIZE)).alias("quantiles"),
        )

    return df.groupBy(*by).agg(F.array(*map(state, columns)).alias("states")).select(*by, F.inline("states"))


def merged(kept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of several slots as one for each ``by`` and column; of merged states again as well."""
    return kept.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), F.hll_union_agg("distinct").alias("distinct"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.sum("total").cast("decimal(38,6)").alias("total"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def figures(kept: DataFrame, by: Sequence[str] = (), at: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """by, column, rows, nulls, distinct, low, high, total, quantiles (at each of ``at``) of states; quantiles are null where no number is."""
    ranks = F.array(*map(F.lit, at))
    quantiles = F.when(F.kll_sketch_get_n_double("quantiles") > 0, F.kll_sketch_get_quantile_double("quantiles", ranks))
    return kept.select(
        *by, "column", "rows", (F.col("rows") - F.col("filled")).alias("nulls"), F.hll_sketch_estimate("distinct").alias("distinct"), "low", "high", "total", quantiles.alias("quantiles"),
    )
