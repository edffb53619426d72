"""Counts that come with a write itself, so nothing is read back or run again to be counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write(df: DataFrame, path: str, *by: str, mode: str = "overwrite", drop: tuple[str, ...] = (), **metrics: Column) -> dict:
    """Write ``df`` as Parquet in folders by ``by`` and give rows and the aggregates ``metrics`` of it: one job.

    Columns of ``drop`` serve the metrics and are not written.
    A task that is run again after a lost executor counts once, as the counts are those of the tasks that write.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(name) for name, m in metrics.items())).drop(*drop).write.mode(mode)
    (out.partitionBy(*by) if by else out).parquet(path)
    return {"rows": 0} | dict.fromkeys(metrics) | seen.get  # a frame that the optimizer knows to be empty reports nothing


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a checked folder in the place of another, without writing its rows again."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = a.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(b, True)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{source} was not moved to {target}")
