"""Sources: CSV, parameterised SQL with a cost gate, synthetic rows, archive windows, fallback."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions.cards import with_check_digit

ROW_CAP = 1000


class SourceError(RuntimeError):
    """A source that cannot or must not be read."""


def read_csv(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """A CSV with header, all text: quotes doubled, newlines in quotes, byte order mark dropped, empty as null; ``rows`` caps it."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", inferSchema=False)
    return df if rows is None else df.limit(rows)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly to at least as many tasks as there are cores: a narrow table of a million rows may be one small file, and so one task's work."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def not_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise SourceError("the source gave no rows")
    return df


def planned_bytes(df: DataFrame) -> int:
    """What the optimizer expects to read, columns and filters pruned."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@dataclass(frozen=True)
class SqlSource:
    """A query with named parameters over the session's tables; it must bind :row_limit, and is refused over its byte cap."""

    sql: str
    max_rows: int = ROW_CAP
    max_bytes: int | None = None

    def __post_init__(self) -> None:
        if ":row_limit" not in self.sql:
            raise SourceError("the query has no :row_limit")
        if not 0 < self.max_rows <= ROW_CAP:
            raise SourceError(f"row cap {self.max_rows} is not within 1 and {ROW_CAP}")

    def frame(self, spark: SparkSession, start: datetime, end: datetime, **more: object) -> DataFrame:
        df = spark.sql(self.sql, args={"window_start": start, "window_end": end, "row_limit": self.max_rows, **more})
        if self.max_bytes is not None and (size := planned_bytes(df)) > self.max_bytes:
            raise SourceError(f"the query would read {size} bytes; the cap is {self.max_bytes}")
        return df.limit(self.max_rows)


def in_window(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Rows whose time is known and in [start, end)."""
    return df.where(F.col(column).isNotNull() & (F.col(column) >= start) & (F.col(column) < end))


def archive_window(ts: Column, archive_start: str, archive_end: str, hours: int = 4) -> Column:
    """struct(start, end): a time inside the archive as it is, any other wrapped onto it, both snapped to the grid.

    ``archive_end`` is the last day of the archive, which ends with that day.
    """
    first, last = F.unix_seconds(F.lit(archive_start).cast("timestamp")), F.unix_seconds(F.lit(archive_end).cast("timestamp")) + 86_399
    at, width = F.unix_seconds(ts.cast("timestamp")), hours * 3600
    slots = F.floor((last - first) / width)
    # the archive ends a microsecond before midnight, so a whole second after its last one is elapsed 0
    elapsed = F.floor((F.unix_micros(ts.cast("timestamp")) - (last * 1_000_000 + 999_999)) / F.lit(3_600_000_000) / hours)
    start = F.when(at.between(first, last), at).otherwise(first + width * F.pmod(elapsed, slots))
    day = start - F.pmod(start, F.lit(86_400))
    snapped = day + F.floor((start - day) / width) * width
    return F.struct(F.timestamp_seconds(snapped).alias("start"), F.timestamp_seconds(snapped + width).alias("end"))


def synthetic_trips(spark: SparkSession, n: int, seed: str) -> DataFrame:
    """Deterministic rows of a bike-share archive: the same for one seed on any number of tasks."""
    u = lambda k: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "id"), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    normal = F.sqrt(-2 * F.log(u(1))) * F.cos(2 * 3.141592653589793 * u(2))
    return spark.range(n).select(
        F.concat(F.lit("T"), F.lpad(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(10**12)).cast("string"), 12, "0")).alias("trip_id"),
        (F.floor(u(3) * 9000) + 1000).alias("bike_id"), F.element_at(F.array(*map(F.lit, ("Walk Up", "Local365", "Local31", "Annual"))), (F.floor(u(4) * 4) + 1).cast("int")).alias("subscriber_type"),
        (F.floor(u(5) * 80) + 2500).alias("start_station_id"), (F.floor(u(6) * 80) + 2500).alias("end_station_id"),
        F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.floor(u(7) * 14_400)).alias("start_time"),
        F.greatest(F.round(F.exp(2.6 + 0.8 * normal)), F.lit(1.0)).cast("long").alias("duration_minutes"),
    )


def synthetic_orders(spark: SparkSession, n: int, seed: str = "orders") -> DataFrame:
    """Test orders with valid card numbers."""
    h = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(10**14))
    return spark.range(n).select(
        F.concat(F.lit("O"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("order_id"), F.concat(F.lit("Customer "), F.pmod(h, F.lit(5000)).cast("string")).alias("customer_name"),
        F.concat(F.lit("c"), F.pmod(h, F.lit(5000)).cast("string"), F.lit("@example.com")).alias("customer_email"),
        with_check_digit(F.concat(F.lit("4"), F.lpad(h.cast("string"), 14, "0"))).alias("card_info"), (F.pmod(h, F.lit(100_000)) / 100).alias("sale_price"),
    )


@dataclass(frozen=True)
class Extracted:
    frame: DataFrame
    source: str
    attempts: int
    fell_back: bool
    error: str | None = None


def with_fallback(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame], attempts: int = 3, names: tuple[str, str] = ("primary", "fallback")) -> Extracted:
    """The primary source, tried ``attempts`` times, else the fallback; which one it was is part of the result."""
    error = None
    for k in range(attempts):
        try:
            return Extracted(not_empty(primary()), names[0], k + 1, False)
        except Exception as e:  # any failure of a source counts as an attempt
            error = f"{type(e).__name__}: {e}".splitlines()[0]
    return Extracted(not_empty(fallback()), names[1], attempts, True, error)


def choose_source(csv: str | None = None, fixture: bool = False, live: bool = False) -> str:
    """csv, then fixture, then live, else the fixture."""
    return "csv" if csv else "fixture" if fixture else "live" if live else "fixture"
