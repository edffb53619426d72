"""Warehouse tables: typed layout, keyed upsert, insert-if-absent, partition replacement, additive evolution, audit, registration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilframe.operators.classify import SPARK_TYPE, Manifest
from veilframe.operators.protect import INDEX, MASKED

RUN_COLUMNS = ("logical_date", "run_slot", "trace_id", "loaded_at", "masked_by")


@dataclass(frozen=True)
class Scope:
    """A run slot or a logical date; nothing else may scope a report."""

    column: str
    value: str

    def __post_init__(self) -> None:
        if self.column not in ("run_slot", "logical_date"):
            raise ValueError(f"{self.column!r} is no scope")

    def predicate(self) -> Column:
        return F.col(self.column) == F.lit(self.value)


def typed_layout(masked: DataFrame, manifest: Manifest, run_slot: str, trace_id: str) -> DataFrame:
    """Columns of the manifest that the artifact has, with their types, and those of the run; masked and indexed ones stay text."""
    types = {c.name: SPARK_TYPE[c.sql_type] for c in manifest.columns if not c.sensitive}
    key = manifest.primary_key
    if manifest.key_is_synthetic:
        types[key] = "string"
    present = [c for c in masked.columns if c in types or c.endswith((MASKED, INDEX))]
    cols = [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in present]
    run = [F.to_date("logical_date").alias("logical_date")] if "logical_date" in masked.columns else []
    masked_by = [F.col("masked_by")] if "masked_by" in masked.columns else []
    return masked.select(*cols, *run, *masked_by, F.lit(run_slot).alias("run_slot"), F.lit(trace_id).alias("trace_id"))


def last_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the greatest in ``order``; an aggregate with map-side combine, so a hot key shuffles one row per task."""
    rest = [c for c in rows.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order)) if order else F.first(F.struct(*rest))
    return rows.groupBy(*key).agg(best.alias("r")).select(*key, *(F.col("r")[c].alias(c) for c in rest)).select(*rows.columns)


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """Old rows whose key is not new, and the last new row of each key; columns that one side lacks are null."""
    fresh = last_per_key(new, key, order or [F.col(c) for c in sorted(set(new.columns) - set(key))])
    return old.join(fresh.select(*key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def upsert_counts(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """One row (inserted, updated): keys of ``new`` that are new, and that replace a row."""
    keys = new.select(*key).distinct()
    known = old.select(*key).distinct().withColumn("known", F.lit(1))
    return keys.join(known, key, "left").agg(
        F.count_if(F.col("known").isNull()).alias("inserted"), F.count_if(F.col("known").isNotNull()).alias("updated"),
    )


def insert_if_absent(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``new`` to append: first per key, where the key is not there yet."""
    order = [F.col(c) for c in sorted(set(new.columns) - set(key))]
    rest = [c for c in new.columns if c not in key]
    first = new.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, *(F.col("r")[c].alias(c) for c in rest)) if rest else new.distinct()
    return first.select(*new.columns).join(old.select(*key), key, "left_anti")


def replace_partitions(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """What a table holds after ``new`` overwrote the partitions that it has rows in."""
    return old.join(new.select(column).distinct(), column, "left_anti").select(*old.columns).unionByName(new, allowMissingColumns=True)


def write_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Overwrite only the partitions that ``df`` has rows in."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


class VersionedTable:
    """A table of immutable versions under a folder; a table in ``_current`` names the one to read.

    One writer at a time. A reader holds the version it opened; a failed write leaves no trace in what is read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_current")
        if not folder.getFileSystem(conf).exists(folder):
            return 0
        return self.spark.read.schema("version int").parquet(f"{self.path}/_current").agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame | None:
        v = self.version()
        return self.spark.read.parquet(f"{self.path}/v{v}") if v else None

    def publish(self, df: DataFrame) -> int:
        v = self.version() + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{v}")
        self.spark.createDataFrame([(v,)], "version int").coalesce(1).write.mode("append").parquet(f"{self.path}/_current")
        return v

    def upsert(self, new: DataFrame, key: list[str], order: list[Column] | None = None) -> dict[str, int]:
        old = self.read()
        if old is None:
            fresh = last_per_key(new, key, order or [F.col(c) for c in sorted(set(new.columns) - set(key))])
            seen = Observation()
            self.publish(fresh.observe(seen, F.count(F.lit(1)).alias("rows")))
            return {"inserted": seen.get["rows"], "updated": 0}
        counts = upsert_counts(old, new, key).first().asDict()
        self.publish(upsert(old, new, key, order))
        return counts


class BucketedTable:
    """A keyed table in buckets by the hash of its key, each with a version of its own: an upsert rewrites only the buckets that it has keys of.

    Versions of a batch are written in one job and named by one file afterwards, so a failed write is never read.
    One writer at a time. ``buckets`` is fixed for the life of a table; a bucket should fit one task.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def versions(self) -> dict[int, int]:
        """The version to read of each bucket that has rows."""
        named = f"{self.path}/_current"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(named)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return {}
        return {r.bucket: r.version for r in self.spark.read.schema("bucket int, version int").parquet(named).groupBy("bucket").agg(F.max("version").alias("version")).collect()}

    def read(self, only: list[int] | None = None) -> DataFrame | None:
        """The rows of all buckets, or of those in ``only``; None where there are none."""
        paths = [f"{self.path}/v{v}/__bucket={b}" for b, v in sorted(self.versions().items()) if only is None or b in only]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def upsert(self, new: DataFrame, order: list[Column] | None = None) -> int:
        """Put in the last row of each key of ``new``; gives the number of buckets that were written."""
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        touched = [r[0] for r in new.select(bucket).distinct().collect()]  # numbers of buckets
        if not touched:
            return 0
        old = self.read(touched)
        rows = upsert(new.limit(0) if old is None else old, new, self.key, order)
        version = max(self.versions().values(), default=0) + 1
        rows.withColumn("__bucket", bucket).repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{self.path}/v{version}")
        self.spark.createDataFrame([(b, version) for b in touched], "bucket int, version int").coalesce(1).write.mode("append").parquet(f"{self.path}/_current")
        return len(touched)


def audit_row(spark: SparkSession, dataset: str, run_slot: str, trace_id: str, run_id: str, inserted: int, updated: int) -> DataFrame:
    """The row that a load appends to load_audit."""
    row = spark.createDataFrame([(dataset, run_slot, trace_id, run_id, inserted, updated)], "dataset string, run_slot string, trace_id string, run_id string, inserted long, updated long")
    return row.withColumn("loaded_at", F.current_timestamp())


def table_ddl(df: DataFrame, name: str, location: str, partition: str | None = None) -> str:
    """DDL of an external Parquet table over an artifact."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = f"\nPARTITIONED BY (`{partition}`)" if partition else ""
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING PARQUET{by}\nLOCATION '{location}'"


def register(spark: SparkSession, df: DataFrame, name: str, location: str, partition: str | None = None) -> dict:
    """Create the table or add the columns it lacks, and find its partitions; failure is a result, not an error."""
    try:
        if not spark.catalog.tableExists(name):
            spark.sql(table_ddl(df, name, location, partition))
        else:
            there = {c.name for c in spark.catalog.listColumns(name)}
            missing = [f for f in df.schema.fields if f.name not in there]
            if missing:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in missing)})")
        if partition:
            spark.catalog.recoverPartitions(name)
    except Exception as e:  # optional stage: the run goes on, degraded
        return {"registered": False, "table": name, "reason": str(e).splitlines()[0]}
    return {"registered": True, "table": name, "partition": partition}


def table_count(spark: SparkSession, name: str) -> int | None:
    return spark.table(name).count() if spark.catalog.tableExists(name) else None
