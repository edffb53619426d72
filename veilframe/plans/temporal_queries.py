"""Queries of joins and groups by time, and of the traffic audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import reports, temporal
from veilframe.operators.traffic import Category, Profile
from veilframe.plans.registry import query, table
from veilframe.plans.relational_queries import _folder

AUDIT = Profile((Category("click", (), 1, 18), Category("view", (), 1, 24), Category("error", (), 2, 15)), Category("default", (), 3, 40), window_seconds=21_600, block_seconds=7_200, allowlist=("10.0.0.0/30",))


@query("""SELECT e.event_id, v.verdict_id, v.verdict FROM events e ASOF LEFT JOIN (
  SELECT user_id, ts AS at, max(event_id) AS verdict_id, arg_max(value, event_id) AS verdict FROM events WHERE event_type = 'signup' GROUP BY 1, 2) v ON e.user_id = v.user_id AND e.ts >= v.at""")
def as_of_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event the user's latest verdict at or before it."""
    e = table(spark, sf_dir, "events")
    verdicts = e.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("verdict_id"), F.col("value").alias("verdict"))
    return temporal.as_of(e.select("event_id", "user_id", "ts"), verdicts, ["user_id"], "ts", ("verdict_id",)).select("event_id", "verdict_id", "verdict")


@query("""SELECT r.event_id AS run, count(*) AS n, CAST(sum(e.event_id) AS BIGINT) AS ids FROM events r JOIN events e
  ON e.user_id = r.user_id AND e.ts >= r.ts AND e.ts < r.ts + to_minutes(CAST((r.event_id % 97 + 1) * (r.event_id % 7 + 1) * 5 AS INTEGER)) WHERE r.event_type = 'error' GROUP BY 1""")
def events_in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user within the windows of the user's runs, which last from minutes to days."""
    e = table(spark, sf_dir, "events")
    length = F.make_dt_interval(mins=((F.col("event_id") % 97 + 1) * (F.col("event_id") % 7 + 1) * 5).cast("int"))
    runs = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("run"), F.col("ts").alias("from"), (F.col("ts") + length).alias("to"))
    pairs = temporal.overlaps(e.select("user_id", "event_id", "ts"), runs, ("ts", None), ("from", "to"), ("user_id",))
    return pairs.groupBy("run").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


_SESSIONS = """WITH o AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
g AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM o)
SELECT user_id, min(ts) AS "start", max(ts) AS "end", count(*) AS n FROM g GROUP BY user_id, g.g"""


@query(_SESSIONS)
def client_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = temporal.sessions(table(spark, sf_dir, "events"), "user_id", "ts", 6 * 3600)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(_SESSIONS)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions from a stream: closed once the watermark is a gap past their last event, which one later row brings about."""
    from veilframe.streaming import consumers

    folder = _folder(spark)
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    later = e.agg(F.lit(None).cast("long").alias("user_id"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    e.unionByName(later).write.parquet(f"{folder}/in")
    stream = consumers.client_sessions(spark.readStream.schema("user_id long, ts timestamp").parquet(f"{folder}/in"), "user_id", "6 hours")
    stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").format("parquet").option("path", f"{folder}/out").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(stream.schema).parquet(f"{folder}/out").where("user_id is not null")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


def audited_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests: request, client, category, ts."""
    e = table(spark, sf_dir, "events")
    category = F.when(F.col("event_type").isin("click", "view", "error"), F.col("event_type")).otherwise("default")
    client = F.concat(F.lit("10.0."), F.floor(F.col("user_id") / 256).cast("string"), F.lit("."), (F.col("user_id") % 256).cast("string"))
    return e.select(F.col("event_id").alias("request"), client.alias("client"), category.alias("category"), F.col("ts").cast("timestamp").alias("ts"))


@query()
def traffic_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits by client and category, blocks, anomalies and their ends, of the stream of events; a plain simulation says the same in the tests."""
    from veilframe.streaming import auditor

    folder, rows = _folder(spark), audited_requests(spark, sf_dir)
    later = rows.agg(F.lit(-1).cast("long").alias("request"), F.lit("later").alias("client"), F.lit("default").alias("category"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    rows.unionByName(later).write.parquet(f"{folder}/in")
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", "UTC")
    decided = auditor.audit(own.readStream.schema(rows.schema).parquet(f"{folder}/in"), AUDIT)
    decided.writeStream.option("checkpointLocation", f"{folder}/checkpoint").format("parquet").option("path", f"{folder}/out").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(decided.schema).parquet(f"{folder}/out")


@query("""WITH r AS (SELECT event_id AS run, event_type AS pipeline, ts AS ended_at FROM events WHERE event_id % 2 = 0), v AS (SELECT event_id - 1 AS run, ts + INTERVAL 5 MINUTE AS received_at, event_id % 3 <> 0 AS proceed FROM events WHERE event_id % 2 = 1 AND event_id % 5 <> 0)
SELECT r.run, r.pipeline, v.received_at, CASE WHEN v.run IS NULL THEN 'silent' WHEN v.proceed THEN 'proceed' ELSE 'stop' END AS state FROM r LEFT JOIN v ON v.run = r.run AND v.received_at >= r.ended_at AND v.received_at <= r.ended_at + INTERVAL 10 MINUTE""")
def stream_silent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams of runs and of verdicts joined within a grace time; a run without a verdict is silent once its grace is over."""
    from veilframe.streaming import consumers

    folder = _folder(spark)
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    runs = e.where("event_id % 2 = 0").select(F.col("event_id").alias("run"), F.col("event_type").alias("pipeline"), F.col("ts").alias("ended_at"))
    verdicts = e.where("event_id % 2 = 1 AND event_id % 5 <> 0").select((F.col("event_id") - 1).alias("run"), (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("received_at"), (F.col("event_id") % 3 != 0).alias("proceed"))
    later = e.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("at"))
    runs.unionByName(later.select(F.lit(-1).cast("long").alias("run"), F.lit("").alias("pipeline"), F.col("at").alias("ended_at"))).write.parquet(f"{folder}/runs")
    verdicts.unionByName(later.select(F.lit(-2).cast("long").alias("run"), F.col("at").alias("received_at"), F.lit(True).alias("proceed"))).write.parquet(f"{folder}/verdicts")
    streams = [spark.readStream.schema(df.schema).parquet(f"{folder}/{n}") for df, n in ((runs, "runs"), (verdicts, "verdicts"))]
    joined = consumers.silent_runs(*streams, "10 minutes")
    joined.writeStream.option("checkpointLocation", f"{folder}/checkpoint").format("parquet").option("path", f"{folder}/out").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(joined.schema).parquet(f"{folder}/out").where("run >= 0")
    return out.withColumn("received_at", F.col("received_at").cast("timestamp_ntz"))


@query("""SELECT CAST(grouping(event_type) * 2 + grouping(hour) AS INTEGER) AS level, event_type, CAST(hour AS INTEGER) AS hour, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS amount
FROM (SELECT event_type, hour(ts) AS hour, value FROM events) GROUP BY CUBE (event_type, hour)""")
def chart_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of a report's counts by category, by hour, by both and in total, in one pass over the rows."""
    e = table(spark, sf_dir, "events").select("event_type", F.hour("ts").alias("hour"), "value")
    return reports.cube(e, ["event_type", "hour"], {"n": F.count("*"), "amount": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")})
