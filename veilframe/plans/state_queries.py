"""Queries of merged profiles, of artifacts held against each other, and of the message log as a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import observed, reconcile, states
from veilframe.plans.registry import query, table
from veilframe.plans.relational_queries import _folder


def _slot_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of orders for each month, written and read back as a report of several slots would."""
    orders = table(spark, sf_dir, "orders").withColumn("slot", F.date_format("o_orderdate", "yyyy-MM"))
    path = f"{_folder(spark)}/states"
    kept = states.states(orders, ["slot"], ["o_custkey", "o_totalprice", "o_orderstatus"])
    kept.write.partitionBy("slot").parquet(path)
    return spark.read.schema(kept.schema).parquet(path)


@query("""WITH p AS (SELECT strftime(o_orderdate, '%Y') AS "year", CAST(o_custkey AS DOUBLE) AS a, o_totalprice AS b, o_orderstatus AS c FROM orders),
c AS (SELECT "year", 'o_custkey' AS "column", a AS v, a IS NOT NULL AS filled FROM p UNION ALL SELECT "year", 'o_totalprice', b, b IS NOT NULL FROM p UNION ALL SELECT "year", 'o_orderstatus', NULL, c IS NOT NULL FROM p)
SELECT "year", "column", count(*) AS "rows", CAST(sum(CASE WHEN filled THEN 0 ELSE 1 END) AS BIGINT) AS nulls, min(v) AS low, max(v) AS high, CAST(sum(CAST(v AS DECIMAL(28, 6))) AS DOUBLE) AS total FROM c GROUP BY 1, 2""")
def profile_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact part of a profile of each year, merged from the states of its months."""
    years = states.merged(_slot_states(spark, sf_dir).withColumn("year", F.substring("slot", 1, 4)), ["year"])
    return states.figures(years, ["year"]).select("year", "column", "rows", "nulls", "low", "high", F.col("total").cast("double").alias("total"))


@query("""SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) AS exact, true AS distinct_within, true AS median_within FROM orders
UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice), true, true FROM orders UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), true, NULL FROM orders""")
def merged_sketch_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the merged sketches of all months are within their stated errors: distinct counts within 5 % (three standard errors), the rank of the median within 1 %."""
    orders = table(spark, sf_dir, "orders")
    found = states.figures(states.merged(_slot_states(spark, sf_dir)), at=[0.5]).select("column", "distinct", F.col("quantiles")[0].alias("median"))
    columns = ["o_custkey", "o_totalprice", "o_orderstatus"]
    medians = {r["column"]: r["median"] for r in found.collect()}  # a row for each column

    def off(c: str) -> Column:
        """How far the median found is from the middle rank, in rows' shares; ties span ranks."""
        if medians.get(c) is None:
            return F.lit(None).cast("double")
        share = lambda x: F.count_if(x) / F.count(c)
        return F.greatest(share(F.col(c) < medians[c]) - 0.5, 0.5 - share(F.col(c) <= medians[c]), F.lit(0.0))

    exact = orders.agg(F.array(*(F.struct(F.lit(c).alias("column"), F.count_distinct(c).alias("exact"), off(c).alias("off")) for c in columns)).alias("e")).select(F.inline("e"))
    return exact.join(found, "column").select("column", "exact", (F.abs(F.col("distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_within"), (F.col("off") <= 0.01).alias("median_within"))


_SIDES = ("artifact", "messages", "warehouse")


@query("""WITH a AS (SELECT c_custkey, c_name, c_acctbal FROM customer), m AS (SELECT * FROM a WHERE c_custkey % 97 <> 0 UNION ALL SELECT * FROM a WHERE c_custkey % 89 = 0),
w AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 83 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM m)
SELECT 'artifact' AS left_side, 'messages' AS right_side, c_custkey, c_name, c_acctbal, count(*) AS surplus FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM m) GROUP BY ALL
UNION ALL SELECT 'artifact', 'messages', c_custkey, c_name, c_acctbal, -count(*) FROM (SELECT * FROM m EXCEPT ALL SELECT * FROM a) GROUP BY ALL
UNION ALL SELECT 'messages', 'warehouse', c_custkey, c_name, c_acctbal, count(*) FROM (SELECT * FROM m EXCEPT ALL SELECT * FROM w) GROUP BY ALL
UNION ALL SELECT 'messages', 'warehouse', c_custkey, c_name, c_acctbal, -count(*) FROM (SELECT * FROM w EXCEPT ALL SELECT * FROM m) GROUP BY ALL""")
def reconciled_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An artifact against its published messages (some lost, some sent twice), and these, decoded, against a warehouse (some changed)."""
    artifact = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    sent = artifact.where("c_custkey % 97 <> 0").unionByName(artifact.where("c_custkey % 89 = 0")).select(F.to_json(F.struct("*")).alias("value"))
    messages = sent.select(F.from_json("value", artifact.schema).alias("m")).select("m.*")
    loaded = messages.withColumn("c_acctbal", F.when(F.expr("c_custkey % 83 = 0"), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return reconcile.chain(dict(zip(_SIDES, (artifact, messages, loaded), strict=True)), ["c_custkey"], artifact.columns, buckets=256)


@query("""SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset", CAST(event_id AS VARCHAR) AS "key", event_type AS "value", ts AS received_at FROM events""")
def message_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a message log in segments, read back as a batch from the data source of its own."""
    from veilframe.sources import message_log

    path = f"{_folder(spark)}/log"
    message_log.append(_event_messages(spark, sf_dir), path, width=1000)
    return message_log.read(spark, path, width="1000").select("partition", "offset", "key", "value", F.col("received_at").cast("timestamp_ntz").alias("received_at"))


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.lit("events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"), F.expr("event_id div 4").alias("offset"),
        F.col("event_id").cast("string").alias("key"), F.col("event_type").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query("""SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset", event_type AS "value", false AS valid FROM events""")
def stream_log_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tap on the log as a stream: stopped after the first messages and begun again from its checkpoint, it loses and repeats none."""
    from veilframe.sources import message_log
    from veilframe.streaming import consumers

    folder, rows = _folder(spark), _event_messages(spark, sf_dir)
    for part in (rows.where("offset < 120"), rows.where("offset >= 120")):
        message_log.append(part, f"{folder}/log", width=1000)
        messages = message_log.read(spark, f"{folder}/log", stream=True, width="1000").drop("key")
        consumers.tap(messages, f"{folder}/tapped", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/tapped").select(F.col("topic").cast("string").alias("topic"), F.col("partition").cast("int").alias("partition"), "offset", "value", "valid")


@query("""SELECT 'batch' AS how, count(*) AS "rows", CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM events
UNION ALL SELECT 'stream', count(*), CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) FROM events""")
def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that a write and the batches of a stream report of themselves."""
    from veilframe.streaming import progress

    folder, e = _folder(spark), table(spark, sf_dir, "events").select("event_id", "event_type")
    errors = F.count_if(F.col("event_type") == "error")
    batch = observed.write(e.repartition(4), f"{folder}/in", errors=errors)
    totals = progress.Totals("written")
    spark.streams.addListener(totals)
    try:
        stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        run = progress.observed(stream, "written", errors=errors).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
        streamed = totals.total(run.runId)
    finally:
        spark.streams.removeListener(totals)
    found = [(how, d["rows"], d["errors"]) for how, d in (("batch", batch), ("stream", streamed))]
    return spark.createDataFrame(found, "how string, rows long, errors long")
