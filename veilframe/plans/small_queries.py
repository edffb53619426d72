"""Queries of the small operators: rejoining messages, uncovered columns, details, captions, counts, slots, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions import crypto, ids
from veilframe.operators import messages, policies, protect, verdicts
from veilframe.plans.registry import query, table
from veilframe.plans.scalar_queries import DEMO_KEYS
from veilframe.sources import tables


@query("""SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS segment, true AS sealed FROM customer""")
def rejoin_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    sealed = crypto.Encryptor(DEMO_KEYS).protect(rows, {"c_name": "c_name_encrypted"}, {"c_name": "c_name_blind_index"})
    slot = F.lit("2026-01-01").cast("timestamp")
    wrap = lambda kind: messages.envelope(kind, "customer", slot, ids.trace_id(slot, "customer"), "run-1", 1, F.col("c_custkey"), "pipeline", slot)
    out = messages.row_messages(sealed, wrap, ["c_name_encrypted", "c_name_blind_index", "c_mktsegment"], ["c_name"])
    both = messages.rejoin(out.select(messages.parse(F.col("value")).alias("message")))  # unjudged: rejoining asks for no problems
    return both.select("key", F.element_at("flat", "c_mktsegment").alias("segment"), F.element_at("encrypted", "c_name_encrypted").startswith("enc:v1:").alias("sealed"))


@query("""SELECT 'p' || p_partkey AS name, CASE p_size % 3 WHEN 1 THEN 'quasi_identifier' ELSE 'direct_identifier' END AS sensitivity FROM part WHERE p_size % 3 <> 0 AND p_partkey % 4 <> 0""")
def missing_policy_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with a column for each part, of which every fourth has a policy."""
    p = table(spark, sf_dir, "part").withColumn("name", F.concat(F.lit("p"), F.col("p_partkey")))
    columns = p.select("name", F.when(F.col("p_size") % 3 == 0, "public").when(F.col("p_size") % 3 == 1, "quasi_identifier").otherwise("direct_identifier").alias("sensitivity"))
    return policies.missing_policies(columns, p.where("p_partkey % 4 = 0").select(F.col("name").alias("column"), F.lit("MASK_HASH").alias("mask")))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'inserted,updated' WHEN 1 THEN 'rows' ELSE 'pdf' END AS keys FROM events""")
def verdict_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("run_id"), F.element_at(F.array(*map(F.lit, ("load", "publish", "report"))), (F.col("event_id") % 3 + 1).cast("int")).alias("stage"))
    event = F.create_map(*(F.lit(x) for pair in (("inserted", "1"), ("updated", "2"), ("rows", "3"), ("pdf", "/a.pdf"), ("secret", "s")) for x in pair))
    named = e.withColumn("event", F.map_filter(event, lambda k, v: ~((F.col("stage") == "report") & (k == "rows"))))
    return messages.stage_details(named, verdicts.DETAILS).select(F.col("run_id").alias("event_id"), F.array_join(F.array_sort(F.map_keys("detail")), ",").alias("keys"))


@query("""SELECT count(*) AS n_all, count(*) FILTER (WHERE event_id % 4 <> 0) AS responding, count(*) FILTER (WHERE event_id % 4 <> 0 AND event_id % 2 = 0 AND event_id % 3 <> 0) AS connected FROM events""")
def preset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    responding, proceed = F.col("event_id") % 4 != 0, (F.col("event_id") % 2 == 0) & (F.col("event_id") % 3 != 0)
    return table(spark, sf_dir, "events").agg(F.count("*").alias("n_all"), F.count_if(responding).alias("responding"), F.count_if(responding & proceed).alias("connected"))


@query("""SELECT event_id, strftime(ts, '%Y%m%dT%H%MZ') AS slot, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events""")
def slot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.to_timestamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, sf_dir, "events").select("event_id", ids.slot_label(at).alias("slot"), ids.iso_z(at).alias("iso"))


@query("""SELECT 'traffic_client_blocked' AS kind, CAST(user_id AS VARCHAR) AS client, ts FROM events WHERE event_id % 10 = 0 ORDER BY ts DESC, client LIMIT 100""")
def recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("client"), "ts", (F.col("event_id") % 10 != 0).alias("allowed"), F.lit("client blocked").alias("reason"))
    return messages.alerts(e)


@query("""SELECT pipeline, kind, state FROM (SELECT event_type AS pipeline, CASE WHEN min(event_id) % 2 = 0 THEN 'child' ELSE 'mother' END AS kind, CASE WHEN count(*) % 2 = 0 THEN 'connected' ELSE 'silent' END AS state FROM events GROUP BY 1) ORDER BY kind DESC, pipeline""")
def pipelines_mother_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("pipeline")).agg(F.min("event_id").alias("least"), F.count("*").alias("n"))
    kind = F.when(F.col("least") % 2 == 0, "child").otherwise("mother")
    rows = by.select("pipeline", kind.alias("kind"), F.when(F.col("n") % 2 == 0, "connected").otherwise("silent").alias("state"))
    return rows.orderBy((F.col("kind") != "mother").cast("int"), "pipeline")


@query("""SELECT 'c_name' AS "column", 'contains plaintext' AS kind, count(*) AS n FROM customer WHERE c_custkey % 5 = 1 UNION ALL SELECT 'c_name', 'equals plaintext', count(*) FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT 'c_name', 'not an envelope', count(*) FROM customer WHERE c_custkey % 5 IN (0, 2) UNION ALL SELECT 'c_address', 'plaintext column', count(*) FROM customer""")
def encryption_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("somewhere").alias("c_address"))
    sealed, kind = F.concat(F.lit("enc:v1:"), F.base64(F.unhex(F.sha2("c_name", 256)))), F.col("c_custkey") % 5
    shown = F.when(kind == 0, F.col("c_name")).when(kind == 1, F.concat(F.lit("enc:v1:"), F.base64(F.concat(F.lit("x"), F.col("c_name"))))).when(kind == 2, F.lit("enc v1")).when(kind == 3, sealed)
    artifact = source.select("c_custkey", "c_address", shown.alias("c_name_encrypted"))
    return protect.encryption_leaks(artifact, source, "c_custkey", ["c_name", "c_address"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 7 IN (0, 1)")
def card_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, kind = table(spark, sf_dir, "orders").select("o_orderkey"), F.col("o_orderkey") % 7
    prefix = F.when(kind == 0, "4111111111111111").when(kind == 1, "411111111111").otherwise("41111111")
    return protect.card_leaks(o.select("o_orderkey", prefix.alias("card_prefix"), F.lit("1111").alias("card_suffix"))).select("o_orderkey")


@query("SELECT * FROM (VALUES ('c_name'), ('c_name_blind_index'), ('c_phone_encrypted'), ('c_phone_masked')) AS t(name)")
def flat_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*table(spark, sf_dir, "customer").columns, "c_phone_encrypted", "c_name_blind_index", "c_phone_masked", "masked_by"]
    return spark.createDataFrame([(c,) for c in protect.flat_leaks(columns, ["c_name"])], "name string")


def inferred_schema(df: DataFrame, enums: tuple[str, ...] = ()) -> dict:
    """The JSON Schema of a table's rows: types, required columns, and the values of the columns ``enums``, which have few."""
    kinds = {"bigint": "integer", "int": "integer", "double": "number", "boolean": "boolean"}
    out = {c: {"type": kinds.get(k, "string")} for c, k in df.dtypes}
    for c in enums:
        out[c]["enum"] = sorted(r[0] for r in df.select(c).distinct().collect())
    return {"type": "object", "required": df.columns, "properties": out}


@query("""SELECT unnest(['/props: no longer required', '/props: removed', '/user_id: type integer became string']) AS broken UNION ALL
SELECT '/event_type: enum values removed' FROM (SELECT count(DISTINCT event_type) AS n, count(DISTINCT CASE WHEN value > 10 AND event_type <> 'view' THEN event_type END) AS later FROM events) WHERE n > later""")
def incompatible_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas inferred from events and from a later version of them: a column less, a type changed, fewer values."""
    e = table(spark, sf_dir, "events")
    later = e.where("value > 10 AND event_type <> 'view'").drop("props").withColumn("user_id", F.col("user_id").cast("string"))
    return spark.createDataFrame([(x,) for x in messages.incompatible(inferred_schema(e, ("event_type",)), inferred_schema(later, ("event_type",)))], "broken string")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'not_json' WHEN event_id % 5 = 1 THEN 'inserted' WHEN event_id % 5 = 2 THEN 'inserted,updated' WHEN event_id % 5 = 3 THEN 'stage' ELSE '' END AS problems FROM events""")
def stage_event_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage events held against their contract file: one without a count, one with counts below 0, one of an unknown stage, one that is no JSON."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 5
    text = lambda stage, counts: F.concat(F.lit('{"trace_id": "t", "run_id": "r", "dataset": "events", "stage": "' + stage + '"'), counts, F.lit("}"))
    both = lambda n: F.concat(F.lit(', "inserted": '), n.cast("string"), F.lit(', "updated": '), n.cast("string"))
    value = F.when(kind == 0, F.lit("{")).when(kind == 1, text("load", F.lit(', "updated": 1'))).when(kind == 2, text("load", both(-F.col("user_id") - 1))).when(kind == 3, text("rest", F.lit(""))).otherwise(text("load", both(F.col("user_id"))))
    judged = messages.CONTRACTS.plan(messages.STAGE_SCHEMA).onto(e.select("event_id", value.alias("value")), "value", "problems")
    return judged.select("event_id", F.array_join("problems", ",").alias("problems"))
