"""Queries of the relational operators: profiles, reports, warehouse, messages, verdicts, rates, streams."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions import cards, ids
from veilframe.operators import classify, contracts, messages, reports, traffic, verdicts, warehouse
from veilframe.plans.registry import query, table
from veilframe.plans.scalar_queries import DEMO_KEYS
from veilframe.sources import tables

EVENT_COLS = ("event_id", "user_id", "event_type", "value")


@query("""SELECT header, n, n_values, n_distinct, sql_type FROM (VALUES ('event_id', 'BIGINT'), ('user_id', 'BIGINT'), ('event_type', 'TEXT'), ('value', 'DOUBLE PRECISION'), ('ts', 'TIMESTAMP')) AS t(header, sql_type)
JOIN (SELECT 'event_id' AS h, count(*) AS n, count(event_id) AS n_values, count(DISTINCT event_id) AS n_distinct FROM events
 UNION ALL SELECT 'user_id', count(*), count(user_id), count(DISTINCT user_id) FROM events
 UNION ALL SELECT 'event_type', count(*), count(nullif(event_type, '')), count(DISTINCT nullif(event_type, '')) FROM events
 UNION ALL SELECT 'value', count(*), count(value), count(DISTINCT value) FROM events
 UNION ALL SELECT 'ts', count(*), count(ts), count(DISTINCT date_trunc('second', ts)) FROM events) ON h = header""")
def schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(*EVENT_COLS, F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    return classify.profile(e).select("header", "n", "n_values", "n_distinct", "sql_type")


@query("""SELECT * FROM (VALUES ('customer', 'c_custkey', 'public', 'BIGINT', true), ('customer', 'c_name', 'quasi_identifier', 'TEXT', false), ('customer', 'c_nationkey', 'public', 'BIGINT', false),
('customer', 'c_acctbal', 'public', 'DOUBLE PRECISION', false), ('customer', 'c_mktsegment', 'public', 'TEXT', false),
('nation', 'n_nationkey', 'public', 'BIGINT', true), ('nation', 'n_name', 'quasi_identifier', 'TEXT', false), ('nation', 'n_regionkey', 'public', 'BIGINT', false),
('region', 'r_regionkey', 'public', 'BIGINT', true), ('region', 'r_name', 'quasi_identifier', 'TEXT', false)) AS t(dataset, name, sensitivity, sql_type, is_key)""")
def classify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for name in ("customer", "nation", "region"):
        m = classify.infer(table(spark, sf_dir, name), name)
        rows += [(name, c.name, c.sensitivity, c.sql_type, c.name == m.primary_key) for c in m.columns]
    return spark.createDataFrame(rows, "dataset string, name string, sensitivity string, sql_type string, is_key boolean")


@query("""SELECT * FROM (VALUES ('', 'primary_key', 'c_custkey', 'c_name'), ('c_acctbal', 'sql_type', 'DOUBLE PRECISION', 'TEXT'), ('c_name', 'sensitivity', 'quasi_identifier', 'direct_identifier'),
('c_phone', 'sensitivity', NULL, 'direct_identifier'), ('c_phone', 'source_name', NULL, 'c_phone'), ('c_phone', 'sql_type', NULL, 'TEXT'), ('c_phone', 'treatment', NULL, '')) AS t(subject, fact, committed, observed)""")
def contract_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    committed = contracts.block(classify.infer(table(spark, sf_dir, "customer"), "customer"))
    observed = {"primary_key": "c_name", "key_is_synthetic": False, "columns": {k: dict(v) for k, v in committed["columns"].items()}}
    observed["columns"]["c_acctbal"]["sql_type"] = "TEXT"
    observed["columns"]["c_name"]["sensitivity"] = classify.DIRECT
    observed["columns"]["c_phone"] = {"source_name": "c_phone", "sql_type": "TEXT", "sensitivity": classify.DIRECT, "treatment": ""}
    return contracts.diff(contracts.facts_frame(spark, committed), contracts.facts_frame(spark, observed))


@query("""SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate IS NOT NULL AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("1995-01-01", "1996-01-01"))
    return tables.in_window(rows, "o_orderdate", start, end).orderBy("o_orderdate", "o_orderkey").limit(100)


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 50""")
def sql_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime

    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_source")
    sql = "SELECT o_orderkey, o_orderstatus FROM orders_source WHERE o_orderdate >= :window_start AND o_orderdate < :window_end ORDER BY o_orderdate, o_orderkey LIMIT :row_limit"
    return tables.SqlSource(sql, max_rows=50).frame(spark, datetime(1996, 1, 1), datetime(1997, 1, 1))


@query("""SELECT p_type AS item, n_name, count(*) AS n_lines, round(sum(l_extendedprice), 1) AS amount FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity > 25 GROUP BY 1, 2""")
def fact_dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 25").select("l_partkey", "l_suppkey", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("item"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy("item", "n_name").agg(F.count("*").alias("n_lines"), F.round(F.sum("l_extendedprice"), 1).alias("amount"))


@query("""SELECT 'l_quantity' AS name, count(l_quantity) AS n, min(l_quantity) + 0.0 AS low, max(l_quantity) + 0.0 AS high FROM lineitem UNION ALL SELECT 'l_discount', count(l_discount), min(l_discount) + 0.0, max(l_discount) + 0.0 FROM lineitem
UNION ALL SELECT 'l_tax', count(l_tax), min(l_tax) + 0.0, max(l_tax) + 0.0 FROM lineitem UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), min(l_extendedprice) + 0.0, max(l_extendedprice) + 0.0 FROM lineitem""")
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    low, high = (lambda c: F.min(c) + 0.0), (lambda c: F.max(c) + 0.0)  # + 0.0 makes a negative zero plain
    wide = table(spark, sf_dir, "lineitem").agg(*(f(c).alias(f"{k}_{c}") for c in names for k, f in (("n", F.count), ("low", low), ("high", high))))
    return wide.select(F.inline(F.array(*(F.struct(F.lit(c).alias("name"), *(F.col(f"{k}_{c}").alias(k) for k in ("n", "low", "high"))) for c in names))))


@query("""SELECT 'l_returnflag' AS name, count(DISTINCT l_returnflag) AS n_distinct, count(DISTINCT l_returnflag) BETWEEN 2 AND 12 AS chartable FROM lineitem
UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus), count(DISTINCT l_linestatus) BETWEEN 2 AND 12 FROM lineitem""")
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("l_returnflag", "l_linestatus")
    row = table(spark, sf_dir, "lineitem").agg(*(F.count_distinct(c).alias(c) for c in names))
    return row.select(F.inline(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("n_distinct"), F.col(c).between(*reports.CATEGORY_BAND).alias("chartable")) for c in names))))


@query("""WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(CASE WHEN l_extendedprice >= hi THEN 7 ELSE floor((l_extendedprice - lo) / (hi - lo) * 6) + 1 END AS BIGINT) AS bucket, count(*) AS n FROM lineitem, b GROUP BY 1""")
def hist6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    lo, hi = rows.agg(F.min("l_extendedprice"), F.max("l_extendedprice")).first()
    return reports.histogram(rows, "l_extendedprice", lo, hi)


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1")
def by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_hour(table(spark, sf_dir, "events"), "ts")


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 6")
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_categories(table(spark, sf_dir, "events"), "event_type")


@query("SELECT left(coalesce(nullif(p_brand, ''), '(blank)'), 38) AS label, n FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 6)")
def category_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_bars(table(spark, sf_dir, "part"), "p_brand")


@query("""SELECT 'RECORDS' AS label, CAST(count(*) AS DOUBLE) AS value FROM orders UNION ALL SELECT 'AVG O TOTALPRICE', round(avg(o_totalprice), 1) FROM orders
UNION ALL SELECT 'MAX O TOTALPRICE', round(max(o_totalprice), 1) FROM orders UNION ALL SELECT 'TOTAL O TOTALPRICE', round(sum(o_totalprice), 1) FROM orders""")
def headline_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), *(reports.rounded(f("o_totalprice")).alias(k) for k, f in (("AVG", F.avg), ("MAX", F.max), ("TOTAL", F.sum))))
    cells = [F.struct(F.lit("RECORDS").alias("label"), F.col("n").cast("double").alias("value"))]
    cells += [F.struct(F.lit(f"{k} {reports.tile_label('o_totalprice')}").alias("label"), F.col(k).alias("value")) for k in ("AVG", "MAX", "TOTAL")]
    return row.select(F.inline(F.array(*cells)))


@query("""SELECT 'by_hour' AS kind, 'ts' AS "column" UNION ALL SELECT 'histogram', 'user_id' UNION ALL SELECT 'categories', 'event_type'""")
def chart_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").drop("props")
    found = reports.choose_charts(e, "event_id", reports.profile(e, "event_id").first().asDict())
    return spark.createDataFrame([(c.kind, c.column) for c in found], "kind string, column string")


@query("SELECT CASE WHEN c_nationkey < 5 THEN 'admin' ELSE 'local-policy-files' END AS masked_by, count(*) AS n FROM customer GROUP BY 1")
def provenance_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.provenance(table(spark, sf_dir, "customer").withColumn("masked_by", F.when(F.col("c_nationkey") < 5, "admin").otherwise("local-policy-files")))


@query("SELECT min(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS start, max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS \"end\" FROM events WHERE event_id % 50 <> 0")
def event_window_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 50 == 0, " ").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("at"))
    return contracts.event_window(e, "at")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))


def _two_slots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    old = o.where("o_orderkey % 3 <> 0").withColumn("run_slot", F.lit("s1"))
    new = o.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("run_slot", F.lit("s2"))
    return old, new


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 's2' ELSE 's1' END AS run_slot
FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.upsert(*_two_slots(spark, sf_dir), ["o_orderkey"])


@query("SELECT count(*) FILTER (WHERE o_orderkey % 3 = 0) AS inserted, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS updated FROM orders WHERE o_orderkey % 2 = 0")
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.upsert_counts(*_two_slots(spark, sf_dir), ["o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber, max(struct_pack(a := l_shipdate, p := l_extendedprice)).p AS l_extendedprice, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1, 2""")
def last_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    return warehouse.last_per_key(rows, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate"), F.col("l_extendedprice")])


@query("SELECT user_id, min(event_id) AS event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 7 = 0 AND user_id % 3 <> 0) GROUP BY 1")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id")
    return warehouse.insert_if_absent(e.where("event_id % 7 = 0 and user_id % 3 <> 0"), e, ["user_id"])


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 5 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 1""")
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderstatus = 'F' and o_orderkey % 2 = 1").withColumn("o_totalprice", F.col("o_totalprice") + 5)
    return warehouse.replace_partitions(o, new, "o_orderstatus")


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 'tier-' || (c_custkey % 4) END AS tier FROM customer""")
def additive_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    new = c.where("c_custkey % 2 = 0").withColumn("tier", F.concat(F.lit("tier-"), (F.col("c_custkey") % 4).cast("string")))
    return warehouse.upsert(c, new, ["c_custkey"])


def _envelope(kind: str) -> Column:
    return messages.envelope(kind, "orders", F.col("o_orderdate"), ids.trace_id(F.col("o_orderdate"), "orders"), "run-1", 1, F.col("o_orderkey"), "pipeline", F.lit("2026-01-01").cast("timestamp"))


@query("""SELECT topic, count(*) AS n, count(DISTINCT key) AS n_keys, count(*) AS n_valid, CAST(sum(CASE WHEN topic = 'rows.flat' THEN length(o_orderstatus) ELSE 0 END) AS BIGINT) AS status_chars
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus, unnest(['rows.encrypted', 'rows.flat']) AS topic FROM orders) GROUP BY 1""")
def published_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veilframe.functions import crypto

    rows = tables.spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"))
    sealed = crypto.Encryptor(DEMO_KEYS).protect(rows, {"o_orderpriority": "o_orderpriority_encrypted"}, {"o_orderpriority": "o_orderpriority_blind_index"})
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority_encrypted", "o_orderpriority_blind_index"]
    out = messages.row_messages(sealed, _envelope, cols, ["o_orderpriority"])
    m = messages.judged(out).withColumn("m", messages.parse(F.col("value")))
    return m.groupBy("topic").agg(
        F.count("*").alias("n"), F.count_distinct("key").alias("n_keys"), F.count_if(F.size("problems") == 0).alias("n_valid"),
        F.sum(F.coalesce(F.length(F.element_at("m.payload", "o_orderstatus")), F.lit(0)).cast("long")).alias("status_chars"),
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS run_slot, o_orderstatus AS status, round(o_totalprice, 2) AS total FROM orders""")
def envelope_flat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    out = messages.row_messages(rows, _envelope, ["o_orderstatus", "o_totalprice"], []).where(F.col("topic") == messages.TOPICS[messages.FLAT])
    get = lambda path: F.get_json_object("value", f"$.{path}")
    return out.select(get("envelope.key").cast("long").alias("o_orderkey"), get("envelope.run_slot").alias("run_slot"), get("payload.o_orderstatus").alias("status"), F.round(get("payload.o_totalprice").cast("double"), 2).alias("total"))


@query("""SELECT CASE event_id % 8 WHEN 0 THEN 'not_json' WHEN 1 THEN 'event_id' WHEN 2 THEN 'flat_payload' WHEN 3 THEN 'try_number' WHEN 4 THEN 'run_slot' ELSE '' END AS problems, count(*) AS n FROM events GROUP BY 1""")
def validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables.spread(table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"))
    kind, env = F.col("event_id") % 8, messages.envelope(messages.FLAT, "events", F.col("ts"), ids.trace_id(F.col("ts"), "events"), "run-1", 1, F.col("event_id"), "pipeline", F.col("ts"))
    broken = env
    for k, name, value in ((1, "event_id", F.lit("xyz")), (3, "try_number", F.lit(0)), (4, "run_slot", F.lit("yesterday"))):
        broken = F.when(kind == k, env.withField(name, value)).otherwise(broken)
    body = F.when(kind == 2, F.create_map(F.lit("c_name_masked"), F.col("event_type"))).otherwise(F.create_map(F.lit("event_type"), F.col("event_type")))
    value = F.when(kind == 0, F.lit("{oops")).otherwise(F.to_json(F.struct(broken.alias("envelope"), body.alias("payload"))))
    found = messages.judged(e.select(value.alias("value")))
    return found.groupBy(F.array_join("problems", ",").alias("problems")).agg(F.count("*").alias("n"))


_REPLAYS = """SELECT 'tap' AS consumer, 'e' || event_id AS event_id, 'u' || (event_id // 3) AS idempotency_key, event_id * 2 AS "offset" FROM events
UNION ALL SELECT 'tap', 'e' || event_id, 'u' || (event_id // 3), event_id * 2 + 1 FROM events WHERE event_id % 5 = 0"""


def _replays(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id")
    if spread:
        e = tables.spread(e)
    rows = e.selectExpr("'tap' AS consumer", "concat('e', event_id) AS event_id", "concat('u', event_id div 3) AS idempotency_key", "event_id * 2 AS offset", "event_id AS n")
    return rows.drop("n").unionByName(rows.where("n % 5 = 0").withColumn("offset", F.col("offset") + 1).drop("n"))


@query(f"""WITH m AS ({_REPLAYS}), s AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "offset") AS nth FROM m)
SELECT *  EXCLUDE (nth), CASE WHEN nth > 1 THEN 'drop' WHEN (SELECT count(*) FROM s AS x WHERE x.nth = 1 AND x.idempotency_key = s.idempotency_key AND x."offset" < s."offset") > 0 THEN 'replay' ELSE 'first' END AS decision FROM s""")
def dedupe_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.dedupe(_replays(spark, sf_dir))


@query("""SELECT event_type AS dataset, arg_max(event_id, (date_trunc('hour', ts), event_id)) AS event_id, max(date_trunc('hour', ts)) AS run_slot FROM events GROUP BY 1""")
def latest_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("run_slot"), "event_id")
    return messages.latest_by_slot(v, order=("run_slot", "event_id"))


@query("""WITH v AS (SELECT event_type AS dataset, date_trunc('hour', ts) AS run_slot, event_id % 3 <> 0 AS proceed, event_id FROM events WHERE event_type <> (SELECT max(event_type) FROM events)),
l AS (SELECT dataset, arg_max(proceed, (run_slot, event_id)) AS proceed, max(run_slot) AS run_slot FROM v GROUP BY 1),
n AS (SELECT max(ts) + INTERVAL 4 HOUR AS now FROM events), x AS (SELECT dataset FROM l UNION SELECT max(event_type) FROM events),
r AS (SELECT x.dataset, CASE WHEN l.run_slot IS NULL THEN 'never_seen' ELSE concat_ws(',', CASE WHEN now > run_slot + INTERVAL 270 MINUTE THEN 'overdue' END, CASE WHEN NOT proceed THEN 'proceed=false:failed' END) END AS reasons
 FROM x LEFT JOIN l ON l.dataset = x.dataset, n) SELECT dataset, reasons = '' AS healthy, reasons FROM r""")
def watchdog_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    last, silent = e.agg(F.max("ts").alias("t"), F.max("event_type").alias("e")).first()
    v = e.where(F.col("event_type") != silent).select(F.col("event_type").alias("dataset"), F.date_trunc("hour", "ts").alias("run_slot"), (F.col("event_id") % 3 != 0).alias("proceed"), "event_id")
    latest = messages.latest_by_slot(v, order=("run_slot", "event_id")).withColumn("status", F.when(F.col("proceed"), "complete").otherwise("failed"))
    now = F.lit(last) + F.expr("INTERVAL 4 HOURS")
    found = verdicts.slot_status(e.select(F.col("event_type").alias("dataset")), latest, now, F.lit(last) - F.expr("INTERVAL 9 HOURS"))
    return found.withColumn("reasons", F.array_join("reasons", ","))


@query("""WITH e AS (SELECT event_type, event_id, event_id % 4 < 2 AS healthy, lag(event_id % 4 < 2) OVER (PARTITION BY event_type ORDER BY event_id) AS b FROM events)
SELECT event_type, event_id, healthy FROM e WHERE b IS DISTINCT FROM healthy""")
def status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", (F.col("event_id") % 4 < 2).alias("healthy"))
    return verdicts.changes(rows, "event_type", "event_id", slot=F.floor(F.col("event_id") / 500))


@query("""WITH r AS (SELECT o_orderkey AS run, o_orderkey % 10 AS kind FROM orders)
SELECT 'run-' || run AS run_id, kind NOT IN (1, 2) AS proceed, CASE WHEN kind IN (1, 2) THEN 'failed' WHEN kind IN (3, 4, 5, 6) THEN 'degraded' ELSE 'complete' END AS status,
CASE kind WHEN 1 THEN 'load failed: boom boom' WHEN 2 THEN 'report did not complete' WHEN 3 THEN 'extract fell back to CSV after 3 attempt(s) at its source' WHEN 4 THEN 'encrypt ran on local although Spark was configured'
 WHEN 5 THEN 'hive table not registered: no reason given' WHEN 6 THEN 'delivery copy failed: disk full' ELSE '' END AS reasons, CASE WHEN kind = 1 THEN NULL ELSE run + 1 END AS rows_loaded FROM r""")
def verdict_compute(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 10).alias("kind"))
    e = runs.select("o_orderkey", "kind", F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"), F.explode(F.array(*map(F.lit, verdicts.STAGES))).alias("stage"))
    e = e.where(~((F.col("kind") == 2) & (F.col("stage") == "report")))
    at = lambda s, k: (F.col("stage") == s) & (F.col("kind") == k)
    rows = e.select(
        "run_id", "stage", F.when(at("load", 1), "boom\n  boom").alias("error"), at("extract", 3).alias("fell_back"), F.lit(3).alias("attempts"),
        F.when(at("encrypt", 4), "local").otherwise("spark").alias("engine"), F.lit(True).alias("spark_configured"), (~at("hive_register", 5)).alias("registered"), F.lit(None).cast("string").alias("reason"),
        F.when(at("report", 6), "disk full").otherwise("/out/report.pdf").alias("collected"), F.lit("orders").alias("dataset"), F.lit(1).cast("long").alias("rows"),
        F.col("o_orderkey").alias("inserted"), F.lit(1).cast("long").alias("updated"), *(F.lit(None).cast("string").alias(c) for c in ("window_start", "window_end", "window_source")),
    )
    found = verdicts.compute_frame(rows)
    return found.select("run_id", "proceed", "status", F.array_join("reasons", "|").alias("reasons"), "rows_loaded")


_HITS = """SELECT event_id, user_id AS client, event_type AS category, ts FROM events"""


@query(f"""WITH h AS ({_HITS}) SELECT event_id, count(*) OVER (PARTITION BY category, client ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS client_hits,
count(*) OVER (PARTITION BY category ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS category_hits FROM h""")
def sliding_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("client"), F.col("event_type").alias("category"), "ts")
    return traffic.sliding_rates(e, 3600).select("event_id", "client_hits", "category_hits")


@query(f"""WITH h AS ({_HITS}), r AS (SELECT *, count(*) OVER (PARTITION BY category, client ORDER BY ts RANGE BETWEEN INTERVAL 86400 SECOND PRECEDING AND CURRENT ROW) AS c,
count(*) OVER (PARTITION BY category ORDER BY ts RANGE BETWEEN INTERVAL 86400 SECOND PRECEDING AND CURRENT ROW) AS t FROM h)
SELECT category, CAST(client AS VARCHAR) AS client, min(ts) AS first_at, max(c) AS worst FROM r WHERE c > 1 GROUP BY 1, 2 UNION ALL SELECT category, NULL, min(ts), max(t) FROM r WHERE t > 40 GROUP BY 1""")
def rate_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("client"), F.col("event_type").alias("category"), "ts")
    limits = e.select("category").distinct().select("category", F.lit(1).alias("per_client"), F.lit(40).alias("total"))
    return traffic.breaches(traffic.sliding_rates(e, 86400), limits)


@query("""WITH n AS (SELECT max(ts) AS now FROM events), h AS (SELECT event_type AS category, CAST(user_id AS VARCHAR) AS client, count(*) AS hits FROM events, n WHERE ts >= now - INTERVAL 10 DAY AND ts <= now GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY hits DESC, client) AS r FROM h)
SELECT category, CAST(sum(hits) AS BIGINT) AS hits, string_agg(client || '=' || hits, ',' ORDER BY r) FILTER (WHERE r <= 5) AS top_clients FROM r GROUP BY 1""")
def traffic_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("client"), F.col("event_type").alias("category"), F.col("ts").cast("timestamp").alias("ts"))
    now = e.agg(F.max("ts")).first()[0]
    return traffic.snapshot(e, F.lit(now), 10 * 86_400)


@query("""SELECT page_id, CASE WHEN path LIKE '/en%' THEN 'english' WHEN path LIKE '/fr/1%' THEN 'french-1' WHEN path LIKE '/fr%' THEN 'french' ELSE 'default' END AS category FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+(/.*)$', 1) AS path FROM pages)""")
def route_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(1, "GET /en", "english"), (2, "GET /fr/1", "french-1"), (3, "GET /fr", "french"), (4, "POST /", "write")], "rule_no int, prefix string, category string")
    pages = table(spark, sf_dir, "pages").select("page_id", F.lit("get").alias("method"), F.regexp_extract("url", "^https?://[^/]+(/.*)$", 1).alias("path"))
    return traffic.route(pages, rules).select("page_id", "category")


@query("""WITH s AS (SELECT event_id, 8 AS total_cores, event_id % 9 AS used_cores, event_id % 8 AS alive, event_id % 11 = 0 AS waiting, event_id % 2 AS active, event_id % 3 AS scaled, event_id % 300 AS since FROM events)
SELECT event_id, CASE WHEN since < 120 THEN 'hold' WHEN alive < 2 THEN 'up' WHEN (waiting OR used_cores / 8.0 >= 0.8) AND alive < 6 THEN 'up' WHEN waiting OR used_cores / 8.0 >= 0.8 THEN 'hold'
WHEN used_cores / 8.0 <= 0.2 AND active = 0 AND alive > 2 AND scaled > 0 THEN 'down' ELSE 'hold' END AS action FROM s""")
def scale_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").selectExpr(
        "event_id", "8 AS total_cores", "event_id % 9 AS used_cores", "event_id % 8 AS alive", "CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS waiting", "event_id % 2 AS active", "event_id % 3 AS scaled", "event_id % 300 AS since_last")
    return e.select("event_id", traffic.scale_decision().alias("action"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '10.0.0.' || (user_id % 256) ELSE '192.168.1.' || (user_id % 256) END AS client, CASE upper(s) WHEN 'ALIVE' THEN 'healthy' WHEN 'DEAD' THEN 'unhealthy' ELSE 'warning' END AS colour,
CASE WHEN event_id % 2 = 0 THEN 'child' ELSE 'mother' END AS kind FROM (SELECT *, ['alive', 'Dead', 'UNKNOWN', ''][CAST(event_id % 4 + 1 AS INT)] AS s FROM events)""")
def small_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    last = (F.col("user_id") % 256).cast("string")
    forwarded = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" 10.0.0."), last, F.lit(" , 9.9.9.9")))
    state = F.element_at(F.array(*map(F.lit, ("alive", "Dead", "UNKNOWN", ""))), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select("event_id", traffic.client_address(forwarded, F.concat(F.lit("192.168.1."), last)).alias("client"), traffic.worker_colour(state).alias("colour"),
                    traffic.pipeline_kind(F.when(F.col("event_id") % 2 == 0, "asset").otherwise("cron")).alias("kind"))


@query("SELECT event_id, ts, event_type FROM events WHERE event_type = (SELECT min(event_type) FROM events) AND value > 10 ORDER BY event_id DESC LIMIT 20 OFFSET 10")
def paged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    wanted = [F.col("event_type") == e.agg(F.min("event_type")).first()[0], F.col("value") > 10]
    rows = e
    for condition in wanted:
        rows = rows.where(condition)
    return rows.select("event_id", "ts", "event_type").orderBy(F.desc("event_id")).offset(10).limit(20)


@query("""WITH runs AS (SELECT 'run-' || event_id AS run_id, event_type AS pipeline, CASE WHEN event_id % 4 = 0 THEN 'failed' ELSE 'success' END AS run_state, ts AS ended_at FROM events),
v AS (SELECT 'run-' || event_id AS run_id, event_id % 3 <> 0 AS proceed FROM events WHERE event_id % 2 = 0), n AS (SELECT max(ts) AS now FROM events)
SELECT r.run_id, pipeline, CASE WHEN ended_at < now - INTERVAL 14400 MINUTE THEN 'silent' WHEN run_state <> 'success' THEN 'failed' WHEN proceed THEN 'connected' ELSE 'responding' END AS state FROM runs r LEFT JOIN v ON v.run_id = r.run_id, n""")
def run_verdict_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("run_id", F.concat(F.lit("run-"), F.col("event_id")))
    now = e.agg(F.max("ts")).first()[0]
    runs = e.select("run_id", F.col("event_type").alias("pipeline"), F.when(F.col("event_id") % 4 == 0, "failed").otherwise("success").alias("run_state"), F.col("ts").alias("ended_at"))
    log = e.where("event_id % 2 = 0").select(F.to_json(F.struct(F.struct("run_id").alias("envelope"), F.struct((F.col("event_id") % 3 != 0).alias("proceed")).alias("payload"))).alias("raw"))
    found = log.select(F.get_json_object("raw", "$.envelope.run_id").alias("run_id"), (F.get_json_object("raw", "$.payload.proceed") == "true").alias("proceed"))
    return verdicts.connection_state(runs, found, F.lit(now), 14_400)


def _stream(spark: SparkSession, sf_dir: str, rows: DataFrame, transform, mode: str) -> DataFrame:
    """What a stream over files of ``rows`` has put out when all are read."""
    folder = _folder(spark)
    rows.write.parquet(f"{folder}/in")
    q = transform(spark.readStream.schema(rows.schema).parquet(f"{folder}/in")).writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        q.format("parquet").option("path", f"{folder}/out").start().awaitTermination()
    else:
        q.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{folder}/out")).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _folder(spark: SparkSession) -> str:
    import uuid

    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="veilframe-stream-")
    return f"{base}/stream-{uuid.uuid4().hex}"


@query(f"""WITH m AS ({_REPLAYS}), s AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "offset") AS nth FROM m), f AS (SELECT event_id, min("offset") AS o, any_value(idempotency_key) AS u FROM s GROUP BY 1)
SELECT s.idempotency_key, s.event_id, s."offset", CASE WHEN nth > 1 THEN 'drop' WHEN s."offset" > (SELECT min(o) FROM f WHERE f.u = s.idempotency_key) THEN 'replay' ELSE 'first' END AS decision FROM s""")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veilframe.streaming import consumers

    rows = _replays(spark, sf_dir, spread=True).select("event_id", "idempotency_key", "offset", F.timestamp_seconds(F.col("offset") + 1_000_000).alias("received_at"))
    return _stream(spark, sf_dir, rows, consumers.decisions, "append")


@query("""SELECT event_type AS dataset, max(date_trunc('hour', ts)) AS run_slot, arg_max('e' || event_id, (date_trunc('hour', ts), event_id)) AS event_id, 'complete' AS status, true AS proceed FROM events GROUP BY 1""")
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veilframe.streaming import consumers

    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("run_slot"), F.concat(F.lit("e"), F.col("event_id")).alias("event_id"),
        F.lit("complete").alias("status"), F.lit(True).alias("proceed"), F.col("event_id").alias("offset"))
    return _stream(spark, sf_dir, rows, consumers.latest_verdicts, "complete")


@query("""SELECT event_id, event_id % 6 <> 0 AS valid FROM events""")
def stream_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veilframe.streaming import consumers

    e = tables.spread(table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts")))
    env = messages.envelope(messages.FLAT, "events", F.col("ts"), ids.trace_id(F.col("ts"), "events"), "run-1", 1, F.col("event_id"), "pipeline", F.col("ts"))
    whole = F.to_json(F.struct(env.alias("envelope"), F.create_map(F.lit("event_type"), F.col("event_type")).alias("payload")))
    value = F.when(F.col("event_id") % 6 == 0, F.lit("{}")).otherwise(whole)
    rows = e.select(F.lit("rows.flat").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), value.alias("value"), F.col("ts").alias("received_at"))
    folder = _folder(spark)
    rows.unionByName(rows.where("offset % 4 = 0")).write.parquet(f"{folder}/in")
    stream = consumers.read_messages(spark, f"{folder}/in")
    consumers.tap(stream, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/log").select(F.col("offset").alias("event_id"), "valid")


@query("""SELECT o_orderkey, 'O' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS order_id, 16 AS digits, true AS valid, true AS same FROM orders""", "synthetic_source_is_stable")
def _synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A synthetic order for each order of the table, by its key: its card number is valid, and it is the same however the source is cut into tasks."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    n = (orders.agg(F.max("o_orderkey")).first()[0] or 0) + 1
    made = tables.synthetic_orders(spark, n)
    again = tables.synthetic_orders(spark, n).repartition(7).select("order_id", F.struct("customer_name", "customer_email", "card_info", "sale_price").alias("again"))
    key = F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
    found = orders.withColumn("order_id", key).join(made, "order_id").join(again, "order_id")
    same = F.struct("customer_name", "customer_email", "card_info", "sale_price") == F.col("again")
    return found.select("o_orderkey", "order_id", F.length("card_info").alias("digits"), cards.is_card_number(F.col("card_info")).alias("valid"), same.alias("same"))
