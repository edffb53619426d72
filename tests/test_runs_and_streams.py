from datetime import datetime

from pyspark.sql import functions as F

from veilframe.functions import crypto
from veilframe.operators import traffic
from veilframe.plans import run
from veilframe.streaming import consumers

KEYS = crypto.Keys("v1", bytes(range(32)), bytes(range(40)))


def write_csv(path, n, extra=""):
    pans = ["4111111111111111", "5555555555554444", "378282246310005"]
    lines = [f"o{i},c{i}@example.com,{i}.25,{pans[i % 3]},2026-01-01 0{i % 9}:00:00" for i in range(n)]
    path.write_text("order_id,customer_email,sale_price,card_info,sold_at" + extra + "\n" + "\n".join(x + (",1" if extra else "") for x in lines) + "\n")


def test_a_run_from_file_to_verdict(spark, tmp_path):
    path = tmp_path / "orders.csv"
    write_csv(path, 7)
    out = str(tmp_path / "out")
    env = run.RunEnv(spark, datetime(2026, 1, 1, 4), out, "orders", str(path), keys=KEYS)
    events, failures, message = run.run(env)
    assert failures == [] and message["payload"]["proceed"], failures
    assert events["load"]["inserted"] == 7 and events["card_split"]["cards"] == 1 and events["publish"]["rows"] == 7
    again = run.RunEnv(spark, datetime(2026, 1, 1, 4), out, "orders", str(path), keys=KEYS)
    events, _, second = run.run(again)
    assert events["load"] | {"run_id": 0} == {"stage": "load", "dataset": "orders", "inserted": 0, "updated": 7, "run_id": 0}
    assert second["envelope"]["idempotency_key"] == message["envelope"]["idempotency_key"] and second["envelope"]["event_id"] != message["envelope"]["event_id"]
    write_csv(path, 7, ",phone")
    events, failures, message = run.run(run.RunEnv(spark, datetime(2026, 1, 1, 8), out, "orders", str(path), keys=KEYS))
    assert [(f["stage"], f["error_type"], f["retryable"]) for f in failures] == [("extract", "ContractMismatch", False)]
    assert message["payload"]["status"] == "failed" and message["payload"]["reasons"][0].startswith("extract failed: orders:")


def test_a_run_over_one_file_is_many_tasks(spark, tmp_path):
    path = tmp_path / "orders.csv"
    write_csv(path, 40)
    env = run.RunEnv(spark, datetime(2026, 1, 1, 4), str(tmp_path / "out"), "orders", str(path), keys=KEYS)
    assert run.run(env, ["extract"], verdict=False)[1] == []
    assert env.read("landed").select(F.input_file_name()).distinct().count() >= 4


def test_no_plaintext_in_any_artifact(spark, tmp_path):
    path = tmp_path / "orders.csv"
    write_csv(path, 5)
    env = run.RunEnv(spark, datetime(2026, 1, 1, 4), str(tmp_path / "out"), "orders", str(path), keys=KEYS)
    run.run(env, verdict=False)
    for kind in ("encrypted", "masked", "card_info", "messages"):
        rows = env.read(kind)
        text = rows.select(F.concat_ws("|", *(F.col(c).cast("string") for c in rows.columns)).alias("t"))
        assert text.where(F.col("t").contains("@example.com") | F.col("t").contains("4111111111111111")).count() == 0, kind


def stream(spark, rows, path):
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def collect(q, spark, tmp_path):
    q.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).format("parquet").option("path", str(tmp_path / "o")).start().awaitTermination()
    return spark.read.parquet(str(tmp_path / "o")).collect()


def test_absence_alarms(spark, tmp_path):
    rows = [("a", "2026-01-01 00:00:00"), ("b", "2026-01-01 00:00:00"), ("b", "2026-01-01 08:00:00"), ("b", "2026-01-01 16:00:00")]
    path = str(tmp_path / "in")
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "dataset string, at string").select("dataset", F.to_timestamp("at").alias("run_slot")).coalesce(1).write.mode("append").parquet(path)
    s = spark.readStream.schema("dataset string, run_slot timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    got = {(r.dataset, r.kind) for r in collect(consumers.absences(s).writeStream.outputMode("append"), spark, tmp_path)}
    assert ("a", "overdue") in got and ("a", "back") not in got


def test_client_blocks(spark, tmp_path):
    rows = spark.createDataFrame([("x", i) for i in (0, 10, 20, 30, 331, 332)] + [("y", 0)], "client string, at long").select("client", F.timestamp_seconds(F.col("at") + 1_000_000).alias("ts"))
    got = collect(consumers.client_blocks(stream(spark, rows, str(tmp_path / "in")), 2).writeStream.outputMode("append"), spark, tmp_path)
    x = [r.allowed for r in sorted((r for r in got if r.client == "x"), key=lambda r: r.ts)]
    assert x == [True, True, False, False, True, True]


def test_listed_clients_are_not_blocked(spark, tmp_path):
    rows = spark.createDataFrame([(c, i) for c in ("10.1.2.3", "2001:db8::7", "9.9.9.9") for i in range(4)], "client string, at long").select("client", F.timestamp_seconds(F.col("at") + 1_000_000).alias("ts"))
    got = collect(consumers.client_blocks(stream(spark, rows, str(tmp_path / "in")), 2, allowlist=("10.0.0.0/8", "2001:db8::/32")).writeStream.outputMode("append"), spark, tmp_path)
    assert len(got) == 12 and {r.client for r in got if not r.allowed} == {"9.9.9.9"} and {r.reason for r in got if r.client[0] != "9"} == {"on the allowlist"}


def test_rows_of_a_key_in_several_pieces_are_in_order(spark, tmp_path):
    """Arrow cuts a key's rows anywhere, and pieces come in no order."""
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    own.conf.set("spark.sql.shuffle.partitions", "1")
    offsets = [9, 8, 7, 6, 5, 4, 3, 2, 1, 0]
    sent = own.createDataFrame([("u", f"e{o // 2}", o) for o in offsets], "idempotency_key string, event_id string, offset long").withColumn("received_at", F.timestamp_seconds(F.col("offset") + 1_000_000))
    got = collect(consumers.decisions(stream(own, sent, str(tmp_path / "in"))).writeStream.outputMode("append"), own, tmp_path)
    assert [r.decision for r in sorted(got, key=lambda r: r.offset)] == ["first", "drop", *["replay", "drop"] * 4]
    hits = own.createDataFrame([("x", i) for i in (332, 331, 30, 20, 10, 0)], "client string, at long").select("client", F.timestamp_seconds(F.col("at") + 1_000_000).alias("ts"))
    blocked = collect(consumers.client_blocks(stream(own, hits, str(tmp_path / "b" / "in")), 2).writeStream.outputMode("append"), own, tmp_path / "b")
    assert [r.allowed for r in sorted(blocked, key=lambda r: r.ts)] == [True, True, False, False, True, True]


def test_total_breaches(spark, tmp_path):
    rows = spark.createDataFrame([("read", i % 20) for i in range(30)] + [("write", i) for i in range(5)] + [("read", 500)], "category string, at long").withColumn("ts", F.timestamp_seconds("at"))
    limits = spark.createDataFrame([("read", 25), ("write", 25)], "category string, total long")
    got = collect(consumers.total_breaches(stream(spark, rows, str(tmp_path / "in")), limits, "60 seconds", "60 seconds").writeStream.outputMode("append"), spark, tmp_path)
    assert [(r.category, r.hits) for r in got] == [("read", 30)]


def test_datasets_never_seen_alarm(spark, tmp_path):
    path = str(tmp_path / "in")
    for at in ("2026-01-01 00:00:00", "2026-01-01 08:00:00", "2026-01-01 16:00:00"):
        spark.createDataFrame([("b", at)], "dataset string, at string").select("dataset", F.to_timestamp("at").alias("run_slot")).coalesce(1).write.mode("append").parquet(path)
    named = str(tmp_path / "roster")
    spark.createDataFrame([("b",), ("gone",)], "dataset string").withColumn("started", F.to_timestamp(F.lit("2026-01-01 00:00:00"))).coalesce(1).write.parquet(named)
    s = spark.readStream.schema("dataset string, run_slot timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    roster = spark.readStream.schema("dataset string, started timestamp").parquet(named)
    got = {(r.dataset, r.kind) for r in collect(consumers.absences(s, roster=roster).writeStream.outputMode("append"), spark, tmp_path)}
    assert ("gone", "never_seen") in got and ("b", "never_seen") not in got


def test_first_sights_and_ledger(spark, tmp_path):
    rows = spark.createDataFrame([("c", "e1", "u1", 1), ("c", "e1", "u1", 2), ("c", "e2", "u1", 3)], "consumer string, event_id string, idempotency_key string, at long").withColumn("received_at", F.timestamp_seconds("at"))
    s = stream(spark, rows, str(tmp_path / "in"))
    assert sorted(r.event_id for r in collect(consumers.first_sights(s).writeStream.outputMode("append"), spark, tmp_path)) == ["e1", "e2"]
    for k in range(2):
        consumers.ledger(s, str(tmp_path / "l"), str(tmp_path / f"lc{k}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "l")).count() == 2
    consumers.record_verdicts(s.withColumn("offset", F.col("at")), str(tmp_path / "v"), str(tmp_path / "vc")).awaitTermination()
    from veilframe.operators.warehouse import VersionedTable

    assert [(r.idempotency_key, r.event_id) for r in VersionedTable(spark, str(tmp_path / "v")).read().collect()] == [("u1", "e2")]


def test_rate_windows(spark, tmp_path):
    rows = spark.createDataFrame([("read", "x", i) for i in (0, 1, 2, 200)], "category string, client string, at long").withColumn("ts", F.timestamp_seconds("at"))
    got = collect(consumers.rate_windows(stream(spark, rows, str(tmp_path / "in")), "60 seconds", "60 seconds").writeStream.outputMode("append"), spark, tmp_path)
    assert [(r.client, r.hits) for r in got] == [("x", 3)]
    profile = traffic.Profile((traffic.Category("auth", ("POST /login",), 3, 5),), traffic.Category("default", (), 50, 500))
    df = spark.createDataFrame([("post", "/login/x"), ("get", "/login")], "m string, p string")
    assert [r[0] for r in df.select(profile.category(F.col("m"), F.col("p"))).collect()] == ["auth", "default"]


def test_messages_of_the_tap_query_are_written_by_all_cores(spark, monkeypatch):
    from pathlib import Path

    from veilframe.plans import catalog
    from veilframe.streaming import consumers

    files, read = [], consumers.read_messages
    monkeypatch.setattr(consumers, "read_messages", lambda s, path, **o: files.extend(Path(path.removeprefix("file:")).glob("*.parquet")) or read(s, path, **o))
    catalog.QUERIES["stream_tap"](spark, "/root/testdata/sf0.001")
    assert len(files) >= spark.sparkContext.defaultParallelism


def test_narrow_segments_are_read_in_runs():
    from veilframe.sources import message_log

    segments = [message_log.Segment(f"/log/{p}/{n}", "t", p, 10 * n, 10 * n + 10) for p in range(2) for n in range(7)]
    found = message_log.runs(segments, offsets=30)
    assert [len(r.segments) for r in found] == [3, 3, 1] * 2 and [s for r in found for s in r.segments] == segments
    assert [len(r.segments) for r in message_log.runs(segments, offsets=5)] == [1] * 14


def test_units_share_calls_and_state_and_go_one_by_one(spark, tmp_path):
    path, hour = str(tmp_path / "in"), 3600
    many = [(f"u{i}", f"e{i}", i, 0) for i in range(300)]
    for batch in ([*many, (None, None, 300, 0), (None, "e", 301, 0)], [("x", "x1", 302, 10 * hour)], [("x", "x2", 303, 10 * hour), ("u7", "e7", 304, 9.5 * hour)], [("u7", "e7", 305, 10 * hour), ("u8", "e8", 306, 10 * hour)]):
        rows = spark.createDataFrame([(*r[:3], float(r[3])) for r in batch], "idempotency_key string, event_id string, offset long, at double")
        rows.withColumn("received_at", F.timestamp_seconds(F.col("at") + 1_000_000)).drop("at").coalesce(1).write.mode("append").parquet(path)
    sent = spark.readStream.schema("idempotency_key string, event_id string, offset long, received_at timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    q = consumers.decisions(sent, "1 hour", buckets=8).writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).format("parquet").option("path", str(tmp_path / "o")).start()
    q.awaitTermination()
    got = {r.offset: r.decision for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert [got[i] for i in range(300)] == ["first"] * 300 and (got[300], got[301]) == ("first", "replay")
    # u7 was known when it came again, and is kept from then on; u8 was not seen for an hour, and begins anew
    assert [got[i] for i in range(302, 307)] == ["first", "replay", "drop", "drop", "first"]
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress) == 8


def test_messages_of_the_dedupe_query_are_written_by_all_cores(spark, monkeypatch):
    from veilframe.plans import catalog, relational_queries

    parts, run_stream = [], relational_queries._stream
    monkeypatch.setattr(relational_queries, "_stream", lambda s, d, rows, *more: parts.append(rows.rdd.getNumPartitions()) or run_stream(s, d, rows, *more))
    catalog.QUERIES["stream_dedupe"](spark, "/root/testdata/sf0.001")
    assert parts[0] >= 2 * spark.sparkContext.defaultParallelism
