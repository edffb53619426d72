"""Merged profiles, artifacts held against each other, and the message log as a source."""

import collections
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from veilframe.operators import reconcile, states
from veilframe.sources import message_log


def test_states_of_slots_merge_to_the_exact_figures(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), None if i % 11 == 0 else rng.gauss(0, 50), rng.randrange(3000), None) for i in range(9000)] + [(None, float("nan"), 7, None)]
    df = spark.createDataFrame(rows, "slot string, x double, id int, nothing string")
    kept = states.states(df, ["slot"])
    assert kept.count() == 4 * 3 and kept.where("slot is null").count() == 3  # a null slot is a slot
    got = {r["column"]: r for r in states.figures(states.merged(states.merged(kept, ["slot"])), at=[0.1, 0.5, 0.9]).collect()}
    values = sorted(x for _, x, _, _ in rows if x is not None and x == x)
    assert (got["x"].rows, got["x"].nulls, got["x"].low, got["x"].high) == (9001, sum(x is None for _, x, _, _ in rows), values[0], values[-1])
    assert float(got["x"].total) == pytest.approx(sum(values), abs=0.01)
    for q, found in zip((0.1, 0.5, 0.9), got["x"].quantiles, strict=True):
        assert abs(sum(v <= found for v in values) / len(values) - q) < 0.01
    assert abs(got["id"].distinct - len({r[2] for r in rows})) < 0.05 * 3000
    assert (got["nothing"].nulls, got["nothing"].distinct, got["nothing"].low, got["nothing"].quantiles) == (9001, 0, None, None)
    assert states.states(df.limit(0), ["slot"]).count() == 0
    with pytest.raises(ValueError, match="rows"):
        states.states(df.withColumnRenamed("slot", "rows"), ["rows"])


def test_differences_are_except_all_both_ways(spark):
    rng = random.Random(6)

    def side():
        return [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b"]), rng.choice([None, 0.5])) for _ in range(300)] + [(1, "hot", 0.5)] * (500 + rng.randrange(3))

    left, right = side(), side()
    a, b = (spark.createDataFrame(rows, "k int, `odd.name` string, v double") for rows in (left, right))
    one, other = collections.Counter(left), collections.Counter(right)
    want = {r: one[r] - other[r] for r in one | other if one[r] != other[r]}
    assert {tuple(r)[:3]: r.surplus for r in reconcile.differences(a, b, ["k"], buckets=16).collect()} == want
    assert {tuple(r)[:3]: r.surplus for r in reconcile.differences(a, a.limit(0), ["k"], buckets=16).collect()} == dict(one)
    assert reconcile.differences(a, a.repartition(7), ["k"]).count() == 0
    with pytest.raises(ValueError, match="differ in their columns"):
        reconcile.differences(a, b.withColumn("v", F.col("v").cast("string")), ["k"])


def test_only_buckets_that_differ_are_compared(spark):
    a = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 500, 99).otherwise(F.col("v")))
    bad = reconcile.unequal(reconcile.digests(a, ["id"], buckets=64), reconcile.digests(b, ["id"], buckets=64))
    assert bad.count() == 1
    swapped = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "id int, p string, q string"), spark.createDataFrame([(1, "x", None), (2, None, "x")], "id int, p string, q string")
    assert reconcile.differences(*swapped, ["id"]).count() == 4  # nulls in other places are another row


def messages(spark, offsets, topic="t/ä"):
    return spark.createDataFrame([(topic, o % 2, o // 2, None if o % 5 == 0 else f"k{o}", f"v{o}", datetime(2026, 1, 1, 0, 0, o % 60)) for o in offsets], message_log.SCHEMA)


def test_a_log_is_read_once_whatever_was_written_twice(spark, tmp_path):
    path = str(tmp_path / "log")
    message_log.append(messages(spark, range(50)), path, 10)
    message_log.append(messages(spark, range(40, 50)), path, 10)  # a write that was tried again
    message_log.append(messages(spark, range(6), "other"), path, 10)
    got = message_log.read(spark, path, width="10")
    assert got.where("topic = 't/ä'").count() == 50 and got.where("topic = 'other'").count() == 6
    assert sorted(r.value for r in message_log.read(spark, path, width="10", topics="other").collect()) == [f"v{i}" for i in range(6)]
    row = got.where("value = 'v23'").first()
    assert (row.topic, row.partition, row.offset, row.key, row.received_at) == ("t/ä", 1, 11, "k23", datetime(2026, 1, 1, 0, 0, 23))
    assert message_log.read(spark, str(tmp_path / "none")).count() == 0


def test_a_stream_waits_for_gaps_and_goes_on_from_its_checkpoint(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")

    def drain():
        stream = message_log.read(spark, path, stream=True, width="10")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
        return sorted(int(r.value[1:]) for r in spark.read.parquet(out).select("value").collect())

    message_log.append(messages(spark, range(30)), path, 10)
    assert drain() == list(range(30))
    message_log.append(messages(spark, range(60, 70)), path, 10)  # seen before what comes before it
    assert drain() == list(range(30))
    message_log.append(messages(spark, range(30, 60)), path, 10)
    assert drain() == list(range(70)) == drain()
    message_log.append(messages(spark, range(4), "new"), path, 10)  # a topic that comes later begins at 0
    assert drain() == sorted([*range(70), *range(4)])


def test_a_write_counts_itself_in_one_job(spark, tmp_path):
    from veilframe.operators import observed

    df = spark.range(0, 1000, 1, 5).withColumn("odd", F.col("id") % 2)
    spark.sparkContext.setJobGroup("observed", "")
    try:
        found = observed.write(df, str(tmp_path / "a"), drop=("odd",), odd=F.sum("odd"), most=F.max("id"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("observed")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {"rows": 1000, "odd": 500, "most": 999} and len(jobs) == 1
    assert spark.read.parquet(str(tmp_path / "a")).columns == ["id"]
    assert observed.write(df.limit(0), str(tmp_path / "b"), most=F.max("id"))["rows"] == 0
    assert observed.write(df.where("id < 0"), str(tmp_path / "c"), most=F.max("id")) == {"rows": 0, "most": None}
    observed.move(spark, str(tmp_path / "a"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1000 and not (tmp_path / "a").exists()


def test_a_run_refuses_too_many_rows_and_none(spark, tmp_path):
    from veilframe.plans import run

    for rows, message in ((3, "the cap is 2"), (0, "no rows")):
        env = run.RunEnv(spark, datetime(2026, 1, 1), str(tmp_path / f"out{rows}"), "d", row_limit=2, frame=spark.range(rows))
        _, failures, _ = run.run(env, verdict=False)
        assert [f["stage"] for f in failures] == ["extract"] and message in failures[0]["message"]
        assert not list((tmp_path / f"out{rows}").glob("landed/*"))


def test_buckets_without_new_keys_are_left_alone(spark, tmp_path):
    from veilframe.operators.warehouse import BucketedTable

    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], 8)
    assert table.read() is None and table.upsert(spark.createDataFrame([], "k int, v string, at int")) == 0
    first = spark.createDataFrame([(k, f"a{k}", 1) for k in [*range(50), None]], "k int, v string, at int")
    assert table.upsert(first, [F.col("at")]) == 8
    assert table.upsert(spark.createDataFrame([(7, "old", 2), (7, "new", 3)], first.schema), [F.col("at")]) == 1
    assert table.upsert(spark.createDataFrame([(7, "newest", 4, True)], "k int, v string, at int, more boolean"), [F.col("at")]) == 1
    got = {r.k: (r.v, r.more) for r in table.read().collect()}
    assert got == {k: (f"a{k}", None) for k in [*range(50), None]} | {7: ("newest", True)}
    assert sorted(table.versions().values()) == [1] * 7 + [3]


def test_ledger_and_verdicts_by_bucket(spark, tmp_path):
    from veilframe.operators.warehouse import BucketedTable
    from veilframe.streaming import consumers

    rows = spark.createDataFrame([(f"c{i % 2}", f"e{i % 30}", f"u{i % 5}", i) for i in range(90)], "consumer string, event_id string, idempotency_key string, offset long")
    table = BucketedTable(spark, str(tmp_path / "v"), ["idempotency_key"], 4)
    for part, low in enumerate((0, 45)):
        rows.where((F.col("offset") >= low) & (F.col("offset") < low + 45)).write.mode("append").parquet(str(tmp_path / "in"))
        s = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        consumers.ledger(s, str(tmp_path / "l"), str(tmp_path / "lc"), 16).awaitTermination()
        consumers.record_verdicts(s, table, str(tmp_path / "vc")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "l"))
    assert kept.count() == kept.select("consumer", "event_id").distinct().count() == rows.select("consumer", "event_id").distinct().count()
    assert {(r.idempotency_key, r.offset) for r in table.read().collect()} == {(f"u{i}", 85 + i) for i in range(5)}


def test_charts_are_drawn(spark):
    from xml.etree import ElementTree

    from veilframe.operators import reports

    rows = [(i, datetime(2026, 1, 1, i % 5), float(i), "<b>&" if i % 3 else None if i % 2 else "", "local") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, at timestamp, amount double, kind string, masked_by string")
    found = reports.build(df, "id")
    page = reports.to_html(found, 'a "title" <x>')
    assert "<b>" not in page and "<x>" not in page and "Masked by: local (60)" in page and page.count("<svg") == len(found["charts"]) == 3
    for c, data in found["charts"]:
        svg = ElementTree.fromstring(reports.to_svg(c, data))
        widths = [float(r.get("width")) for r in svg.iter("rect")]
        assert len(widths) == {"by_hour": 24, "histogram": 7, "categories": len(data)}[c.kind] and max(widths) == reports.WIDTH - reports.NAMES - 80
    empty = reports.to_html(reports.build(df.limit(0), "id"), "none")
    assert "<svg" not in empty
