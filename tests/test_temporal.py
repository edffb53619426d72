"""Joins and groups by time, null times and prefixes, and the traffic audit against plain code."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilframe.operators import temporal, traffic
from veilframe.plans import temporal_queries
from veilframe.streaming import auditor

SF = "/root/testdata/sf0.001"
START = datetime(2026, 1, 1)


def at(s):
    return None if s is None else START + timedelta(seconds=s)


def hot_rows(n, seed, times=400):
    """(key, time, number): half of the rows have one key, many share a moment, some have no key or time."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.5 else rng.choice("abc") if rng.random() < 0.95 else None, rng.randrange(times) if rng.random() < 0.95 else None, i) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_as_of_equals_plain_search(spark, parts):
    left, right = hot_rows(500, 1), hot_rows(120, 2) + [("hot", 50, 900), ("hot", 50, 901), ("only right", 3, 902)]
    left += [("hot", 60, 600 + i) for i in range(300)]  # one moment of one key
    of_left = spark.createDataFrame([(k, at(t), i) for k, t, i in left], "k string, t timestamp, i int")
    of_right = spark.createDataFrame([(k, at(t), i, None if i % 5 == 0 else f"v{i}") for k, t, i in right], "k string, t timestamp, n int, v string")
    got = {r.i: (r.n, r.v) for r in temporal.as_of(of_left, of_right, ["k"], "t", ("n",), parts).collect()}
    for k, t, i in left:
        before = [(u, n) for key, u, n in right if k is not None and key == k and t is not None and u is not None and u <= t]
        n = max(before)[1] if before else None
        assert got[i] == (n, None if n is None or n % 5 == 0 else f"v{n}"), (k, t, i)
    assert len(got) == len(left) and temporal.as_of(of_left.limit(0), of_right, ["k"], "t", ("n",)).count() == 0
    assert temporal.as_of(of_left, of_right.limit(0), ["k"], "t", ("n",)).where("n is null").count() == len(left)
    with pytest.raises(ValueError, match="both sides"):
        temporal.as_of(of_left, of_right.withColumnRenamed("v", "I"), ["k"], "t", ("n",))


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(5)
    spans = lambda n: [(k, t, None if t is None else t + rng.choice([0, -5, 1, 2, 30, 64, 5000]), i) for k, t, i in hot_rows(n, n)]
    left, right = spans(150), spans(140)
    show = lambda rows, p: spark.createDataFrame([(k, at(a), at(b), i) for k, a, b, i in rows], f"k string, {p}a timestamp, {p}b timestamp, {p}i int")
    pairs = temporal.overlaps(show(left, "l"), show(right, "r"), ("la", "lb"), ("ra", "rb"), ("k",))
    want = sorted((i, j) for k, a, b, i in left for m, c, d, j in right if k and k == m and None not in (a, c) and a < b and c < d and a < d and c < b)
    assert sorted((r.li, r.ri) for r in pairs.collect()) == want
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    points = temporal.overlaps(show(left, "l").drop("k"), show(right, "r").drop("k"), ("la", None), ("ra", "rb"))
    assert sorted((r.li, r.ri) for r in points.collect()) == sorted((i, j) for _, a, _, i in left for _, c, d, j in right if None not in (a, c) and c <= a < d)
    assert temporal.overlaps(show(left, "l").limit(0), show(right, "r"), ("la", "lb"), ("ra", "rb"), ("k",)).count() == 0


@pytest.mark.parametrize("parts", [1, 9])
def test_sessions_equal_a_plain_walk(spark, parts):
    rows = hot_rows(600, 3, 20_000) + [("sparse", 1000 * i, 0) for i in range(20)] + [("dense", i, 0) for i in range(300)]
    got = temporal.sessions(spark.createDataFrame([(k, at(t)) for k, t, _ in rows], "k string, t timestamp"), "k", "t", 90, parts)
    want = []
    for key in {k for k, _, _ in rows}:
        own = sorted(t for k, t, _ in rows if k == key and t is not None)
        run = []
        for t in [*own, None]:
            if run and (t is None or t - run[-1] > 90):
                want.append((str(key), run[0], run[-1], len(run)))
                run = []
            run.append(t)
    assert sorted((str(r.k), int((r.start - START).total_seconds()), int((r.end - START).total_seconds()), r.n) for r in got.collect()) == sorted(want)


def test_null_times_and_prefixes(spark):
    rows = [("a", "c", None), ("a", "c", None), ("a", "d", None), ("a", "c", 5), ("a", "c", 7), (None, "c", 7)]
    got = traffic.sliding_rates(spark.createDataFrame([(c, k, at(t), i) for i, (c, k, t) in enumerate(rows)], "category string, client string, ts timestamp, i int"), 60)
    assert {r.i: (r.client_hits, r.category_hits) for r in got.collect()} == {0: (2, 3), 1: (2, 3), 2: (1, 3), 3: (1, 1), 4: (2, 2), 5: (1, 1)}
    rules = spark.createDataFrame([(1, None, "none"), (2, "GET /a", "a")], "rule_no int, prefix string, category string")
    requests = spark.createDataFrame([("get", "/a/b"), ("post", "/a"), (None, None)], "method string, path string")
    assert sorted(r.category for r in traffic.route(requests, rules).collect()) == ["a", "default", "default"]


def test_trailing_counts_use_no_sliding_frame(spark):
    """A frame that slides is counted anew for each row, so a slot of n rows would cost n times n."""
    rng = random.Random(12)
    rows = [(rng.choice("xy"), f"c{rng.randrange(5)}", None if rng.random() < 0.02 else rng.randrange(4_000_000) / 1000) for _ in range(800)] + [("x", "c1", t) for t in (0.0, 60.0, 60.0, 120.0, 120.000001)]
    df = spark.createDataFrame([(c, k, None if t is None else START + timedelta(seconds=t), i) for i, (c, k, t) in enumerate(rows)], "category string, client string, ts timestamp, i int")
    got = traffic.sliding_rates(df, 60)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe(RangeFrame, unboundedpreceding$(), currentrow$())" in plan and "specifiedwindowframe(RangeFrame, -" not in plan
    micros = [None if t is None else round(t * 1e6) for *_, t in rows]
    inside = lambda a, b: a is None and b is None or (a is not None and b is not None and a - 60_000_000 <= b <= a)
    want = {}
    for i, (c, k, _) in enumerate(rows):
        own = [j for j, r in enumerate(rows) if r[0] == c and inside(micros[i], micros[j])]
        want[i] = (sum(rows[j][1] == k for j in own), len(own))
    assert {r.i: (r.client_hits, r.category_hits) for r in got.collect()} == want


def test_snapshot_ranks_over_slots(spark):
    rng = random.Random(8)
    rows = [(rng.choice("xy"), f"c{int(rng.random() ** 2 * 200)}", at(rng.randrange(60))) for _ in range(3000)]
    got = traffic.snapshot(spark.createDataFrame(rows, "category string, client string, ts timestamp"), F.lit(at(60)).cast("timestamp"))
    for r in got.collect():
        own = [c for k, c, _ in rows if k == r.category]
        best = sorted({c: own.count(c) for c in own}.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert r.hits == len(own) and r.top_clients == ",".join(f"{c}={n}" for c, n in best)


def simulated(rows, profile, exempt):
    """The rule, request by request: (request -> allowed, reason, retry_after, alert)."""
    limits = {c.name: c for c in (*profile.categories, profile.default)}
    blocked, anomaly, by_client, total, out = {}, {}, {}, {}, {}
    for request, client, category, now in sorted(rows, key=lambda r: (r[3], r[0])):
        free, alerts = client in exempt, []
        until, why = blocked.get(client, (0, ""))
        if until > now and not free:
            out[request] = (False, f"client blocked ({why})", int(until - now) + 1, None)
            continue
        if blocked.pop(client, None):
            alerts.append("traffic_client_unblocked")
        for hits in (by_client.setdefault((category, client), []), total.setdefault(category, [])):
            hits[:] = [x for x in hits if x >= now - profile.window_seconds] + [now]
        if len(by_client[category, client]) > limits[category].per_client and not free:
            blocked[client] = (now + profile.block_seconds, category)
            out[request] = (False, "over the per-client limit", profile.block_seconds, ",".join([*alerts, "traffic_client_blocked"]))
            continue
        if len(total[category]) > limits[category].total and anomaly.get(category, 0) <= now:
            anomaly[category] = now + profile.block_seconds
            alerts.append("traffic_anomaly")
        until = anomaly.get(category, 0)
        if until > now and not free:
            out[request] = (False, "category under anomalous load", int(until - now) + 1, ",".join(alerts) or None)
            continue
        if until and until <= now:
            del anomaly[category]
            alerts.append("traffic_anomaly_cleared")
        out[request] = (True, "within profile", 0, ",".join(alerts) or None)
    return out


def test_audit_of_events_equals_the_rule(spark):
    rows = [(r.request, r.client, r.category, r.us / 1e6) for r in temporal_queries.audited_requests(spark, SF).select("*", F.unix_micros("ts").alias("us")).collect()]
    want = simulated(rows, temporal_queries.AUDIT, {f"10.0.0.{i}" for i in range(4)})
    got = {r.request: (r.allowed, r.reason, r.retry_after, r.alert) for r in temporal_queries.traffic_audit(spark, SF).collect()}
    assert got == want and {r[1].split(" (")[0] for r in want.values()} >= {"client blocked", "within profile", "over the per-client limit"}


def test_waiting_requests_are_one_state_entry_for_each_call():
    """An entry for each request is read and written one by one, of which a category has millions."""
    import pandas as pd

    class Handle(list):
        def appendValue(self, row):  # noqa: N802
            self.append(row)

        def registerTimer(self, at):  # noqa: N802
            self.timer = at

    step = auditor.ByClient({"read": 3}, 60, 100)
    step.waiting = step.handle = entries = Handle()
    rows = pd.DataFrame([(i, "c", "read", 5_000_000 - i, False, True, "", 0, None, True) for i in range(2000)], columns=step.names)
    assert list(step.handleInputRows(("c",), iter([rows[:1500], rows[1500:]]), None)) == []
    assert len(entries) == 1 and entries.timer == (5_000_000 - 1999) // 1000 + 1 and len(entries[0][0]) < 50_000


def test_audit_over_several_batches(spark, tmp_path):
    """Requests out of order within and across batches, bursts of a client and of a category, blocks that end, clients on the allowlist."""
    rng = random.Random(6)
    profile = traffic.Profile((traffic.Category("read", (), 4, 30), traffic.Category("auth", (), 2, 6)), traffic.Category("default", (), 5, 50), window_seconds=60, block_seconds=100, allowlist=("10.9.0.0/16",))
    rows = [(i, rng.choice(["10.0.0.1", "10.0.0.2", "10.9.0.1"] + [f"10.1.0.{k}" for k in range(40)]), rng.choice(["read", "auth", "default"]), rng.randrange(900_000) / 1000) for i in range(900)]
    rows += [(1000 + i, f"10.2.0.{i}", "auth", 300 + i / 10) for i in range(30)] + [(2000 + i, "10.3.0.1", "read", 500 + i / 10) for i in range(12)] + [(3000, "10.3.0.1", "read", 700.0)]
    base = 1_000_000_000
    frame = lambda some: spark.createDataFrame([(i, c, k, START + timedelta(seconds=t)) for i, c, k, t in some], "request long, client string, category string, ts timestamp")
    for part in range(4):
        own = [r for r in rows if part * 225 <= r[3] + (r[0] * 7 % 10) - 5 < (part + 1) * 225 or (part == 0 and r[3] + (r[0] * 7 % 10) - 5 < 0) or (part == 3 and r[3] + (r[0] * 7 % 10) - 5 >= 900)]
        rng.shuffle(own)
        odd = [(9000, None, "read", 10.0), (9001, "10.0.0.1", "no such", 10.0)] if part == 0 else []
        frame(own + odd).coalesce(1).write.parquet(str(tmp_path / "in" / f"p={part}"))
    frame([(-1, "later", "default", 100_000.0)]).coalesce(1).write.parquet(str(tmp_path / "in" / "p=9"))
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    source = session.readStream.schema("request long, client string, category string, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    decided = auditor.audit(source, profile, "20 seconds")
    decided.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).format("parquet").option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    got = {r.request: (r.allowed, r.reason, r.retry_after, r.alert) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = simulated([(i, c, k, base + t) for i, c, k, t in rows], profile, {"10.9.0.1"})
    assert got == want
    assert {a for r in want.values() if r[3] for a in r[3].split(",")} == {auditor.UNBLOCKED, auditor.NEWLY_BLOCKED, auditor.NEW_ANOMALY, auditor.CLEARED}


def test_cube_tells_its_nulls_from_the_data(spark):
    from veilframe.operators import reports

    df = spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), (None, 1, 4.0)], "x string, y int, v double")
    got = {(r.level, r.x, r.y): r.s for r in reports.cube(df, ["x", "y"], {"s": F.sum("v")}).collect()}
    assert got == {(0, "a", 1): 1.0, (0, "a", None): 2.0, (0, None, 1): 4.0, (1, "a", None): 3.0, (1, None, None): 4.0, (2, None, 1): 5.0, (2, None, None): 2.0, (3, None, None): 7.0}
    assert reports.cube(df.limit(0), ["x", "y"], {"n": F.count("*")}).where("level = 0").count() == 0


def test_synthetic_trips_are_the_same_on_any_number_of_tasks(spark):
    from veilframe.sources import tables

    for parts in (1, 7):
        t = tables.synthetic_trips(spark, 1000, "2026-01-01").repartition(parts)
        got = t.agg(F.count("*"), F.sum("bike_id"), F.sum("start_station_id"), F.sum("duration_minutes"), F.min("trip_id"), F.max("trip_id"), F.count_distinct("subscriber_type")).first()
        assert tuple(got) == (1000, 5467961, 2538881, 18581, "T001090743992", "T998279927158", 4)
