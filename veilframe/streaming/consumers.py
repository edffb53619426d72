"""Message streams: tap, repeats, latest verdict per dataset, absence, rate limits."""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from veilframe.operators.messages import decode, judged, parse, wakes
from veilframe.operators.traffic import is_listed
from veilframe.operators.warehouse import BucketedTable, VersionedTable, insert_if_absent

RAW = "topic string, partition int, offset long, value string, received_at timestamp"


def read_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A folder of message files as a stream, from the first on."""
    return spark.readStream.schema(RAW).options(**options).parquet(path)


def read_kafka(spark: SparkSession, servers: str, topics: str) -> DataFrame:
    """The same from a broker, where the connector is on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).option("startingOffsets", "earliest").load()
    return raw.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at"))


def tapped(messages: DataFrame) -> DataFrame:
    """Each message decoded, with whether and why not it is valid; invalid ones are kept."""
    return judged(messages).withColumn("message", parse(F.col("value"))).select(
        "topic", "partition", "offset", "received_at", "value", F.col("message.envelope.event_type").alias("event_type"), F.col("message.envelope.event_id").alias("event_id"),
        F.col("message.envelope.idempotency_key").alias("idempotency_key"), F.col("message.envelope.dataset").alias("dataset"), F.col("message.envelope.run_slot").alias("run_slot"),
        (F.size("problems") == 0).alias("valid"), "problems",
    )


def tap(messages: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append each message to the log once, known by topic, partition and offset, however often a batch is tried.

    The log is in folders by topic and partition, and a batch is held only against the part
    of the log in its own folders and ranges of offsets.
    """
    spark, key = messages.sparkSession, ["topic", "partition", "offset"]

    def append(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(key)
        if _exists(spark, log):
            ranges = batch.groupBy("topic", "partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect()  # a row for each partition of a topic
            known = F.lit(False)
            for r in ranges:
                known |= (F.col("topic") == r.topic) & (F.col("partition") == r.partition) & F.col("offset").between(r.low, r.high)
            fresh = fresh.join(spark.read.schema(tapped(batch).schema).parquet(log).where(known).select(*key), key, "left_anti")
        tapped(fresh).write.mode("append").partitionBy("topic", "partition").parquet(log)  # a message is judged once it is known to be new, and once only

    return messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(append).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def first_sights(messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Messages whose event was not seen within the delay; bounded state."""
    return messages.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["event_id"])


def decisions(messages: DataFrame, keep: str = "7 days", buckets: int = 4_096) -> DataFrame:
    """event_id, idempotency_key, offset, decision of every message: first, replay or drop.

    ``messages`` (event_id, idempotency_key, offset, received_at). Messages received more than ``keep`` before
    the latest one are late: Spark drops them, so they get no decision. State is a unit's events; it goes
    when, by the time of receipt, nothing has come for the unit for as long as ``keep``.

    Units lie in ``buckets`` by their hash, each a call of Python and a row of state, which a batch that touches it
    writes anew: about a five-hundredth of the units that are kept at once is right. A checkpoint holds for its number of them.
    """
    kept_ms = int(pd.Timedelta(keep).total_seconds() * 1000)

    def decide(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        units: dict[str | None, tuple[int, set]] = pickle.loads(bytes(state.get[0])) if state.exists else {}
        now = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            rows = pd.concat(batches).sort_values("offset")  # a bucket's rows may come in several pieces, in any order
            out = []
            for unit, event, at in zip(rows["idempotency_key"].tolist(), rows["event_id"].tolist(), rows["at"].tolist(), strict=True):
                until, seen = units.get(unit) or (0, set())
                out.append("drop" if event in seen else "replay" if seen else "first")
                seen.add(event)
                units[unit] = max(until, at + kept_ms, now + 1), seen
            yield pd.DataFrame({"idempotency_key": rows["idempotency_key"], "event_id": rows["event_id"], "offset": rows["offset"], "decision": out})
        units = {unit: kept for unit, kept in units.items() if kept[0] >= now}
        if units:
            state.update((pickle.dumps(units),))
            state.setTimeoutTimestamp(min(until for until, _ in units.values()))
        else:
            state.remove()

    at = F.coalesce(F.unix_millis("received_at"), F.lit(0)).alias("at")
    bucket = F.pmod(F.xxhash64("idempotency_key"), F.lit(buckets)).alias("bucket")
    return messages.withWatermark("received_at", keep).select("event_id", "idempotency_key", "offset", "received_at", at, bucket).groupBy("bucket").applyInPandasWithState(
        decide, "idempotency_key string, event_id string, offset long, decision string", "units binary", "append", GroupStateTimeout.EventTimeTimeout,
    )


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """The verdict of each dataset's latest slot, as it changes; for update or complete mode."""
    return verdicts.groupBy("dataset").agg(F.max_by(F.struct("run_slot", "event_id", "status", "proceed"), F.struct("run_slot", "offset")).alias("v")).select("dataset", "v.*")


def waking(messages: DataFrame) -> DataFrame:
    """The messages that start the next pipeline."""
    return messages.withColumn("message", decode(F.col("value"))).where(wakes(F.col("message")))


def record_verdicts(verdicts: DataFrame, table: str | BucketedTable, checkpoint: str) -> StreamingQuery:
    """Keep one row per idempotency_key, the last that came: in a versioned table, which each batch rewrites, or in a bucketed one, of which it rewrites a part."""
    def merge(batch: DataFrame, _: int) -> None:
        if isinstance(table, BucketedTable):
            table.upsert(batch, [F.col("offset")])
        elif not batch.isEmpty():
            VersionedTable(batch.sparkSession, table).upsert(batch, ["idempotency_key"], [F.col("offset")])

    return verdicts.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()


def ledger(messages: DataFrame, path: str, checkpoint: str, buckets: int = 256) -> StreamingQuery:
    """Remember (consumer, event_id, idempotency_key) of what was consumed, each once and for good, in folders by consumer and bucket of the event.

    A batch is held against the buckets that its events are in, not against a consumer's whole history.
    """
    key = ["consumer", "bucket", "event_id"]

    def remember(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("event_id", "idempotency_key", "consumer", F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int").alias("bucket"))
        old = spark.createDataFrame([], rows.schema)
        if _exists(spark, path):
            touched = rows.groupBy("consumer").agg(F.collect_set("bucket").alias("in")).collect()  # a row for each consumer, of numbers of buckets
            known = F.lit(False)
            for r in touched:
                known |= (F.col("consumer") == r["consumer"]) & F.col("bucket").isin(r["in"])
            old = spark.read.schema(rows.schema).parquet(path).where(known)
        insert_if_absent(old, rows, key).write.mode("append").partitionBy("consumer", "bucket").parquet(path)

    return messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(remember).start()


def absences(verdicts: DataFrame, interval_minutes: int = 240, grace_minutes: int = 30, roster: DataFrame | None = None) -> DataFrame:
    """dataset, run_slot, kind: 'overdue' when event time passes a slot's deadline with no later one, 'back' when one comes after that.

    ``roster`` is a stream of (dataset, started): datasets that are expected from then on. One
    of them that no verdict has come for by its deadline is 'never_seen'.
    """
    wait = (interval_minutes + grace_minutes) * 60_000

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        slot, alarmed, seen = state.get if state.exists else (-1, False, False)
        if state.hasTimedOut:
            state.update((slot, True, seen))
            yield pd.DataFrame({"dataset": [key[0]], "run_slot": [pd.Timestamp(slot, unit="ms")], "kind": ["overdue" if seen else "never_seen"]})
            return
        newest, expected = -1, -1
        for pdf in batches:
            for at, named in zip(pdf["run_slot"], pdf["__named"], strict=True):
                ms = int(at.timestamp() * 1000)
                newest, expected = (newest, max(expected, ms)) if named else (max(newest, ms), expected)
        later = newest > slot or (newest >= 0 and not seen)
        if later and alarmed:
            yield pd.DataFrame({"dataset": [key[0]], "run_slot": [pd.Timestamp(newest, unit="ms")], "kind": ["back"]})
        if later:
            slot, alarmed, seen = newest, False, True
        elif slot < 0:
            slot = expected
        state.update((slot, alarmed, seen))
        if not alarmed:
            state.setTimeoutTimestamp(max(slot + wait, state.getCurrentWatermarkMs() + 1))

    rows = verdicts.select("dataset", "run_slot", F.lit(False).alias("__named"))
    if roster is not None:
        rows = rows.unionByName(roster.select("dataset", F.col("started").alias("run_slot"), F.lit(True).alias("__named")))
    return rows.withWatermark("run_slot", "0 seconds").groupBy("dataset").applyInPandasWithState(
        watch, "dataset string, run_slot timestamp, kind string", "slot long, alarmed boolean, seen boolean", "append", GroupStateTimeout.EventTimeTimeout,
    )


def rate_windows(requests: DataFrame, window: str = "60 seconds", slide: str = "5 seconds", delay: str = "10 seconds") -> DataFrame:
    """Hits by category and client in sliding windows, for dashboards."""
    return requests.withWatermark("ts", delay).groupBy(F.window("ts", window, slide), "category", "client").agg(F.count("*").alias("hits")).select(
        F.col("window.start").alias("start"), "category", "client", "hits",
    )


def total_breaches(requests: DataFrame, limits: DataFrame, window: str = "60 seconds", slide: str = "5 seconds", delay: str = "10 seconds") -> DataFrame:
    """start, category, hits, total of the sliding windows in which a category's hits went over its limit.

    ``limits`` (category, total) has a row for each category of the profile. Counts are combined before the shuffle, so a busy category is no one task's.
    """
    hits = requests.withWatermark("ts", delay).groupBy(F.window("ts", window, slide), "category").agg(F.count("*").alias("hits"))
    return hits.join(F.broadcast(limits.select("category", "total")), "category").where("hits > total").select(F.col("window.start").alias("start"), "category", "hits", "total")


def client_blocks(requests: DataFrame, per_client: int, window_seconds: int = 60, block_seconds: int = 300, allowlist: tuple[str, ...] = (), delay: str = "10 minutes") -> DataFrame:
    """client, ts, allowed, reason of every request: over the limit in the trailing window means blocked for a while; blocked requests do not count.

    Clients with an address in a network of ``allowlist`` are always allowed and have no state.
    A client's state goes when event time is past its window and its block; requests more than ``delay`` late are dropped.
    """
    def observe(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        hits, until = (deque(state.get[0]), state.get[1]) if state.exists else (deque(), -1.0)
        pdf = pd.concat(batches).sort_values("ts")  # a client's rows may come in several pieces, in any order
        allowed, reasons = [], []
        for ts in pdf["ts"]:
            now = ts.timestamp()
            if now < until:
                allowed.append(False)
                reasons.append("client blocked")
                continue
            while hits and hits[0] < now - window_seconds:
                hits.popleft()
            hits.append(now)
            over = len(hits) > per_client
            if over:
                until = now + block_seconds
            allowed.append(not over)
            reasons.append("over the limit" if over else "within the limit")
        yield pd.DataFrame({"client": key[0], "ts": pdf["ts"], "allowed": allowed, "reason": reasons})
        state.update((list(hits), until))
        end = max(until, (hits[-1] if hits else 0.0) + window_seconds)
        state.setTimeoutTimestamp(max(int(end * 1000), state.getCurrentWatermarkMs()) + 1)

    listed = is_listed(F.col("client"), list(allowlist))
    judged = requests.where(~listed).withWatermark("ts", delay).groupBy("client").applyInPandasWithState(
        observe, "client string, ts timestamp, allowed boolean, reason string", "hits array<double>, until double", "append", GroupStateTimeout.EventTimeTimeout,
    )
    if not allowlist:
        return judged
    return judged.unionByName(requests.where(listed).select("client", "ts", F.lit(True).alias("allowed"), F.lit("on the allowlist").alias("reason")))


def client_sessions(events: DataFrame, key: str, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """key, start, end, n of the sessions of a stream (key, ts), each once closed; end is the last event. Events more than ``delay`` late are dropped."""
    closed = events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), key).agg(F.max("ts").alias("end"), F.count("*").alias("n"))
    return closed.select(key, F.col("session_window.start").alias("start"), "end", "n")


def silent_runs(runs: DataFrame, verdicts: DataFrame, grace: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """run, pipeline, received_at, state of every run of a stream: proceed or stop by a verdict that comes within the grace time after its end, else silent.

    ``runs`` (run, pipeline, ended_at), ``verdicts`` (run, received_at, proceed). State is kept
    for as long as a match can still come: a run is put out as silent once the watermark of
    both streams is past its grace time. Several verdicts in time give a row each; rows more
    than ``delay`` late are dropped, and a null run matches nothing.
    """
    r = runs.withWatermark("ended_at", delay)
    v = verdicts.select(F.col("run").alias("__run"), "received_at", "proceed").withWatermark("received_at", delay)
    within = F.expr(f"__run = run AND received_at >= ended_at AND received_at <= ended_at + INTERVAL {grace}")
    state = F.when(F.col("__run").isNull(), "silent").when(F.col("proceed"), "proceed").otherwise("stop")
    return r.join(v, within, "left_outer").select("run", "pipeline", "received_at", state.alias("state"))
