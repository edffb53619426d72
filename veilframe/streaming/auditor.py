"""Traffic audit of a stream of requests: limits by client and category, and by category.

Two stateful steps, both in order of event time whatever the order of arrival: requests wait
until the watermark has passed them. The first, keyed by client, refuses clients that are
blocked and blocks those over a category's limit. The second, keyed by category, counts what
the first let through or blocked just then, and refuses a whole category for a while when its
total goes over its limit. A client's state is gone once it has neither hits nor a block.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from veilframe.operators.traffic import Profile, is_listed

DECISION = "request long, client string, category string, at long, ts timestamp, exempt boolean, allowed boolean, reason string, retry_after long, alert string, counted boolean"
COLUMNS = [c.split()[0] for c in DECISION.split(", ")]
#: What is answered, and how alerts are called.
BLOCKED, OVER, ANOMALY, FINE = "client blocked", "over the per-client limit", "category under anomalous load", "within profile"
UNBLOCKED, NEWLY_BLOCKED, NEW_ANOMALY, CLEARED = "traffic_client_unblocked", "traffic_client_blocked", "traffic_anomaly", "traffic_anomaly_cleared"
SECOND = 1_000_000


class _InOrder(StatefulProcessor):
    """Rows of a key wait until the watermark has passed them, then are decided in order of time and request.

    They wait as compressed Arrow batches, one for each call: a state entry for each row would be read and written row by row.
    """

    names = "request client category at exempt allowed reason retry_after alert counted".split()
    row = pa.schema(list(zip(names, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.bool_()), strict=True)))
    piece = 50_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.kept = handle.getValueState("kept", "state binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pa.Table.from_batches([pa.RecordBatch.from_pandas(pdf[self.names], self.row, preserve_index=False) for pdf in rows if len(pdf)], self.row)
        if found.num_rows:
            self._wait(found)
        yield from ()

    def _wait(self, rows: pa.Table) -> None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.row, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        self.waiting.appendValue((sink.getvalue().to_pybytes(),))
        self.handle.registerTimer(pc.min(rows["at"]).as_py() // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        batches = [b for (data,) in self.waiting.get() for b in pa.ipc.open_stream(bytes(data))]
        if not batches:
            return
        waiting = pa.Table.from_batches(batches, self.row).sort_by([("at", "ascending"), ("request", "ascending")])
        n = pc.sum(pc.less(waiting["at"], passed)).as_py() or 0
        self.waiting.clear()
        if n < waiting.num_rows:
            self._wait(waiting.slice(n))
        ready = (r for a in range(0, n, self.piece) for r in zip(*(c.to_pylist() for c in waiting.slice(a, min(self.piece, n - a)).columns), strict=True))
        for out in itertools.batched(self.decide(ready), self.piece):
            yield pd.DataFrame([(*r[:4], pd.NaT, *r[4:]) for r in out], columns=COLUMNS).assign(ts=pd.to_datetime([r[3] for r in out], unit="us"))

    def close(self) -> None:
        pass

    def _load(self, empty: tuple) -> tuple:
        return pickle.loads(bytes(self.kept.get()[0])) if self.kept.exists() else empty

    def _keep(self, state: tuple) -> None:
        if any(state):
            self.kept.update((pickle.dumps(state),))
        else:
            self.kept.clear()

    def decide(self, ready: Iterable[tuple]) -> Iterator[tuple]:
        raise NotImplementedError


class ByClient(_InOrder):
    def __init__(self, limits: dict[str, int], window_seconds: int, block_seconds: int):
        self.limits, self.window, self.block = limits, window_seconds * SECOND, block_seconds * SECOND

    def decide(self, ready: Iterable[tuple]) -> Iterator[tuple]:
        hits, until, why = self._load(({}, 0, ""))
        last = 0
        for request, client, category, at, exempt, *_ in ready:
            last, alert = at, None
            if until > at and not exempt:
                yield (request, client, category, at, exempt, False, f"{BLOCKED} ({why})", (until - at) // SECOND + 1, None, False)
                continue
            if until and until <= at:
                until, why, alert = 0, "", UNBLOCKED
            own = hits[category] = [x for x in hits.get(category, ()) if x >= at - self.window] + [at]
            if len(own) > self.limits[category] and not exempt:
                until, why = at + self.block, category
                yield (request, client, category, at, exempt, False, OVER, self.block // SECOND, NEWLY_BLOCKED if alert is None else f"{alert},{NEWLY_BLOCKED}", True)
            else:
                yield (request, client, category, at, exempt, True, FINE, 0, alert, True)
        kept = {c: own for c, times in hits.items() if (own := [x for x in times if x >= last - self.window])}
        self._keep((kept, until, why if until else ""))


class ByCategory(_InOrder):
    def __init__(self, limits: dict[str, int], window_seconds: int, block_seconds: int):
        self.limits, self.window, self.block = limits, window_seconds * SECOND, block_seconds * SECOND

    def decide(self, ready: Iterable[tuple]) -> Iterator[tuple]:
        hits, until = self._load(([], 0))
        first = 0  # of the hits in the window
        for row in ready:
            request, client, category, at, exempt, allowed, reason, retry, alert, counted = row
            if not counted:
                yield row
                continue
            hits.append(at)
            while hits[first] < at - self.window:
                first += 1
            if first > 100_000:
                del hits[:first]
                first = 0
            if not allowed:  # blocked just now: counted, but it asks for no more
                yield row
                continue
            alerts = [alert] if alert else []
            if len(hits) - first > self.limits[category] and until <= at:
                until = at + self.block
                alerts.append(NEW_ANOMALY)
            if until > at and not exempt:
                allowed, reason, retry = False, ANOMALY, (until - at) // SECOND + 1
            elif until and until <= at:
                until = 0
                alerts.append(CLEARED)
            yield (request, client, category, at, exempt, allowed, reason, retry, ",".join(alerts) or None, counted)
        self._keep((hits[first:], until))


def audit(requests: DataFrame, profile: Profile, delay: str = "10 seconds") -> DataFrame:
    """request, client, category, ts, allowed, reason, retry_after, alert of every request of a stream, once the watermark has passed it.

    ``requests`` (request, client, category, ts); request numbers tell requests of one moment
    apart. An alert names what the request brought about, several by commas. Clients in a
    network of the profile's allowlist are counted and never refused. Requests more than
    ``delay`` late, without a client, category or time, or of a category that the profile
    doesn't know, give no row. The session needs the RocksDB state store.
    """
    categories = [*profile.categories, profile.default]
    known = F.col("category").isin([c.name for c in categories]) & F.col("client").isNotNull()
    rows = requests.select("request", "client", "category", F.unix_micros("ts").alias("at"), "ts", is_listed(F.col("client"), list(profile.allowlist)).alias("exempt")).where(known)
    rows = rows.select("request", "client", "category", "at", "ts", "exempt", F.lit(True).alias("allowed"), F.lit("").alias("reason"), F.lit(0).cast("long").alias("retry_after"), F.lit(None).cast("string").alias("alert"), F.lit(True).alias("counted"))
    seconds = (profile.window_seconds, profile.block_seconds)
    by_client = rows.withWatermark("ts", delay).groupBy("client").transformWithStateInPandas(ByClient({c.name: c.per_client for c in categories}, *seconds), DECISION, "Append", "EventTime", eventTimeColumnName="ts")
    by_category = by_client.groupBy("category").transformWithStateInPandas(ByCategory({c.name: c.total for c in categories}, *seconds), DECISION, "Append", "EventTime")
    return by_category.select("request", "client", "category", "ts", "allowed", "reason", "retry_after", "alert")
