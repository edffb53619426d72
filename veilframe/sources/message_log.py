"""A message log in files as a data source of its own, for batches and streams: format ``message_log`` with a broker's schema.

A log is a folder of segments, ``topic=T/partition=P/segment=N``, each of ``width`` offsets. Offsets of a
partition begin at 0 and have no gaps. :func:`append` writes them; a reader's task is a run of segments, of ``WIDTH`` offsets in all or one segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "topic string, partition int, offset long, key string, value string, timestamp timestamp"
WIDTH = 100_000


def append(messages: DataFrame, path: str, width: int = WIDTH) -> None:
    """Append ``messages`` (the columns of SCHEMA, with their offsets) in files that are each a run of offsets of one segment."""
    rows = messages.select(*(c.split()[0] for c in SCHEMA.split(", "))).withColumn("segment", F.expr(f"offset div {width}"))
    where = ["topic", "partition", "segment"]
    rows.repartition(*where).sortWithinPartitions(*where, "offset").write.mode("append").partitionBy(*where).parquet(path)


@dataclass
class Segment(InputPartition):
    """Offsets from ``low`` up to ``high`` of one segment of a topic's partition."""

    folder: str
    topic: str
    partition: int
    low: int
    high: int


@dataclass
class Run(InputPartition):
    """Segments of one topic's partition, in order."""

    segments: list[Segment]


def runs(segments: list[Segment], offsets: int = WIDTH) -> list[Run]:
    """The segments in runs of at most ``offsets`` offsets, or of one segment, so that a log of narrow ones is not as many tasks."""
    out: list[Run] = []
    for s in segments:
        last = out[-1].segments if out else []
        if last and (s.topic, s.partition) == (last[-1].topic, last[-1].partition) and s.high - last[0].low <= offsets:
            last.append(s)
        else:
            out.append(Run([s]))
    return out


class Log:
    """What the files of a log say; made anew wherever it is used."""

    def __init__(self, options: dict[str, str]):
        self.path, self.width = options["path"], int(options.get("width", WIDTH))
        self.topics = {t.strip() for t in options["topics"].split(",")} if options.get("topics") else None
        if "://" in self.path or self.path.startswith("file:"):
            self.fs, self.root = pa.fs.FileSystem.from_uri(self.path)
        else:
            self.fs, self.root = pa.fs.LocalFileSystem(), self.path

    def _named(self, folder: str, name: str) -> list[tuple[str, str]]:
        """(value, folder) of the folders name=value in ``folder``."""
        found = self.fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True))
        return sorted((unquote(f.base_name[len(name) + 1:]), f.path) for f in found if f.type == pa.fs.FileType.Directory and f.base_name.startswith(f"{name}="))

    def partitions(self) -> list[tuple[str, int, str]]:
        return [(t, int(p), at) for t, folder in self._named(self.root, "topic") if self.topics is None or t in self.topics for p, at in self._named(folder, "partition")]

    def files(self, folder: str) -> list[str]:
        return sorted(f.path for f in self.fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))

    def _runs(self, folder: str) -> list[tuple[int, int]]:
        """(first, last) offset of each file, from its footer."""
        runs = []
        for file in self.files(folder):
            with self.fs.open_input_file(file) as f:
                meta = pq.read_metadata(f)
            at = meta.schema.names.index("offset")
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            if stats:
                runs.append((min(s.min for s in stats), max(s.max for s in stats)))
        return sorted(runs)

    def end(self, folder: str) -> int:
        """The offset after the last one that has all before it.

        Footers are read from the last segment back to the first full one, so a file that is seen before
        an earlier one of the same write is not passed over: it waits until the gap is closed.
        """
        seen: list[list[tuple[int, int]]] = []
        start = 0
        for n, at in sorted(((int(n), at) for n, at in self._named(folder, "segment")), reverse=True):
            runs = self._runs(at)
            seen.append(runs)
            start = n * self.width
            if self._reach(runs, start) == start + self.width:
                break
        else:
            start = 0
        return self._reach([r for runs in reversed(seen) for r in runs], start)

    @staticmethod
    def _reach(runs: list[tuple[int, int]], start: int) -> int:
        for first, last in sorted(runs):
            if first > start:
                break
            start = max(start, last + 1)
        return start

    def ends(self) -> dict[str, int]:
        return {f"{p}/{t}": self.end(folder) for t, p, folder in self.partitions()}

    def segments(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        out, folders = [], {f"{p}/{t}": at for t, p, at in self.partitions()}
        for name, high in sorted(end.items()):
            partition, topic = name.split("/", 1)
            folder = folders.get(name)
            low = start.get(name, 0)
            if folder is None and low < high:
                raise ValueError(f"the log has lost partition {partition} of topic {topic}")
            while low < high:
                n = low // self.width
                stop = min(high, (n + 1) * self.width)
                out.append(Segment(f"{folder}/segment={n}", topic, int(partition), low, stop))
                low = stop
        return out

    def read(self, part: Segment) -> Iterator[pa.RecordBatch]:
        """The offsets of a segment, each once, however often a file with it was written."""
        tables = []
        for file in self.files(part.folder):
            with self.fs.open_input_file(file) as f:
                t = pq.read_table(f, columns=["offset", "key", "value", "timestamp"], filters=[("offset", ">=", part.low), ("offset", "<", part.high)])
            tables.append(t.set_column(3, "timestamp", t["timestamp"].cast(pa.timestamp("us", t["timestamp"].type.tz), safe=False).cast(pa.timestamp("us", "UTC"))))
        rows = pa.concat_tables(tables).sort_by("offset") if tables else None
        offsets = rows["offset"].to_numpy() if rows else []
        first = [i for i, o in enumerate(offsets) if i == 0 or o != offsets[i - 1]]
        if len(first) != part.high - part.low:
            raise ValueError(f"{part.folder} has {len(first)} of the offsets {part.low} to {part.high - 1}")
        rows = rows.take(first)
        n = len(rows)
        whole = pa.table([pa.array([part.topic] * n, pa.string()), pa.array([part.partition] * n, pa.int32()), *(rows[c] for c in ("offset", "key", "value", "timestamp"))], ["topic", "partition", "offset", "key", "value", "timestamp"])
        yield from whole.combine_chunks().to_batches(max_chunksize=10_000)


class BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Run]:
        log = Log(self.options)
        return runs(log.segments({}, log.ends()))

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        for segment in partition.segments if partition is not None else ():  # a log without messages has no segments
            yield from Log(self.options).read(segment)


class StreamReader(DataSourceStreamReader):
    """Offsets are the next one to read of each partition; partitions that appear later begin at 0."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def initialOffset(self) -> dict[str, int]:
        return {}

    def latestOffset(self) -> dict[str, int]:
        return Log(self.options).ends()

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Run]:
        return runs(Log(self.options).segments(start, end))

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        for segment in partition.segments:
            yield from Log(self.options).read(segment)


class MessageLog(DataSource):
    """Options: ``path``, ``width`` as the log was written with, ``topics`` separated by commas (all, if not given)."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BatchReader:
        return BatchReader(dict(self.options))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(dict(self.options))


def read(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """A log as messages for the tap: topic, partition, offset, value, received_at and the key."""
    spark.dataSource.register(MessageLog)
    reader = spark.readStream if stream else spark.read
    return reader.format("message_log").options(path=path, **options).load().withColumnRenamed("timestamp", "received_at")
