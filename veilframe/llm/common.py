"""What the corpus operators share: tables, saved intermediate results, connected components."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in local mode, where the session names none."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="veilframe-")
        sc.setCheckpointDir(folder)
    return folder


def saved(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and later readers prune columns.

    A lost executor costs nothing that was written. The caller owns the folder
    named in ``spark.checkpoint.dir`` and empties it after the job. Frames whose rows are
    megabytes need ``rows_per_file``: writers look at their size every 100 rows only, and
    readers take up to 4,096 rows of a file at once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/veilframe/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    for written in _recorders:
        written.append(out)
    return out


_recorders: list[list[DataFrame]] = []


@contextlib.contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """All frames that :func:`saved` writes meanwhile, for who wants to :func:`discard` them."""
    written: list[DataFrame] = []
    _recorders.append(written)
    try:
        yield written
    finally:
        _recorders.remove(written)


def discard(*frames: DataFrame) -> None:
    """Remove what :func:`saved` wrote for frames that nothing reads any more: all that came of them has been written itself."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def slices(texts: pa.Array, limit: int = 16_000_000) -> Iterator[tuple[int, int]]:
    """(start, end) of rows whose texts have ``limit`` bytes at most, or of one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, end
        start = end


def with_few(rows: DataFrame, facts: DataFrame, *keys: str, heavy: int = 1000, broadcast_rows: int = 50_000) -> DataFrame:
    """``rows`` joined to ``facts`` by ``keys``; a fact says in n how many rows it meets.

    Facts of many rows, ``broadcast_rows`` of them at most, are broadcast, so a key that a third of the rows has is not one task's.
    """
    facts = saved(facts)
    many = max(heavy, -(-(facts.agg(F.sum("n")).first()[0] or 0) // broadcast_rows))
    large, small = facts.where(F.col("n") >= many).drop("n"), facts.where(F.col("n") < many).drop("n")
    return rows.join(F.broadcast(large), list(keys)).unionByName(rows.join(F.broadcast(large.select(*keys)), list(keys), "left_anti").join(small, list(keys)))


def digest(*texts: Column) -> Column:
    """16 bytes that name the texts, in this order; texts with other bounds between them have another digest."""
    return F.unhex(F.md5(F.concat(*(F.md5(t.cast("binary")) for t in texts))))


def with_shares(rows: DataFrame, facts: DataFrame, key: str, heavy: int = 1000, broadcast_rows: int = 50_000) -> DataFrame:
    """``rows`` joined to ``facts`` by ``key``, a number or a digest; a fact says in n how many rows it meets at most, and may be of any size.

    Rows of a frequent key are dealt to shares by a hash of their other columns, and its fact is copied once for each
    share, so no key is one task's. Only such keys and their numbers of shares are broadcast, ``broadcast_rows`` of
    them at most and 24 bytes each.
    """
    facts = saved(facts)
    many = max(heavy, -(-(facts.agg(F.sum("n")).first()[0] or 0) // broadcast_rows))
    shares = F.ceil(F.col("n") / many).cast("int")
    large = facts.where(F.col("n") > many).select(key, shares.alias("__shares"))
    rest = [c for c in rows.columns if c != key]
    dealt = F.coalesce(F.pmod(F.xxhash64(*rest), F.col("__shares")), F.lit(0)).cast("int")
    copies = facts.withColumn("__share", F.explode(F.sequence(F.lit(0), F.greatest(shares, F.lit(1)) - 1))).drop("n")
    marked = rows.join(F.broadcast(large), key, "left").select(*rows.columns, dealt.alias("__share"))
    return marked.join(copies, [key, "__share"]).drop("__share")


def _with_least(pairs: DataFrame, key: str, value: str, heavy: int, rows: int) -> DataFrame:
    """``pairs``, of at most ``rows`` rows, with m, the least ``value`` of each ``key``.

    Keys of ``heavy`` rows or more, of which there are at most rows / heavy, are broadcast, so no key is one task's.
    """
    low = pairs.groupBy(key).agg(F.min(value).alias("m"), F.count("*").alias("degree"))
    if rows < heavy:  # no key can have so many
        return pairs.join(low.drop("degree"), key).select(*pairs.columns, "m")
    large = low.where(F.col("degree") >= heavy).select(key, F.col("m").alias("of_heavy"))
    marked = pairs.join(F.broadcast(large), key, "left")
    done = marked.where("of_heavy is not null").select(*pairs.columns, F.col("of_heavy").alias("m"))
    rest = marked.where("of_heavy is null").select(*pairs.columns)
    return done.union(rest.join(low.where(F.col("degree") < heavy).select(key, "m"), key).select(*pairs.columns, "m"))


def components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, heavy: int = 1000, broadcast_rows: int = 50_000) -> DataFrame:
    """(node, component) of every node that ``edges`` name; component is the smallest node reachable.

    Alternates two contractions until nothing changes: every node's larger
    neighbours are hung on its smallest neighbour, then its smaller ones. Smallest
    neighbours come from an aggregate with map-side combine and a join in which nodes
    of many edges are broadcast, ``broadcast_rows`` of them at most, so no neighbour list is ever gathered.
    """
    pairs = (
        edges.select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v"))
        .where("u < v").distinct()
    )
    pairs = saved(pairs)
    before = None
    for _ in range(max_rounds):
        state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state.n:
            break
        before, many = state, max(heavy, -(-2 * state.n // broadcast_rows))
        both = pairs.union(pairs.select("v", "u")).toDF("u", "v")
        large = _with_least(both, "u", "v", many, 2 * state.n).select(F.least("u", "m").alias("m"), "u", "v").where("v > u and v > m").select(F.col("m").alias("u"), "v").distinct()
        joined = _with_least(large, "v", "u", many, 2 * state.n)
        small = joined.select(
            F.explode(F.array(
                F.struct(F.col("m").alias("u"), F.col("v").alias("v")),
                F.struct(F.col("m").alias("u"), F.col("u").alias("v")),
            )).alias("e")
        ).select("e.u", "e.v").where("u < v").distinct()
        old, pairs = pairs, saved(small)
        discard(old)
    else:
        raise RuntimeError("connected components did not settle")
    roots = pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)
