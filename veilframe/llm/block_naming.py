"""Exact duplicates by deterministic block naming.

A text without its white space is cut into blocks of a fixed size. All blocks of all
documents are sorted, and a block's name is its rank among the distinct ones. Then
adjacent names are paired, the pairs sorted and ranked in the same way, until one name
is left of each document. Names are ranks of contents, not hashes, so two documents
have one identity if and only if their texts are equal.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import discard, saved, slices, with_few

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def named(rows: DataFrame, *key: str, digest: Column | None = None) -> DataFrame:
    """``rows`` (row, pos, the key and further columns) with name, the rank of their key among the distinct keys, instead of the key.

    Rows are dealt to ranges of (key, row, pos), so a key that a third of the rows has is cut
    into several tasks; a range goes on with the rank of the one before where both have a key
    in common. Keys must not be null. With a ``digest`` of a long key, keys are in order of
    digest and then of themselves, and the bounds of ranges, which the driver samples, hold
    the digest alone; should two keys share one, the keys themselves are dealt.
    """
    kinds = dict(rows.dtypes)
    rest = [c for c in rows.columns if c not in key]
    dealt = rows.withColumn("digest", F.lit(0).cast("long") if digest is None else digest)
    digested = digest is not None
    order = ("digest",) if digested else key

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, done = TaskContext.get().partitionId(), None, -1
        for batch, after in itertools.pairwise(itertools.chain((b for b in batches if b.num_rows), [None])):
            n = batch.num_rows
            keys = [batch.column(k) for k in ("digest", *key)]
            new, same_digest = np.zeros(n, bool), np.zeros(n, bool)
            new[0], same_digest[0] = before != [k[0].as_py() for k in keys], before is not None and before[0] == keys[0][0].as_py()
            for i, k in enumerate(keys):
                other = pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
                new[1:] |= other
                if i == 0:
                    same_digest[1:] = ~other
            local = done + np.cumsum(new)
            clash = new & same_digest if digested else np.zeros(n, bool)
            end = clash.copy()
            end[0] |= before is None
            end[-1] |= after is None
            before, done = [k[-1].as_py() for k in keys], int(local[-1])
            shown = [pc.if_else(pa.array(end), k, pa.scalar(None, k.type)) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(np.full(n, part, np.int32)), pa.array(local), pa.array(end), pa.array(clash), *shown], [*rest, "part", "local", "is_end", "clash", "digest", *key],
            )

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), "part int, local long, is_end boolean, clash boolean, digest long", *(f"`{k}` {kinds[k]}" for k in key)])
    ranked = saved(dealt.repartitionByRange(*order, "row", "pos").sortWithinPartitions("digest", *key, "row", "pos").mapInArrow(rank, schema))
    along = Window.orderBy("part", "local")  # two rows for each task
    like_before = lambda *columns: F.coalesce(F.struct(*columns) == F.lag(F.struct(*columns)).over(along), F.lit(False))
    ends = ranked.where("is_end").select("part", "local", "clash", like_before("digest").alias("same_digest"), like_before(*key).alias("same"), (F.lag("part").over(along) < F.col("part")).alias("starts"))
    ends = ends.groupBy("part").agg(F.max("local").alias("last"), F.max(F.coalesce("starts", F.lit(False)) & F.col("same")).alias("goes_on"), F.max(F.col("clash") | (F.col("same_digest") & ~F.col("same"))).alias("clash")).orderBy("part").collect()  # a row for each task
    if digested and any(r["clash"] for r in ends):
        discard(ranked)
        return named(rows, *key)
    bases, total = [], 0
    for r in ends:
        total -= r["goes_on"]
        bases.append((r["part"], total))
        total += r["last"] + 1
    base = F.broadcast(rows.sparkSession.createDataFrame(bases, "part int, base long"))  # a row for each task
    return ranked.join(base, "part").select(*rest, (F.col("base") + F.col("local")).alias("name"))


def blocks_of(docs: DataFrame, block_bytes: int) -> DataFrame:
    """row, pos, n_blocks, block of every block of the normalised texts; at pos 0 also doc_id, n_chars, text_sha256."""
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                texts = pc.fill_null(batch.column(1)[a:b], "")
                plain = [t.translate(None, BLANKS) for t in texts.cast(pa.binary()).to_pylist()]
                sizes = np.fromiter(map(len, plain), np.int64, len(plain))
                counts = np.maximum(1, -(-sizes // block_bytes))
                of = np.repeat(np.arange(len(plain)), counts)
                pos = np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
                starts = (np.cumsum(sizes) - sizes)[of] + pos * block_bytes
                bounds = np.append(starts, sizes.sum()).astype(np.int32)  # blocks lie end to end
                block = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(bounds), pa.py_buffer(b"".join(plain))])
                first = pa.array(of, mask=pos > 0)
                digests = pa.array([hashlib.sha256(t).hexdigest() for t in plain])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2)[a:b].take(pa.array(of)), pa.array(pos), pa.array(counts[of]), block, batch.column(0)[a:b].take(first), pc.utf8_length(texts).cast(pa.int64()).take(first), digests.take(first)],
                    ["row", "pos", "n_blocks", "block", "doc_id", "n_chars", "text_sha256"],
                )

    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), F.monotonically_increasing_id().alias("row"))
    return base.mapInArrow(cut, f"row long, pos long, n_blocks long, block binary, doc_id {kind}, n_chars long, text_sha256 string")


def identities(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, level, name) of every document, equal where the texts are equal, and the columns that stand at pos 0.

    A document of up to 2 ** level blocks, and of more than half as many, has its one name at that level.
    """
    now = named(blocks, "block", digest=F.xxhash64("block"))
    facts = now.where("pos = 0").drop("pos", "n_blocks", "name")
    most = now.agg(F.max("n_blocks")).first()[0] or 1
    found = now.where("n_blocks = 1").select("row", F.lit(0).alias("level"), "name")
    for level in range(1, (most - 1).bit_length() + 1):
        at = lambda side: F.max(F.when(F.col("pos") % 2 == side, F.col("name")))
        pairs = now.where("n_blocks > 1").groupBy("row", F.expr("pos div 2").alias("pos"), F.expr("(n_blocks + 1) div 2").alias("n_blocks")).agg(at(0).alias("left"), F.coalesce(at(1), F.lit(-1)).alias("right"))
        now = named(pairs, "left", "right")
        found = found.unionByName(now.where("n_blocks = 1").select("row", F.lit(level).alias("level"), "name"))
    return found, facts


def deduplicate(docs: DataFrame, block_bytes: int = 2048) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text; further columns are ignored).

    Texts are equal if they are the same without white space (space and the characters 9 to
    13); a null text is an empty one. Of equal texts the row of most code points stays, then
    of the smallest doc_id, then (repeated rows) any one of them; a row without a doc_id stays
    only where all its equals have none, with a null keep_id. An empty table gives no rows.
    """
    blocks = saved(blocks_of(docs, block_bytes))
    found, facts = identities(blocks)
    rows = saved(found.join(facts, "row"))
    discard(blocks)
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best")
    groups = rows.groupBy("level", "name").agg(F.count("*").alias("n"), best).select("level", "name", "n", F.col("n").alias("group_size"), F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    return with_few(rows, groups, "level", "name").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
