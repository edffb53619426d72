"""Ranked lexical search over document-sharded postings.

Documents are indexed in shards. A shard holds, for each of its terms, the documents and
the impact of the term in each, an integer that depends on the document alone, in
compressed rows: one list after the other, with the lists' sizes beside the terms. An
item's terms are added one after the other to one accumulator for each document of the
shard; a partial selection that keeps ties finds the best, and the shards' best are
merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import discard, saved, slices

#: Bytes of a text that belong to no term become spaces, and A-Z lower case.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()

#: Shards are rows of megabytes: a file holds as many as a task may have in memory at once.
SHARDS_PER_FILE = 4


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For every term of every text, in order, the text's number and the term's; and the distinct terms."""
    whole = pc.fill_null(texts, "").cast(pa.large_binary())
    bounds = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    plain = data[int(bounds[0]):int(bounds[-1])].to_pybytes().translate(TERM_BYTES) if data else b""
    plain = pa.Array.from_buffers(pa.large_utf8(), len(whole), [None, pa.py_buffer(bounds - bounds[0]), pa.py_buffer(plain)])
    split = pc.ascii_split_whitespace(plain)
    found = split.flatten().dictionary_encode()
    at = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(whole)), np.diff(split.offsets.to_numpy()))
    empty = pc.index(found.dictionary, pa.scalar("", found.dictionary.type)).as_py()  # stands at the ends of texts
    if empty >= 0:
        of, at = of[at != empty], at[at != empty]
        at -= at > empty
        found = pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), pa.concat_arrays([found.dictionary[:empty], found.dictionary[empty + 1:]]))
    return of, at, found.dictionary.cast(pa.string())


def index(docs: DataFrame, shard_bytes: int = 4_000_000) -> tuple[DataFrame, int, int]:
    """The written shards of ``docs`` (doc_id, text), the number of documents that have a term, and that of all their terms.

    A shard is a row: doc_ids, terms, df (documents of each term), docs and impacts (each term's in a row).
    """
    kind = dict(docs.dtypes)["doc_id"]

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), shard_bytes):
                of, at, terms = terms_of(batch.column(1)[a:b])
                lengths = np.bincount(of, minlength=b - a)
                pairs, tf = np.unique(at * (b - a) + of, return_counts=True)
                df = np.bincount(pairs // (b - a), minlength=len(terms))
                ids = pa.concat_arrays([batch.column(0)[a:b]])
                blobs = [(pairs % (b - a)).astype(np.int32), tf.astype(np.int32), lengths.astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids), pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms), pa.array([df.tolist()], pa.list_(pa.int64())),
                     *(pa.array([x.tobytes()], pa.binary()) for x in blobs), pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())])],
                    ["doc_ids", "terms", "df", "docs", "tf", "lengths", "n_docs", "n_terms"],
                )

    fixed = f"doc_ids array<{kind}>, terms array<string>, df array<long>, docs binary"
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    raw = saved(base.mapInArrow(shard, f"{fixed}, tf binary, lengths binary, n_docs long, n_terms long"), SHARDS_PER_FILE)
    n_docs, n_terms = (x or 0 for x in raw.agg(F.sum("n_docs"), F.sum("n_terms")).first())

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                docs, tf = (np.frombuffer(batch.column(c)[k].as_py(), np.int32) for c in (3, 4))
                lengths = np.frombuffer(batch.column(5)[k].as_py(), np.int64)
                m = 100 - 90 + (90 * lengths * n_docs) // max(n_terms, 1)
                impacts = (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m[docs])
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns[:4], pa.array([impacts.astype(np.int32).tobytes()], pa.binary())], ["doc_ids", "terms", "df", "docs", "impacts"])

    shards = saved(raw.mapInArrow(weigh, f"{fixed}, impacts binary"), SHARDS_PER_FILE)
    discard(raw)
    return shards, n_docs, n_terms


def best_of(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Documents of the k best scores above 0, best first, equal scores by place; ties at the last one are all looked at."""
    least = 1
    if len(scores) > k:
        least = max(least, int(scores[np.argpartition(scores, len(scores) - k)[len(scores) - k]]))
    found = np.flatnonzero(scores >= least)
    return found[np.lexsort((places[found], -scores[found]))][:k]


def search(shards: DataFrame, n_docs: int, items: DataFrame, k: int = 10, batch_terms: int = 500_000) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` (item_id, text; further columns are ignored) its k best documents.

    Items are distinct rows: one that is repeated counts once, and two texts of one item_id
    are ranked each. An item without terms, or whose terms no document has, gives no row. Of
    equal scores the smaller doc_id comes first, null ones last; repeated documents have
    ranks of their own. Items are taken to the shards in batches of about ``batch_terms`` terms.
    """
    spark, kind = shards.sparkSession, shards.schema["doc_ids"].dataType.elementType.simpleString()
    asked = saved(items.select(F.col("item_id").alias("item_id"), F.col("text").alias("text")).distinct().withColumn("item", F.monotonically_increasing_id()))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, at, terms = terms_of(batch.column(1))
            both = np.unique(of * max(len(terms), 1) + at)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(both // max(len(terms), 1))), terms.take(pa.array(both % max(len(terms), 1)))], ["item", "term"])

    wanted = saved(asked.select("item", "text").mapInArrow(split, "item long, term string"))
    counted = shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    df = counted.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = saved(wanted.join(df, "term").select("item", "term", weight.alias("w")).where("w > 0"))
    n_batches = max(1, -(-weights.count() // batch_terms))

    def ranked(own: list) -> DataFrame:
        """The best of each task for one batch of items, whose terms and weights go along with the tasks."""
        terms = pa.array(sorted({r["term"] for r in own}), pa.string())
        number = {t: i for i, t in enumerate(terms.to_pylist())}
        by_item: dict[int, list[tuple[int, int]]] = {}
        for r in own:
            by_item.setdefault(r["item"], []).append((number[r["term"]], r["w"]))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, list[tuple]] = {}
            for batch in batches:
                for row in range(batch.num_rows):
                    ids = batch.column(0)[row].values
                    found = pc.fill_null(pc.index_in(terms, value_set=batch.column(1)[row].values), -1).to_numpy()
                    ends = np.cumsum(batch.column(2)[row].values.to_numpy())
                    starts = np.concatenate([[0], ends])
                    docs, impacts = (np.frombuffer(batch.column(c)[row].as_py(), np.int32) for c in (3, 4))
                    places = np.empty(len(ids), np.int64)
                    places[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
                    for item, parts in by_item.items():
                        scores, hit = np.zeros(len(ids), np.int64), False
                        for term, w in parts:
                            if (t := found[term]) >= 0:
                                a, b = starts[t], starts[t + 1]
                                scores[docs[a:b]] += w * impacts[a:b].astype(np.int64)
                                hit = True
                        if hit:
                            top = best_of(scores, places, k)
                            new = zip(scores[top].tolist(), ids.take(pa.array(top)).to_pylist(), strict=True)
                            best[item] = sorted([*best.get(item, []), *new], key=lambda x: (-x[0], x[1] is None, x[1]))[:k]
            rows = [(item, doc_id, score) for item, some in best.items() for score, doc_id in some]
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], id_type), pa.array(cols[2], pa.int64())], ["item", "doc_id", "score"])

        return shards.mapInArrow(scan, f"item long, doc_id {kind}, score long")

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(shards.schema["doc_ids"].dataType.elementType)
    found = None
    for n in range(n_batches):
        own = weights.where(F.pmod(F.xxhash64("item"), F.lit(n_batches)) == n).collect()  # about batch_terms rows
        part = ranked(own)
        found = part if found is None else found.unionByName(part)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    top = found.withColumn("rank", place).where(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score of the k best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    A null or empty text, or one without a term, is no document. An empty table of either kind gives no rows.
    """
    shards, n_docs, _ = index(docs)
    return search(shards, n_docs, items, k)
