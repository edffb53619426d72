"""Block naming, heap codes and sharded search against plain code, with odd rows."""

import hashlib
import heapq
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import block_naming, heap_codes, sharded_search

# --- exact duplicates ---------------------------------------------------------


def plain_duplicates(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for plain, own in groups.items():
        keep = rows[min(own)[3]][0]
        out += [(str(rows[i][0]), str(keep), len(own), hashlib.sha256(plain.encode()).hexdigest()) for *_, i in own]
    return sorted(out)


def naming_rows():
    rng = random.Random(11)
    texts = ["", " \n\t", None, "a", " a", "ab", "a b", "aaaaaaaa", "aaaaaaaaa", "a" * 4000, "a" * 3999 + "b", "\x0b\x0c\r a", "é x", "é  x", "日本語" * 300, "日本語" * 300 + " "]
    texts += ["".join(rng.choice("ab \n") for _ in range(rng.randrange(1, 30))) for _ in range(200)]
    texts += ["a hot copy\nof one row"] * 150 + ["a hot copy of one row "] * 50
    rows = [(rng.randrange(1000), t) for t in texts] + [(None, "nameless"), (None, "name less"), (7, "twice"), (7, "twice"), (None, "both named and not"), (3, "both named and not")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_bytes", [1, 5, 512])
def test_block_naming_against_plain_groups(spark, block_bytes):
    rows = naming_rows() if block_bytes > 1 else [r for r in naming_rows() if len(r[1] or "") < 500]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).select("*", *(F.lit("x").alias(c) for c in ("name", "row", "pos", "block", "level", "part", "n")))
    got = block_naming.deduplicate(docs, block_bytes).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == plain_duplicates(rows)
    assert Counter(r.text_sha256 for r in got if r.kept) == {h: 1 for *_, h in plain_duplicates(rows)}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_block_naming_of_text_ids_and_no_rows(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, None)], "doc_id string, text string")
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in block_naming.deduplicate(docs).collect()) == [("None", "None", 1, True), ("a", "a", 2, True), ("b", "a", 2, False)]
    assert block_naming.deduplicate(docs.limit(0)).count() == 0


def test_names_are_ranks_and_a_hot_key_is_cut(spark):
    keys = ["m"] * 3000 + [chr(97 + i % 26) * (1 + i % 5) for i in range(600)]
    rows = spark.createDataFrame([(i, 0, k) for i, k in enumerate(keys)], "row long, pos long, key string").repartition(8)
    rank = {k: i for i, k in enumerate(sorted(set(keys)))}
    for digest in (None, F.lit(5).cast("long"), F.ascii("key").cast("long")):  # keys that share a digest are dealt themselves
        assert {r.row: r.name for r in block_naming.named(rows, "key", digest=digest).collect()} == {i: rank[k] for i, k in enumerate(keys)}
    names = {k: {r.name for r in own} for k, own in itertools.groupby(sorted(block_naming.named(rows, "key", digest=F.xxhash64("key")).collect(), key=lambda r: keys[r.row]), key=lambda r: keys[r.row])}
    assert sorted(n for own in names.values() for n in own) == list(range(len(rank)))
    ranged = rows.repartitionByRange(8, "key", "row", "pos").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert ranged.max() < 2 * len(keys) / 8


# --- vector codes -------------------------------------------------------------


def plain_lloyd(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error) and the entries, from the definition."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, np.floor(4096 * np.array(r[1])).astype("<i4").tobytes()))
    x = np.array([[math.floor(4096 * v) for v in r[1]] for r in kept], np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for n in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        codes = d.argmin(axis=2)
        if n == rounds:
            break
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own := x[codes[:, p] == e, p]).size:
                    books[p, e] = [math.floor(int(s) / len(own)) if abs(s) < 2**50 else int(s) // len(own) for s in own.sum(axis=0)]
    errors = d.min(axis=2).sum(axis=1)
    return [(r[0], "".join(f"{c:02x}" for c in row), int(e), r[2]) for r, row, e in zip(kept, codes, errors, strict=True)], books


def vector_rows(n=900, width=16):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 0.2, (30, width))
    x = (centres[rng.integers(0, 30, n)] + rng.normal(0, 0.05, (n, width))).astype(np.float32)
    x[5] = x[4]  # equal entries of the first codebook
    x[300:500] = x[299]  # a hot vector
    x[600:640] = 0
    rows = [(i, v.tolist(), int(i % 3) if i % 7 else None) for i, v in enumerate(x)]
    return rows + [(2000, None, 1), (2001, [None] + [0.0] * (width - 1), 1), (2002, [math.nan] * width, None), (2003, [math.inf] * width, 2), (None, [0.5] * width, None), (8, [0.25] * width, 0)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 3000])
def test_heap_codes_against_plain_rounds(spark, block_bytes):
    rows = vector_rows()
    want, books = plain_lloyd(rows)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5).select("*", *(F.lit(1).alias(c) for c in ("code", "error", "ints", "n")))
    got = heap_codes.compress(vectors, block_bytes=block_bytes).collect()
    show = lambda some: sorted((str(a), b, c) for a, b, c in some)
    assert show((r.vec_id, r.code, r.error) for r in got) == show(w[:3] for w in want)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()}
    sums = Counter()
    for *_, e, label in want:
        sums[label] += e
    label_of = {(i, tuple(v)): label for i, v, label in rows if v}
    assert {r.label_error for r in got} == set(sums.values()) and label_of


def test_heap_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>, label string"
    few = [(1, [0.0] * 8, "a"), (2, [1.0] * 8, None), (3, [1.0] * 8, None), (4, [0.1] * 9, "b"), (5, [], "b"), (6, [1e30] * 8, "c")]
    got = {r.vec_id: r for r in heap_codes.compress(spark.createDataFrame(few, schema)).collect()}
    assert (got[1].code, got[1].error, got[2].code, got[3].code) == ("00" * 8, 0, "01" * 8, "01" * 8)
    assert [got[i].code for i in (4, 5, 6)] == [None] * 3 and [got[i].label_error for i in (1, 2, 4)] == [0, 0, None]
    assert heap_codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert heap_codes.compress(spark.createDataFrame([(4, [0.1] * 9, "b")], schema)).collect()[0].code is None


def test_only_violated_parts_are_popped():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 1000):
        keys = rng.random(n).tolist()
        heapq.heapify(keys)
        keys = np.array(keys)
        for bound in (-1.0, 0.1, 0.5, 2.0):
            assert sorted(heap_codes.violated(keys, bound).tolist()) == np.flatnonzero(keys <= bound).tolist()
    points = (rng.normal(0, 300, (2000, 8, 8)) + rng.choice([-2000, 0, 2000], (2000, 1, 1))).astype(np.int64)
    books, scanned = points[:16].transpose(1, 0, 2).copy(), []
    codes, heaps, drift = np.zeros((2000, 8), np.uint8), heap_codes.Heaps([np.empty(0)] * 128, [np.empty(0, np.int32)] * 128), np.zeros((8, 16))
    whole = heap_codes.nearest
    for n in range(12):
        before = len(scanned)
        try:
            heap_codes.nearest = lambda x, b: scanned.append(len(x)) or whole(x, b)
            heap_codes.reassign(points, codes, heaps, books, drift, n == 0)
        finally:
            heap_codes.nearest = whole
        compared = sum(scanned[before:])
        d = ((points[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        assert (codes == d.argmin(axis=2)).all() and sum(len(k) for k in heaps.keys) == codes.size
        moved = books.copy()
        for p in range(8):
            for e in range(16):
                if (own := points[codes[:, p] == e, p]).size:
                    moved[p, e] = own.mean(axis=0) // 1
        steps = np.sqrt(((moved - books) ** 2).sum(axis=2))
        drift = drift + steps + np.array([[np.delete(row, e).max() for e in range(16)] for row in steps])
        books = moved
    assert compared < codes.size / 2


# --- ranked search ------------------------------------------------------------


def plain_search(docs, items, k=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counts = [Counter(cut(t)) for _, t in docs]
    n_docs, total = sum(map(bool, counts)), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for (doc_id, _), c in zip(docs, counts, strict=True):
            score = 0
            for t in set(cut(text)):
                if c[t]:
                    m = 100 - 90 + 90 * sum(c.values()) * n_docs // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(str(item_id), i, str(None if none else d), -s) for i, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("shard_bytes", "batch_terms"), [(4_000_000, 500_000), (60, 5)])
def test_search_against_plain_scores(spark, shard_bytes, batch_terms):
    rng = random.Random(2)
    words = ["the", "The", "a", "x1", "É", "é", "naïve", "日本", "don't", "end.", "_y_", "z\x00z", "two em"] + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))) for i in range(300)]
    docs += [(1000 + i, "tie w1 w2") for i in range(60)] + [(None, "tie w1 w2"), (None, None), (5, None), (6, ""), (7, "!!!"), (1000, "tie w1 w2"), (2000, "long " * 30_000 + "w3")]
    rng.shuffle(docs)
    items = [(1, "tie"), (2, "the w1, w2 É naïve x1"), (2, "another text of one id w5"), (3, None), (4, ""), (5, "nothing known"), (6, "W7 w7 w8 日本"), (6, "W7 w7 w8 日本"), (None, "w9"), (8, "long w3"), (9, "two em z")]
    extra = [F.lit("x").alias(c) for c in ("item", "term", "w", "rank", "score", "df")]
    shards, n_docs, _ = sharded_search.index(spark.createDataFrame(docs, "doc_id long, text string").repartition(4).select("*", *extra), shard_bytes)
    got = sharded_search.search(shards, n_docs, spark.createDataFrame(items, "item_id long, text string").select("*", *extra), batch_terms=batch_terms).collect()
    assert sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in got) == plain_search(docs, items)


def test_shards_of_one_task_are_cut_into_small_files(spark):
    """Writers and readers hold a file's rows at once, and a shard is megabytes, so a task's memory must not grow with its shards."""
    docs = spark.createDataFrame([(i, f"word{i} and more words of text {i}") for i in range(100)], "doc_id long, text string").coalesce(1)
    shards, n_docs, _ = sharded_search.index(docs, 60)
    files = shards.groupBy(F.input_file_name()).count().collect()
    assert n_docs == 100 and len(files) > 5 and max(r["count"] for r in files) <= sharded_search.SHARDS_PER_FILE


def test_search_of_no_rows_and_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "two")], "item_id string, text string")
    assert [(r.item_id, r["rank"], r.doc_id) for r in sharded_search.ranked_search(docs, items).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]
    assert sharded_search.ranked_search(docs.limit(0), items).count() == 0 and sharded_search.ranked_search(docs, items.limit(0)).count() == 0


def test_ties_at_the_last_place_go_by_place():
    scores, places = np.array([5, 7, 5, 5, 0, 5]), np.array([9, 1, 3, 2, 0, 8])
    assert sharded_search.best_of(scores, places, 3).tolist() == [1, 3, 2]
    assert sharded_search.best_of(scores, places, 10).tolist() == [1, 3, 2, 5, 0]
    assert sharded_search.best_of(np.zeros(0, int), places[:0], 3).tolist() == []
