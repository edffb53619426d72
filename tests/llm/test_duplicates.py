import random

import numpy as np
import pandas as pd
import pytest

from veilframe.llm import common, embedding_forest, ngram_join


def union_find(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 540)] + [(700, 701 + i) for i in range(50)]
    want = union_find(800, links)
    for heavy in (1000, 5):  # few or many nodes are broadcast
        got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "src long, dst long"), heavy=heavy).collect()}
        assert got == {x: want[x] for pair in links if pair[0] != pair[1] for x in pair}
    assert common.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def shingle_set(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    k = min(5, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    place = {i: k for k, i in enumerate(order)}
    root = union_find(len(rows), [(place[a], place[b]) for a, b in links])
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return sorted((rows[i][0], n[i], rows[order[root[place[i]]]][0]) for i in range(len(rows)))


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.choice((3, 5, 9, 60, 200)))]
        for _ in range(rng.choice((1, 1, 3, 12))):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
            base = copy if rng.random() < 0.5 else base
    return rows


def as_rows(df):
    return sorted((r.doc_id, r.n_links, r.class_id) for r in df.collect())


def test_near_duplicates_equal_brute_force(spark, near_rows):
    docs = spark.createDataFrame(near_rows, "doc_id long, text string")
    assert as_rows(ngram_join.near_duplicates(docs)) == brute(near_rows)


def test_large_groups_in_blocks_equal_brute_force(spark, near_rows):
    base = " ".join(f"x{i}" for i in range(120)).split()
    rows = near_rows + [(1000 + i, " ".join(base[:i] + [f"y{i}"] + base[i + 1:])) for i in range(90)] + [(2000 + i, "same text all over again and again") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(ngram_join.near_duplicates(docs, block_rows=16)) == brute(rows)
    assert as_rows(ngram_join.near_duplicates(docs, block_chars=3000)) == brute(rows)


def test_giant_clusters_are_split_by_trie_nodes(spark, near_rows):
    base = " ".join(f"x{i}" for i in range(120)).split()
    rows = near_rows + [(1000 + i, " ".join(base[:i] + [f"y{i}"] + base[i + 1:])) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(ngram_join.near_duplicates(docs, block_rows=16, spread=2)) == brute(rows)


def levels(spark, monkeypatch, rows, **options):
    """The depths that a run goes through, and its rows; nothing is replaced."""
    depths, plain = [], ngram_join._verify
    monkeypatch.setattr(ngram_join, "_verify", lambda p, k, depth, *a: depths.append(depth) or plain(p, k, depth, *a))
    got = as_rows(ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **options))
    return depths, got


def test_prefixes_are_shortened_until_the_recall_is_reached(spark, monkeypatch):
    """Links of high similarity are all found by long prefixes; links near the threshold, or few of any kind, take shorter ones."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(999)) for _ in range(400)) for _ in range(60)]
    close = [(k * 60 + i, t + f" end{k}") for i, t in enumerate(texts) for k in range(6)]
    depths, got = levels(spark, monkeypatch, close, target_recall=0.9999)
    assert depths == [8] and got == brute(close)
    far = [(k * 60 + i, t if not k else " ".join(t.split()[:400 - 36 * k])) for i, t in enumerate(texts) for k in range(3)]
    depths, got = levels(spark, monkeypatch, far, target_recall=0.9999)
    assert depths[:3] == [8, 7, 6] and got == brute(far)
    depths, got = levels(spark, monkeypatch, far[:2], target_recall=0.99999)
    assert depths == [8, 7, 6, 5, 4] and got == brute(far[:2])


def test_estimated_recall():
    rng = np.random.default_rng(1)
    s = rng.uniform(0.8, 0.9, 40_000)
    trees = rng.binomial(ngram_join.TREES, s**7)  # in how many trees each pair shares 7 min-hashes
    deeper = rng.binomial(trees, s)
    found = lambda x: np.bincount((s[x > 0] * 1000).astype(int), minlength=1001)
    true = (trees > 0).mean()
    assert abs(ngram_join.estimated_recall(found(trees), ((trees > 0) & (deeper == 0)).sum(), 7, 0.8) - true) < 0.0005 and true < 0.9999
    assert ngram_join.estimated_recall(np.zeros(1001), 0, 8, 0.8) < 0.99
    assert ngram_join.estimated_recall(found(trees), 4000, 7, 0.8) < true - 0.002  # more than expected came with this level


def test_join_equals_all_pairs_of_a_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    sets, index = [shingle_set(t) for _, t in rows], {}
    for i, own in enumerate(sets):
        for x in own:
            index.setdefault(x, []).append(i)
    links = set()
    for i, own in enumerate(sets):
        shared = {}
        for x in own:
            for j in index[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        links |= {(j, i) for j, n in shared.items() if 5 * n >= 4 * (len(own) + len(sets[j]) - n)}
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("doc_id")
    assert {r[0]: k for r, k in zip(rows, n, strict=True)} == got.n_links.to_dict() and len(links) > 100
    assert got.kept.sum() == got.class_id.nunique()


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, None, "a", 1), (2, None, "a", 1), (3, "", "a", 1), (4, " \n", "a", 1), (5, "one", "a", 1), (6, "one", "b", 2), (6, "one", "b", 2), (None, "one", "b", 2), (None, "two", "b", 2), (None, "two", "b", 2), (7, "word " * 100_000, "c", 3), (8, "word " * 90_000, "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, body string, node int")
    got = ngram_join.near_duplicates(docs, carry=("node", "body")).toPandas()
    assert len(got) == len(rows) and sorted(got.body) == sorted(r[2] for r in rows)
    by = got.dropna(subset=["doc_id"]).groupby("doc_id")
    assert by.n_links.max().to_dict() == {1: 0, 2: 0, 3: 0, 4: 0, 5: 3, 6: 3, 7: 1, 8: 1}
    assert by.class_id.max().to_dict() == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 7}
    assert by.kept.sum().to_dict() == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 0, 7: 1, 8: 0}
    nameless = got[got.doc_id.isna()].sort_values(["n_links", "kept"])
    assert nameless.n_links.tolist() == [1, 1, 3] and nameless.kept.tolist() == [False, True, False]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def vectors(seed=2, n=900, dims=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    for i in range(1, n):
        if rng.random() < 0.5:
            x[i] = x[rng.integers(i)] * rng.uniform(0.5, 3) + rng.normal(size=dims) * rng.choice((0.0, 0.05, 0.2, 0.35))
    return x.astype(np.float32), rng.integers(0, 3, n)


def brute_vectors(x, labels, threshold=0.93):
    unit = x.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    return linked.sum(1), union_find(len(x), list(zip(*np.nonzero(linked), strict=True)))


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 64, "levels": 2, "fit_rows": 100, "trees": 10}])
def test_forest_against_brute_force(spark, options):
    x, labels = vectors()
    df = spark.createDataFrame([(i, x[i].tolist(), int(labels[i])) for i in range(len(x))], "vec_id long, embedding array<float>, label int")
    got = embedding_forest.near_duplicate_vectors(df, **options).toPandas().set_index("vec_id").sort_index()
    n, root = brute_vectors(x, labels)
    assert (got.n_links.to_numpy() <= n).all() and got.n_links.sum() >= 0.97 * n.sum()
    if not options:
        assert got.n_links.tolist() == n.tolist() and got.component_id.tolist() == root
    assert (got.kept == (got.index == got.component_id)).all()


def test_forest_of_odd_rows(spark):
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [float("nan"), 1.0], 0), (4, [float("inf"), 1.0], 0), (5, [1.0, None], 0), (6, [], 0), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1.0, 0.0], 1), (11, [1e-30, 0.0], 0), (12, [1.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame([(a, b, c, 7, "x") for a, b, c in rows], "vec_id long, embedding array<double>, label int, node int, unit string")
    got = embedding_forest.near_duplicate_vectors(df).toPandas()
    assert len(got) == len(rows)
    assert got.groupby("vec_id").n_links.max().to_dict() == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 3, 9: 3, 10: 0, 11: 3, 12: 0}
    assert got.groupby("vec_id").component_id.max()[11] == 8
    assert embedding_forest.near_duplicate_vectors(df.limit(0)).count() == 0


def test_many_equal_vectors_are_one_point(spark):
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(3000), "embedding": [[1.0, 2.0]] * 3000, "label": 1}))
    got = embedding_forest.near_duplicate_vectors(df, leaf_rows=64)
    assert got.where("n_links = 2999 and component_id = 0").count() == 3000


def test_thousands_of_unequal_near_copies_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2800, 64))
    x[:2400] = x[0] + rng.normal(size=(2400, 64)) * 0.03 * np.linalg.norm(x[0]) / 8
    plain = embedding_forest.saved

    def bounded(df):
        out = plain(df)
        assert out.count() <= 6 * 2 * len(x)
        return out

    monkeypatch.setattr(embedding_forest, "saved", bounded)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(len(x)), "embedding": list(x.tolist()), "label": 1}))
    got = embedding_forest.near_duplicate_vectors(df).toPandas().sort_values("vec_id")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert got.n_links.tolist() == ((unit @ unit.T >= 0.93).sum(1) - 1).tolist()
    assert got.component_id.tolist() == [0] * 2400 + list(range(2400, 2800))


def test_recall_at_production_parameters(spark):
    """One label of more vectors than a leaf holds, so that trees split; half of them near copies over the band."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 48))
    x[1500:] = x[:1500] + rng.normal(size=(1500, 48)) * rng.uniform(0.05, 0.45, 1500)[:, None]
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(3000), "embedding": list(x.tolist()), "label": 1}))
    got = embedding_forest.near_duplicate_vectors(df).toPandas().set_index("vec_id").sort_index()
    n, _ = brute_vectors(x, np.ones(3000, int))
    assert (got.n_links.to_numpy() <= n).all() and got.n_links.sum() >= 0.95 * n.sum() and n.sum() > 1500
