"""N-gram Jaccard self-join with a MinHash LSH forest.

Each distinct text has one signature per tree, a row of min-hashes that is read as
its path in a prefix trie. Level by level, from the longest prefix on, the nodes of
the tries that branch at that depth bring together the texts below them: pairs whose
longest common prefix, over all trees, ends there. They are verified exactly on their
shingle sets. Prefixes are shortened until the recall that is estimated from the links
found so far, their similarities and what the last level added, reaches the target.
Candidates are verified in blocks of bounded size that return counts and a few
links per text, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import components, discard, saved, slices, with_few

TREES, DEPTH = 24, 8
_rng = np.random.default_rng(20)
_A = _rng.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on."""
    with np.errstate(over="ignore"):
        out = np.full(max(len(words) - width + 1, 0), np.uint64(width))
        for k in range(width):
            out = (out ^ (out >> np.uint64(31))) * _M2 + words[k:k + len(out)] * _M1
        out = (out ^ (out >> np.uint64(29))) * _M3
    return out ^ (out >> np.uint64(32))


def shingles(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words of each text; a shorter text is one run of all its words."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    tokens = split.flatten()
    is_word = pc.not_equal(tokens, "").to_numpy(zero_copy_only=False)
    coded = tokens.dictionary_encode()
    words = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)[coded.indices.to_numpy()][is_word]
    ends = np.concatenate([[0], np.cumsum(is_word)])[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
    runs, out = _runs(words, width), []
    for a, b in itertools.pairwise(ends):
        out.append(np.unique(runs[a:b - width + 1] if b - a >= width else _runs(words[a:b], b - a) if b > a else runs[:0]))
    return out


def signature(hashes: np.ndarray) -> bytes:
    """TREES x DEPTH min-hashes, 16 bits of each."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 512):
            mixed = _A[:, None] * hashes[None, i:i + 512]
            mixed += _B[:, None]
            np.minimum(least, mixed.min(axis=1), out=least)
        least = (least ^ (least >> np.uint64(33))) * _M3
    return (least >> np.uint64(48)).astype("<u2").tobytes()


def level_recall(similarity: np.ndarray | float, depth: int) -> np.ndarray | float:
    """Chance that two texts of this similarity share a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def _prefix_keys(signatures: np.ndarray, depth: int) -> np.ndarray:
    """One 64-bit key per text and tree of the first ``depth`` min-hashes (n x TREES)."""
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(TREES, dtype=np.uint64) * _M3 + np.uint64(depth), (len(signatures), 1))
        for k in range(depth):
            key = (key ^ (key >> np.uint64(30))) * _M2 + signatures[:, :, k].astype(np.uint64) * _M1
        key = (key ^ (key >> np.uint64(29))) * _M3
    return key ^ (key >> np.uint64(32))


def _signatures(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<u2").reshape(len(blobs), TREES, DEPTH)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = (s for a, b in slices(batch.column(1)) for s in shingles(batch.column(1)[a:b]))
        blobs = [signature(s) if len(s) else None for s in sets]
        chars = pc.cast(pc.fill_null(pc.utf8_length(batch.column(1)), 0), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(blobs, pa.binary()), chars], [*batch.schema.names, "signature", "chars"],
        )


def _triangle(at: np.ndarray, limit: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of the sorted indices, about ``limit`` at a time."""
    n, start = len(at), 0
    while start < n - 1:
        stop = min(n - 1, start + max(1, limit // (n - start)))
        sizes = n - 1 - np.arange(start, stop)
        first = np.repeat(np.arange(start, stop), sizes)
        second = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first + 1
        yield at[first], at[second]
        start = stop


def _pairs_of(cluster: np.ndarray, trees: np.ndarray, keys: np.ndarray, deeper: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of one cluster whose longest common prefix ends at the depth of ``keys``, each once.

    ``keys`` and ``deeper`` (n x TREES) name the trie nodes of this depth and the next, and ``trees``
    has a bit for each tree whose node belongs to the cluster. A pair belongs to the first tree in which it meets.
    """
    for t in range(keys.shape[1]):
        own = np.flatnonzero(trees >> t & 1)
        order = own[np.lexsort((keys[own, t], cluster[own]))]
        c, k = cluster[order], keys[order, t]
        edges = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (k[1:] != k[:-1]), True])
        for a, b in zip(edges[:-1][np.diff(edges) > 1], edges[1:][np.diff(edges) > 1], strict=True):
            at = np.sort(order[a:b])
            for i, j in _triangle(at):
                if deeper is not None:
                    apart = (deeper[i, t] != deeper[j, t]) & ~(deeper[i] == deeper[j]).any(axis=1)
                    i, j = i[apart], j[apart]
                first = ~(keys[i, :t] == keys[j, :t]).any(axis=1)
                yield i[first], j[first]


def _batched(pairs: Iterator[tuple[np.ndarray, np.ndarray]], limit: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, sorted by i, in batches of about ``limit``."""
    waiting, size = [], 0

    def batch() -> tuple[np.ndarray, np.ndarray]:
        i, j = (np.concatenate([x[k] for x in waiting]) for k in range(2))
        order = np.argsort(i, kind="stable")
        return i[order], j[order]

    for i, j in pairs:
        waiting.append((i, j))
        size += len(i)
        if size >= limit:
            yield batch()
            waiting, size = [], 0
    if size:
        yield batch()


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs."""
    out = np.empty(len(i), np.int64)
    begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1], True]) if len(i) else np.empty(0, np.int64)
    for a, b in zip(begins[:-1], begins[1:], strict=True):
        own, others = sets[i[a]], j[a:b]
        if b - a == 1:
            out[a] = len(np.intersect1d(own, sets[others[0]], assume_unique=True))
            continue
        for s in range(0, b - a, 256):
            part = [sets[x] for x in others[s:s + 256]]
            flat = np.concatenate(part)
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            sums = np.concatenate([[0], np.cumsum(own[at] == flat)])
            ends = np.cumsum([len(x) for x in part])
            out[a + s:a + s + len(part)] = sums[ends] - sums[ends - [len(x) for x in part]]
    return out


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n by the links."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def estimated_recall(links: np.ndarray, new: float, depth: int, threshold: float) -> float:
    """The share of all links that prefixes of ``depth`` have found, by the links found so far.

    ``links`` counts them by thousandths of similarity, the ``new`` ones of this level
    included. A link of similarity s stands for 1 / level_recall(s) links; one link at the
    threshold is added, so that few links prove nothing. Where this level added more than
    the levels before it let expect, what is still missing is taken to be as much more.
    """
    s = np.maximum(np.arange(1001) / 1000, threshold)
    counts = links.astype(float)
    counts[int(threshold * 1000)] += 1
    now = level_recall(s, depth)
    missing, surprise = float((counts * (1 / now - 1)).sum()), 1.0
    if depth < DEPTH:
        before = level_recall(s, depth + 1)
        expected = float((counts / now * (now - before)).sum())
        surprise = max(1.0, (new + 1) / (expected + 1))
    return float(counts.sum() / (counts.sum() + missing * surprise))


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, target_recall: float = 0.9999, block_rows: int = 2048,
    block_chars: int = 16_000_000, least_depth: int = 4, spread: int = TREES, carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_links, class_id, kept of every row of ``docs`` (doc_id, text; of further columns those in ``carry`` are returned too).

    Two rows are linked if the Jaccard similarity of their sets of five-word runs is
    at least ``threshold``; words are what stands between ASCII white space, case and
    signs kept, and a text of fewer than five words is one run. Equal texts are linked.
    n_links counts other rows linked directly, class_id is the smallest doc_id that
    links reach, and kept marks exactly one row of each class: one of its smallest doc_id.

    A null or wordless text links with nothing, equal or not: each such row is a class of
    its own. Repeated rows are copies that link, and one of them is kept. Rows with a null
    doc_id link like others; a class of such rows alone has a null class_id and one row
    kept. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    kinds = [(f"__c{i}", dict(docs.dtypes)[c]) for i, c in enumerate(carry)]
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), *(F.col(c).alias(k) for c, (k, _) in zip(carry, kinds, strict=True)))
    schema = ", ".join(["doc_id " + kind, "text string", *(f"{k} {t}" for k, t in kinds), "signature binary, chars long"])
    signed = base.mapInArrow(_sign, schema).withColumn("body", F.unhex(F.md5("text"))).withColumn("row", F.monotonically_increasing_id())
    signed = saved(signed)  # written, so each row keeps its number
    usable = signed.where("signature is not null")
    texts = saved(
        usable.groupBy("body").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("rep"), F.count("*").alias("copies"),
            F.first("signature").alias("signature"), F.first("chars").alias("chars"),
        ).withColumn("node", F.monotonically_increasing_id())
    )
    paths, known = _forest(texts, signed, least_depth)
    found, links = [], np.zeros(1001)
    for depth in range(DEPTH, DEPTH - 1 if known.isEmpty() else least_depth - 1, -1):  # where no two texts share the shortest prefix one level says so
        level = _verify(paths, known, depth, threshold, block_rows, block_chars, spread)
        found.append(level.where("node is not null"))
        new = np.zeros(1001)
        for s, n in level.where("node is null").groupBy("other").agg(F.sum("n")).collect():  # a row for each thousandth
            new[s] = n
        links += new
        if estimated_recall(links, new.sum(), depth, threshold) >= target_recall:
            break
    discard(paths, known)  # the levels have been written
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)

    counts = every.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(every.where("other is not null").select(F.col("node").alias("src"), F.col("other").alias("dst")))
    ids = texts.select("node", "body", "rep", "copies").join(counts, "node", "left").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = ids.groupBy("component").agg(F.min("rep").alias("least"))
    classes = ids.join(least, "component").select("body", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least")
    own = [F.col(k).alias(c) for c, (k, _) in zip(carry, kinds, strict=True)]
    linked = usable.drop("signature", "text").join(classes, "body").select("doc_id", *own, "n_links", F.col("least.doc_id").alias("class_id"), (F.col("row") == F.col("least.row")).alias("kept"))
    alone = signed.where("signature is null").select("doc_id", *own, F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def _prefix(depth: int) -> Column:
    return F.xxhash64("tree", F.expr(f"substring(path, 1, {2 * depth})"))


def _forest(texts: DataFrame, signed: DataFrame, least_depth: int) -> tuple[DataFrame, DataFrame]:
    """The tries' paths (node, tree, path) that share a prefix of ``least_depth`` with another text's, and the texts that have one."""
    paths = texts.select("node", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "signature").select(
        "node", "tree", F.expr(f"substring(signature, tree * {2 * DEPTH} + 1, {2 * DEPTH})").alias("path")
    )
    rows = paths.withColumn("prefix", _prefix(least_depth))
    shared = rows.groupBy("prefix").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("prefix")
    met = saved(rows.join(shared, "prefix", "left_semi").select("node", "tree", "path"))
    nodes = met.select("node").distinct()
    known = texts.join(nodes, "node", "left_semi").select("node", F.col("rep.row").alias("row"), "copies", "signature", "chars")
    return met, saved(known.join(signed.select("row", "text"), "row").drop("row"))


def _verify(paths: DataFrame, known: DataFrame, depth: int, threshold: float, block_rows: int, block_chars: int, spread: int) -> DataFrame:
    """Verified links of the texts whose longest common prefix in any tree ends at ``depth``.

    Rows are (node, other null, n): n rows of other texts are linked with node in one
    group; (node, other): a link that, with its like, spans what a group connects; and
    (node null, other, n): n links of a similarity of ``other`` thousandths.
    """
    child = _prefix(depth + 1) if depth < DEPTH else F.col("node")
    rows = paths.select("node", "tree", _prefix(depth).alias("prefix"), child.alias("child"))
    branching = rows.groupBy("prefix").agg(F.min("child").alias("a"), F.max("child").alias("b"), F.min("node").alias("low")).where("a < b").select("prefix", "low")
    met = rows.select("node", "tree", "prefix").join(branching, "prefix")
    bit = F.expr("bit_or(shiftleft(1, tree))").alias("trees")
    # a trie node's texts go to its least text's cluster: those of near copies are mostly the same in all trees
    clusters = saved(met.groupBy(F.col("low").alias("cluster"), "node").agg(bit).join(known.select("node", "chars"), "node"))

    def blocks() -> Column:
        return F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("chars") / block_chars)).cast("int").alias("blocks")

    sizes = saved(clusters.groupBy("cluster").agg(blocks(), F.count("*").alias("n")))
    # a small cluster has a bin; of a large one each pair of its blocks is a group; one of more blocks than there
    # are trees is taken apart by trie nodes, so that none of its texts is sent to all of them
    parts = with_few(clusters, sizes.where(F.col("blocks") <= spread), "cluster")
    huge = sizes.where(F.col("blocks") > spread).select(F.col("cluster").alias("low"))
    if not huge.isEmpty():
        split = met.join(huge, "low", "left_semi").select(F.col("prefix").alias("cluster"), "node", F.expr("shiftleft(1, tree)").alias("trees")).join(known.select("node", "chars"), "node")
        parts = parts.unionByName(split.join(split.groupBy("cluster").agg(blocks()), "cluster"))
    parts = parts.withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    small = parts.where("blocks = 1").agg(F.count("*"), F.coalesce(F.sum("chars"), F.lit(0))).first()
    bins = max(1, -(-small[0] // block_rows), -(-small[1] // block_chars))
    pair = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(-1).alias("i"), F.pmod(F.xxhash64("cluster"), F.lit(bins)).cast("int").alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(b, F.col("block")).alias("i"), F.greatest(b, F.col("block")).alias("j")))
    )
    grouped = parts.join(known.drop("chars"), "node").withColumn("pair", F.explode(pair)).select(
        F.when(F.col("blocks") > 1, F.col("cluster")).alias("large"), F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "node", "cluster", "trees", "block", "copies", "signature", "text",
    )

    def verify(group: pa.Table) -> pa.Table:
        sets = shingles(group["text"].combine_chunks())
        node, cluster, trees, block, copies = (group[c].to_numpy() for c in ("node", "cluster", "trees", "block", "copies"))
        signatures = _signatures(group["signature"].to_pylist())
        keys, deeper = _prefix_keys(signatures, depth), _prefix_keys(signatures, depth + 1) if depth < DEPTH else None
        sizes = np.array([len(s) for s in sets])
        is_across = group["i"][0].as_py() >= 0 and group["i"][0] != group["j"][0]  # pairs within a block belong to the group (b, b)
        n, found, similar = np.zeros(len(node), np.int64), [], np.zeros(1001, np.int64)
        for i, j in _batched(_pairs_of(cluster, trees, keys, deeper)):
            close = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
            if is_across:
                close &= block[i] != block[j]
            i, j = i[close], j[close]
            both = _overlaps(sets, i, j)
            union = sizes[i] + sizes[j] - both
            linked = both >= threshold * union - 1e-9
            i, j = i[linked], j[linked]
            n += (np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))).astype(np.int64)
            similar += np.bincount((1000 * both[linked] / union[linked] + 1e-9).astype(np.int64), minlength=1001)
            root = _roots(len(node), i, j)
            child = np.flatnonzero(root != np.arange(len(node)))
            found.append((child, root[child]))
        i, j = (np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in range(2))
        root = _roots(len(node), i, j)
        some, child, at = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(node))), np.flatnonzero(similar)
        return pa.table({
            "node": pa.array(node[some].tolist() + node[child].tolist() + [None] * len(at), pa.int64()),
            "other": pa.array([None] * len(some) + node[root[child]].tolist() + at.tolist(), pa.int64()),
            "n": pa.array(np.concatenate([n[some], np.zeros(len(child), np.int64), similar[at]])),
        })

    found = saved(grouped.groupBy("large", "i", "j").applyInArrow(verify, "node long, other long, n long"))
    discard(clusters, sizes)
    return found
