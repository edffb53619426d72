"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors of a label by random directions at the median of
their projections, again and again, until a leaf is small; vectors near a split go
to both sides (spill overlap). Vectors that share a leaf in any tree are compared
exactly. A pair is counted only in the first leaf, by tree and number, that both
are in, so leaves return counts and a few links per vector, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import components, saved
from veilframe.llm.ngram_join import _roots


#: Quantiles that are tried where a cut at the median puts too many points on both sides.
QUANTILES = (0.05, 0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9, 0.95)
#: With fewer sampled points than this a node below the root waits for a sample of its own.
FEW = 32


def direction(tree: int, node: int, dims: int) -> np.ndarray:
    """The random direction that splits a node of a tree; the same in every task."""
    v = np.random.default_rng([17, tree, node & (2**63 - 1)]).standard_normal(dims)
    return v / np.linalg.norm(v)


def _cut(x: np.ndarray, margin: float) -> float:
    """Where to split projections: the median, or the best of further quantiles where the median saves no comparisons; inf if none does."""
    best, least = np.inf, 1.0
    for q in (0.5, *QUANTILES):
        cut = np.quantile(x, q)
        left, right = np.mean(x < cut + margin), np.mean(x >= cut - margin)
        if (work := left**2 + right**2) < least:
            best, least = float(cut), work
        if q == 0.5 and np.isfinite(best):
            break
    return best


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, from the packed doubles of each row."""
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = []
        for values in batch.column(2).to_pylist():
            v = np.array(values, float) if values and None not in values else np.zeros(1)
            big = np.abs(v).max() if np.isfinite(v).all() else 0.0
            v = v / big if big else v
            units.append((v / np.sqrt(v @ v)).tobytes() if big else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(units, pa.binary())], ["vec_id", "label", "unit"])


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.93, trees: int = 6, leaf_rows: int = 1024, spill: float = 0.3, levels: int = 6, fit_rows: int = 4096, max_rounds: int = 12,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label; further columns are ignored).

    Rows of one label are linked if the cosine of their vectors, in double precision,
    is at least ``threshold``. Null labels, and vectors that are null, empty, zero or
    hold null or non-finite components, link with nothing. Equal directions are one
    point of the forest with a count; so are repeated rows. Vectors of different
    lengths link with nothing. ``spill`` is the margin on either side of a split, as a
    part of the largest distance (in projection) that linked vectors have in the mean.

    Splits of a node are fitted on at most about ``fit_rows`` of its points, chosen by
    hash; all points are routed. A node that cannot be split further, as its points
    stay within the margin, so that its two sides would take as many comparisons as
    the node itself, is final and compared in pairs of blocks of ``leaf_rows``.
    """
    kind = dict(vectors.dtypes)["vec_id"]
    label_kind = dict(vectors.dtypes)["label"]
    base = vectors.select(F.col("vec_id").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").alias("embedding"))
    rows = saved(base.mapInArrow(_pack, f"vec_id {kind}, label {label_kind}, unit binary"))
    usable = rows.where("label is not null and unit is not null and vec_id is not null")
    points = saved(
        usable.groupBy("label", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn("point", F.monotonically_increasing_id())
    )
    at = points.select(
        "point", "unit", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
        F.xxhash64("label", F.length("unit")).alias("node"),
    )
    placed, waiting = [], saved(at.withColumn("final", F.lit(False)))
    for _ in range(max_rounds):
        sizes = saved(waiting.groupBy("tree", "node").agg(F.count("*").alias("count"), F.max("final").alias("final")))
        is_large = (F.col("count") > leaf_rows) & ~F.col("final")
        large = sizes.where(is_large).drop("final")
        if large.isEmpty():
            break
        placed.append(waiting.join(sizes.where(~is_large), ["tree", "node"], "left_semi"))
        open_ = waiting.join(large, ["tree", "node"])
        waiting = saved(_route(open_, threshold, spill, levels, leaf_rows, fit_rows))
    placed.append(waiting)
    leaves = placed[0]
    for more in placed[1:]:
        leaves = leaves.unionByName(more)
    leaves = saved(leaves.select("point", "tree", "node"))

    members = leaves.groupBy("point").agg(F.array_sort(F.collect_set(F.struct("tree", "node"))).alias("all"))  # trees x spill copies of one point
    sizes = leaves.groupBy("tree", "node").agg(F.ceil(F.count("*") / (2 * leaf_rows)).cast("int").alias("blocks"))
    full = leaves.join(sizes, ["tree", "node"]).withColumn("block", F.pmod(F.xxhash64("point", F.lit(3)), F.col("blocks")).cast("int"))
    full = full.join(members, "point").join(points.select("point", "unit", "copies"), "point")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(b, F.col("block")).alias("i"), F.greatest(b, F.col("block")).alias("j")))
    grouped = full.withColumn("pair", F.explode(pair)).select(
        "tree", "node", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "block", "point", "unit", "copies",
        F.transform("all", lambda x: F.xxhash64(x["tree"], x["node"])).alias("keys"), F.transform("all", lambda x: x["tree"]).alias("key_trees"), F.transform("all", lambda x: x["node"]).alias("key_nodes"),
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        point, copies, block = (group[c].to_numpy() for c in ("point", "copies", "block"))
        unit = _matrix(group["unit"])
        here = (group["tree"][0].as_py(), group["node"][0].as_py())
        linked = unit @ unit.T >= threshold
        exact = np.abs(unit @ unit.T - threshold) < 1e-12
        for a, b in zip(*np.nonzero(exact), strict=True):  # at the very threshold, as a plain sum of products says
            linked[a, b] = float(unit[a] @ unit[b]) >= threshold
        linked &= linked.T
        if group["i"][0] != group["j"][0]:
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        earlier: dict[tuple[int, int], list[int]] = {}
        for k, (ts, ns) in enumerate(zip(group["key_trees"].to_pylist(), group["key_nodes"].to_pylist(), strict=True)):
            for key in zip(ts, ns, strict=True):
                if key < here:
                    earlier.setdefault(key, []).append(k)
        joined = linked.copy()
        for own in earlier.values():
            if len(own) > 1:
                joined[np.ix_(own, own)] = False
        i, j = np.nonzero(np.triu(joined))
        n = joined @ copies
        root = _roots(len(point), i, j)
        some, child = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(point)))
        return pa.table({
            "point": pa.array(np.concatenate([point[some], point[child]])),
            "other": pa.array([None] * len(some) + point[root[child]].tolist(), pa.int64()),
            "n": pa.array(np.concatenate([n[some], np.zeros(len(child), np.int64)]).astype(np.int64)),
        })

    found = saved(grouped.groupBy("tree", "node", "i", "j").applyInArrow(compare, "point long, other long, n long"))
    links = found.where("other is null").groupBy("point").agg(F.sum("n").alias("n"))
    joined = components(found.where("other is not null").select(F.col("point").alias("src"), F.col("other").alias("dst")))
    ids = points.join(links, "point", "left").join(joined.withColumnRenamed("node", "point"), "point", "left").withColumn("component", F.coalesce("component", "point"))
    least = ids.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = ids.join(least, "component").select("label", "unit", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = usable.join(classes, ["label", "unit"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("label is null or unit is null or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _route(open_: DataFrame, threshold: float, spill: float, levels: int, leaf_rows: int, fit_rows: int) -> DataFrame:
    """point, unit, tree, node, final after up to ``levels`` splits of every node; a point near a split is in both children.

    ``final`` marks the nodes that no cut makes cheaper to compare.
    """
    sample = open_.where(F.pmod(F.xxhash64("point", "tree", F.lit(9)), F.lit(1 << 20)) < F.lit(float(fit_rows) * (1 << 20)) / F.col("count"))

    def fit(group: pa.Table) -> pa.Table:
        """Thresholds of the subtree of one node, in heap order; nan where no split is needed, inf where none helps."""
        unit = _matrix(group["unit"].combine_chunks())
        tree, node, count = (group[c][0].as_py() for c in ("tree", "node", "count"))
        depth = max(1, min(levels, int(np.ceil(np.log2(count / leaf_rows)))))
        cuts = np.full(1 << depth, np.nan)
        margin = spill * np.sqrt(2 - 2 * threshold) / np.sqrt(unit.shape[1])
        inside = [(1, np.arange(len(unit)))]
        while inside:
            at, own = inside.pop()
            if at >= 1 << depth or len(own) < (2 if at == 1 else FEW):
                continue
            x = unit[own] @ direction(tree, node + at, unit.shape[1])
            cuts[at] = _cut(x, margin)
            if np.isinf(cuts[at]):
                continue
            inside += [(2 * at, own[x < cuts[at]]), (2 * at + 1, own[x >= cuts[at]])]
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node]), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    fitted = sample.select("tree", "node", "count", "unit").groupBy("tree", "node").applyInArrow(fit, "tree int, node long, cuts array<double>")
    subtrees = saved(fitted)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            point, tree, node = (batch.column(k).to_pylist() for k in range(3))
            units, cuts = batch.column(3).to_pylist(), batch.column(4)
            by_node: dict[tuple[int, int], list[int]] = {}
            for k in range(batch.num_rows):
                by_node.setdefault((tree[k], node[k]), []).append(k)
            out: list[tuple] = []
            for (t, n), own in by_node.items():
                unit = np.frombuffer(b"".join(units[k] for k in own), np.float64).reshape(len(own), -1)
                margin = spill * np.sqrt(2 - 2 * threshold) / np.sqrt(unit.shape[1])
                splits = cuts[own[0]].as_py()
                inside = [(1, np.arange(len(own)))]
                while inside:
                    at, some = inside.pop()
                    if not len(some):
                        continue
                    cut = splits[at] if at < len(splits) else np.nan
                    if np.isfinite(cut):
                        x = unit[some] @ direction(t, n + at, unit.shape[1]) - cut
                        inside += [(2 * at, some[x < margin]), (2 * at + 1, some[x >= -margin])]
                    else:
                        child = (n * 1_000_003 + at * 7_919 + 1) % (1 << 62)
                        out += [(point[own[k]], units[own[k]], t, child, bool(np.isinf(cut))) for k in some]
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["point", "unit", "tree", "node", "final"])

    routed = open_.join(subtrees, ["tree", "node"]).select("point", "tree", "node", "unit", "cuts")
    return routed.mapInArrow(route, "point long, unit binary, tree int, node long, final boolean")
