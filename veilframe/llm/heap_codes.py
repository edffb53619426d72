"""Vector codes by Lloyd's rounds with heaps of bounds.

Vectors become integers and are cut into parts, each with a codebook of its own. A part
has an upper bound of the distance to its entry and a lower bound of that to any other
one. When entries move, the slack between the two shrinks by at most the drift of the
entry and the largest drift of another. In every block of vectors, each entry has a heap
of its parts keyed by slack plus the drift so far: only those at its top whose key the
cumulative drift has passed are popped and compared with all entries again. Each round's
new entries come from the sums that moved parts take along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import discard, saved, with_few

#: Components of at most so much, so that sums of squares of differences fit 64 bits.
LARGEST = 1 << 27


def violated(keys: np.ndarray, bound: float) -> np.ndarray:
    """Places of a heap whose keys are at most ``bound``: from the root down, and below a place only if it is one of them."""
    found, at = [], np.zeros(min(1, len(keys)), np.int64)
    while len(at):
        at = at[keys[at] <= bound]
        found.append(at)
        at = np.concatenate([2 * at + 1, 2 * at + 2])
        at = at[at < len(keys)]
    return np.concatenate(found) if found else at


class Heaps:
    """One heap for each part position and entry: keys, and the vectors of a block that they belong to."""

    def __init__(self, keys: list[np.ndarray], items: list[np.ndarray]):
        self.keys, self.items = keys, items

    @classmethod
    def read(cls, sizes: bytes, keys: bytes, items: bytes) -> Heaps:
        cuts = np.cumsum(np.frombuffer(sizes, np.int32))[:-1]
        return cls(np.split(np.frombuffer(keys, np.float64), cuts), np.split(np.frombuffer(items, np.int32), cuts))

    def written(self) -> tuple[bytes, bytes, bytes]:
        return np.array([len(k) for k in self.keys], np.int32).tobytes(), np.concatenate(self.keys).tobytes(), np.concatenate(self.items).tobytes()

    def pop(self, heap: int, bound: float) -> np.ndarray:
        """Takes out what is at most ``bound``; the rest is a heap again."""
        at = violated(self.keys[heap], bound)
        if not len(at):
            return at
        out = self.items[heap][at]
        self.keys[heap], self.items[heap] = np.delete(self.keys[heap], at), np.delete(self.items[heap], at)
        self._heapify(heap)
        return out

    def push(self, heap: int, keys: np.ndarray, items: np.ndarray) -> None:
        self.keys[heap], self.items[heap] = np.append(self.keys[heap], keys), np.append(self.items[heap], items.astype(np.int32))
        self._heapify(heap)

    def _heapify(self, heap: int) -> None:
        order = np.argsort(self.keys[heap], kind="stable")  # sorted keys are a heap
        self.keys[heap], self.items[heap] = self.keys[heap][order], self.items[heap][order]


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest entry of each point (of equal ones the first), its squared distance, and that of the nearest other one."""
    d = np.stack([((points - c) ** 2).sum(axis=1) for c in book], axis=1)
    best, rows = d.argmin(axis=1), np.arange(len(d))
    own = d[rows, best]
    if d.shape[1] == 1:
        return best, own, np.full(len(d), np.inf)
    d[rows, best] = np.iinfo(np.int64).max
    return best, own, d.min(axis=1).astype(float)


def reassign(points: np.ndarray, codes: np.ndarray, heaps: Heaps, books: np.ndarray, drift: np.ndarray, first: bool) -> np.ndarray:
    """Brings codes and heaps of a block up to date with the codebooks; returns what each entry gains: sums by component, and a count.

    ``points`` (vectors x parts x width), ``codes`` (vectors x parts), ``books`` (parts x
    entries x width), ``drift`` (parts x entries) the cumulative drift of each heap.
    """
    parts, entries, width = books.shape
    gains = np.zeros((parts, entries, width + 1), np.int64)
    for p in range(parts):
        own = np.arange(len(points)) if first else np.concatenate([heaps.pop(p * entries + e, drift[p, e]) for e in range(entries)])
        if not len(own):
            continue
        x = points[own, p]
        best, near, other = nearest(x, books[p])
        near, other, so_far = np.sqrt(near.astype(float)), np.sqrt(other), drift[p, best]
        key = other - near + so_far - 1e-9 * (1 + near + np.where(np.isinf(other), 0, other) + so_far)  # less than any error of rounding, so what may be a tie is popped
        old = codes[own, p].copy()
        codes[own, p] = best
        for e in range(entries):
            if len(at := np.flatnonzero(best == e)):
                heaps.push(p * entries + e, key[at], own[at])
            come, gone = x[(best == e) & (first | (old != e))], x[(old == e) & (best != e)] if not first else x[:0]
            gains[p, e, :width] = come.sum(axis=0) - gone.sum(axis=0)
            gains[p, e, width] = len(come) - len(gone)
    return gains


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, ints of the rows whose vector is whole: packed 32-bit integers, null where a component is too large for them."""
    kinds = dict(vectors.dtypes)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            lists = batch.column(2)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.cast(lists.flatten(), pa.float64())
            x = np.floor(pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False) * scale)
            of = np.repeat(np.arange(len(sizes)), sizes)
            whole, fits = np.ones(len(sizes), bool), np.ones(len(sizes), bool)
            whole[of[~np.isfinite(x)]] = False
            fits[of[np.abs(np.nan_to_num(x)) >= LARGEST]] = False
            data = np.where(np.abs(np.nan_to_num(x)) < LARGEST, np.nan_to_num(x), 0).astype("<i4").tobytes()
            ends = np.cumsum(sizes) * 4
            packed = [data[e - 4 * n:e] if ok else None for e, n, ok in zip(ends.tolist(), sizes.tolist(), fits.tolist(), strict=True)]
            keep = pa.array(whole)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(packed, pa.binary()).filter(keep)], ["vec_id", "label", "ints"])

    base = vectors.select(F.col("vec_id").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").alias("embedding"))
    return base.mapInArrow(convert, f"vec_id {kinds['vec_id']}, label {kinds['label']}, ints binary")


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, block_bytes: int = 1 << 20) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the rows of ``vectors`` (vec_id, embedding, label; further columns are ignored).

    Rows whose vector is null or holds null or non-finite components are dropped.
    Components become floor(scale * x). Codebooks begin as the parts of the ``entries``
    smallest vec_ids (of equal ones the vector that is less byte by byte; null ids come
    last; with fewer rows there are fewer entries). Each round assigns every part to its
    nearest entry, ties to the first, and moves each entry that has parts to the floor of
    their mean; at the end parts are assigned again.

    All vectors have the length of the smallest vec_id's whose length is a multiple of
    ``parts``; others, empty ones, and those with a component of 2 ** 27 or more after
    scaling, have a null code and error. Repeated rows count each. Null labels are one
    label. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = saved(integers(vectors, scale))
    usable = rows.where(F.length("ints") > 0).where(F.length("ints") % (4 * parts) == 0)
    order = [F.col("vec_id").asc_nulls_last(), "ints"]
    least = usable.orderBy(*order).select("ints").first()
    size = len(least[0]) if least else 4 * parts
    width = size // 4 // parts
    fits = F.coalesce(F.length("ints") == size, F.lit(False))
    start = rows.where(fits).orderBy(*order).limit(entries).select("ints").collect()  # one row for each entry
    books = np.array([np.frombuffer(r[0], "<i4") for r in start], np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    n_entries, per_block = books.shape[1], max(1, block_bytes // size)
    kinds = dict(rows.dtypes)
    state_columns = "codes binary, sizes binary, keys binary, items binary, gains array<long>"
    fixed = f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, ints binary"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each block of vectors."""
        for batch in batches:
            for k in range(0, batch.num_rows, per_block):
                some = batch.slice(k, per_block)
                one = lambda c: pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), pa.concat_arrays([some.column(c)]))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([one(0), one(1), pa.array([b"".join(some.column(2).to_pylist())], pa.binary())], ["ids", "labels", "ints"])

    def advance(books: np.ndarray, drift: np.ndarray, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    own = batch.slice(k, 1)
                    ints = own.column(2)[0].as_py()
                    points = np.frombuffer(ints, "<i4").reshape(-1, parts, width).astype(np.int64)
                    if first:
                        codes, empty = np.zeros((len(points), parts), np.uint8 if n_entries <= 256 else np.uint16), parts * n_entries
                        heaps = Heaps([np.empty(0)] * empty, [np.empty(0, np.int32)] * empty)
                    else:
                        codes = np.frombuffer(own.column(3)[0].as_py(), np.uint8 if n_entries <= 256 else np.uint16).reshape(-1, parts).copy()
                        heaps = Heaps.read(*(own.column(c)[0].as_py() for c in (4, 5, 6)))
                    gains = reassign(points, codes, heaps, books, drift, first)
                    state = [codes.tobytes(), *heaps.written()]
                    yield pa.RecordBatch.from_arrays([*own.columns[:3], *(pa.array([s], pa.binary()) for s in state), pa.array([gains.ravel().tolist()], pa.list_(pa.int64()))], names)
        return run

    names = ["ids", "labels", "ints", "codes", "sizes", "keys", "items", "gains"]
    blocks = saved(rows.where(fits).select("vec_id", "label", "ints").mapInArrow(pieces, fixed))
    drift = np.zeros((parts, n_entries))
    totals = np.zeros((parts, n_entries, width + 1), np.int64)
    for at in range(rounds + 1):
        before, blocks = blocks, saved(blocks.mapInArrow(advance(books, drift, at == 0), f"{fixed}, {state_columns}"))
        discard(before)
        if at == rounds or not n_entries:
            break
        gained = blocks.select(F.posexplode("gains").alias("at", "gain")).where("gain <> 0").groupBy("at").agg(F.sum("gain")).collect()  # a number for each component of each entry
        for k, gain in gained:
            totals.flat[k] += gain
        counts = totals[..., width:]
        moved = np.where(counts > 0, np.floor_divide(totals[..., :width], np.maximum(counts, 1)), books)
        steps = np.sqrt(((moved - books) ** 2).sum(axis=2, dtype=float))
        others = np.array([[np.delete(row, e).max(initial=0.0) for e in range(n_entries)] for row in steps])
        books, drift = moved, drift + steps + others

    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes = np.frombuffer(batch.column(3)[k].as_py(), np.uint8 if n_entries <= 256 else np.uint16).reshape(-1, parts)
                points = np.frombuffer(batch.column(2)[k].as_py(), "<i4").reshape(-1, parts, width).astype(np.int64)
                error = sum(((points[:, p] - books[p][codes[:, p]]) ** 2).sum(axis=1) for p in range(parts))
                texts = codes.astype(">u2").tobytes().hex() if n_entries > 256 else codes.tobytes().hex()
                step = len(texts) // max(len(codes), 1)
                out = [texts[i:i + step] for i in range(0, len(texts), step)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[k].values, batch.column(1)[k].values, pa.array(out), pa.array(error)], ["vec_id", "label", "code", "error"])

    coded = blocks.mapInArrow(measured, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    alone = rows.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    every = saved(coded.unionByName(alone).withColumn("named", F.col("label").isNotNull()).withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit(""))))
    sums = every.groupBy("named", "label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    return with_few(every, sums, "named", "label").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
