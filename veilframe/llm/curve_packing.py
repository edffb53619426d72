"""Packing along a space-filling curve: documents that are alike share sequences.

Every document is tokenized once and its ids are averaged through a fixed table of
hashed vectors to a point in few dimensions. Points are ranked by their Hilbert
key, and the documents, laid end to end along the curve, are cut every
``sequence`` tokens. No token is padding but for the very last sequence, and that
one is cut at powers of two, which need none.
"""

from __future__ import annotations

import codecs
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import saved, slices

DIMS, BITS, TIE_BITS = 3, 12, 26
MEMO_SIZE = 600_000
#: Signs that may follow a word as a token of their own; an apostrophe may begin an ending.
SIGNS = string.punctuation.replace("'", "")
#: Letters of old blocks, where all tables of Unicode agree, whose lower case is one letter, whatever stands beside it.
#: A word with others is left to the tokenizer itself.
LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{233}\x{386}\x{388}-\x{38a}\x{38c}\x{38e}-\x{3a1}\x{3a4}-\x{3cd}\x{400}-\x{481}\x{48a}-\x{513}]+$"


class _Words:
    """One tokenizer, and the ids of the runs of letters or signs that it has met; bounded, and kept as long as the Python worker."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.runs = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.runs.normalizer, self.runs.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.CharDelimiterSplit(" ")
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends, self.ids = np.zeros(self.size, bool), {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.ends[i] = token.endswith("</w>")
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = dict(enumerate(map(chr, range(128))))  # the letter that stands for each byte
        for c in map(chr, range(0x80, 0x514)):
            letters |= zip(c.encode(), alphabet.pre_tokenize_str(c)[0][0], strict=True)
        self.letters = "".join(letters.get(b, "\ufffe") for b in range(256))


_tokenizers: dict[str, _Words] = {}


def _tokenizer(path: str) -> _Words:
    if path not in _tokenizers:
        _tokenizers[path] = _Words(path)
    return _tokenizers[path]


def _whole(texts: list[str], known: _Words) -> list[bytes]:
    return [np.array(e.ids, np.uint32).tobytes() for e in known.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _runs(new: list[str], known: _Words) -> list[bytes]:
    """Ids of runs of lower case letters, or of signs. To the tokenizer each is one word, so the steps that
    find words are left out: one text of many runs is encoded and cut at word ends."""
    out: list[bytes] = []
    for i in range(0, len(new), 4000):
        some = new[i:i + 4000]
        text = codecs.charmap_decode(" ".join(some).encode(), "strict", known.letters)[0]
        ids = np.array(known.runs.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = ((np.flatnonzero(known.ends[ids]) + 1) * 4).tolist()
        if len(ends) == len(some):
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        else:  # a vocabulary without word ends, or runs that it takes apart
            out += _whole(some, known)
    return out


def _ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start:start + size] of every start and size in a row."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _flat(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of all blobs in a row, and where each starts and how many it has."""
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    return np.frombuffer(b"".join(blobs), np.uint32), np.cumsum(sizes) - sizes, sizes


def _word_ids(words: pa.Array, counts: np.ndarray, known: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of distinct words, as :func:`_flat` has them; ``counts`` says how often each occurs.

    Letters and the signs after them are separate to the tokenizer, so most words are
    two runs, which many words share. Runs that occur once are not remembered.
    """
    stem = pc.ascii_rtrim(words, characters=SIGNS)
    left, size = (pc.utf8_length(x).to_numpy() for x in (stem, words))
    lettered = pc.match_substring_regex(stem, LETTERS).to_numpy(zero_copy_only=False)
    odd = np.flatnonzero(~lettered & (left > 0))
    first, last = np.flatnonzero(lettered), np.flatnonzero((lettered | (left == 0)) & (size > left))
    tails = [w[n:] for w, n in zip(words.take(pa.array(last)).to_numpy(zero_copy_only=False), left[last].tolist(), strict=True)]
    pieces = pa.concat_arrays([pc.utf8_lower(stem.take(pa.array(first))), pa.array(tails, pa.string())]).dictionary_encode()
    kind = pieces.indices.to_numpy()
    names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
    ids = list(map(known.ids.get, names))
    new = [k for k, own in enumerate(ids) if own is None]
    often = np.bincount(kind, counts[np.concatenate([first, last])], len(names)) > 1 if len(names) else np.empty(0)
    if len(known.ids) > MEMO_SIZE:
        known.ids.clear()
    for k, own in zip(new, _runs([names[k] for k in new], known), strict=True):
        ids[k] = own
        if often[k]:
            known.ids[names[k]] = own
    flat, starts, sizes = _flat(ids + _whole(words.take(pa.array(odd)).to_pylist(), known))
    which = np.full((len(words), 2), len(starts))  # up to two runs of each word; the last entry is the empty one
    which[first, 0], which[last, 1] = kind[:len(first)], kind[len(first):]
    which[odd, 0] = len(names) + np.arange(len(odd))
    starts, sizes = np.append(starts, 0), np.append(sizes, 0)
    flat = _ragged(flat, starts[which.ravel()], sizes[which.ravel()])
    sizes = sizes[which].sum(axis=1)
    return flat, np.cumsum(sizes) - sizes, sizes


def encode(texts: pa.Array, known: _Words) -> tuple[np.ndarray, np.ndarray]:
    """The tokenizer's ids of all whole texts in a row, without special ids, and how many each text has.

    No token of this kind of vocabulary spans white space, so a text's ids are those
    of its words in a row, and each distinct word is looked up once.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    tokens = split.flatten().dictionary_encode()
    at = tokens.indices.to_numpy()
    flat, starts, sizes = _word_ids(tokens.dictionary, np.bincount(at, minlength=len(tokens.dictionary)), known)
    own = sizes[at]
    ends = np.concatenate([[0], np.cumsum(own)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    return _ragged(flat, starts[at], own), np.diff(ends)


def mean_vectors(flat: np.ndarray, sizes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean of the vectors of each text's ids (n x dims), the ids of all texts in a row; 0 for a text without ids."""
    points, at = np.zeros((len(sizes), vectors.shape[1])), np.flatnonzero(sizes)
    ends = np.cumsum(sizes[at])
    done = 0
    while done < len(at):  # a million ids at a time, or one longer text
        begin = ends[done] - sizes[at[done]]
        stop = max(done + 1, int(np.searchsorted(ends, begin + 1_000_000, side="right")))
        some = at[done:stop]
        points[some] = np.add.reduceat(vectors[flat[begin:ends[stop - 1]]], ends[done:stop] - sizes[some] - begin, axis=0, dtype=np.float64) / sizes[some, None]
        done = stop
    return points


def hashed_vectors(n: int, seed: int = 5) -> np.ndarray:
    """A fixed random vector for each id."""
    return np.random.default_rng(seed).standard_normal((n, DIMS)).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of each row of integer cells (n x dims, 0 <= cell < 2**bits).

    Gray-code transform of the axes (Skilling, 2004), over all rows at once.
    """
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            inside = (x[i] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, sequence: int = 2048, partitions: int | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    ``docs`` (doc_id, text; further columns are ignored). A document is its text's
    ids, then ``end_id``. A null or empty text is that one id. Rows with equal Hilbert keys
    (copies, also those that share a doc_id or have none) are ordered by a hash of doc_id and
    of the number that each row gets when its tokens are written, so a hot key is spread over
    tasks like any other; repeated rows are packed each. An empty table gives no pieces.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))

    vocabulary = max(_tokenizer(tokenizer_path).size, end_id + 1)
    width = np.uint16 if vocabulary <= 1 << 16 else np.uint32

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vectors = _tokenizer(tokenizer_path), hashed_vectors(vocabulary)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                flat, sizes = encode(batch.column(1)[a:b], known)
                points = mean_vectors(flat, sizes, vectors)
                bounds = np.concatenate([[0], np.cumsum(sizes)]) * width().itemsize
                blobs = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat.astype(width))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], *(pa.array(points[:, d]) for d in range(DIMS)), pa.array(sizes + 1), blobs.cast(pa.binary())],
                    ["doc_id", *(f"x{d}" for d in range(DIMS)), "n", "ids"],
                )

    tokenized = base.mapInArrow(tokenize, f"doc_id {kind}, {', '.join(f'x{d} double' for d in range(DIMS))}, n long, ids binary")
    tokens = saved(tokenized.withColumn("row", F.monotonically_increasing_id()))
    stats = tokens.agg(F.sum("n"), F.count("*"), *(f(F.col(f"x{d}")) for d in range(DIMS) for f in (F.avg, F.stddev_pop))).first()
    total, n_docs = stats[0] or 0, stats[1]
    centre = [(stats[2 + 2 * d] or 0.0, max(stats[3 + 2 * d] or 0.0, 1e-12)) for d in range(DIMS)]

    @F.pandas_udf("long")
    def curve(*xs: pd.Series) -> pd.Series:
        cells = np.empty((len(xs[0]), DIMS), np.int64)
        for d, x in enumerate(xs):
            z = (x.to_numpy() - centre[d][0]) / centre[d][1]
            cells[:, d] = np.minimum((1 / (1 + np.exp(-1.702 * np.clip(z, -20, 20)))) * (1 << BITS), (1 << BITS) - 1)  # near the normal law's ranks
        return pd.Series(hilbert_key(cells) << TIE_BITS)

    tie = F.pmod(F.xxhash64("doc_id", "row"), F.lit(1 << TIE_BITS))
    keyed = tokens.withColumn("key", curve(*(F.col(f"x{d}") for d in range(DIMS))) + tie)
    parts = partitions or max(1, min(20_000, -(-total // 2_000_000)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = saved(keyed.select("key", "n"))
    steps = [i / parts for i in range(1, parts)]
    cuts = sorted({int(x) for x in narrow.approxQuantile("key", steps, 0.2 / parts)}) if n_docs and steps else []

    def slice_of(key: Column) -> Column:
        """Which range of the curve a key lies in: the number of cuts at or below it, by binary search in the plan."""
        def search(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(key < F.lit(cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

        if len(cuts) <= 256:
            return search(0, len(cuts))

        @F.pandas_udf("int")
        def found(k: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(np.array(cuts), k.to_numpy(), side="right").astype(np.int32))

        return found(key)

    totals = dict(tuple(r) for r in narrow.groupBy(slice_of(F.col("key")).alias("slice")).agg(F.sum("n")).collect())  # a row for each slice
    starts, at = {}, 0
    for s in range(len(cuts) + 1):
        starts[s] = at
        at += totals.get(s, 0)
    last = total - total % sequence  # from here on sequences are cut at powers of two
    tail = [(last + sum(1 << b for b in range(sequence.bit_length()) if b > k and (total - last) >> b & 1), 1 << k) for k in range(sequence.bit_length() - 1, -1, -1) if (total - last) >> k & 1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, position = None, 0
        for batch in batches:
            rows: list[tuple] = []
            for s, doc_id, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if s != where:
                    where, position = s, starts[s]
                ids = np.append(np.frombuffer(blob, width), end_id).astype("<u4")
                begin = 0
                while begin < n:
                    if position < last:
                        sequence_id, offset = divmod(position, sequence)
                        room = sequence - offset
                    else:
                        k = max(i for i, (a, _) in enumerate(tail) if a <= position)
                        sequence_id, offset = last // sequence + k, position - tail[k][0]
                        room = tail[k][1] - offset
                    size = min(n - begin, room)
                    rows.append((doc_id, begin, size, zlib.crc32(ids[begin:begin + size].tobytes()), n, sequence_id, offset))
                    begin, position = begin + size, position + size
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(1).type), *(pa.array(c, pa.int64()) for c in cols[1:])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    ranged = keyed.select(slice_of(F.col("key")).cast("int").alias("slice"), "doc_id", "n", "ids", "key").repartitionById(len(cuts) + 1, F.col("slice"))
    ordered = ranged.sortWithinPartitions("slice", "key", "doc_id", "n", "ids").select("slice", "doc_id", "n", "ids")
    return ordered.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
