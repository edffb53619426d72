"""Encoding and decoding with pieces: unigram Viterbi over a double-array trie.

Pieces are read from a SentencePiece model file. A text becomes a marker, then
itself with every space a marker; the segmentation with the largest sum of log
scores wins, on ties the one whose last piece starts first. A character without a
piece becomes the pieces of its UTF-8 bytes. No piece has a marker after another
character, so segmentations of the stretches between markers are independent, and
each distinct stretch is decoded once, many at a time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
STRETCH = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")
MEMO_SIZE = 300_000
LONG = 64
# Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of one protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            b = data[i]
            i += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while i < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[i:i + size]
            i += size


def read_pieces(data: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, type) in the order of ids."""
    out = []
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            out.append((own[1].decode(), float(np.frombuffer(own[2], "<f4")[0]), own.get(3, NORMAL)))
    return out


@dataclass
class Vocabulary:
    """Pieces as a double-array trie over UTF-8 bytes: the child of s by byte b is base[s] + b if check[...] == s."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # id of the piece that ends in a state, -1 if none
    score: np.ndarray  # by id
    byte_ids: np.ndarray
    unknown: int
    unknown_score: float
    surface: list[bytes]  # what each id decodes to


def log_scores(pieces: list[tuple[str, float, int]]) -> np.ndarray:
    """Log scores by rank: files of merge ranks have no probabilities, so the rank-th piece gets those of Zipf's law."""
    normal = [i for i, p in enumerate(pieces) if p[2] in (NORMAL, USER)]
    out = np.zeros(len(pieces))
    out[normal] = -np.log(np.arange(len(normal)) + 2.0)
    return out


def build(pieces: list[tuple[str, float, int]], scores: np.ndarray | None = None) -> Vocabulary:
    scores = log_scores(pieces) if scores is None else scores
    children: list[dict[int, int]] = [{}]
    ends = {}
    normal = [i for i, p in enumerate(pieces) if p[2] in (NORMAL, USER)]
    for i in normal:
        state = 0
        for b in pieces[i][0].encode():
            if b not in children[state]:
                children[state][b] = len(children)
                children.append({})
            state = children[state][b]
        ends[state] = i
    size = 2 * len(children) + 512
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    free = np.ones(size, bool)
    free[0] = False
    first = 1
    waiting = [(0, 0)]
    for node, at in waiting:
        piece[at] = ends.get(node, -1)
        keys = sorted(children[node])
        if not keys:
            continue
        while not free[first]:
            first += 1
        offsets = np.array(keys) - keys[0]
        slot = first
        while True:
            candidates = np.flatnonzero(free[slot:slot + 4096 + 256][:4096]) + slot
            ok = candidates[free[np.minimum(candidates[:, None] + offsets[None, :], size - 1)].all(axis=1) & (candidates >= keys[0])]
            if len(ok):
                slot = int(ok[0])
                break
            slot += 4096
            if slot + 8192 > size:
                grow = len(free)
                base, check, piece = (np.concatenate([x, np.full(grow, v, np.int32)]) for x, v in ((base, 0), (check, -1), (piece, -1)))
                free = np.concatenate([free, np.ones(grow, bool)])
                size = len(free)
        base[at] = slot - keys[0]
        for b in keys:
            child = base[at] + b
            free[child], check[child] = False, at
            waiting.append((children[node][b], child))
    byte_ids = np.full(256, -1, np.int64)
    surface = []
    for i, (text, _, kind) in enumerate(pieces):
        if kind == BYTE:
            byte_ids[int(text[3:5], 16)] = i
            surface.append(bytes([int(text[3:5], 16)]))
        else:
            surface.append(b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else text.replace(MARKER, " ").encode())
    unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    return Vocabulary(base, check, piece, scores, byte_ids, unknown, float(scores[normal].min()) - 10.0, surface)


def _char_sizes(data: np.ndarray) -> np.ndarray:
    """Length of the UTF-8 character that starts with each byte; 0 for the bytes within one."""
    return np.select([data < 0x80, data < 0xC0, data < 0xE0, data < 0xF0], [1, 0, 2, 3], 4)


def segment(stretches: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """Ids of each stretch, all of about one length: Viterbi over all at once."""
    n, length = len(stretches), max(map(len, stretches))
    data = np.zeros((n, length), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    data[np.arange(length)[None, :] < sizes[:, None]] = np.frombuffer(b"".join(stretches), np.uint8)
    chars = _char_sizes(data)
    best = np.full((n, length + 5), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, length + 5), np.int32)
    by = np.full((n, length + 5), -1, np.int32)
    limit = len(v.base)
    for start in range(length):
        rows = np.flatnonzero((sizes > start) & (chars[:, start] > 0))
        score = best[rows, start]
        width = chars[rows, start]
        single = np.zeros(len(rows), bool)
        live, state = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        at = start
        while len(live):
            inside = sizes[rows[live]] > at
            live, state = live[inside], state[inside]
            if not len(live):
                break
            child = v.base[state] + data[rows[live], at]
            child = np.where(child < limit, child, 0)
            ok = v.check[child] == state
            ok &= child > 0
            live, state = live[ok], child[ok]
            at += 1
            ids = v.piece[state]
            done = ids >= 0
            if done.any():
                k, ids = live[done], ids[done]
                single[k[width[k] == at - start]] = True
                total = score[k] + v.score[ids]
                better = total > best[rows[k], at]
                r = rows[k[better]]
                best[r, at], back[r, at], by[r, at] = total[better], start, ids[better]
        k = np.flatnonzero(~single)
        if len(k):
            end = start + width[k]
            total = score[k] + v.unknown_score
            better = total > best[rows[k], end]
            r = rows[k[better]]
            best[r, end[better]], back[r, end[better]], by[r, end[better]] = total[better], start, -2
    out = []
    for i, text in enumerate(stretches):
        at, path = int(sizes[i]), []
        while at > 0:
            start, own = int(back[i, at]), int(by[i, at])
            if own >= 0:
                path.append(own)
            else:
                parts = [int(x) for x in v.byte_ids[list(text[start:at])]]
                path += reversed(parts) if min(parts) >= 0 else [v.unknown]
            at = start
        out.append(np.array(path[::-1], np.uint32))
    return out


class Coder:
    def __init__(self, v: Vocabulary):
        self.v, self.memo = v, {}

    def _stretches(self, text: str) -> list[str]:
        """The text's stretches: each a run of markers and what follows it; a plain word stands for itself with one marker."""
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " " or MARKER in text:
            return [s[1:] if s[0] == MARKER and s[1:2] != MARKER and len(s) > 1 else "\0" + s for s in STRETCH.findall(MARKER + text.replace(" ", MARKER))]
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        memo = self.memo
        if len(memo) > MEMO_SIZE:
            memo.clear()
        split = [self._stretches(t or "") for t in texts]
        new = sorted({s for words in split for s in words if s not in memo}, key=len)
        whole = [(s[1:] if s[0] == "\0" else MARKER + s).encode("utf-8", "replace") for s in new]
        i = 0
        while i < len(new):  # about a million bytes of one length at a time
            count = max(1, min(8192, 1_000_000 // (4 * len(new[min(i + 8191, len(new) - 1)]) + 8)))
            for s, ids in zip(new[i:i + count], segment(whole[i:i + count], self.v), strict=True):
                memo[s] = ids.tobytes()
            i += count
        return [np.frombuffer(b"".join(map(memo.__getitem__, words)), np.uint32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.v.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def encode_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids, decoded of every row of ``docs`` (doc_id, text; further columns are ignored).

    A null or empty text has no ids and decodes to "". Decoding gives back every text
    but for markers in it, which become spaces. Repeated rows are encoded each.
    The vocabulary is broadcast; its size is that of the model file.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i in range(0, len(texts), 512):
                ids = coder.encode(texts[i:i + 512])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:i + 512], batch.column(1)[i:i + 512], pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([coder.decode(x) for x in ids], pa.string())],
                    ["doc_id", "text", "ids", "decoded"],
                )

    return docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")).mapInArrow(code, f"doc_id {kind}, text string, ids binary, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), round_trip."""
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"),
    )
