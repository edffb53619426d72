"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Two bags of hashed n-grams are modelled: words and word pairs, and runs of one to
three token shapes (lower, Title, UPPER, number, with the signs around them, or
"same word again"). A document's log weight is the sum over its n-grams of
log p_target - log p_raw. Adding Gumbel noise and keeping the k largest keys draws
k documents without replacement in proportion to their weights; k is the number of
documents the two models expect to be target text.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import saved

SIGNS = string.punctuation + "«»“”‘’…–—¿¡"
WORD_BUCKETS = 1 << 16
BUCKETS = 2 * WORD_BUCKETS
SAME = zlib.crc32(b"\0same")
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
MEMO_SIZE = 400_000


class _Tokens(dict):
    """token (no white space) -> hash of its word in lower case << 32 | hash of its shape, signs around it included."""

    def __missing__(self, t: str) -> int:
        word = t.strip(SIGNS)
        if word.islower():
            shape = "a"
        elif not word:
            shape = ""
        elif word.isdigit():
            shape = "9"
        elif len(word) > 1 and word.isupper():
            shape = "U"
        elif word[0].isupper() and (len(word) == 1 or word[1:].islower()):
            shape = "A"
        else:
            shape = "m"
        if len(word) < len(t):
            before, after = t.split(word, 1) if word else (t, "")
            shape = f"{before}\0{shape}\0{after}"
        out = zlib.crc32((word.lower() or t).encode("utf-8", "replace")) << 32 | zlib.crc32(shape.encode("utf-8", "replace"))
        self[t] = out
        return out


_tokens = _Tokens()


def features(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of the whole text."""
    found = text.split() if text else []
    if not found:
        return np.empty(0, np.int64)
    if len(_tokens) > MEMO_SIZE:
        _tokens.clear()
    both = np.fromiter(map(_tokens.__getitem__, found), np.uint64, len(found))
    words, shapes = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    shapes[1:][words[1:] == words[:-1]] = SAME
    with np.errstate(over="ignore"):
        w, s = words * _M1, shapes * _M1
        grams = [w, w[:-1] * _M2 + w[1:], s, s[:-1] * _M2 + s[1:], (s[:-2] * _M2 + s[1:-1]) * _M3 + s[2:]]
        ids = [((g ^ (g >> np.uint64(29))) * _M3 >> np.uint64(48)).astype(np.int64) for g in grams]
    return np.concatenate([ids[0], ids[1], *(x + WORD_BUCKETS for x in ids[2:])])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    waiting: dict[bool, list[np.ndarray]] = {False: [], True: []}

    def settle() -> None:
        for good, ids in waiting.items():
            if ids:
                counts = np.bincount(np.concatenate(ids), minlength=BUCKETS)
                raw[:] += counts
                target[:] += counts * good
                ids.clear()

    size = 0
    for batch in batches:
        for text, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = features(text)
            waiting[good].append(ids)
            size += len(ids)
            if size > 2_000_000:
                settle()
                size = 0
    settle()
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])


def log_ratios(raw: np.ndarray, target: np.ndarray, min_z: float = 3.0) -> np.ndarray:
    """log p_target - log p_raw of each bucket, 0 where the difference is within counting noise."""
    out = np.zeros(BUCKETS)
    for part in (slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, BUCKETS)):
        r, t = raw[part].astype(float), target[part].astype(float)
        if not r.sum() or not t.sum():
            continue
        expected = r * t.sum() / r.sum()
        ratio = np.log((t + 0.5) / (expected + 0.5))
        out[part] = np.where(np.abs(t - expected) > min_z * np.sqrt(expected + 1), ratio, 0)
    return out


def _gumbel(ident: Column, seed: int) -> Column:
    u = (F.pmod(F.xxhash64(ident, F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def top_k_threshold(scored: DataFrame, key: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value of ``key``, found exactly by counting in ever finer bins; no row leaves its task."""
    lo, hi, n = scored.agg(F.min(key), F.max(key), F.count(key)).first()
    if k <= 0 or not n:
        return float("inf")
    if k >= n:
        return lo
    above = 0  # rows above hi
    while lo < hi:
        width = (hi - lo) / bins
        slot = F.least(F.floor((F.col(key) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        counts = dict(
            (int(b), (c, x, y)) for b, c, x, y in
            scored.where(F.col(key).between(lo, hi)).groupBy(slot.alias("b"))
            .agg(F.count("*"), F.min(key), F.max(key)).collect()
        )
        for b in sorted(counts, reverse=True):
            c, x, y = counts[b]
            if above + c >= k:
                lo, hi = x, y
                break
            above += c
        if counts[b][0] == 1:
            break
    return lo


def judge(docs: DataFrame, labels: DataFrame, seed: int = 7, target_rows: int = 50_000, temperature: float = 1.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """Draw the documents that read like the labelled good ones.

    ``docs`` (doc_id, text; of further columns those in ``carry`` are returned too), ``labels`` (doc_id, quality).
    The target model is fitted on at most ``target_rows`` good documents, chosen by
    hash; the raw model counts all documents. Returns one row per document:
    doc_id, log_weight, sample_key, kept (whether it was drawn).

    A null or empty text has log weight 0, that is, it is as likely target as raw.
    Repeated rows get equal keys and are drawn or left together, as are ties at the
    k-th key. Without good labels or without documents nothing is known or drawn:
    in the first case all documents are drawn, in the second the result is empty.
    """
    spark = docs.sparkSession
    kinds = [(f"__c{i}", dict(docs.dtypes)[c]) for i, c in enumerate(carry)]
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), *(F.col(c).alias(k) for c, (k, _) in zip(carry, kinds, strict=True)))
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    n_known, n_good = known.agg(F.count("*"), F.coalesce(F.sum((F.col("quality") == 1).cast("long")), F.lit(0))).first()
    good = (
        known.where("quality = 1").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(target_rows).withColumn("good", F.lit(True))
    )
    # at most target_rows ids
    marked = base.join(F.broadcast(good), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counts = (
        marked.mapInArrow(_count, "bucket long, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    )  # at most BUCKETS rows
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    raw[counts.bucket], target[counts.bucket] = counts.raw, counts.target
    ratios = spark.sparkContext.broadcast(log_ratios(raw, target))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            weights = [float(table[features(t)].sum()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights, pa.float64()), *batch.columns[2:]], ["doc_id", "log_weight", *batch.schema.names[2:]])

    kind = dict(base.dtypes)["doc_id"]
    scored = base.mapInArrow(score, ", ".join([f"doc_id {kind}, log_weight double", *(f"{k} {t}" for k, t in kinds)]))
    scored = saved(scored.withColumn("sample_key", F.col("log_weight") / F.lit(temperature) + _gumbel(F.col("doc_id"), seed)))
    if n_good:
        share = F.least(F.lit(1.0), F.exp(F.least(F.col("log_weight"), F.lit(50.0))) * F.lit(n_good / n_known))
        k = round(scored.agg(F.coalesce(F.sum(share), F.lit(0.0))).first()[0])
    else:
        k = scored.count()
    cut = top_k_threshold(scored, "sample_key", k)
    own = [F.col(k).alias(c) for c, (k, _) in zip(carry, kinds, strict=True)]
    return scored.select("doc_id", *own, "log_weight", "sample_key", (F.col("sample_key") >= F.lit(cut)).alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of :func:`judge` that are drawn."""
    return judge(docs, labels, **options).where("kept")
