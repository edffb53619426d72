"""Toxicity through a noisy channel: disguised words are decoded, then the restored text is scored.

A character model (four-grams of all words of the corpus) decodes suspicious
tokens: digits and signs that stand for letters, letters spaced out, letters
repeated. Each such token is a lattice of possible letters, and of word ends where
letters are spaced; Viterbi finds the likeliest reading. A logistic model over word beginnings and whole words, fitted
on labelled rows, then scores each document with the restored words added.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The letters that a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
WORD = re.compile(r"[^\W\d_]+")
LETTER = re.compile(r"[^\W\d_]")
_SIGNS = re.escape("".join(LEET))
_OTHER_SIGNS = re.escape("".join(c for c in LEET if not c.isalnum()))
SIGN = re.compile(rf"[{_SIGNS}]")
#: What a disguised word may be written in, and what may separate its parts.
UNIT, SEPARATORS = re.compile(rf"[\w{_SIGNS}*.\-]+"), re.compile(r"[*._\-]+")
SIGN_FIRST, SIGN_BEFORE, DIGITS_LAST = re.compile(rf"[{_SIGNS}]+[^\W\d_]"), re.compile(rf"[{_SIGNS}][^\W\d_]"), re.compile(r"[^\W\d_]{2}[0-9]{1,3}\Z")
#: Three or more single characters in a row, with one or two separators between.
SPACED = re.compile(rf"(?<![\w{_SIGNS}])(?:[^\W_]|[{_OTHER_SIGNS}])(?:[\s.*_\-]{{1,2}}(?:[^\W_]|[{_OTHER_SIGNS}])(?![^\W_])){{2,}}+")
PLAIN = re.compile(r"[^\W\d_]*[^\w@]*")
THRICE = re.compile(r"(.)\1\1")
GRAM_BUCKETS, CONTEXT_BUCKETS = 1 << 18, 1 << 16
START = 10  # the code point that stands before and after each word
SIGN_COST, DROP_COST = 0.7, 1.0


def _grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the four-grams that end at each position from 3 on, and of their first three characters."""
    p = points.astype(np.uint64)
    with np.errstate(over="ignore"):
        a = (p[:-3] * np.uint64(0x9E3779B97F4A7C15) + p[1:-2]) * np.uint64(0xC2B2AE3D27D4EB4F) + p[2:-1]
        b = (a * np.uint64(0x165667B19E3779F9)) ^ (a >> np.uint64(31))
        c = (b + p[3:]) * np.uint64(0x9E3779B97F4A7C15)
    return ((c ^ (c >> np.uint64(32))) >> np.uint64(46)).astype(np.int64), (b >> np.uint64(48)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, contexts = np.zeros(GRAM_BUCKETS), np.zeros(CONTEXT_BUCKETS)

    def settle(tokens: Counter) -> None:
        words: Counter = Counter()
        for token, n in tokens.items():
            for w in WORD.findall(token.lower()):
                words[w] += n
        if not words:
            return
        pad = "\n" * 3
        text = pad + pad.join(words) + pad
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        weights = np.repeat(np.fromiter(words.values(), float, len(words)), np.fromiter(map(len, words), int, len(words)) + 3)
        weights = np.concatenate([weights, np.zeros(len(points) - 3 - len(weights))])
        ends = points[3:]
        counted = (ends != START) | (points[2:-1] != START)  # the padding between two words counts once
        g, c = _grams(points)
        grams[:] += np.bincount(g[counted], weights[counted], GRAM_BUCKETS)
        contexts[:] += np.bincount(c[counted], weights[counted], CONTEXT_BUCKETS)

    words: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                words.update(text.split())
        if len(words) > 200_000:
            settle(words)
            words.clear()
    settle(words)
    for kind, table in ((0, grams), (1, contexts)):
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at), pa.array(table[at])], ["kind", "bucket", "n"])


class CharModel:
    """log p(character | three before it), from hashed counts."""

    def __init__(self, grams: np.ndarray, contexts: np.ndarray):
        self.grams, self.contexts, self.memo = grams, contexts, {}

    def logp(self, context: str, char: str) -> float:
        key = context + char
        found = self.memo.get(key)
        if found is None:
            g, c = _grams(np.array([ord(x) for x in key], np.uint32))
            found = float(np.log((self.grams[g[0]] + 0.05) / (self.contexts[c[0]] + 5.0)))
            if len(self.memo) > 300_000:
                self.memo.clear()
            self.memo[key] = found
        return found

    def decode(self, token: str, spaced: bool = False) -> str:
        """The likeliest reading of one disguised token: Viterbi over states of the last three letters.

        In a ``spaced`` token separators are nothing, and a word may end after every character; the reading has spaces then.
        """
        chars = [c for c in token.lower() if not spaced or c.isalnum() or c in LEET]
        states: dict[str, tuple[float, tuple | None]] = {"\n\n\n": (0.0, None)}  # cost and (what is written, what was before)
        logp, i = self.logp, 0
        while i < len(chars):
            c, run = chars[i], 1
            while i + run < len(chars) and chars[i + run] == c:
                run += 1
            i += run
            options: list[tuple[float, str]] = []
            letters = [(0.0, c)] if c.isalpha() else [(SIGN_COST, x) for x in LEET.get(c, "")]
            for cost, x in letters:
                options.append((cost, x))
                if run > 1:
                    options.append((cost, x * 2))
                if spaced:
                    options.append((cost, f"{x} {x}" if run > 1 else f"{x} "))
                    if run > 1:
                        options += [(cost, f"{x} "), (cost, f"{x * 2} ")]
            if not c.isalpha():
                options.append((DROP_COST * run if c in LEET else 0.0, ""))
            after: dict[str, tuple[float, tuple | None]] = {}
            for state, (cost, path) in states.items():
                for more, written in options:
                    s, total = state, cost + more
                    for x in written:
                        if x == " ":
                            total -= logp(s, "\n")
                            s = "\n\n\n"
                        else:
                            total -= logp(s, x)
                            s = s[1:] + x
                    old = after.get(s)
                    if old is None or total < old[0]:
                        after[s] = (total, (written, path))
            states = after
        path = min(((cost - (logp(s, "\n") if s != "\n\n\n" else 0.0), k, path) for k, (s, (cost, path)) in enumerate(states.items())), key=lambda x: x[:2])[2]
        read = []
        while path:
            written, path = path
            read.append(written)
        return "".join(reversed(read)).strip()


def is_leeted(unit: str, first: bool) -> bool:
    """Whether signs stand between letters, after two or more, or (in the ``first`` unit of a token) before them."""
    letter = LETTER.search(unit)
    if not letter:
        return False
    sign = SIGN.search(unit, letter.end())
    return bool(first and SIGN_FIRST.match(unit) or sign and LETTER.search(unit, sign.end()) or DIGITS_LAST.search(unit[-5:]))


def leeted(token: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Where the units of a token with letters under signs are, and where several units joined by separators are such a one."""
    parts, joined = [], []
    for m in UNIT.finditer(token):
        run, at = m[0], m.start()
        is_first = at == 0 or token[at - 1] in "\"'(["
        start = 0
        for sep in (*SEPARATORS.finditer(run), None):
            end = sep.start() if sep else len(run)
            if start < end and is_leeted(run[start:end], is_first and start == 0):
                parts.append((at + start, at + end))
            start = sep.end() if sep else end
        if SEPARATORS.search(run.strip("*._-")) and SIGN_BEFORE.search(run) and is_leeted(run, is_first):
            joined.append(m.span())
    return parts, joined


def beginnings(word: str) -> list[int]:
    """Hashes of the word and of its beginnings of three to six letters."""
    out = [zlib.crc32(word.encode("utf-8", "replace"))]
    for n in range(3, min(6, len(word)) + 1):
        out.append(zlib.crc32(word[:n].encode("utf-8", "replace"), 1))
    return out


class Restorer:
    """Finds the disguised tokens of a text, decodes them and names the features of plain and decoded words."""

    def __init__(self, model: CharModel, wanted: dict[int, object] | None = None):
        self.model, self.wanted, self.memo = model, wanted, {}

    def token(self, token: str) -> list[str]:
        """The words of one token without white space, then what it may disguise."""
        word = token.lower().rstrip(".,;:!?")
        if word.isalpha() and not THRICE.search(word):
            return [word]
        out = WORD.findall(word)
        parts, joined = ([], []) if PLAIN.fullmatch(token) else leeted(token)
        hidden = [token[a:b] for a, b in (*parts, *joined)] + [w for w in WORD.findall(token) if THRICE.search(w)]
        return out + [x for h in hidden if (x := self.model.decode(h))]

    def _keep(self, words: list[str]) -> tuple[int, ...]:
        return tuple(f for w in words for f in beginnings(w) if self.wanted is None or f in self.wanted)

    def features(self, text: str | None) -> set[int]:
        """Features of the whole text; only the wanted ones, if any are named."""
        out: set[int] = set()
        if not text:
            return out
        memo = self.memo
        if len(memo) > 400_000:
            memo.clear()
        for token in set(text.split()):
            own = memo.get(token)
            if own is None:
                own = memo[token] = self._keep(self.token(token))
            if own:
                out.update(own)
        for m in SPACED.finditer(text):
            if LETTER.search(m[0]):
                out.update(self._keep(self.model.decode(m[0], spaced=True).split()))
        return out

    def _restored(self, token: str) -> str:
        parts, joined = ([], []) if PLAIN.fullmatch(token) else leeted(token)
        spans = sorted(parts or joined)
        inside = [m.span() for m in WORD.finditer(token) if THRICE.search(m[0]) and not any(a <= m.start() < b for a, b in spans)] if THRICE.search(token) else []
        out, at = [], 0
        for a, b in sorted(spans + inside):
            out += [token[at:a], self.model.decode(token[a:b]) or token[a:b]]
            at = b
        return "".join(out) + token[at:]

    def restored_text(self, text: str) -> str:
        """The text with every disguised token replaced by its reading."""
        text = SPACED.sub(lambda m: LETTER.search(m[0]) and self.model.decode(m[0], spaced=True) or m[0], text)
        return re.sub(r"\S+", lambda m: self._restored(m[0]), text)


def fit_logistic(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_cols: int, l2: float = 0.02, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model over sets of present features, by Adam on the whole sample."""
    w, bias, n = np.zeros(n_cols), 0.0, len(y)
    m, v, mb, vb = np.zeros(n_cols), np.zeros(n_cols), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[cols], n) + bias, -30, 30)))
        error = p - y
        grad, grad_b = np.bincount(cols, error[rows], n_cols) + l2 * w, error.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b * grad_b
        rate = 0.1 / (1 - 0.9**step)
        w -= rate * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= rate * mb / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    return w, float(bias)


def thinned(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, copies: int = 2, keep: float = 0.25, seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sample with copies of its positive rows that keep a few of their features each: one clear word is enough evidence."""
    rng = np.random.default_rng(seed)
    all_rows, all_cols, all_y = [rows], [cols], [y]
    n = len(y)
    for _ in range(copies):
        own = (y[rows] == 1) & (rng.random(len(rows)) < keep)
        present, at = np.unique(rows[own], return_inverse=True)
        all_rows.append(at + n)
        all_cols.append(cols[own])
        all_y.append(np.ones(len(present)))
        n += len(present)
    return np.concatenate(all_rows), np.concatenate(all_cols), np.concatenate(all_y)


def held_out(doc_id: str = "doc_id"):
    """Rows whose label is never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, max_features: int = 2048, min_z: float = 5.0, cutoff: float = 0.7, seed: int = 11, carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    ``docs`` (doc_id, text; of further columns those in ``carry`` are returned too), ``labels`` (doc_id, toxic).
    The character model counts all words of all documents. The logistic model is
    fitted on at most ``sample_rows`` labelled rows that are not held out, chosen by
    hash; it has at most ``max_features`` word beginnings, those that tell most.

    A null or empty text has no word and scores the model's constant, which is below the sample's share of toxic rows; a null
    doc_id counts as not held out and is never learned from. Without labels of
    both kinds every score is 0. A token of any length takes time in proportion to it. Repeated rows are scored alike, each on its own.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    kinds = [(f"__c{i}", dict(docs.dtypes)[c]) for i, c in enumerate(carry)]
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), *(F.col(c).alias(k) for c, (k, _) in zip(carry, kinds, strict=True)))
    found = base.select("text").mapInArrow(_count_grams, "kind int, bucket long, n double").groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    # at most GRAM_BUCKETS + CONTEXT_BUCKETS rows, whatever the corpus
    grams, contexts = np.zeros(GRAM_BUCKETS), np.zeros(CONTEXT_BUCKETS)
    for which, out in ((0, grams), (1, contexts)):
        part = found[found.kind == which]
        out[part.bucket.to_numpy(np.int64)] = part.n.to_numpy(float)
    tables = spark.sparkContext.broadcast((grams.astype(np.float32), contexts.astype(np.float32)))

    known = (
        labels.where("toxic is not null and doc_id is not null").where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_rows)
    )
    sample = base.join(F.broadcast(known), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))  # sample_rows ids at most

    def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(CharModel(*tables.value))
        n, bad = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = restore.features(text)
                n.update(own)
                if toxic == 1:
                    bad.update(own)
        keys = [k for k in n if n[k]]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([n[k] for k in keys], pa.int64()), pa.array([bad[k] for k in keys], pa.int64())], ["feature", "n", "bad"])

    n_rows, n_bad = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    weights: dict[int, float] = {}
    bias = -np.inf
    if n_bad and n_bad < n_rows:
        rate = n_bad / n_rows
        z = (F.col("bad") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
        chosen = [
            r[0] for r in sample.mapInArrow(count_features, "feature long, n long, bad long").groupBy("feature")
            .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("bad >= 2").withColumn("z", z)
            .where(F.col("z") >= min_z).orderBy(F.desc("z"), "feature").limit(max_features).select("feature").collect()
        ]
        index = {f: i for i, f in enumerate(chosen)}

        def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restore = Restorer(CharModel(*tables.value), index)
            for batch in batches:
                rows = [sorted({index[f] for f in restore.features(t)}) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.int32()))], ["toxic", "present"])

        fitted = sample.mapInArrow(present, "toxic int, present array<int>").toPandas()  # sample_rows at most
        y = (fitted.toxic == 1).to_numpy(float)
        sizes = fitted.present.map(len).to_numpy()
        cols = np.concatenate([np.asarray(x, np.int64) for x in fitted.present]) if sizes.sum() else np.empty(0, np.int64)
        w, bias = fit_logistic(*thinned(np.repeat(np.arange(len(y)), sizes), cols, y), len(chosen))
        weights = {f: float(w[i]) for f, i in index.items()}
    model = spark.sparkContext.broadcast((weights, bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        restore = Restorer(CharModel(*tables.value), weights)
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                logit = bias + sum(weights[f] for f in sorted(restore.features(text)))
                scores.append(float(1 / (1 + np.exp(-min(max(logit, -30.0), 30.0)))) if np.isfinite(bias) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), *batch.columns[2:]], ["doc_id", "score", *batch.schema.names[2:]])

    own = [F.col(k).alias(c) for c, (k, _) in zip(carry, kinds, strict=True)]
    return base.mapInArrow(score, ", ".join([f"doc_id {kind}, score double", *(f"{k} {t}" for k, t in kinds)])).select(
        "doc_id", *own, held_out().alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"),
    )
