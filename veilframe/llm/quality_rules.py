"""Quality rules whose cutoffs carry a risk guarantee.

Each rule rejects a document whose feature is above a cutoff; a document goes if any
rule rejects it. A part of the labelled documents orders joint cutoffs: a path on which
one rule at a time gets stricter, in the order of what that gains. The others are the
holdout: for each stratum the verdicts along the path are tested one after the other,
and admitted while the exact binomial (Clopper-Pearson) bound of the share of good
documents that all rules together lose is at most ``alpha``. Tests in a fixed order need
no correction; over strata the error level is divided by Holm's rule: a stratum whose
whole path is admitted leaves its share to the others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import saved

BLANKS = dict.fromkeys(map(ord, "\x09\x0a\x0b\x0c\x0d"), " ")
#: Cutoffs of each rule, the loosest first; a document is rejected above the cutoff.
GRID = tuple(round(0.99 - 0.01 * i, 2) for i in range(100))
RULES = ("symbol_ratio", "repeat_ratio", "dup_line_ratio", "upper_ratio", "same_word_ratio")


def words_of(text: str) -> list[str]:
    return [w for w in text.translate(BLANKS).split(" ") if w]


def measure(text: str | None) -> tuple[int, int, int, int, int, list[float]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then the rules' features, each from 0 to 1."""
    text = text or ""
    words = words_of(text)
    n = len(words)
    word_chars = sum(map(len, words))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    dup = len(lines) - len(set(lines))
    repeated = same = 0
    if n:
        index: dict[str, int] = {}
        ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
        same = int((ids[1:] == ids[:-1]).sum())
        if n >= 3:
            size = len(index)
            pair = ids[:-2] * size + ids[1:-1]
            if size < 2_000_000:
                keys = pair * size + ids[2:]
            else:
                keys = np.unique(pair, return_inverse=True)[1] * size + ids[2:]
            _, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
            twice = counts[at] > 1
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[k:n - 2 + k] |= twice
            repeated = int(covered.sum())
    chars = max(word_chars, 1)
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    rules = [min(symbols / chars, 1.0), repeated / max(n, 1), dup / max(len(lines), 1), min(upper / chars, 1.0), same / max(n, 1)]
    return n, word_chars, symbols, dup, repeated, rules


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [measure(t) for t in batch.column(2).to_pylist()]
        cols = [pa.array([x[i] for x in found], pa.int64()) for i in range(5)]
        rules = [pa.array([x[5][i] for x in found], pa.float64()) for i in range(len(RULES))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(3), *cols, *rules],
            ["doc_id", "stratum", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *RULES],
        )


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(X <= x) of X ~ Binomial(n, p), summed in log space."""
    if x >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(x + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(v - top) for v in logs))


def order_cutoffs(features: np.ndarray, quality: np.ndarray, price: float = 5.0) -> list[tuple[int, float]]:
    """The path of (rule, cutoff): what each step adds to the cutoffs before it.

    Each time the rule and cutoff are taken that reject the most: a share of the bad
    documents not yet rejected counts 1, a share of the good ones ``price`` times as
    much against it. A large step is made of several, by tenths of the bad documents it rejects.
    """
    left, grid, path = np.ones(len(quality), bool), np.array(GRID), []
    n_good, n_bad = max(int((quality == 1).sum()), 1), max(int((quality == 0).sum()), 1)
    cutoffs = np.full(features.shape[1], np.inf)
    while True:
        best = (0.0, 0, 0)
        for rule in range(features.shape[1]):
            above = (features[left, rule, None] > grid).astype(np.int64)  # documents x cutoffs
            value = above[quality[left] == 0].sum(axis=0) / n_bad - price * above[quality[left] == 1].sum(axis=0) / n_good
            k = int(np.argmax(value))  # the loosest of equal ones
            best = max(best, (float(value[k]), -rule, -k))
        if best[0] <= 0:
            return path
        rule, k = -best[1], -best[2]
        bad = np.sort(features[left & (quality == 0), rule])[::-1]
        bad = bad[bad > grid[k]]
        steps = {k} | {int(np.argmax(grid < bad[min(len(bad) - 1, len(bad) * i // 10)])) for i in range(1, 10)}
        path += [(rule, GRID[i]) for i in sorted(steps) if i <= k and GRID[i] < cutoffs[rule]]
        cutoffs[rule] = min(cutoffs[rule], GRID[k])
        left &= features[:, rule] <= GRID[k]


def _rule_step(path: list[tuple[int, float]], rule: int) -> Column:
    """The first step, from 1 on, at which one rule rejects a row; null if none does. Cutoffs of a rule fall along the path."""
    case = F
    for step, (of, cutoff) in enumerate(path, 1):
        if of == rule:
            case = case.when(F.col(RULES[rule]) > cutoff, step)
    return F.lit(None).cast("int") if case is F else case


def rejected_at(path: list[tuple[int, float]]) -> Column:
    """The first step of the path whose rule rejects a row of the rules' features; null if none does."""
    return F.least(*(_rule_step(path, rule) for rule in range(len(RULES))))


def admitted_steps(holdout: DataFrame, n_steps: int, alpha: float, delta: float) -> DataFrame:
    """stratum, n_good, steps: how many steps of the path each stratum may use.

    ``holdout`` (stratum, step) has the good documents and the step that rejects each, null if none does.
    """
    counts = holdout.groupBy("stratum", F.coalesce("step", F.lit(n_steps + 1)).alias("step")).count()

    def test(group: pa.Table) -> pa.Table:
        at, count = group["step"].to_numpy(), group["count"].to_numpy()
        n = int(count.sum())
        lost = np.cumsum(np.bincount(at, count, n_steps + 2))[1:n_steps + 1].astype(int)
        return pa.table({"stratum": group["stratum"][:1], "n_good": pa.array([n], pa.int64()), "p": pa.array([[binomial_cdf(x, n, alpha) for x in lost.tolist()]], pa.list_(pa.float64()))})

    tested = saved(counts.groupBy("stratum").applyInArrow(test, "stratum string, n_good long, p array<double>"))  # a row for each stratum
    n_strata = tested.count()
    place = F.row_number().over(Window.orderBy(F.element_at("p", -1), "stratum"))
    passed = tested.select(F.element_at("p", -1).alias("last"), place.alias("place")).withColumn("ok", F.col("last") <= F.lit(delta) / (F.lit(n_strata + 1) - F.col("place")))
    first_failed = passed.where("not ok").agg(F.min("place")).first()[0]  # Holm: the path of least error first, until one isn't admitted whole
    level = delta / (n_strata + 1 - first_failed) if first_failed else delta
    return tested.select("stratum", "n_good", F.when(F.element_at("p", -1) <= level, n_steps).otherwise(F.size(F.filter("p", lambda p: p <= level))).alias("steps"))


def choose_cutoffs(labelled: DataFrame, alpha: float, delta: float, order_share: float = 0.2, order_rows: int = 20_000) -> tuple[list[tuple[int, float]], DataFrame]:
    """The path, and the steps of it that each stratum may use.

    ``labelled`` (digest, stratum, quality and the features) has the labelled texts that
    pass the base rule, each once: copies of a text are one trial, whichever documents they
    are, as they say nothing new. A share ``order_share`` of the texts, chosen by hash and at
    most about ``order_rows``, orders the path; all others test it.
    """
    slot = F.pmod(F.xxhash64("digest", F.lit(13)), F.lit(1 << 20))
    n = labelled.count()
    bound = int(min(order_share, order_rows / max(n, 1)) * (1 << 20))
    sample = labelled.where(slot < bound).select("quality", *RULES).toPandas()  # order_rows or so
    path = order_cutoffs(sample[list(RULES)].to_numpy(float), sample["quality"].to_numpy(int))
    holdout = labelled.where((slot >= bound) & (F.col("quality") == 1)).select("stratum", rejected_at(path).alias("step"))
    if not path:
        return path, holdout.groupBy("stratum").agg(F.count("*").alias("n_good")).withColumn("steps", F.lit(0))
    return path, admitted_steps(holdout, len(path), alpha, delta)


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The measures and verdict of every document, one row for each row of ``docs``.

    ``docs`` (doc_id, text and the stratum column; further columns are ignored),
    ``labels`` (doc_id, quality). At confidence 1 - delta, over all strata together,
    no stratum loses more than a share ``alpha`` of its good texts to the rules. Copies of a
    text, repeated rows included, are one trial in a stratum, good if any of them is labelled so.

    A null or empty text has no words and fails the base rule. A null stratum is the
    stratum "". A stratum with too few labelled good documents to prove any step of
    the path (217 distinct ones for the first of four strata, with none of them lost) keeps whatever passes
    the base rule; so do all if no cutoff gains anything or there are no labels. Repeated
    rows are measured each on its own; repeated labels of a document count once, as good
    if any says so; a null doc_id has no label. ``broken_rules`` names the rules that
    reject, and ``steps`` is the number of steps of the path that the stratum uses.
    """
    kind = dict(docs.dtypes)["doc_id"]
    base = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col("text").alias("text"), F.md5("text").alias("digest"))
    measures = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    found = saved(base.mapInArrow(_measure, f"doc_id {kind}, stratum string, digest string, {measures}, {', '.join(f'{r} double' for r in RULES)}"))
    found = found.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    trials = found.where(~F.col("base_failed")).join(known, "doc_id").groupBy("stratum", "digest")  # equal texts have equal features
    labelled = saved(trials.agg(F.max("quality").alias("quality"), *(F.max(r).alias(r) for r in RULES)))
    path, admitted = choose_cutoffs(labelled, alpha, delta)
    judged = found.join(admitted.select("stratum", "steps"), "stratum", "left").withColumn("steps", F.coalesce("steps", F.lit(0)))
    broken = F.array_compact(F.array(*(
        F.when(F.coalesce(_rule_step(path, i) <= F.col("steps"), F.lit(False)), F.lit(r)) for i, r in enumerate(RULES)
    )))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size(broken) == 0)).alias("kept"), F.array_join(broken, ",").alias("broken_rules"), "steps",
    )
