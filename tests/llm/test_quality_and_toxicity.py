import math
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veilframe.llm import quality_resampling as qr
from veilframe.llm import quality_rules as rules
from veilframe.llm import toxicity_channel as tox

SF = "/root/testdata/sf0.01"
EDGES = "doc_id long, text string, lang string, good string, score double, bucket int"
ODD = [(1, None, None, "x", 1.0, 1), (2, "", "en", "x", 1.0, 1), (3, " \n\t", "en", "x", 1.0, 1), (4, "word " * 60_000, "de", "x", 1.0, 1), (5, "a b c", "en", "x", 1.0, 1), (5, "a b c", "en", "x", 1.0, 1), (None, "no id", "en", "x", 1.0, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, EDGES)


def test_top_k_threshold_is_exact(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=5000) * 10, np.full(50, 3.25)])
    df = spark.createDataFrame(pd.DataFrame({"key": values}))
    for k in (1, 17, 1300, 2500, 4999, len(values), len(values) + 5):
        assert qr.top_k_threshold(df, "key", k, bins=16) == np.sort(values)[::-1][min(k, len(values)) - 1]
    assert qr.top_k_threshold(df, "key", 0) == math.inf
    assert qr.top_k_threshold(df.limit(0), "key", 3) == math.inf


def test_resampling_equals_brute_force(docs, labels):
    got = qr.judge(docs, labels).toPandas().set_index("doc_id")
    texts, good = docs.toPandas().set_index("doc_id").text, set(labels.where("quality = 1").toPandas().doc_id)
    raw, target = np.zeros(qr.BUCKETS, np.int64), np.zeros(qr.BUCKETS, np.int64)
    for i, t in texts.items():
        ids = qr.features(t)
        np.add.at(raw, ids, 1)
        if i in good:
            np.add.at(target, ids, 1)
    table = qr.log_ratios(raw, target)
    weights = texts.map(lambda t: table[qr.features(t)].sum())
    assert np.allclose(got.log_weight, weights.reindex(got.index))
    known = labels.toPandas()
    k = round(np.minimum(1, np.exp(np.minimum(weights, 50)) * (known.quality == 1).mean()).sum())
    assert set(got.index[got.kept]) == set(got.sample_key.nlargest(k).index)
    found = known.merge(got, left_on="doc_id", right_index=True)
    assert found[found.quality == 1].kept.mean() > 0.98 and found[found.quality == 0].kept.mean() < 0.05


def test_resampling_of_odd_rows(spark, odd, labels):
    got = qr.judge(odd, labels.limit(0)).toPandas()
    assert len(got) == len(ODD) and got.kept.all()
    assert set(qr.judge(odd, spark.createDataFrame([(5, 1), (4, 0)], "doc_id long, quality int")).columns) == {"doc_id", "log_weight", "sample_key", "kept"}
    assert qr.resample(odd.limit(0), labels).count() == 0


@pytest.fixture(scope="module")
def model():
    words = ["idiot", "stupid", "loser", "moron"] * 20 + "the theory of that other thing is in the outer line and stop".split() * 50
    batches = [__import__("pyarrow").RecordBatch.from_arrays([__import__("pyarrow").array([" ".join(words)])], ["t"])]
    grams, contexts = np.zeros(tox.GRAM_BUCKETS), np.zeros(tox.CONTEXT_BUCKETS)
    for batch, out in zip(tox._count_grams(iter(batches)), (grams, contexts), strict=True):
        out[batch.column(1).to_numpy()] = batch.column(2).to_numpy()
    return tox.CharModel(grams, contexts)


@pytest.mark.parametrize(("shown", "word"), [
    ("1d10t", "idiot"), ("$tupid", "stupid"), ("l0s3r", "loser"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("idiooooot", "idiot"), ("l-o-s-e-r", "loser"),
])
def test_disguises_are_decoded(model, shown, word):
    text = f"the other {shown} of that"
    assert word in tox.Restorer(model).restored_text(text).split()
    features = tox.Restorer(model).features(text)
    assert set(tox.beginnings(word)) <= features


def test_viterbi_equals_brute_force(model):
    from itertools import product

    def best(token):
        options = [[(0.0, c), ] if c.isalpha() else [(tox.SIGN_COST, x) for x in tox.LEET[c]] + [(tox.DROP_COST, "")] for c in token]
        found = []
        for path in product(*options):
            text, cost, state = "".join(x for _, x in path), sum(c for c, _ in path), "\n\n\n"
            for x in text + "\n":
                cost -= model.logp(state, x)
                state = state[1:] + x
            found.append((cost, text))
        return min(found)

    for token in ("1d10t", "l0s3r", "th3ory", "0f", "1n", "5t0p"):
        cost, text = best(token)
        assert model.decode(token) == text


@pytest.mark.parametrize(("shown", "words"), [
    ("such a m o r o n", ["moron"]), ("s t u p i d  l o s e r", ["stupid", "loser"]), ("s t u p i d i d i o t", ["stupid", "idiot"]), ("i\td\ni\to\nt", ["idiot"]),
    ("l-0-s-3-r", ["loser"]), ("stup_1d", ["stupid"]), ("m o o o r r r o n", ["moron"]),
])
def test_words_among_spaced_letters_are_found(model, shown, words):
    text = f"the other {shown}, of that"
    features, restored = tox.Restorer(model).features(text), tox.Restorer(model).restored_text(text)
    for word in words:
        assert set(tox.beginnings(word)) <= features and word in tox.WORD.findall(restored)


@pytest.mark.parametrize("token", [
    "1" + "a" * 1_000_000, "1" + "ab" * 100_000, "a-" * 300_000, "a1" * 50_000, "." * 800_000 + "x", "1 2 " * 200_000 + "12x", "1 a " * 10_000 + "12x", "-" * 900_000, "ab9" * 40_000 + "!",
])
def test_one_very_long_token_takes_linear_time(model, token):
    import time

    start = time.process_time()
    tox.Restorer(model).features(token)
    assert time.process_time() - start < 30


def test_three_spaced_letters_and_no_labels(spark, docs):
    assert tox.SPACED.search("an a s s there") and not tox.SPACED.search("it is a b") and not tox.SPACED.search("1 2 33")
    assert set(tox.score_toxicity(docs.limit(5), spark.createDataFrame([], "doc_id long, toxic int")).toPandas().score) == {0.0}


def test_plain_words_are_left_alone(model):
    text = "The theory, of that other thing! is 1999 in line 12."
    assert tox.Restorer(model).restored_text(text) == text


def test_toxicity(docs, labels):
    got = tox.score_toxicity(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7).astype(int)).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    tp = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert tp / max((held.predicted == 1).sum(), 1) > 0.9 and tp / (held.toxic == 1).sum() > 0.7


def test_held_out_labels_teach_nothing(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    a, b = (tox.score_toxicity(docs, x).toPandas().set_index("doc_id").score.sort_index() for x in (labels, flipped))
    assert np.allclose(a, b)


def test_toxicity_of_odd_rows(spark, odd, labels):
    got = tox.score_toxicity(odd, labels).toPandas()
    assert len(got) == len(ODD) and not got.score.isna().any()
    assert (tox.score_toxicity(odd, labels.limit(0)).toPandas().score < 0.01).all()
    assert tox.score_toxicity(odd.limit(0), labels).count() == 0


def naive(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in (i, i + 1, i + 2)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if line.strip("\x20\x09\x0a\x0b\x0c\x0d"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_measures(docs):
    texts = [t for t in docs.limit(120).toPandas().text if len(t) < 6000] + ["a b c a b c", "x\nx\n \n \nx", "a b # $", "a a a a", "", "\x1c a"]
    for t in texts:
        assert rules.measure(t)[:5] == naive(t)


def test_binomial_bound():
    from fractions import Fraction

    for x, n, p in ((0, 10, 0.1), (3, 50, 0.1), (7, 200, 0.05), (10, 10, 0.4)):
        exact = float(sum(Fraction(math.comb(n, i)) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(x + 1)))
        assert math.isclose(rules.binomial_cdf(x, n, p), min(exact, 1.0), rel_tol=1e-9)


def holm_steps(p, delta):
    """Steps of each stratum by the rule as stated: test every chain at its share; whoever is through leaves its share."""
    done, level = set(), delta / len(p)
    while True:
        level = delta / max(len(p) - len(done), 1)
        more = {k for k, v in p.items() if k not in done and all(x <= level for x in v)}
        if not more:
            break
        done.add(min(more, key=lambda k: (p[k][-1], k)))
    out = {}
    for k, v in p.items():
        out[k] = len(v) if k in done else next((i for i, x in enumerate(v) if x > level), len(v))
    return out


def test_steps_equal_brute_force(spark):
    from fractions import Fraction

    def cdf(x, n, p):
        return float(sum(Fraction(math.comb(n, i)) * p**i * (1 - p) ** (n - i) for i in range(x + 1)))

    rng = np.random.default_rng(4)
    for trial in range(3):
        strata = {f"s{k}": rng.integers(1, 9, int(rng.integers(60, 900))) for k in range(5)}
        strata = {k: [None if x > 6 or rng.random() < 0.97 else int(x) for x in v] for k, v in strata.items()}
        df = spark.createDataFrame([(k, x) for k, v in strata.items() for x in v], "stratum string, step int")
        want = holm_steps({k: [cdf(sum(x is not None and x <= t for x in v), len(v), Fraction(1, 50)) for t in range(1, 7)] for k, v in strata.items()}, 0.05)
        assert {r.stratum: r.steps for r in rules.admitted_steps(df, 6, 0.02, 0.05).collect()} == want, trial


def test_the_risk_bound_holds_in_simulation():
    """True losses of the path's steps straddle alpha in every stratum; a step beyond alpha is admitted in at most a share delta of the draws."""
    rng, alpha, delta = np.random.default_rng(6), 0.02, 0.05
    risks = np.array([0.001, 0.004, 0.012, 0.0201, 0.024, 0.05])
    sizes, wrong, useful = (300, 700, 2500, 1200), 0, 0
    for _ in range(1500):
        p = {}
        for k, n in enumerate(sizes):
            lost = np.cumsum(rng.multinomial(n, [*np.diff(risks, prepend=0), 1 - risks[-1]])[:-1])
            p[k] = [rules.binomial_cdf(int(x), n, alpha) for x in lost]
        steps = holm_steps(p, delta)
        wrong += any(s > 3 for s in steps.values())
        useful += steps[2] >= 2
    assert wrong / 1500 <= delta and useful / 1500 > 0.9


def test_path_is_the_best_step_by_step():
    rng = np.random.default_rng(2)
    quality = (rng.random(400) < 0.7).astype(int)
    x = rng.random((400, 3)) * np.where(quality == 1, 0.4, 0.8)[:, None]
    path = rules.order_cutoffs(x, quality, price=5.0)

    def value(rejected):
        return rejected[quality == 0].mean() - 5.0 * rejected[quality == 1].mean()

    first = max((value(x[:, r] > c), -r, c) for r in range(3) for c in rules.GRID)
    firsts = [c for r, c in path if r == -first[1]]
    assert path[0][0] == -first[1] and first[2] in firsts
    gone, values = np.zeros(400, bool), []
    for rule, cutoff in path:
        gone |= x[:, rule] > cutoff
        values.append(value(gone))
    assert values[-1] == max(values) > 0.5
    assert max(value(gone | (x[:, r] > c)) for r in range(3) for c in rules.GRID) <= values[-1] + 1e-12
    assert rules.order_cutoffs(x, np.ones(400, int)) == [] and rules.order_cutoffs(x[:0], quality[:0]) == []


def test_false_rejection_is_limited(spark):
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = rules.apply_rules(big, labels)
    got = judged.join(labels, "doc_id").join(big.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == labels.count() and judged.count() == big.count()
    for _, own in got[~got.base_failed].groupby("lang"):  # the method decides in every stratum
        assert own[own.quality == 1].kept.mean() >= 0.98 and own[own.quality == 0].kept.mean() < 0.1 and (own.steps > 0).all()
    assert (got.base_failed == ((got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words))).all() and not (got.kept & got.base_failed).any()
    assert ((got.broken_rules == "") == (got.kept | got.base_failed))[~got.base_failed].all()


def test_rules_of_odd_rows(spark, odd, labels):
    got = rules.apply_rules(odd, labels).toPandas()
    assert len(got) == len(ODD) and got[got.doc_id == 1].n_words.tolist() == [0] and not got.kept.any()
    assert rules.apply_rules(odd, labels.limit(0)).count() == len(ODD)
    assert rules.apply_rules(odd.limit(0), labels).count() == 0


def test_copies_of_the_table_prove_nothing_more(spark, docs, labels):
    own = docs.select("doc_id", "text", "lang").toPandas()
    known = labels.toPandas()
    once = rules.apply_rules(docs, labels).toPandas()
    again = pd.concat([own.assign(doc_id=own.doc_id + k * 1_000_000) for k in range(5)] + [own])
    known = pd.concat([known.assign(doc_id=known.doc_id + k * 1_000_000) for k in range(5)])
    got = rules.apply_rules(spark.createDataFrame(again), spark.createDataFrame(known)).toPandas()
    steps = once.set_index("doc_id").steps.to_dict()
    assert {int(i): n for i, n in zip(got.doc_id, got.steps, strict=True) if i in steps} == steps and len(got) == len(again)
