import numpy as np
from conftest import as_files
from pyspark.sql import functions as F

from datashelf.llm import language as L


def model(k=3, seed=0):
    rng = np.random.default_rng(seed)
    out = L.Crf([f"l{i}" for i in range(k)])
    out.transitions = rng.normal(size=(k, k))
    return out


def marginals(scores, transitions):
    """Word by word, in plain forward-backward."""
    n, k = scores.shape
    e, t = np.exp(scores), np.exp(transitions)
    ahead, behind = np.zeros((n, k)), np.ones((n, k))
    v = np.ones(k)
    for i in range(n):
        v = (v @ t) * e[i]
        v = ahead[i] = v / v.sum()
    for i in range(n - 2, -1, -1):
        behind[i] = t @ (e[i + 1] * behind[i + 1])
        behind[i] /= behind[i].sum()
    out = ahead * behind
    return out / out.sum(1, keepdims=True)


def test_chunked_forward_backward_equals_the_plain_one():
    rng, m = np.random.default_rng(4), model()
    sizes = np.array([1, 31, 32, 33, 200, 2, 64])
    scores = rng.normal(size=(sizes.sum(), 3)) * 3
    got = L.label_sums(scores, sizes, m.transitions)
    at = 0
    for row, n in zip(got, sizes):
        assert np.allclose(row, marginals(scores[at : at + n], m.transitions).sum(0))
        at += n


def test_training_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    scores, t = rng.normal(size=(2, 6, 3)), rng.normal(size=(3, 3))
    marginal, pairs = L._expectations(scores, t)
    for i in range(2):
        assert np.allclose(marginal[i], marginals(scores[i], t))
    total = lambda s, u: sum(_log_sum(s[i], u) for i in range(2))
    step = 1e-5
    for a in range(3):
        for b in range(3):
            moved = t.copy()
            moved[a, b] += step
            assert abs((total(scores, moved) - total(scores, t)) / step - pairs[a, b]) < 1e-3


def _log_sum(scores, t):
    """Log of the sum over all label paths; the first word's start is left to every label alike, as in the model."""
    v = np.log(np.exp(t).sum(0)) + scores[0]
    for s in scores[1:]:
        v = np.log(np.exp(v[:, None] + t).sum(0)) + s
    return np.log(np.exp(v).sum())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.predict_language(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    held = found.filter("held_out and n_chars >= 40").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert held["n"] > 150 and held["a"] >= 0.97
    wrong = found.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)).count()
    assert wrong == 0 and found.filter("score < 0 or score > 1").count() == 0


def test_words_of_switched_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fitted = L.fit(docs)
    rows = {r["lang"]: r["text"] for r in docs.filter("lang in ('en', 'de') and n_chars > 900 and n_chars < 3000").orderBy("doc_id").collect()}
    english, german = (L.LETTERS.findall(rows[x].lower())[:60] for x in ("en", "de"))
    words = english + german + english
    with np.errstate(over="ignore"):
        best = marginals(L.emissions(words, fitted), fitted.transitions).argmax(1)
    want = [fitted.labels.index(x) for x in ["en"] * len(english) + ["de"] * len(german) + ["en"] * len(english)]
    assert np.mean(best == want) > 0.9
    assert (np.diag(fitted.transitions) > fitted.transitions.mean(1)).all()


def test_odd_rows(odd_docs, odd_rows, no_docs):
    got = L.predict_language(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3, 7))
    assert by_id[None]["held_out"] and by_id[4]["lang_pred"] in ("en", "de", "fr")
    assert L.predict_language(no_docs).count() == 0


def test_without_labels_nothing_is_known(odd_docs):
    bare = as_files(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in L.predict_language(bare).collect()} == {("und", 0.0)}


def test_prediction_sees_only_the_text(odd_docs):
    fitted = L.fit(odd_docs)
    other = as_files(odd_docs.withColumns({"lang": F.lit("zz"), "source": F.lit("s9")}))
    a, b = (sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in L.predict_language(d, fitted).collect()), key=str) for d in (odd_docs, other))
    assert a == b


def test_signs_of_numbers_are_no_letters(spark):
    assert L.words_of("² ½ ① Ⅷ 12 _") == [] and L.words_of("A²b été x_1") == ["a", "b", "été", "x"]
