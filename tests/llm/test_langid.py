import numpy as np
from pyspark.sql import functions as F

from palimpsest.llm import langid
from palimpsest.llm.langid import UNDEFINED, fit, held_out, identify, keep_identified, label, op4_language_id, viterbi


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    begins, scores = [0], []
    for _ in range(100):
        n = int(rng.integers(0, 30))
        scores.append(rng.normal(size=(n, 4)) * 5)
        begins.append(begins[-1] + n)
    path = viterbi(np.concatenate(scores), np.array(begins), 8.0)
    for s, a, b in zip(scores, begins, begins[1:]):
        if not len(s):
            continue
        v = s[0]
        for row in s[1:]:
            v = (v[:, None] - 8.0 * (1 - np.eye(4))).max(0) + row
        p = path[a:b]
        assert abs(s[np.arange(len(s)), p].sum() - 8.0 * (np.diff(p) != 0).sum() - v.max()) < 1e-9


def test_held_out_accuracy(spark, medium):
    got = op4_language_id(spark, medium)
    joined = got.join(spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(joined) == 1000 and all(0 <= r.score <= 1 for r in joined)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in joined)
    held = [r for r in joined if r.held_out]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.99


def test_shortcut_gives_viterbis_path(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    model = fit(docs)
    texts = [r.text for r in docs.where("length(text) < 3000").limit(150).collect()]
    mixed = [a[:300] + " " + b[-300:] for a, b in zip(texts, texts[1:])]
    fast = label(model, texts + mixed)
    w = langid.words_of(texts + mixed)
    scores = sum(np.add.reduceat(model.scores[k][g], w.bounds[k], axis=0) for k, g in enumerate(w.grams)).astype(float)
    allowed = model.scripts[w.script]
    scores = np.where(allowed, scores, scores.min(1, keepdims=True) - 2 * langid.SWITCH)
    scores[~allowed.any(1)] = 0
    begins = np.searchsorted(w.text, np.arange(len(texts + mixed) + 1))
    path = viterbi(scores, begins)
    for k, spans in enumerate(fast[2]):
        got = [p for a, b, p in spans for _ in range(int(((w.begin - w.base[k] >= a) & (w.begin - w.base[k] < b) & (w.text == k)).sum()))]
        s = scores[begins[k] : begins[k + 1]]
        value = lambda p: s[np.arange(len(p)), p].sum() - langid.SWITCH * (np.diff(p) != 0).sum()
        assert abs(value(np.array(got, int)) - value(path[begins[k] : begins[k + 1]])) < 1e-6


def test_two_short_runs_and_a_compromise():
    """No run gains more than the penalty over the compromise language c, but a and b together do."""
    w = langid.words_of(["abc xyz"])
    at = w.grams[0][w.bounds[0]]
    scores = np.zeros((len(langid.ORDERS), langid.BUCKETS, 3), np.float32)
    scores[0][at[0]], scores[0][at[1]] = (0, -20, -5), (-20, 0, -5)
    model = langid.Model(["a", "b", "c"], scores, np.ones((len(langid.SCRIPTS) + 1, 3), bool))
    assert at[0] != at[1] and label(model, ["abc xyz"])[2] == [[(0, 3, 0), (4, 7, 1)]]


def test_shortcut_on_short_texts():
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + k) for k in rng.integers(0, 26, 4)) for _ in range(60)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 7))) for _ in range(3000)]
    model = langid.Model(["a", "b", "c", "d"], (rng.normal(size=(len(langid.ORDERS), langid.BUCKETS, 4)) * 2).astype(np.float32), np.ones((len(langid.SCRIPTS) + 1, 4), bool))
    w = langid.words_of(texts)
    scores = sum(np.add.reduceat(model.scores[k][g], w.bounds[k], axis=0) for k, g in enumerate(w.grams)).astype(float)
    begins = np.searchsorted(w.text, np.arange(len(texts) + 1))
    path = viterbi(scores, begins)
    value = lambda s, p: s[np.arange(len(p)), p].sum() - langid.SWITCH * (np.diff(p) != 0).sum()
    for k, spans in enumerate(label(model, texts)[2]):
        s, places = scores[begins[k] : begins[k + 1]], w.begin[begins[k] : begins[k + 1]] - w.base[k]
        got = np.array([next(p for a, b, p in spans if a <= x < b) for x in places])
        assert abs(value(s, got) - value(s, path[begins[k] : begins[k + 1]])) < 1e-6


def test_spans_of_mixed_texts(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    model = fit(docs)
    one = {lang: docs.where((F.col("lang") == lang) & (F.length("text") > 2000)).orderBy("doc_id").first().text[:1500] for lang in ("en", "de")}
    langs, scores, spans = label(model, [one["en"] + " " + one["de"], one["en"]])
    found = [(model.languages[p], b - a) for a, b, p in spans[0]]
    assert sum(n for lang, n in found if lang == "en") > 1300 and sum(n for lang, n in found if lang == "de") > 1300
    assert found[0][0] == "en" and found[-1][0] == "de" and scores[0] < 0.7 and langs[1] == "en"


def test_odd_rows(spark, odd, nothing):
    model = fit(odd.where(~held_out(F.col("doc_id"))))
    rows = identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert 0 <= r.score <= 1 and (r.lang_pred == UNDEFINED) == (not r.spans)
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, 6, 7)} == {UNDEFINED}
    assert keep_identified(odd, model).columns == odd.columns
    assert identify(nothing, model).count() == 0
    empty = fit(nothing)
    assert empty.languages == [] and {r.lang_pred for r in identify(odd, empty).collect()} == {UNDEFINED}


def test_fitting_takes_a_bounded_sample(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    a, b = fit(docs, train_rows=30), fit(docs, train_rows=30)
    assert a.languages == ["de", "en", "es", "fr"] and np.array_equal(a.scores, b.scores)
