"""Language filter: held-out accuracy, exact trigram counts, edge cases."""

from collections import Counter

import numpy as np

from pricewise.llm import langid

DOCS = "/root/testdata/sf0.01/documents.parquet"


def trigrams(text):
    codes = ["" if not c.isalpha() else c for c in text.lower()]
    codes = ["", *codes, ""]
    return [(codes[i - 1], codes[i], codes[i + 1]) for i in range(1, len(codes) - 1) if codes[i]]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS).withColumn("held_out", langid.held_out(langid.F.col("doc_id")))
    model = langid.learn(docs.where("not held_out"))
    rows = langid.predict(docs, model, columns=["doc_id", "lang", "held_out"]).collect()
    out = [r for r in rows if r.held_out]
    assert 200 < len(out) < 300 and len(rows) == docs.count()
    assert np.mean([r.lang == r.lang_pred for r in out]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_and_decision_against_brute_force(spark):
    rows = [(1, "Élan été; x2y ÉT\té", "fr"), (2, "the then\nthe", "en"), (3, "the", None), (4, "été", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {(r.lang, r.gram): r.n for r in langid.trigram_counts(docs).collect()}
    want = Counter((lang, sum(ord(c or "\0") << s for c, s in zip(g, (42, 21, 0)))) for _, t, lang in rows if lang for g in trigrams(t))
    assert got == dict(want)
    model = langid.learn(docs)
    total = {lang: sum(n for (x, _), n in want.items() if x == lang) for lang in ("fr", "en")}
    rate = {k: n / total[k[0]] for k, n in want.items()}
    top = {g: max(v for (_, x), v in rate.items() if x == g) for _, g in want}
    member = {k for k, v in rate.items() if v >= langid.SHARE * top[k[1]]}
    for r in langid.predict(docs, model).collect():
        grams = [sum(ord(c or "\0") << s for c, s in zip(g, (42, 21, 0))) for g in trigrams(r.text)]
        hits = {lang: sum((lang, g) in member for g in grams) for lang in model.languages}
        assert hits[r.lang_pred] == max(hits.values())
        assert abs(r.score - hits[r.lang_pred] / len(grams)) < 0.01


def test_false_positives_are_corrected():
    model = langid.LanguageFilter(["a", "b"], np.zeros((1, langid.MIN_SLOTS), np.uint64), np.array([0.5, 0.0]), "k")
    best, score = langid.decide(np.array([[100, 55, 30], [100, 100, 30], [0, 0, 0]]), model)
    assert best.tolist() == [1, 0, -1] and np.allclose(score, [0.3, 1.0, 0.0])


def test_edge_cases(spark):
    long_text = "the thing that " * 40_000
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 ... !?", "en"), (4, long_text, "en"), (5, "the that", None), (5, "the that", None), (None, "İı the", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", langid.F.lit("clash"))
    out = langid.predict(docs, langid.learn(docs)).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (r.lang_pred, r.score > 0) for r in out} == {1: ("und", False), 2: ("und", False), 3: ("und", False), 4: ("en", True), 5: ("en", True), None: ("en", True)}
    held = docs.select(langid.held_out(langid.F.col("doc_id")).alias("h")).collect()
    assert all(r.h is not None for r in held)


def test_many_languages_and_none(spark):
    rows = [(i, chr(0x4E00 + 3 * i) * 3, f"l{i:03d}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model.planes.shape[0] == 3
    assert all(r.lang == r.lang_pred for r in langid.predict(docs, model).collect())
    bare = docs.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict(bare, langid.learn(bare)).collect()} == {"und"}
    empty = docs.limit(0)
    assert langid.predict(empty, langid.learn(empty)).collect() == []


def test_slots_follow_the_counts(spark):
    assert langid.slots_for(0) == langid.slots_for(langid.MIN_SLOTS // 8) == langid.MIN_SLOTS
    assert langid.slots_for(3_000_000) == 1 << 25
    import pytest
    with pytest.raises(ValueError, match="MAX_SLOTS"):
        langid.slots_for(20_000_000)
    # three letters each of a wide alphabet: many trigrams in one language, the rate stays low
    rows = [(i, "".join(chr(0x4E00 + (i * 7919 + k * k * 31) % 20_000) for k in range(400)), "zh" if i % 2 else "en") for i in range(400)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.planes.shape[1] > langid.MIN_SLOTS and max(model.false_rate) < 0.05
