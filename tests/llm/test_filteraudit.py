"""The byte transducer, the verified hash table and the counts of all orders, against plain Python."""

import re
from itertools import permutations

import numpy as np
import pytest

from pricewise.llm import filteraudit as FA

SCHEMA = "doc_id long, text string, lang string, other string"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"words": len(words), "distinct": len(set(words)), "code_points": len(text),
            "capitals": len(re.findall("[A-Z]", text)), "symbols": len(re.findall(r"[#$%&*|]", text))}


def plain_audit(docs, labels):
    """(part, order, step) -> counts, straight from the definition."""
    rows = [(i, t or "", p or "") for i, t, p, *_ in docs]
    fails = []
    for i, t, _ in rows:
        m = plain_counts(t)
        f = set()
        if m["words"] < 100:
            f.add("A")
        if 100 * m["distinct"] < 80 * m["words"]:
            f.add("B")
        if 100 * m["capitals"] > 10 * m["code_points"]:
            f.add("C")
        if m["symbols"]:
            f.add("D")
        if any(o == t and j is not None and (i is None or j < i) for j, o, _ in rows):
            f.add("E")
        fails.append(f)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {p for *_, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, fails) if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                kept = [x for x in left if f not in x[1]]
                seen = set(order[:step - 1])
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(kept), len(gone), sum(f in s and bool(s & seen) for _, s in mine), sum(s == {f} for _, s in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def audited(spark, docs, labels, slices=1):
    d = spark.createDataFrame(docs, SCHEMA).repartition(slices)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in FA.audit(d, lab).collect()}


def slice_of(texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), off


TEXTS = ["", " ", "a", "a a", "a\n\tb A#", "é É 𝄞 ü\x0bü", "xx", "x x", "x", " lead and trail ", " a  b", "B" * 5000, "w1 w2 " * 300, "|", "ab a b ab"]


def test_scan_equals_plain_counts():
    for texts in (TEXTS, TEXTS[::-1], [""], ["a"], []):
        got = FA.scan(*slice_of(texts))
        for k, t in enumerate(texts):
            assert {n: int(v[k]) for n, v in got.items()} == plain_counts(t), t


def test_random_slices_equal_plain_counts():
    rng = np.random.default_rng(3)
    letters = list("ab AB#\n\té𝄞")
    for _ in range(60):
        texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(rng.integers(1, 30))]
        got = FA.scan(*slice_of(texts))
        for k, t in enumerate(texts):
            assert {n: int(v[k]) for n, v in got.items()} == plain_counts(t), t


def test_spans_with_one_hash_are_told_apart(monkeypatch):
    # a base of 0 hashes every span of the same first byte alike; the bytes decide
    monkeypatch.setattr(FA, "_powers", lambda base, n: np.zeros(n, np.uint64))
    got = FA.scan(*slice_of(["aa ab ac aa", "aa"]))
    assert got["distinct"].tolist() == [3, 1]


LONG = " ".join(f"w{i}" for i in range(130))
DOCS = [(1, LONG, "en", "x"), (2, LONG, "fr", "x"), (3, LONG, "en", None), (3, LONG, "en", None), (4, None, "en", "x"), (5, "", None, "x"),
        (6, "AAA " * 120, "en", "x"), (7, LONG + " $", "", "x"), (None, LONG, "en", "x"), (None, "alone", "fr", "x"), (None, "alone", "fr", "x"),
        (8, "AAA " * 120, "fr", "x"), (1, "a $ B", "en", "x"), (9, LONG + " more", "en", "x"), (10, LONG + " other", "fr", "x")]
LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (6, None, 1), (None, 1, 1), (77, 1, 1), (9, 1, None)]


@pytest.mark.parametrize("slices", [1, 5])
def test_audit_equals_definition(spark, slices):
    want = plain_audit(DOCS, LABELS)
    assert audited(spark, DOCS, LABELS, slices) == want
    assert len(want) == 3 * 600


def test_group_of_copies_in_one_part(spark):
    docs = [(i, LONG, "en", None) for i in range(40)] + [(100 + i, LONG + f" {i}", "en", None) for i in range(20)]
    got = audited(spark, docs, [(i, 1, 0) for i in range(0, 60, 2)])
    assert got["en", "EABCD", 1][:2] == [21, 39] and got["en", "ABCDE", 5][4] == 19
    assert got == plain_audit(docs, [(i, 1, 0) for i in range(0, 60, 2)])


def test_empty_tables_and_clashing_columns(spark):
    assert audited(spark, [], LABELS) == {}
    docs = spark.createDataFrame([(1, "a", "en", 5, 6)], "doc_id long, text string, lang string, fails int, digest int").withColumnRenamed("fails", "n")
    got = FA.audit(docs).where("filter_order = 'ABCDE'").orderBy("step").collect()
    assert [r.removed for r in got] == [1, 0, 0, 0, 0] and got[0].shapley == 120


def test_thresholds_are_parameters(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "")], SCHEMA)
    assert FA.measure(docs, min_words=3).first().fails == 0
    assert FA.measure(docs, min_words=4).first().fails == 1
