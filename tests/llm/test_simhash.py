"""SimHash near-duplicates against a brute-force version."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from pricewise.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    label = {i: i for i in fps}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in combinations(fps, 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 3:
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return {i: find(i) for i in fps}


def result(df):
    return {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in df.collect()}


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fps = {r.doc_id: brute_fp(r.text) for r in docs.collect()}
    comp = brute_components(fps)
    assert result(simhash.cluster(docs)) == {i: (fps[i], comp[i]) for i in fps}


def test_edge_cases(spark):
    long_text = "Wort été x " * 60_000
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, "One", "c"), (5, "one", "c"), (6, "a b", "d"), (7, "A\x0bB", "d"),
            (8, long_text, "e"), (9, long_text.upper(), "e"), (9, long_text.upper(), "e"), (None, "one", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", docs_clash())
    got = simhash.cluster(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].component_id for i in (1, 2, 3)] == [1, 1, 1] and by[1].fp == 0
    assert by[4].component_id == by[5].component_id == by[None].component_id == 4
    assert by[6].component_id == by[7].component_id == 6
    for i, t, _ in rows:
        assert by[i].fp % (1 << 64) == brute_fp(t)
    kept = sorted(r.doc_id or -1 for r in simhash.keep_one(docs, simhash.cluster(docs)).collect())
    assert kept == [-1, *sorted({by[i].component_id for i in by if i})]


def docs_clash():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.cluster(docs).collect() == []


@pytest.mark.parametrize("groups", [4, 6])
def test_link_finds_all_chains(spark, groups):
    """Random fingerprints with planted chains and a dense ball; one cell is large."""
    rng = np.random.default_rng(5)
    fps = set(rng.integers(0, 1 << 63, 300).tolist())
    x = 0x0123456789ABCDEF
    ball = {x}
    for _ in range(400):
        y = x
        for b in rng.integers(0, 64, 4):
            y ^= 1 << int(b)
        ball.add(y)
    chain = [0x7000000000000001]
    for k in range(12):
        chain.append(chain[-1] ^ (7 << (3 * k + 5)))
    fps = sorted(fps | ball | set(chain))
    want = brute_components(dict(enumerate(fps)))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.link(df, groups=groups)
    from pricewise.llm.graph import connected_components
    rows = connected_components(links).collect()
    label = {r.node % (1 << 64): r.label for r in rows}
    got = {}
    for i, f in enumerate(fps):
        got.setdefault(label.get(f, ("alone", f)), []).append(i)
    expect = {}
    for i, c in want.items():
        expect.setdefault(c, []).append(i)
    assert sorted(got.values()) == sorted(expect.values())
    assert links.count() <= len(simhash.band_choices(groups)) * len(fps) * 2


def test_texts_under_one_id_are_told_apart(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red orange yellow green blue violet")
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (7, c), (7, c)], "doc_id long, text string")
    kept = simhash.keep_one(docs, simhash.cluster(docs)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (5, b), (7, c)]
