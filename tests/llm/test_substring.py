"""Substring dedup against brute force; the index against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from pricewise.llm import substring
from pricewise.llm.fmindex import FMIndex, repeated_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted((tuple(r) for r in substring.dedup(df, **kw).collect()), key=str)


@pytest.mark.parametrize("window", [5, 9])
def test_index_finds_all_repeated_windows(window):
    rng = np.random.default_rng(window)
    seqs = [rng.integers(1, 4, rng.integers(window, 60)) for _ in range(40)]
    s = np.concatenate([np.r_[x, 0] for x in seqs])
    length = np.array([len(x) for x in seqs])
    begin = np.cumsum(length + 1) - length - 1
    got = repeated_windows(FMIndex(s, 4), s, begin, length, window)
    count = Counter(tuple(x[i:i + window]) for x in seqs for i in range(len(x) - window + 1))
    for r, x in enumerate(seqs):
        for i in range(len(x) - window + 1):
            assert got[r, i] == (count[tuple(x[i:i + window])] > 1)


def corpus(seed=3):
    r = random.Random(seed)
    vocab = [f"w{i}é" for i in range(400)]
    passages = [[r.choice(vocab) for _ in range(r.randint(36, 150))] for _ in range(6)]
    rows = []
    for d in range(120):
        w = [r.choice(vocab) for _ in range(r.randint(0, 120))]
        if d % 2:
            p = list(r.choice(passages))
            for _ in range(r.randint(0, 2)):
                p[r.randrange(len(p))] = r.choice(vocab)
            at = r.randint(0, len(w))
            w[at:at] = p
        rows.append((d, r.choice(["  ", "\t", " ", "\n"]).join(w)))
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_finer_levels(spark):
    """So small shards that most anchors are put off, down to whole windows."""
    rows = corpus(4)
    assert run(spark, rows, shard_words=60) == brute(rows)


def test_edge_cases(spark):
    same = " ".join(f"x{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \t "), (4, "short text"), (5, same), (5, same), (6, same + " tail"), (None, same),
            (7, "a " * 5_000), (8, " ".join(f"u{i}" for i in range(60_000))), (9, "one two " + " ".join(f"u{i}" for i in range(30, 70))),
            (10, "A" * 100_000 + " b"), (11, " ".join(f"v{i}" for i in range(35))), (12, " ".join(f"v{i}" for i in range(35)))]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got, want = run(spark, rows), brute(rows)
    assert got == want and sum(r[2] for r in want) > 0
