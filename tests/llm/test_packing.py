"""Packing: exact tokens, gapless places, and close to the least number of sequences."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from pricewise.llm import packing

PATH = "/opt/tokenizers/word_bpe_49k.json"


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_hold_the_tokenizers_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = ["<|endoftext|> a", "don't, x.. I'VE", "İstanbul ΑΣ. été!", "K ſ ß ẞ ÅÉ?! ..", "日本語。テ ", "x\x85y z k \x1c q", "a<|endoftext|>,"]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(odd, 10_000)), "doc_id long, text string"))
    tok = Tokenizer.from_file(PATH)
    got = {}
    for r in packing.token_pieces(docs, PATH, 256).collect():
        assert r.start == 256 * r.piece and r.length == len(r.ids) // 4 <= 256
        got.setdefault(r.doc_id, {})[r.piece] = bytes(r.ids)
    for r in docs.collect():
        want = [*tok.encode(r.text, add_special_tokens=False).ids, 0]
        assert np.frombuffer(b"".join(got[r.doc_id][k] for k in range(len(got[r.doc_id]))), "<u4").tolist() == want


def test_edge_cases_and_places(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "word " * 120_000, 3), (4, "same", 4), (4, "same", 4), (None, "same", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    placed = packing.pack(packing.token_pieces(docs, PATH).withColumn("offset", packing.F.lit("clash")), ["doc_id", "piece"])
    out = placed.collect()
    check(out, packing.CAPACITY)
    assert sorted((r.doc_id or 0, r.length) for r in out if r.doc_id != 3) == [(0, 2), (1, 1), (2, 1), (4, 2), (4, 2)]
    assert sum(r.length for r in out if r.doc_id == 3) == 120_001
    whole = packing.sequences(placed).collect()
    assert all(len(r.ids) == 4 * r.length <= 4 * packing.CAPACITY for r in whole)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.token_pieces(docs, PATH), ["doc_id", "piece"]).collect() == []


@pytest.mark.parametrize("seed", [0, 1])
def test_few_sequences(seed):
    lengths = np.random.default_rng(seed).integers(1, 2049, 5_000)
    seq, offset = packing.sum_of_squares(np.sort(lengths)[::-1], 2048)
    assert seq.max() + 1 <= 1.02 * max(lengths.sum() / 2048, (lengths > 1024).sum())


def test_rule_picks_the_least_sum_of_squares():
    """Every step against a plain evaluation of the whole sum."""
    capacity, lengths = 20, [13, 13, 12, 9, 8, 7, 7, 6, 5, 5, 4, 3, 3, 2, 2, 1, 1, 1]
    seq, offset = packing.sum_of_squares(np.array(lengths), capacity)
    fill = {}
    for s, b, o in zip(lengths, seq, offset):
        def total(f):
            gaps = [capacity - x for x in f.values() if x < capacity]
            return sum(gaps.count(g) ** 2 for g in set(gaps))
        options = {k: total({**fill, k: v + s}) for k, v in fill.items() if v + s <= capacity}
        assert fill.get(b, 0) == o
        if options:
            assert b in options and options[b] == min(options.values())
        else:
            assert b not in fill
        fill[b] = o + s
