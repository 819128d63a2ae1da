"""Cross-tokenizer alignment against whole-text encoding and the definition, token by token."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from conftest import SF_SMALL
from pricewise.llm import crosstoken as CT
from pricewise.llm.common import table
from pricewise.llm.queries import op12_cross_tokenizer

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = CT.ByteTokenizer(BYTE), CT.PieceTokenizer(PIECE)


def plain_tokens(text):
    """(ids, ends) of both sides of a whole text, or None."""
    if not text:
        return None
    want = (" " + text).encode()
    out = []
    for tok, t in ((A, " " + text), (B, text)):
        ids = np.frombuffer(tok.encode([t])[0], np.uint32).tolist()
        if b"".join(tok.bytes[i] for i in ids) != want:
            return None
        out.append((ids, np.cumsum([len(tok.bytes[i]) for i in ids]).tolist()))
    return out


def plain_groups(text):
    tokens = plain_tokens(text)
    if tokens is None:
        return []
    (a, ea), (b, eb) = tokens
    groups, i, j = [], 0, 0
    for end in sorted(set(ea) & set(eb)):
        x, y = i, j
        while i < len(ea) and ea[i] <= end:
            i += 1
        while j < len(eb) and eb[j] <= end:
            j += 1
        groups.append((a[x:i], b[y:j]))
    return groups


def plain_align(docs):
    """The contract's columns of every (doc_id, text), straight from the definition."""
    all_groups = [plain_groups(t) for _, t in docs]
    links = [Counter((a, b) for ga, gb in groups for a in ga for b in gb) for groups in all_groups]
    held = Counter(p for l in links for p in l)
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, _), groups, l in zip(docs, all_groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(l.values()),
                    sum(n for p, n in l.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in l.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


HARD = ["plain words here", " lead", "trail ", "two  spaces   three", "tab\tand\nline \n next", " ", "  ", "\n", "don't we'll it's I'm 's 've", "caf\u00e9 na\u00efve \u00fcber",
        "\u4e2d\u6587 \u6c49\u5b57\uff0c\u6ca1\u6709\u7a7a\u683c", "a\u3000b \u3000 c", "x\u00a0 y \u00a0z", "nel\u0085 x", "line\u2028 sep \u2029 p", "emoji \U0001f600\U0001f680 done \U0001f468\u200d\U0001f469",
        "the <|endoftext|> and <s> </s> <unk> <0x41>", "mark \u2581 inside", "\u2581", "123 4567 89.5 1,000", "!!!! ???? ... ----", "a" * 3000, "ab " * 400, "\x00 nul \x7f x",
        "\u00a0", "e\u0301 combining \u0301 x", "\u1680 ogham \u1680x", "\u180e x\u180e y", "\u200b zero \u200bw", "\ufeffbom \ufeff x", "code:\n    if x:\n        return  1\n", "\x1c x\x1c y\x1d"]


def test_stretches_give_whole_text_ids():
    rng = np.random.default_rng(5)
    pieces = [" ", "  ", "\n", "\t", "a", "the", "don't", "\u00e9", "\u3000", "\u00a0", "\u2028", "1", "42", "!", "\u4e2d", "\U0001f600", "x ", " y", "'s", "\u0085", "\x1c"]
    texts = HARD + ["".join(rng.choice(pieces, rng.integers(1, 25))) for _ in range(1500)]
    aligner = CT.Aligner(BYTE, PIECE)
    assert aligner.b.restarts
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    counts, *_, digests = aligner.documents(np.frombuffer(b"".join(raw), np.uint8), off)
    for k, t in enumerate(texts):
        groups = plain_groups(t)
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert counts["n_groups"][k] == len(groups), repr(t)
        assert digests[k] == (hashlib.sha256(text.encode()).hexdigest() if groups else ""), repr(t)


def test_windows_are_remembered_by_id_tuples_and_cut_at_anchors():
    aligner = CT.Aligner(BYTE, PIECE)
    raw = b"go  home go home"
    aligner.documents(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert {key[0] for key in aligner.windows} >= {A.encode([" home"])[0], A.encode([" go"])[0]}
    before = len(aligner.windows)
    aligner.documents(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert len(aligner.windows) == before


DOCS = [(i, t) for i, t in enumerate(HARD)] + [(100, None), (101, ""), (102, "plain words here"), (102, "plain words here"), (None, "plain words there"), (103, "plain " * 50)]


@pytest.mark.parametrize("slices,block_bytes", [(1, 1 << 20), (4, 300)])
def test_corpus_equals_definition(spark, slices, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(slices)
    assert got(CT.align_corpus(docs, BYTE, PIECE, block_bytes=block_bytes)) == plain_align(DOCS)


def test_empty_and_all_without_tokens(spark):
    schema = "doc_id long, text string, block int, docs string"
    assert got(CT.align_corpus(spark.createDataFrame([], schema), BYTE, PIECE)) == []
    none = [(1, None, 1, "x"), (2, "", 2, None), (3, "\u2581", 3, "y")]
    assert got(CT.align_corpus(spark.createDataFrame(none, schema), BYTE, PIECE)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_small_caches_change_nothing(monkeypatch):
    texts = [t.encode() for _, t in DOCS if t]
    wide, small = CT.Aligner(BYTE, PIECE), CT.Aligner(BYTE, PIECE)
    monkeypatch.setattr(CT, "CACHED", 3)
    for t in texts:
        data, off = np.frombuffer(t, np.uint8), np.array([0, len(t)])
        assert small.documents(data, off)[-1] == wide.documents(data, off)[-1]


def test_full_caches_keep_what_was_met_again(monkeypatch):
    wide, small, learned = CT.Aligner(BYTE, PIECE), CT.Aligner(BYTE, PIECE), []
    learn = small.learn
    monkeypatch.setattr(small, "learn", lambda new: (learned.extend(new), learn(new)))
    texts = [f"often seen words stay, word{i} and other{i} go".encode() for i in range(60)]
    monkeypatch.setattr(CT, "CACHED", 40)
    for t in texts:
        data, off = np.frombuffer(t, np.uint8), np.array([0, len(t)])
        a, b = small.documents(data, off), wide.documents(data, off)
        assert a[-1] == b[-1] and {c: v.tolist() for c, v in a[0].items()} == {c: v.tolist() for c, v in b[0].items()}
        assert Counter(dict(zip(a[2].tolist(), a[3].tolist()))) == Counter(dict(zip(b[2].tolist(), b[3].tolist())))
        assert len(small.ids) <= 40 + len(t.split()) and len(small.windows) <= 40 + len(t.split())
    assert learned.count(b" often") == learned.count(b" stay,") == 1
    assert learned.count(b" word3") == 1


def test_query_equals_definition(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert got(op12_cross_tokenizer(spark, SF_SMALL)) == plain_align(docs)
