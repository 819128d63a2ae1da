"""The pipeline on the given small table against brute-force versions of its stages."""

import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline as P  # noqa: E402
from pricewise.llm import langid, linededup  # noqa: E402
from pricewise.llm.queries import word_tokenizer  # noqa: E402
from test_simhash import brute_components, brute_fp  # noqa: E402

DATA = "/root/testdata/sf0.01"


def brute_lines(rows):
    pages = Counter(r.source for r in rows)
    seen = Counter((r.source, x) for r in rows for x in {x.strip(" \t\r") for x in (r.text or "").split("\n")} if x)
    drop = {k for k, n in seen.items() if n >= linededup.MIN_PAGES and n > linededup.RATIO * pages[k[0]]}
    return {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" \t\r")) not in drop) for r in rows}


def brute_language(rows):
    """Ids kept, by trigram shares learned from labelled texts of the other half."""
    def grams(text):
        codes = ["", *("" if not c.isalpha() else c for c in text.lower()), ""]
        return [(codes[i - 1], codes[i], codes[i + 1]) for i in range(1, len(codes) - 1) if codes[i]]

    half = {r.doc_id: zlib.crc32((r.text or "").encode()) % 2 for r in rows}
    own = {r.doc_id: grams(r.text or "") for r in rows}
    kept = set()
    for k in (0, 1):
        seen = {}
        for r in rows:
            if half[r.doc_id] != k and r.lang is not None:
                seen.setdefault(r.lang, Counter()).update(own[r.doc_id])
        total = {lang: sum(c.values()) for lang, c in seen.items()}
        top = {g: max(c[g] / total[lang] for lang, c in seen.items()) for g in set().union(*seen.values())}
        member = {lang: {g for g, n in c.items() if n / total[lang] >= langid.SHARE * top[g]} for lang, c in seen.items()}
        for r in rows:
            g = own[r.doc_id]
            if half[r.doc_id] == k and g:
                share = {lang: sum(x in m for x in g) / len(g) for lang, m in member.items()}
                best = max(share, key=share.get)
                if share[best] >= P.FLOOR and (r.lang in (None, best) or share[best] < P.CONFIDENT):
                    kept.add(r.doc_id)
    return kept


STRANGE = ["Litwo Ojczyzno moja ty jestes jak zdrowie ile cie trzeba cenic ten tylko sie dowie kto cie stracil dzis pieknosc twa", "\u4e2d\u6587\u6587\u672c\u5728\u8fd9\u91cc\u6ca1\u6709\u7a7a\u683c",
           "xqzjv wkqpz vvxjq zzkwq pqxzj kjwqx qqzvk xwzjp jqkxv", "\u0421\u044a\u0435\u0448\u044c \u0435\u0449\u0451 \u044d\u0442\u0438\u0445 \u043c\u044f\u0433\u043a\u0438\u0445 \u0431\u0443\u043b\u043e\u043a"]


def test_language_rejects_what_is_in_no_learned_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    added = [(10_000 + i, t, "en" if i % 2 else None, "src0", len(t)) for i, t in enumerate(STRANGE)] + [(20_000, docs.where("lang = 'en'").first().text, None, None, None)]
    out = P.language(spark, docs.unionByName(spark.createDataFrame(added, docs.schema)), DATA)
    assert [r.doc_id for r in out.where("doc_id >= 10000").collect()] == [20_000]
    assert out.where("doc_id < 10000").count() >= 0.985 * docs.count()


def plain(text):
    return " ".join(w.lower().strip(".,;:!?") for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs.collect()
    out = P.language(spark, docs, DATA)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == brute_language(before)

    lines = P.lines(spark, docs, DATA).collect()
    want = brute_lines(before)
    assert {r.doc_id: r.text for r in lines} == want and all(r.n_chars == len(r.text) for r in lines)
    assert any(want[r.doc_id] != r.text for r in before)

    few = docs.where("doc_id < 300")
    comp = brute_components({r.doc_id: brute_fp(r.text) for r in few.collect()})
    kept = P.near_dedup(spark, few, DATA)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comp.values())) and kept.columns == docs.columns

    items = [plain(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = P.decontamination(spark, docs, DATA)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in before if not any(i in plain(r.text) for i in items)}
    assert clean.columns == docs.columns

    tok = Tokenizer.from_file(word_tokenizer())
    placed = P.pack(spark, few, DATA).collect()
    size = Counter()
    for r in placed:
        size[r.doc_id] += r.length
    assert size == {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in few.collect()}


def test_run_applies_all_stages(spark):
    out = P.run(spark, DATA)
    ids = {r.doc_id for r in out.collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert ids < {r.doc_id for r in docs.collect()} and len(ids) > 850
    ends = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in ends)


ROWS = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "12 34", None, "a", 5), (4, "the cat sat on the mat", "en", "a", 22), (4, "the cat sat on the mat", "en", "a", 22),
        (None, "another text with words in it", "en", None, 29), (5, "word " * 60_000, None, "b", 300_000), (6, "le chat est sur la table", "fr", "b", 24)]
CLASH = ["lang_pred", "score", "n_lines", "n_dropped", "fp", "component_id", "contaminated", "items", "piece", "offset", "length", "host"]


@pytest.mark.parametrize("empty", [False, True])
def test_edge_cases_through_all_stages(spark, empty):
    docs = spark.createDataFrame([] if empty else ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *(F.lit(f"keep {c}").alias(c) for c in CLASH))
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = P.cut_lineage(stage(spark, docs, DATA), name)
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns and all(r[c] == f"keep {c}" for r in rows for c in CLASH)
        if not empty and name == "language":
            assert sorted(r.doc_id or 0 for r in rows) == [0, 4, 4, 5, 6]
        if not empty and name == "near_dedup":
            assert sorted(r.doc_id or 0 for r in rows) == [0, 4, 5, 6]
    assert bool(rows) != empty


def test_one_copy_of_a_large_group_stays(spark):
    """20 copies in a source of 60 pages, and 6 in one of 8: whole after lines, one each after near_dedup."""
    word = [f"w{i}" for i in range(4_000)]
    group = {"a": "\n".join(" ".join(word[i:i + 12]) for i in range(0, 96, 12)), "b": "\n".join(" ".join(word[i:i + 12]) for i in range(100, 196, 12))}
    rows = [(i, group["a"], "a") for i in range(20)] + [(100 + i, group["b"], "b") for i in range(6)]
    rows += [(200 + i, "menu\n" + " ".join(word[300 + 40 * i:340 + 40 * i]), "a") for i in range(40)]
    rows += [(300 + i, " ".join(word[2_000 + 40 * i:2_040 + 40 * i]), "b") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = P.cut_lineage(P.lines(spark, docs, DATA), "lines")
    texts = {r.doc_id: r.text for r in out.collect()}
    assert all(texts[i] == t for i, t, _ in rows if i < 200)
    assert all(texts[i] == t.removeprefix("menu\n") for i, t, _ in rows if i >= 200)
    kept = {r.doc_id: r.text for r in P.near_dedup(spark, out, DATA).collect()}
    assert kept[0] == group["a"] and kept[100] == group["b"] and sorted(i for i in kept if i < 200) == [0, 100]
