"""Decontamination against a plain search and on planted questions."""

import re

import pytest

from pricewise.llm import decontaminate as D

DATA = "/root/testdata/sf0.01"


def plain(text):
    return " ".join(w.lower().strip(".,;:!?") for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_given_documents_hold_the_whole_items(spark):
    docs, bench = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    want = {r.doc_id: sorted(i for i, t in items.items() if t in plain(r.text)) for r in docs.collect()}
    got = {r.doc_id: list(r["items"]) for r in D.flag(docs, bench).collect()}
    assert got == want and any(want.values())


ITEM = "If a train travels 120 km in 2 hours and Alice boards it at Paris, then how far does Alice get in 2 more hours at the same speed as before?"


def flags(spark, texts, items=((1, ITEM),)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' as item_id", "1 as hash")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {r.doc_id: (r.contaminated, r.changed) for r in D.flag(docs, bench).collect()}


def test_templates(spark):
    other = ITEM.replace("120 km", "95.5 km").replace("Alice", "Robert").replace("Paris", "Lima").replace("2 hours", "3 hours").replace("2 more", "3 more")
    mixed = other.replace("does Robert", "does Carol")  # one name becomes two
    got = flags(spark, [
        "Some words first. " + ITEM + " And more.", other, mixed, ITEM.upper(), ITEM.lower(), other.replace("travels", "runs").replace("before", "now"),
        " ".join(reversed(ITEM.split())), "A text about a train that travels far with Alice and other people of Paris.", ITEM[:60]])
    assert got[0] == (True, False) and got[1] == (True, True) and got[3][0] and got[4][0]
    assert not got[2][0] and not got[6][0] and not got[7][0] and not got[8][0]


def test_template_tokens():
    assert [D.template(w)[0] for w in ("12.5", "$3,000.", "50%", "5km", "5xyz", "Alice,", "I", "USA", "word.", "--")] == \
        ["\x00num", "\x00num", "\x00num", "\x00numunit", "5xyz", "\x00name", "i", "usa", "word", "--"]
    assert D.template("Alice", 1)[0] == "alice" and D.template("km") == ("km", D.IS_UNIT)


def test_edge_cases(spark):
    long_text = "filler words go on and on " * 30_000 + ITEM
    items = [(1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "Tiny item here"), (None, "an item without any id number at all")]
    got = flags(spark, [None, "", long_text, "x tiny Item here y", "say: an item without any id number at all!"], items)
    assert got == {0: (False, False), 1: (False, False), 2: (True, False), 3: (True, False), 4: (True, False)}
    docs = spark.createDataFrame([(7, ITEM), (7, ITEM), (None, ITEM), (8, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(str(r.doc_id) for r in D.flag(docs, bench).collect() if r.contaminated) == ["7", "7", "None"]
    assert [r.doc_id for r in D.drop_contaminated(docs, bench).collect()] == [8]
    assert D.flag(docs.limit(0), bench).collect() == []
    assert not any(r.contaminated for r in D.flag(docs, bench.limit(0)).collect())


SHORT = "the old miller carried seven heavy sacks of grain across a narrow bridge before dawn broke"
LONG = "the river that runs below our town was once so clean that people drank from it but since the mill came upstream nobody has dared to swim there and even the fish have gone away to quieter waters"


def test_near_copies_and_passages(spark):
    words = SHORT.split()
    assert len(words) == 16
    edits = [" ".join([*words[:i], "otherwise", *words[i + 1:]]) for i in range(16)]
    long = LONG.split()
    two = " ".join("otherwise" if i in (4, len(long) - 5) else w for i, w in enumerate(long))
    got = flags(spark, [*edits, "He wrote: " + " ".join(long[:len(long) * 3 // 4]) + ", no more.", two, " ".join(long[:12])], ((1, SHORT), (2, LONG)))
    assert all(got[i][0] for i in range(18)) and not got[18][0]
    # one of two equal numbers changed, in a copy that is verbatim else
    assert flags(spark, [ITEM.replace("2 more", "7 more")]) == {0: (True, True)}


def test_short_items_and_placeholders_are_met_literally(spark):
    items = ((1, "42"), (2, "Alice has 5 km"), (3, "Alice Bob Carol Dave Erin 1 2 3 4"))
    got = flags(spark, ["there are 17 of them", "so Robert has 9 km to go", "Paul John Mark Luke Adam 5 6 7 8", "the answer is 42.", "so Alice has 5 km to go", "Alice Bob Carol Dave Erin 1 2 3 4"], items)
    assert [got[i][0] for i in range(6)] == [False] * 3 + [True] * 3


@pytest.mark.parametrize("broadcast_rows", [D.BROADCAST_ROWS, 0])
def test_rows_of_one_id_are_judged_each(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast_rows)
    docs = spark.createDataFrame([(None, ITEM), (None, "clean one"), (None, "clean two"), (7, ITEM), (7, "clean"), (7, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    left = D.drop_contaminated(docs, bench).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in left) == [("7", "None"), ("7", "clean"), ("None", "clean one"), ("None", "clean two")]
    assert sorted(r.contaminated for r in D.flag(docs, bench).collect()) == [False] * 4 + [True] * 2


def test_lists_of_numbers_and_repeated_words_do_not_multiply(spark, monkeypatch):
    rows = {}
    cut = D.cut_lineage

    def counted(df, name):
        out = cut(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(D, "cut_lineage", counted)
    numbers = [" ".join(str((i * 7919 + k) % 9973) for i in range(200)) for k in range(2)]
    many = " ".join(str(i) for i in range(20_000, 22_000))
    items = [(1, numbers[0]), (2, "ha " * 200), (3, "7 " * 200), (4, "Ann " * 200)]
    got = flags(spark, [many, "ha " * 2000, "7 " * 2000, "Bob " * 2000, numbers[1], "so " + numbers[0] + " end", "Ann " * 300], items)
    assert [got[i] for i in range(7)] == [(False, False), (True, False), (True, False), (False, False), (False, False), (True, False), (True, False)]
    assert rows["template_hits"] <= 2 * 196 * 6


def test_windows_once_against_a_plain_version():
    import numpy as np
    rng = np.random.default_rng(5)
    row, h, lit = np.sort(rng.integers(0, 5, 300)), rng.integers(0, 9, 300).astype(np.uint64), rng.random(300) < 0.7
    seen, want = set(), []
    for r, x, one in zip(row.tolist(), h.tolist(), lit.tolist()):
        want.append(not one or (r, x) not in seen)
        if one:
            seen.add((r, x))
    assert D._once(row, h, lit).tolist() == want
    assert D._once(row[:0], h[:0], lit[:0]).tolist() == []
