"""Budgeted chat windows: the definition in plain Python, round trips, masks, budget, plan."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewise.llm import chatwindows as CW
from pricewise.llm.queries import op11_chat_windows

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ANS]", "[ROLE]", "[TEXT]", "[/ROLE]", "[/TEXT]", "[/ANS]"]


def plain_windows(rows, budget, history):
    """conv -> list of (turns repeated, turns new) by the module's rules; a turn is (role, text, tokens)."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns = [(r, x, CW.OVERHEAD + math.ceil(len(x.encode()) / 4)) for _, r, x in sorted(turns)]
        system = turns[:1] if turns[0][0] == "system" else []
        rest = turns[len(system):]
        room = max(1, budget - history - sum(s[2] for s in system))
        starts = [sum(t[2] for t in rest[:k]) for k in range(len(rest))]
        spans, last = [], None
        for k, t in enumerate(rest):
            key = (starts[k] // room, starts[k] + t[2] > (starts[k] // room + 1) * room)
            if key != last:
                spans.append([])
            spans[-1].append(k)
            last = key
        made = []
        for i, span in enumerate(spans or [[]]):
            back = [rest[j] for j in range(span[0]) if starts[span[0]] - starts[j] <= history] if span else []
            made.append(((system if i else []) + back, (system if not i else []) + [rest[j] for j in span]))
        out[c] = made
    return out


def made(spark, rows, budget=CW.BUDGET, history=CW.HISTORY, slices=1):
    df = spark.createDataFrame(rows, SCHEMA).repartition(slices)
    return CW.windows(df, budget, history)


def some_conversations(seed, n=40):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        roles = (["system"] if rng.random() < 0.5 else []) + [rng.choice(["user", "assistant", "assistant", "tool", "system", None, "a[INST]b"]) for _ in range(rng.randint(0, 12))]
        for t, r in enumerate(roles):
            text = " ".join(rng.choice(CONTROL + ["a", "é", "\\", "<\\s>", "[\\\\INST]", "[", "<", " ", "\n", "𝄞"]) for _ in range(rng.randint(0, 30)))
            rows.append((c, t, r, rng.choice([text, text, None, ""])))
    return rows


@pytest.mark.parametrize("budget,history,slices", [(60, 20, 1), (30, 0, 4), (200, 64, 3), (5, 100, 2)])
def test_windows_equal_definition(spark, budget, history, slices):
    rows = some_conversations(budget)
    want = plain_windows(rows, budget, history)
    got = {}
    for r in made(spark, rows, budget, history, slices).withColumn("turns", CW.parse(F.col("text"))).orderBy("conv_id", "window").collect():
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(want)
    for c, windows in want.items():
        assert [r.window for r in got[c]] == list(range(1, len(windows) + 1))
        for r, (back, new) in zip(got[c], windows):
            assert [(t.role, t.text) for t in r.turns] == [t[:2] for t in back + new]
            assert r.n_repeated == len(back) and r.n_tokens == sum(t[2] for t in back + new)
            targets = [r.text[s.start:s.end] for s in r.loss]
            assert len(targets) == sum(t[0] == "assistant" for t in new)
            rest = [t for t in new if t[0] != "system" or t is not new[0]]
            assert r.n_tokens <= budget or len(rest) <= 1 or budget - history < 1


def test_digests_equal_definition(spark):
    rows = some_conversations(9) + [(77, 0, "system", "only"), (78, 0, None, None), (78, 0, None, None), (None, 1, "assistant", "x"), (None, None, "user", "y"), (79, 5, "assistant", "z" * 9000)]
    got = {r.conv_id: r for r in CW.digests(CW.read_back(made(spark, rows, 50, 16, 3))).collect()}
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_escape_can_be_undone_and_hides_controls(spark):
    rng = random.Random(1)
    texts = CONTROL + ["".join(rng.choice(CONTROL + ["\\", "<", "[", "/", "s>", "INST]", "x"]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", CW.escape(F.col("t")).alias("e"), CW.unescape(CW.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROL), r


def test_given_token_counts(spark):
    rows = spark.createDataFrame([(1, t, "user", "x", 90) for t in range(4)], SCHEMA + ", k long")
    assert CW.windows(rows, 200, 0, F.col("k")).count() == 3  # two turns, one over the limit, one
    assert CW.windows(rows, 100, 0, F.col("k")).count() == 4


def test_empty_and_clashing_columns(spark):
    assert made(spark, []).count() == 0
    df = spark.createDataFrame([(1, 0, "assistant", "x", 3, 4, 5)], SCHEMA + ", window int, start int, fmt int")
    (r,) = CW.windows(df).collect()
    assert r.text == "<s>[ANS] x </s>" and [tuple(s) for s in r.loss] == [(9, 10)]


def test_awkward_conversation_of_the_query(spark):
    r = op11_chat_windows(spark, SF_SMALL).where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.n_turns == 2 and r.loss_chars == len(said)


def test_plan_has_no_python_and_one_shuffle(spark):
    plan = op11_chat_windows(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "RDD" not in plan
    assert plan.count("Exchange") == 1, plan
