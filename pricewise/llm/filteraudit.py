"""Filter interaction audit: what each order of five quality filters removes, and why.

One table-driven pass over the UTF-8 bytes of each text (``scan``) feeds all filters of
content. A byte has a class (CLASSES); the machine's state is "between words" or "in a
word"; NEXT gives the next state and ACTIONS what to do on the way: count a code point,
a capital, a symbol, open a word, close a word. A class alone fixes the next state, so
numpy looks the states and actions of a whole slice up at once. Closed word spans go
into an open-addressing hash table per slice, keyed by (row, span); a hit counts as the
same word only after its bytes were compared (``distinct_spans``).

The filters, by letter (failure conditions; words are maximal ``[^\\x20\\x09-\\x0D]+``):

- A: fewer than ``min_words`` words
- B: 100 * distinct words < ``min_distinct_pct`` * words
- C: 100 * capitals A-Z > ``max_capital_pct`` * code points
- D: any of ``# $ % & * |``
- E: equal to the text of a row with a smaller id

A document becomes a set of failed filters; ``interactions`` needs only how many
documents of a part have each set, so its work after one aggregation is bounded by the
number of parts.

Scale: texts are read once, in slices, and never shuffled. E is found by aggregates
alone: rows are counted by (digest, part, fails, labels, id), then the least id of each
digest, each with partial sums first, so a text copied a million times is one row per
task and label combination. Digests are SHA-256. No join but the one with ``labels`` by
id (null ids are dealt by digest there).

Edge cases: null text is the empty text (fails A alone, and E if repeated); a null part
is the empty string; a null id comes after all others and equals no other id, so of
rows with null ids alone none fails E; repeated rows count each, and as equal ids are
not smaller ids they do not fail E by each other; several labels of an id count as 1 if
any is 1; a null label is none; an empty table gives no rows; very long texts are one
slice; input columns beyond the named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ramp, text_slices

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PCT = 80
MAX_CAPITAL_PCT = 10
SYMBOLS = b"#$%&*|"

SPACE, CAPITAL, SYMBOL, INK, LEAD, CONTINUATION = range(6)
BETWEEN, IN_WORD = range(2)
OPEN, CLOSE, CODE_POINT, IS_CAPITAL, IS_SYMBOL = (1 << i for i in range(5))


def _classes() -> np.ndarray:
    """Class of each byte."""
    out = np.full(256, INK, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = SPACE
    out[ord("A"):ord("Z") + 1] = CAPITAL
    out[list(SYMBOLS)] = SYMBOL
    out[0x80:0xC0] = CONTINUATION
    out[0xC0:] = LEAD
    return out


CLASSES = _classes()
#: State after a byte of each class (the same from both states).
NEXT = np.array([BETWEEN, IN_WORD, IN_WORD, IN_WORD, IN_WORD, IN_WORD], np.uint8)
#: What a byte of each class does, by the state before it.
_OF_CLASS = np.array([CODE_POINT, CODE_POINT | IS_CAPITAL, CODE_POINT | IS_SYMBOL, CODE_POINT, CODE_POINT, 0], np.uint8)
ACTIONS = np.stack([_OF_CLASS | np.where(NEXT == IN_WORD, OPEN, 0), _OF_CLASS | np.where(NEXT == BETWEEN, CLOSE, 0)]).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes from ``a`` and from ``b`` are equal (sizes above 0)."""
    if not len(a):
        return np.zeros(0, bool)
    differ = data[ramp(a, size)] != data[ramp(b, size)]
    first = np.zeros(len(size), np.int64)
    np.cumsum(size[:-1], out=first[1:])
    return ~np.logical_or.reduceat(differ, first)


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of different spans of each row, by a verified open-addressing hash table."""
    n = len(starts)
    if not n:
        return np.zeros(rows, np.int64)
    # a span's hash from running sums of byte * base^place, brought back to place 0
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=run[1:])
    h = (run[ends] - run[starts]) * _powers(_INVERSE, len(data))[starts]
    h ^= row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    mask = (1 << (2 * n).bit_length()) - 1
    table = np.full(mask + 1, -1, np.int64)
    slot = (h & np.uint64(mask)).astype(np.int64)
    size = ends - starts
    new = np.zeros(n, bool)
    waiting = np.arange(n)
    while len(waiting):
        at = slot[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]  # of several, one stays
        owner = table[at]
        mine = owner == waiting
        new[waiting[mine]] = True
        waiting, owner = waiting[~mine], owner[~mine]
        same = (h[waiting] == h[owner]) & (row[waiting] == row[owner]) & (size[waiting] == size[owner])
        maybe = np.flatnonzero(same)
        same[maybe] = _same_bytes(data, starts[waiting[maybe]], starts[owner[maybe]], size[owner[maybe]])
        waiting = waiting[~same]
        slot[waiting] = (slot[waiting] + 1) & mask
    return np.bincount(row[new], minlength=rows)


def scan(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Per row of a slice: words, distinct words, code points, capitals and symbols."""
    rows = len(off) - 1
    cls = CLASSES[data]
    state = np.empty(len(data), np.uint8)
    state[1:] = NEXT[cls[:-1]]
    state[off[:-1][off[:-1] < len(data)]] = BETWEEN  # every row begins between words
    act = ACTIONS[state, cls]

    def per_row(bit: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(act & bit), off))

    starts = np.flatnonzero(act & OPEN)
    # a word is closed by its space or by the end of its row
    at_end = off[1:][(np.diff(off) > 0)]
    open_end = at_end[NEXT[cls[at_end - 1]] == IN_WORD] if len(at_end) else at_end
    ends = np.sort(np.concatenate([np.flatnonzero(act & CLOSE), open_end]))
    words = np.diff(np.searchsorted(starts, off))
    row = np.repeat(np.arange(rows), words)
    return {"words": words, "distinct": distinct_spans(data, starts, ends, row, rows), "code_points": per_row(CODE_POINT),
            "capitals": per_row(IS_CAPITAL), "symbols": per_row(IS_SYMBOL)}


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
            min_words: int = MIN_WORDS, min_distinct_pct: int = MIN_DISTINCT_PCT, max_capital_pct: int = MAX_CAPITAL_PCT) -> DataFrame:
    """(doc_id, part, the five counts of ``scan``, fails, digest) of every row; ``fails``
    has bit 0 for A to bit 3 for D, E being no matter of one row."""
    names = ["words", "distinct", "code_points", "capitals", "symbols"]
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("part", T.StringType()),
                           *(T.StructField(n, T.LongType()) for n in names),
                           T.StructField("fails", T.IntegerType()), T.StructField("digest", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in text_slices(batches, "text"):
            m = scan(data, off)
            fails = ((m["words"] < min_words).astype(np.int32)
                     | (100 * m["distinct"] < min_distinct_pct * m["words"]).astype(np.int32) << 1
                     | (100 * m["capitals"] > max_capital_pct * m["code_points"]).astype(np.int32) << 2
                     | (m["symbols"] > 0).astype(np.int32) << 3)
            view = memoryview(np.ascontiguousarray(data))
            digest = [hashlib.sha256(view[a:b]).digest() for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *(pa.array(m[n].astype(np.int64)) for n in names),
                                              pa.array(fails, pa.int32()), pa.array(digest, pa.binary())], names=schema.names)

    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), part.alias("part"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _one(c: Column) -> Column:
    return F.coalesce(F.max((c == 1).cast("int")), F.lit(0))


def profiles(measured: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(part, fails, good, toxic, n): documents by set of failed filters (bit 4: E)."""
    rows = measured.select("doc_id", "part", "fails", "digest")
    if labels is None:
        rows = rows.withColumn("good", F.lit(0)).withColumn("toxic", F.lit(0))
    else:
        known = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
                 .agg(_one(F.col("quality")).alias("good"), _one(F.col("toxic")).alias("toxic")).withColumn("label_salt", F.lit(0)))
        salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(0).cast("int")
        rows = (rows.withColumn("salt", salt).join(known, (F.col("doc_id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")), "left")
                .fillna(0, ["good", "toxic"]))
    by = ["part", "fails", "good", "toxic"]
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    one_id = rows.groupBy("digest", *by, key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # of each digest and combination: all rows, and those at its least id
    combined = one_id.groupBy("digest", *by).agg(F.sum("n").alias("n"), F.min(F.struct("key", "n")).alias("least"))
    # a digest has at most one row per combination of part and labels here
    texts = combined.groupBy("digest").agg(F.min("least.key").alias("first"), F.collect_list(F.struct(*by, "n", "least")).alias("rows"))
    each = texts.select("first", F.explode("rows").alias("r")).select(*(f"r.{c}" for c in by), "r.n", "r.least", "first")
    is_first = F.col("least.key") == F.col("first")
    # without an id there is no smaller id: rows of null ids alone pass
    passed = F.when(is_first, F.col("least.n")).otherwise(0)
    split = each.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("fails").alias("fails"), passed.alias("n")),
        F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - passed).alias("n")))).alias("s"))
    return split.where("s.n > 0").groupBy("part", "s.fails", "good", "toxic").agg(F.sum("s.n").alias("n"))


def orders(spark, filters: str = FILTERS) -> DataFrame:
    """(filter_order, step, f, earlier): every order of the filters; ``earlier`` is the set
    of those applied before step's filter ``f`` as bits. Five filters make 600 rows."""
    rows = []
    for p in permutations(range(len(filters))):
        rows += [("".join(filters[i] for i in p), k + 1, f, sum(1 << i for i in p[:k])) for k, f in enumerate(p)]
    return spark.createDataFrame(rows, "filter_order string, step int, f int, earlier int")


def interactions(profile: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, see the module's contract.

    All steps that apply filter f after the same set of filters have the same counts, so
    these are summed once per (part, f, set) and then looked up per order.
    """
    n = len(filters)
    all_orders = orders(profile.sparkSession, filters)
    bit = F.expr("shiftleft(1, f)")
    pairs = F.array(*(F.struct(F.lit(f).alias("f"), F.lit(s).alias("earlier")) for f in range(n) for s in range(1 << n) if not s >> f & 1))
    each = profile.select("*", F.explode(pairs).alias("p")).select("*", "p.f", "p.earlier")
    fails = F.col("fails").bitwiseAND(bit) != 0
    gone = F.col("fails").bitwiseAND(F.col("earlier")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    counts = each.groupBy("part", "f", "earlier").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("fails") == bit).alias("unique_fails"), total(fails & ~gone & (F.col("good") == 1)).alias("good_lost"),
        total(fails & ~gone & (F.col("toxic") == 1)).alias("toxic_lost"))
    steps = counts.join(F.broadcast(all_orders), ["f", "earlier"])  # n * n! rows, fixed by the filters
    share = steps.groupBy("part", "f").agg(F.sum("removed").alias("shapley"))  # n rows a part
    out = steps.join(share, ["part", "f"])
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame | None = None, **columns) -> DataFrame:
    """All orders of the five filters over whole texts."""
    return interactions(profiles(measure(docs, **columns), labels))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
lab AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT w.part, coalesce(lab.good, false) AS good, coalesce(lab.toxic, false) AS toxic,
         (len(ws) < 100)::INT
       + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
       + 4 * (100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t))::INT
       + 8 * regexp_matches(w.t, '[#$%&*|]')::INT
       + 16 * (coalesce(w.doc_id > least.least, least.least IS NOT NULL))::INT AS fails
  FROM w JOIN least ON w.t = least.t LEFT JOIN lab ON w.doc_id = lab.doc_id),
p AS (SELECT part, fails, good, toxic, count(*) AS n FROM m GROUP BY ALL),
l AS (SELECT unnest([0, 1, 2, 3, 4]) AS i),
o AS (
  SELECT [a.i, b.i, c.i, e.i, f.i] AS ord
  FROM l a, l b, l c, l e, l f
  WHERE len(list_distinct([a.i, b.i, c.i, e.i, f.i])) = 5),
s AS (
  SELECT list_aggregate(list_transform(ord, lambda x: chr(65 + x)), 'string_agg', '') AS filter_order, k AS step, ord[k] AS f,
         coalesce(list_sum(list_transform(ord[1:k - 1], lambda x: 1 << x)), 0)::INT AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
r AS (
  SELECT p.part, s.filter_order, s.step, s.f,
         sum(CASE WHEN fails & (1 << f) = 0 AND fails & earlier = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN fails & (1 << f) <> 0 AND fails & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fails & (1 << f) <> 0 AND fails & earlier <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = (1 << f) THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN good AND fails & (1 << f) <> 0 AND fails & earlier = 0 THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN toxic AND fails & (1 << f) <> 0 AND fails & earlier = 0 THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM p, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r
"""
