"""Benchmark decontamination by template canonicalisation.

Text and benchmark items become sequences of template tokens: numbers, names and
units are replaced by typed placeholders, every other word is lower-cased and freed of
outer punctuation. Windows of ``WINDOW`` tokens of the items are hash-joined with those
of all documents. Matched windows on one diagonal (same shift between item and
document) are an occurrence; its slots give pairs (item value, document value). A window
whose slots all have the item's values is literal and always counts. One with other
values counts if its occurrence is consistent (every item value has one document value)
and the item has MIN_LITERAL words outside its slots: short items and those of
placeholders must be met literally.

A window of fewer than MIN_WINDOW_LITERAL words outside its slots says nothing about its
text: it is joined by the values in its slots and so matches literally only.

The counted windows, from any place of the document, cover tokens of the item. A
document is contaminated if they cover ``COVERAGE`` or more of an item's tokens, or all
but WINDOW of them and MIN_COVERED at least (one edited word near an end hides as many),
or if literal windows in a row cover RUN tokens of a longer item: verbatim copies,
questions with other numbers or names, near copies and long quotations alike.

- number: digits with signs, separators, currency signs or a percent sign
- unit: a word of UNITS right after a number; a number with such a unit attached is
  one token of its own type
- name: a word with a capital first letter and small letters after it, at a sentence
  start too (there, any word may be a name)

Each text is read in two forms, with names as placeholders and with names lower-cased
like other words, so that a copy in capitals or small letters matches as well. A match
lies within one form.

Scale: the documents are read once. Each task first tests its windows against a bitmap
of FILTER_BITS slots (bounded, whatever the benchmark's size; a fuller bitmap lets more
windows pass, nothing is lost), then only passing windows are shuffled by hash. The
aggregations by (document, item, diagonal) are Spark group-bys. Windows that can match
literally only leave a text once each, however often it repeats them: where they stand
does not matter. So lists of numbers or a word said a thousand times do not multiply.
Template windows with slots keep all their places, which a text that repeats one of the
item's templates can still multiply with the item's own repeats of it. The join is by hash, so
a passage that a third of all documents share is split by adaptive execution.

Edge cases: null texts have no words and are clean; an item with fewer than WINDOW
tokens is one window of its own length, one without words matches nothing; equal items
all match; decisions are by doc_id and text (a hash of it), so different texts under one
id, the null id too, are judged each by itself; an empty documents or benchmark table gives no match; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, distinct_words, text_slices, worker_memory

WINDOW = 5
COVERAGE = 0.8
#: Tokens that suffice when no more than WINDOW are left out; literal tokens in a row that always do.
MIN_COVERED, RUN = 2 * WINDOW, 20
#: Words outside slots that an item needs for matches with other values.
MIN_LITERAL = 5
#: Words outside slots that a window needs to be joined by its template; others join by their values.
MIN_WINDOW_LITERAL = 2
FILTER_BITS = 1 << 22
#: Contaminated rows, and items found in them, that are broadcast at most.
BROADCAST_ROWS = 400_000
CACHED_WORDS = 250_000

#: Units of measure and money that may follow a number.
UNITS = frozenset("""
mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams pound pounds lb lbs oz ounce ounces ton tons tonne tonnes
ml cl l litre litres liter liters gallon gallons second seconds sec s minute minutes min hour hours h hr day days week weeks month months year years
dollar dollars euro euros cent cents usd eur gbp percent degree degrees celsius fahrenheit kelvin volt volts v watt watts w kw kwh joule joules
newton newtons n pa kpa hz khz mhz ghz byte bytes kb mb gb tb bit bits mph kmh
""".split())

_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
_WITH_UNIT = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*([A-Za-z]+)$")
_EDGE = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
#: ASCII marks that _EDGE takes off, for the common case of a word of letters.
_LEAD = """!"#%&'()*,./:;<=>?@[\\]^`{|}~"""
_TRAIL = """!"#$&'()*+,-./:;<=>?@[\\]^`{|}~"""
_NUM, _UNIT, _NAME, _NUM_UNIT = "\x00num", "\x00unit", "\x00name", "\x00numunit"

#: Flags of a word.
IS_SLOT, IS_NUMBER, IS_UNIT = 1, 2, 4
_BASE = 0x9E3779B97F4A7C15


#: The forms: names as placeholders, names as words.
FORMS = (0, 1)


def _classify(word: str) -> tuple[str, str, int, int]:
    """(token with names as placeholders, token with names as words, flags of both)."""
    bare = word.lstrip(_LEAD).rstrip(_TRAIL)
    if not bare.isalpha():
        bare = _EDGE.sub("", word) or word
        if _NUMBER.match(bare):
            return _NUM, _NUM, IS_SLOT | IS_NUMBER, IS_SLOT | IS_NUMBER
        m = _WITH_UNIT.match(bare)
        if m and m[1].lower() in UNITS:
            return _NUM_UNIT, _NUM_UNIT, IS_SLOT, IS_SLOT
    low = bare.lower()
    if low in UNITS:
        return low, low, IS_UNIT, IS_UNIT
    if len(bare) > 1 and bare[0].isupper() and bare[1:].islower() and bare.isalpha():
        return _NAME, low, IS_SLOT, 0
    return low, low, 0, 0


def template(word: str, form: int = 0) -> tuple[str, int]:
    """(template token, flags) of a word; a unit counts as one only after a number."""
    c = _classify(word)
    return c[form], c[2 + form]


def _value(word: str) -> str:
    """What a slot holds."""
    return word.strip(".,;:!?\"'()").lower()


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode(), 1)


class _Templates:
    """Token hashes and flags of the words a task has met, by form."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.hashes = [np.zeros(0, np.uint64) for _ in FORMS]
        self.values = np.zeros(0, np.uint64)
        self.flags = [np.zeros(0, np.uint8) for _ in FORMS]

    def of(self, words: list[str]) -> np.ndarray:
        """Numbers of the words in ``hashes`` and ``flags``."""
        if len(self.number) > CACHED_WORDS:
            self.clear()
        new = [w for w in words if w not in self.number]
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            found = [_classify(w) for w in new]
            self.values = np.concatenate([self.values, np.array([xxhash.xxh64_intdigest(_value(w).encode(), 2) for w in new], np.uint64)])
            for form in FORMS:
                self.hashes[form] = np.concatenate([self.hashes[form], np.array([_hash(c[form]) for c in found], np.uint64)])
                self.flags[form] = np.concatenate([self.flags[form], np.array([c[2 + form] for c in found], np.uint8)])
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def _as_unit(h: np.ndarray, f: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units right after a number of the same row become slots."""
    after = np.zeros(len(f), bool)
    after[1:] = (f[:-1] & IS_NUMBER) > 0
    after[first[:-1][first[:-1] < len(f)]] = False
    unit = after & ((f & IS_UNIT) > 0)
    return np.where(unit, np.uint64(_hash(_UNIT)), h), np.where(unit, IS_SLOT, f & IS_SLOT).astype(np.uint8)


def _windows(h: np.ndarray, size: int, form: int) -> np.ndarray:
    """Hash of every run of ``size`` tokens; of every row of an array of such runs."""
    if h.ndim == 1 and len(h) < size:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) if h.ndim == 2 else len(h) - size + 1, 2 * size + form, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = (out ^ (h[:, j] if h.ndim == 2 else h[j:len(h) - size + 1 + j])) * np.uint64(_BASE)
            out ^= out >> np.uint64(32)
    return out


def _once(row: np.ndarray, hashes: np.ndarray, literally: np.ndarray) -> np.ndarray:
    """Which windows to keep: of those that match ``literally``, the first of each hash in a row."""
    keep = np.ones(len(row), bool)
    some = np.flatnonzero(literally)
    order = some[np.lexsort((hashes[some], row[some]))]
    keep[order[1:]] = (row[order[1:]] != row[order[:-1]]) | (hashes[order[1:]] != hashes[order[:-1]])
    return keep


def _window_rows(texts: DataFrame, sizes: list[int] | None, passing) -> DataFrame:
    """(id, form, hash, pos, size, tokens, literal, slots): windows of every text, with their
    length, the text's tokens and those that are no slots. ``sizes``: the window lengths;
    None takes WINDOW, or the whole of a shorter text. ``passing``: bitmap or None."""
    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("form", T.IntegerType()), T.StructField("hash", T.LongType()), T.StructField("pos", T.LongType()),
                           T.StructField("size", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("literal", T.LongType()), T.StructField("slots", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_memory("templates").setdefault("words", _Templates())
        allow = passing.value if passing is not None else None
        for rows, data, off in text_slices(batches, "text"):
            words, which, first = distinct_words(data, off)
            if not words:
                continue
            known_as = known.of(words)[which]
            n_words = np.diff(first)
            row_of = np.repeat(np.arange(len(off) - 1), n_words)
            for form in FORMS:
                h, slot = _as_unit(known.hashes[form][known_as], known.flags[form][known_as], first)
                slots_before = np.concatenate([[0], np.cumsum(slot, dtype=np.int64)])
                literal = n_words - np.diff(slots_before[first])
                for size in sizes if sizes is not None else range(1, WINDOW + 1):
                    win = _windows(h, size, form)
                    ok = row_of[:len(win)] == row_of[size - 1:]
                    if sizes is None:
                        own = n_words[row_of[:len(win)]]
                        ok &= (own == size) if size < WINDOW else (own >= WINDOW)
                    n_slots = slots_before[size:] - slots_before[:-size] if len(win) else win
                    by_value = n_slots > max(0, size - MIN_WINDOW_LITERAL)
                    few = np.flatnonzero(by_value & ok)
                    if len(few):
                        run_of = few[:, None] + np.arange(size)
                        win[few] = _windows(np.where(slot[run_of], known.values[known_as[run_of]], h[run_of]), size, form)
                    if allow is not None:
                        ok &= allow[win & np.uint64(FILTER_BITS - 1)]
                    at = np.flatnonzero(ok)
                    if not len(at):
                        continue
                    r = row_of[at]
                    if allow is not None:
                        at = at[_once(r, win[at], (by_value | (n_slots == 0))[at])]
                        r = row_of[at]
                    slots = [[_value(words[which[k]]) for k in range(a, a + size) if slot[k]] for a in at.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(pa.array(r)), pa.array(np.full(len(r), form, np.int32)), pa.array(win[at].view(np.int64)),
                         pa.array(at - first[r]), pa.array(np.full(len(r), size, np.int64)), pa.array(n_words[r].astype(np.int64)), pa.array(literal[r].astype(np.int64)),
                         pa.array(slots, pa.list_(pa.string()))],
                        names=["id", "form", "hash", "pos", "size", "tokens", "literal", "slots"])

    return texts.mapInArrow(run, schema)


def _tokens_covered(at: str) -> Column:
    """Tokens in the windows that begin at the sorted places ``at``."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(at, start, lambda a, p: F.struct((a["n"] + p + F.col("size") - F.greatest(a["end"], p)).alias("n"), (p + F.col("size")).alias("end")), lambda a: a["n"])


def _longest_run(at: str) -> Column:
    """Tokens of the longest row of windows, each one token after the one before."""
    start = F.struct(F.lit(-2).cast("long").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("best"))

    def step(a, p):
        run = F.when(p == a["last"] + 1, a["run"] + 1).otherwise(F.col("size"))
        return F.struct(p.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(at, start, step, lambda a: a["best"])


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, coverage, changed) of every contaminated document and item;
    ``changed`` is true if some slot has another value than the item's."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id_col).alias("id"), F.col(item_text_col).alias("text"))
    known = cut_lineage(_window_rows(items, None, None).select(
        F.col("id").alias("item_id"), "form", "hash", F.col("pos").alias("item_pos"), "size", "tokens", "literal", F.col("slots").alias("item_slots")), "templates")
    # window lengths (at most WINDOW) and the bitmap's set slots (at most FILTER_BITS): bounded
    short = items.select(F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("k")).where(f"k > 0 and k < {WINDOW}").distinct()
    sizes = [*(r.k for r in short.collect()), WINDOW]
    allow = np.zeros(FILTER_BITS, bool)
    set_bits = known.select(F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1).cast("long")).alias("b")).distinct().toArrow().column(0).to_numpy()
    allow[set_bits] = True
    texts = docs.select(F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")).alias("id"), F.col(text_col).alias("text"))
    hits = _window_rows(texts, sizes, spark.sparkContext.broadcast(allow)).drop("size", "tokens", "literal")
    pairs = (hits.join(known, ["form", "hash"]).where(F.size("slots") == F.size("item_slots"))
             .select("id", F.struct("item_id", "form", (F.col("pos") - F.col("item_pos")).alias("shift")).alias("occ"),
                     "size", "tokens", "literal", "item_pos", (F.col("slots") == F.col("item_slots")).alias("same"), F.arrays_zip("item_slots", "slots").alias("values")))
    pairs = cut_lineage(pairs, "template_hits")
    values = pairs.select("id", "occ", F.explode_outer("values").alias("v")).select("id", "occ", "v.*").distinct()
    occurrence = (values.groupBy("id", "occ", "item_slots").agg(F.count("slots").alias("k"))
                  .groupBy("id", "occ").agg((F.max("k") <= 1).alias("consistent")).withColumnsRenamed({"id": "i", "occ": "o"}))
    counts = F.col("same") | (F.col("consistent") & (F.col("literal") >= MIN_LITERAL))
    item = ["id", "item_id", "form", "size", "tokens"]
    # hits repeat a few items, so their file is far smaller than their rows: never broadcast by its size
    covered = (pairs.drop("values").join(occurrence.hint("merge"), F.col("id").eqNullSafe(F.col("i")) & F.col("occ").eqNullSafe(F.col("o")))
               .select("id", "occ.item_id", "occ.form", "size", "tokens", "item_pos", "same", counts.alias("counts"))
               .groupBy(*item, "item_pos").agg(F.max("same").alias("same"), F.max("counts").alias("counts"))
               .groupBy(*item).agg(F.array_sort(F.collect_list(F.when(F.col("counts"), F.col("item_pos")))).alias("at"),
                                   F.array_sort(F.collect_list(F.when(F.col("same"), F.col("item_pos")))).alias("same_at"), (~F.min("same")).alias("changed"))
               .select(*item, _tokens_covered("at").alias("n"), _longest_run("same_at").alias("run"), "changed")
               .where((F.col("n") >= COVERAGE * F.col("tokens")) | (F.col("run") >= RUN)
                      | (F.col("n") >= F.greatest(F.col("tokens") - WINDOW, F.lit(MIN_COVERED))))
               .groupBy("id", "item_id").agg(F.max(F.col("n") / F.col("tokens")).alias("coverage"), F.min("changed").alias("changed")))
    return covered.select("id.doc_id", "id.text_hash", "item_id", "coverage", "changed")


def contaminated(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """(doc_id, text_hash, items, changed): one row per contaminated id and text; items sorted."""
    return matches(docs, benchmark, **columns).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.min("changed").alias("changed"))


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The contaminated ids and texts, written once; broadcast up to BROADCAST_ROWS, joined by shuffle beyond."""
    found = cut_lineage(contaminated(docs, benchmark, id_col=id_col, text_col=text_col), "contaminated")
    found = found.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    held = found.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    return F.broadcast(found) if held <= BROADCAST_ROWS else found


def _is_row(id_col: str, text_hash: Column) -> Column:
    return F.col(id_col).eqNullSafe(F.col("__id")) & (text_hash == F.col("__hash"))


def flag(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, contaminated, items, changed) for every row of ``docs``; texts are not shuffled."""
    found = _found(docs, benchmark, id_col, text_col)
    none = F.array().cast(found.schema["items"].dataType)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"))
    return rows.join(found, _is_row("doc_id", F.col("text_hash")), "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"),
        F.coalesce("changed", F.lit(False)).alias("changed"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` less the contaminated rows."""
    found = _found(docs, benchmark, id_col, text_col).select("__id", "__hash")
    return docs.join(found, _is_row(id_col, F.xxhash64(text_col)), "left_anti")
