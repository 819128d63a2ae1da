"""Language identification by a language-bitmask n-gram filter.

Training counts the letter trigrams of the labelled texts by language (map-side sums,
then one shuffle of trigram counts). A trigram belongs to a language when its rate
there is at least ``SHARE`` of its highest rate in any language. All (trigram,
language) memberships go into one bit-sliced Bloom filter: a row of bits per slot, one
bit per language, so a lookup (the AND of a trigram's slots) returns all languages
that contain the trigram at once.

Prediction looks up every trigram of the whole text and counts the hits of each
language (a popcount over the text's bitmasks). A language whose column of the filter
is filled to a share f gives false hits at the rate f^k for k slots; with n trigrams
and h hits the corrected count is (h - n p) / (1 - p), p = f^k. The largest corrected
count decides, ties by the more frequent language, then by name. The score is that
language's corrected share of the text's trigrams (0 to 1).

Bounds: the filter has SLOTS_PER_MEMBER rows or more for each trigram of the language
with most of them (a power of two, MIN_SLOTS at least), so a column is never filled
beyond 1 - exp(-PROBES / SLOTS_PER_MEMBER) = 0.31 and false hits stay at about 0.03,
whatever the size of the corpus. What goes to the tasks is 8 bytes a row for each 64
languages; a corpus whose filter would need more than MAX_SLOTS rows (a gigabyte, 16
million different trigrams in one language) is refused with a message, not answered
with a full filter. Counts cover every labelled row; nothing is sampled. Words are
remembered by task as a cache only.

A trigram is a letter with its two neighbours, anything but a letter counting as one
boundary sign, after lower-casing.

Edge cases: a text that is null or has no letter is ``und`` with score 0; a null
language is not learned from; without any labelled row every text is ``und``; repeated
rows count and are predicted each; an empty table gives an empty result; very long
texts are read whole in slices of words; other columns pass through untouched unless
they are named like a result column, which replaces them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import distinct_words, text_slices, worker_memory

MIN_SLOTS, MAX_SLOTS = 1 << 16, 1 << 27
SLOTS_PER_MEMBER = 8
PROBES = 3
#: Least rate of a trigram in a language, as a share of its highest rate in any.
SHARE = 0.5
UNKNOWN = "und"
#: Distinct words a Python worker remembers; emptied beyond it.
CACHED_WORDS = 200_000


@dataclass
class LanguageFilter:
    """The bit-sliced filter: ``planes[j][slot]`` holds the bits of languages 64j to 64j+63."""
    languages: list[str]
    planes: np.ndarray
    false_rate: np.ndarray
    key: str
    #: Different trigrams learned from, over all languages.
    trigrams: int = 0


def _letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for anything but a letter, with a boundary at both ends."""
    low = text.lower()
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    seen, back = np.unique(codes, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in seen.tolist()], bool)
    return np.concatenate([[0], np.where(letter, seen, 0)[back] if len(seen) else codes, [0]])


def _trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of all words and the number in each word."""
    codes = _letter_codes("\n".join(words))
    mid = np.flatnonzero(codes[1:-1]) + 1
    grams = codes[mid - 1] << 42 | codes[mid] << 21 | codes[mid + 1]
    size = np.array([len(w.lower()) + 1 for w in words], np.int64)
    ends = np.cumsum(size)
    return grams, np.diff(np.searchsorted(mid, np.concatenate([[0], ends]) + 1))


def slots_for(members: int) -> int:
    """Rows of a filter whose fullest column holds ``members`` trigrams."""
    slots = max(MIN_SLOTS, 1 << max(0, members * SLOTS_PER_MEMBER - 1).bit_length())
    if slots > MAX_SLOTS:
        raise ValueError(f"{members} trigrams of one language need {slots} rows of the filter, more than MAX_SLOTS ({MAX_SLOTS})")
    return slots


def _slots(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    """PROBES slots of each trigram (multiplicative mixing of its code)."""
    out = []
    with np.errstate(over="ignore"):
        x = grams.astype(np.uint64)
        for _ in range(PROBES):
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            out.append((x >> np.uint64(20)) % np.uint64(slots))
    return out


def trigram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows with a language; a task gives one row per pair and flush."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merged(parts):
            g, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return g, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)

        for rows, data, off in text_slices(batches, "text"):
            words, which, first = distinct_words(data, off)
            if not words:
                continue
            grams, per_word = _trigrams(words)
            lang = rows.column(1).dictionary_encode()
            n_lang = len(lang.dictionary)
            of_word = np.repeat(lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(first))
            seen = np.bincount(of_word * len(words) + which, minlength=n_lang * len(words)).reshape(n_lang, len(words))
            for k, name in enumerate(lang.dictionary.to_pylist()):
                weight = np.repeat(seen[k], per_word)
                some = weight > 0
                held.setdefault(name, []).append(merged([(grams[some], weight[some])]))
                if len(held[name]) > 15:
                    held[name] = [merged(held[name])]
        for name, parts in held.items():
            g, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])

    counted = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return counted.mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", share: float = SHARE) -> LanguageFilter:
    """The filter from all labelled rows of ``docs``.

    The rates and memberships are Spark aggregations; the slots are set by tasks and
    or-ed together by slot. The driver receives the finished filter (at most MAX_SLOTS
    rows of bits) and one row per language.
    """
    counts = trigram_counts(docs, text_col, lang_col).persist()
    try:
        totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
        by_size = [r.lang for r in totals.orderBy(F.desc("total"), "lang").collect()]
        bit = {lang: i for i, lang in enumerate(by_size)}
        planes = np.zeros((max(1, -(-len(by_size) // 64)), MIN_SLOTS), np.uint64)
        trigrams = 0
        if by_size:
            trigrams = counts.select("gram").distinct().count()
            # a rate per language; the highest per trigram travels with the trigram's one aggregate row
            ranks = docs.sparkSession.createDataFrame(list(bit.items()), "lang string, bit int")
            rated = counts.join(F.broadcast(totals.join(ranks, "lang")), "lang").withColumn("rate", F.col("n") / F.col("total"))
            grams = rated.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("bit", "rate")).alias("langs"))
            member = grams.select("gram", F.explode("langs").alias("l"), "top").where(F.col("l.rate") >= share * F.col("top")) \
                .select("gram", F.col("l.bit").alias("bit")).persist()
            most = member.groupBy("bit").count().agg(F.max("count")).first()[0]
            slots = slots_for(most or 0)
            planes = np.zeros((len(planes), slots), np.uint64)
            schema = T.StructType([T.StructField("plane", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("bits", T.LongType())])

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    bits = b.column(1).to_numpy(zero_copy_only=False)
                    for slot in _slots(b.column(0).to_numpy(zero_copy_only=False), slots):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array((bits // 64).astype(np.int32)), pa.array(slot.astype(np.int64)),
                             pa.array((np.uint64(1) << (bits % 64).astype(np.uint64)).view(np.int64))], names=["plane", "slot", "bits"])

            set_bits = member.mapInArrow(run, schema).groupBy("plane", "slot").agg(F.bit_or("bits").alias("bits")).toArrow()
            plane, slot, bits = (set_bits.column(i).to_numpy() for i in range(3))
            planes[plane, slot] = bits.view(np.uint64)
            member.unpersist()
    finally:
        counts.unpersist()
    fill = np.array([(planes[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(by_size))])
    return LanguageFilter(by_size, planes, fill ** PROBES, uuid.uuid4().hex, trigrams)


def _hits(words: list[str], model: LanguageFilter) -> np.ndarray:
    """For each word its number of trigrams and its hits by language."""
    grams, per_word = _trigrams(words)
    slots = [s.astype(np.int64) for s in _slots(grams, model.planes.shape[1])]
    out = np.zeros((len(words), 1 + len(model.languages)), np.int32)
    out[:, 0] = per_word
    of_gram = np.repeat(np.arange(len(words)), per_word)
    for j, plane in enumerate(model.planes):
        mask = plane[slots[0]]
        for s in slots[1:]:
            mask = mask & plane[s]
        for i in range(64 * j, min(64 * (j + 1), len(model.languages))):
            out[:, 1 + i] = np.bincount(of_gram, (mask >> np.uint64(i % 64) & np.uint64(1)).astype(np.int8), len(words))
    return out


def decide(counts: np.ndarray, model: LanguageFilter) -> tuple[np.ndarray, np.ndarray]:
    """Position of the language (-1: none) and score, from rows of (trigrams, hits...)."""
    n = counts[:, :1].astype(np.float64)
    if not model.languages:
        return np.full(len(counts), -1), np.zeros(len(counts))
    p = model.false_rate
    true = np.clip((counts[:, 1:] - n * p) / np.maximum(1 - p, 1e-9), 0, None)
    best = true.argmax(axis=1)
    score = np.clip(true.max(axis=1) / np.maximum(n[:, 0], 1), 0, 1)
    none = n[:, 0] == 0
    return np.where(none, -1, best), np.where(none, 0.0, score)


def predict(docs: DataFrame, model: LanguageFilter, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``columns``) with lang_pred (string) and score (double)."""
    # plain arrays and names: executors need not know the class to read them
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.planes, model.false_rate, model.key))
    keep = [c for c in columns or docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageFilter(*shared.value)
        names = np.array([*model.languages, UNKNOWN], object)
        memory = worker_memory("language")
        if memory.get("lang_key") != model.key:
            memory.update(lang_key=model.key, lang_words={}, lang_rows=np.zeros((0, 1 + len(model.languages)), np.int32))
        for rows, data, off in text_slices(batches, text_col):
            words, which, first = distinct_words(data, off)
            known, table = memory["lang_words"], memory["lang_rows"]
            if len(known) > CACHED_WORDS:
                known, table = {}, table[:0]
            new = [w for w in words if w not in known]
            if new:
                known.update(zip(new, range(len(table), len(table) + len(new))))
                table = np.concatenate([table, _hits(new, model)])
            memory.update(lang_words=known, lang_rows=table)
            total = np.zeros((rows.num_rows, table.shape[1]), np.int64)
            some = np.flatnonzero(np.diff(first))
            if len(some):
                at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                total[some] = np.add.reduceat(table[at[which]], first[some], axis=0, dtype=np.int64)
            best, score = decide(total, model)
            yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.names.index(c)) for c in keep), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                                             names=[*keep, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids kept out of training: crc32 of the id's text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
