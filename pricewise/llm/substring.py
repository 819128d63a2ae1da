"""Substring dedup: compressed FM-index per shard, matching statistics by backward search.

A window of WINDOW words that starts anywhere else too, in the same document or another,
is repeated, and each word under a repeated window is removed. An index of one shard
against all documents would need every (shard, document) pair, so documents are dealt
so that a window meets all its equals in one shard:

1. Anchors. Every window has an anchor, the run of M[0] words with the least hash (see
   ``windows``). One pass counts the anchors (combined in the task, then by Spark). An
   anchor seen once belongs to no repeated window.
2. Stretches. A second pass sends the words of each stretch of windows whose anchor is
   seen more often to the anchor's shard; a task sends a text at most once, and once
   more, without its words, if it sees it again.
3. Shards. A task takes its anchors in order until SHARD_WORDS words are together,
   builds the FM-index of the different texts and streams them through it. Texts that
   came more than once are repeated as a whole.
4. An anchor with more than SHARD_WORDS words of different texts is not indexed at once:
   its texts are dealt again by anchors of longer runs (M[1], and last the whole window,
   where equal keys mean equal windows). So tasks stay bounded and no row is dropped.
5. Flags. A third pass finds the flagged stretches in the documents again; flags are
   joined by (anchor, text hash) and gathered by document, and the documents are joined
   once to cut the words.

The bitmaps that choose what to send have a fixed size (BITMAP_BITS); a fuller one sends
more and loses nothing.

Edge cases: null and empty texts have no words and give empty text; texts shorter than a
window lose nothing; repeated rows are repeats of each other and lose all windows; null
doc_ids take part; rows of one id with different texts are told apart by the text's
hash; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, distinct_words, normal_bytes, ramp, text_slices, words_of
from .fmindex import FMIndex, repeated_windows
from .windows import WINDOW, stretches, word_hashes

#: Words of a run whose least hash is the anchor, by level.
M = (8, 20, WINDOW)
SHARD_WORDS = 1_500_000
BITMAP_BITS = 1 << 27
#: Texts a task remembers to have sent; emptied beyond it, which only sends more.
REMEMBERED = 2_000_000

#: Larger slices share the work on repeated words; the passes hold little else.
SLICE, SLICE_ROWS = 3 << 20, 1024

_KEYS = ["anchor", "text_hash"]


def _in_bitmap(bits: np.ndarray, a: np.ndarray) -> np.ndarray:
    at = a & np.uint64(BITMAP_BITS - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bitmap(anchors: DataFrame) -> np.ndarray:
    """Bits of the anchors: BITMAP_BITS / 64 longs at most reach the driver."""
    word = F.shiftrightunsigned("anchor", 6).bitwiseAND(F.lit(BITMAP_BITS // 64 - 1).cast("long"))
    bit = F.expr("shiftleft(1L, cast(anchor & 63L as int))")
    rows = anchors.select(word.alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.uint64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return out


def _stretches_of(data: np.ndarray, off: np.ndarray, level: int):
    """Distinct words, each word's number, its hash, and the stretches of the rows."""
    words, which, first = distinct_words(data, off, as_bytes=True)
    h = word_hashes(words, level + 1)[which] if words else np.zeros(0, np.uint64)
    return words, which, first, h, stretches(h, first, M[level])


def _text_hash(h: np.ndarray, begin: int, end: int) -> int:
    return xxhash.xxh64_intdigest(h[begin:end].tobytes(), 3)


def _anchor_counts(docs: DataFrame) -> DataFrame:
    """(anchor, n): anchors of the texts; n is 1, or 2 for more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, off in text_slices(batches, "text", SLICE, SLICE_ROWS):
            anchor, n = np.unique(_stretches_of(data, off, 0)[4][0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], names=["anchor", "n"])

    return docs.select("text").mapInArrow(run, "anchor long, n byte").groupBy("anchor").agg(F.sum("n").alias("n"))


def _sent_stretches(docs: DataFrame, live) -> DataFrame:
    """(anchor, text_hash, n, text) of the stretches of live anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for _, data, off in text_slices(batches, "text", SLICE, SLICE_ROWS):
            words, which, _, h, (anchor, begin, size) = _stretches_of(data, off, 0)
            if len(seen) > REMEMBERED:
                seen.clear()
            out = []
            for k in np.flatnonzero(_in_bitmap(live.value, anchor)).tolist():
                a, b = int(begin[k]), int(begin[k] + size[k] + WINDOW - 1)
                key = (int(anchor[k]), _text_hash(h, a, b))
                times = seen.get(key, 0)
                if times < 2:
                    seen[key] = times + 1
                    out.append((*key, None if times else b" ".join([words[i] for i in which[a:b].tolist()]).decode()))
            if out:
                a, t, text = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(np.array(t, np.uint64).view(np.int64)),
                                                  pa.array(np.ones(len(out), np.int8)), pa.array(text, pa.string())], names=["anchor", "text_hash", "n", "text"])

    return docs.select("text").mapInArrow(run, "anchor long, text_hash long, n byte, text string")


def _flag_long(flags: np.ndarray) -> np.ndarray:
    """Flags of up to 64 windows as one long."""
    wide = np.zeros((len(flags), 64), np.uint8)
    wide[:, :flags.shape[1]] = flags
    return np.packbits(wide, axis=1, bitorder="little").view(np.int64).ravel()


def _judge_shard(texts: list[str], times: np.ndarray) -> np.ndarray:
    """Flags of the different texts of a shard."""
    arr = pa.array(texts, pa.large_string())
    words, which, first = distinct_words(np.frombuffer(arr.buffers()[2], np.uint8), np.frombuffer(arr.buffers()[1], np.int64)[:len(arr) + 1])
    length = np.diff(first)
    begin = first[:-1] + np.arange(len(length))  # one separator after each text
    s = np.zeros(len(which) + len(length), np.int64)
    s[ramp(begin, length)] = which + 1
    flags = np.zeros((len(texts), 64), bool)
    again = times > 1
    flags[again] = np.arange(64)[None, :] < (length[again] - WINDOW + 1)[:, None]
    once = np.flatnonzero(~again)
    if len(once):
        found = repeated_windows(FMIndex(s, len(words) + 1), s, begin[once], length[once], WINDOW)
        flags[once, :found.shape[1]] = found
    return _flag_long(flags)


def _judge(rows: DataFrame, level: int, shard_words: int) -> DataFrame:
    """(anchor, text_hash, flags) of the texts with a repeated window. ``rows``: anchor,
    text_hash, n, text, a text being given by at least one row of its key."""
    last = level == len(M) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple] = []
        texts: list[str] = []
        times: list[int] = []
        counts = {"words": 0, "of_anchor": 0}
        hot: int | None = None  # anchor whose texts are put off

        def batch(rows):
            a, t, f, n, x = zip(*rows) if rows else ((),) * 5
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(t, pa.int64()), pa.array(f, pa.int64()), pa.array(n, pa.int8()), pa.array(x, pa.string())],
                                              names=["anchor", "text_hash", "flags", "n", "text"])

        def judged(upto: int):
            if not upto:
                return []
            flags = _judge_shard(texts[:upto], np.array(times[:upto])).tolist()
            out = [(*k, f, None, None) for k, f in zip(keys, flags) if f]
            del keys[:upto], texts[:upto], times[:upto]
            return out

        for b in batches:
            for anchor, text_hash, n, text in zip(*(c.to_pylist() for c in b.columns)):
                key = (anchor, text_hash)
                if keys and keys[-1] == key:
                    times[-1] = min(2, times[-1] + n)
                    continue
                if keys and keys[-1][0] != anchor:
                    if hot is not None:
                        yield batch([(*k, None, t, x) for k, t, x in zip(keys, times, texts)])
                        for held in (keys, texts, times):
                            held.clear()
                        counts["words"], hot = 0, None
                    counts["of_anchor"] = 0
                    if counts["words"] >= shard_words:
                        yield batch(judged(len(keys)))
                        counts["words"] = 0
                keys.append(key)
                texts.append(text)
                times.append(min(2, n))
                size = text.count(" ") + 1
                counts["words"] += size
                counts["of_anchor"] += size
                if not last and counts["of_anchor"] > shard_words:
                    if hot is None:  # what came before this anchor is a shard of its own
                        first = next(i for i, k in enumerate(keys) if k[0] == anchor)
                        yield batch(judged(first))
                        hot = anchor
                    if len(keys) > 4096:
                        yield batch([(*k, None, t, x) for k, t, x in zip(keys[:-1], times, texts)])
                        for held in (keys, texts, times):
                            del held[:-1]
        yield batch([(*k, None, t, x) for k, t, x in zip(keys, times, texts)] if hot is not None else judged(len(keys)))

    dealt = rows.select(*_KEYS, "n", "text").repartition("anchor").sortWithinPartitions("anchor", "text_hash", F.col("text").isNull())
    out = cut_lineage(dealt.mapInArrow(run, "anchor long, text_hash long, flags long, n byte, text string"), "judged")
    done = out.where("text is null").select(*_KEYS, "flags")
    put_off = out.where("text is not null")
    if last or put_off.isEmpty():
        return done
    finer = cut_lineage(_finer(put_off, level + 1), "finer")
    own = _judge(finer.select("anchor", "text_hash", "n", "text"), level + 1, shard_words)
    back = (finer.select(*_KEYS, "up_anchor", "up_hash", "shift").join(own, _KEYS)
            .select(F.col("up_anchor").alias("anchor"), F.col("up_hash").alias("text_hash"), F.expr("shiftleft(flags, shift)").alias("flags"))
            .groupBy(*_KEYS).agg(F.bit_or("flags").alias("flags")))
    return done.unionByName(back)


def _finer(rows: DataFrame, level: int) -> DataFrame:
    """The stretches of put-off texts under the next level's anchors, with what they are part of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, off in text_slices(batches, "text", SLICE, SLICE_ROWS):
            words, which, first, h, (anchor, begin, size) = _stretches_of(data, off, level)
            row = np.searchsorted(first, begin, "right") - 1
            ends = begin + size + WINDOW - 1
            up = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor.view(np.int64)), pa.array(np.array([_text_hash(h, a, b) for a, b in zip(begin, ends)], np.uint64).view(np.int64)),
                part.column(2).take(up), pa.array([b" ".join([words[i] for i in which[a:b].tolist()]).decode() for a, b in zip(begin, ends)], pa.string()),
                part.column(0).take(up), part.column(1).take(up), pa.array((begin - first[row]).astype(np.int32))],
                names=["anchor", "text_hash", "n", "text", "up_anchor", "up_hash", "shift"])

    return rows.select(*_KEYS, "n", "text").mapInArrow(run, "anchor long, text_hash long, n byte, text string, up_anchor long, up_hash long, shift int")


def _places(docs: DataFrame, flagged) -> DataFrame:
    """(anchor, text_hash, id, key, begin): stretches of flagged anchors in the documents."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("id", docs.schema["id"].dataType),
                           T.StructField("key", T.LongType()), T.StructField("begin", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in text_slices(batches, "text", SLICE, SLICE_ROWS):
            _, _, first, h, (anchor, begin, size) = _stretches_of(data, off, 0)
            hit = np.flatnonzero(_in_bitmap(flagged.value, anchor))
            if not len(hit):
                continue
            anchor, begin, size = anchor[hit], begin[hit], size[hit]
            row = np.searchsorted(first, begin, "right") - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor.view(np.int64)), pa.array(np.array([_text_hash(h, a, b) for a, b in zip(begin, begin + size + WINDOW - 1)], np.uint64).view(np.int64)),
                rows.column(0).take(pa.array(row)), rows.column(2).take(pa.array(row)), pa.array((begin - first[row]).astype(np.int32))], schema=pa.schema(
                    [("anchor", pa.int64()), ("text_hash", pa.int64()), ("id", rows.schema.field(0).type), ("key", pa.int64()), ("begin", pa.int32())]))

    return docs.mapInArrow(run, schema)


def _cut(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, text) from rows with their flags."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in text_slices(batches, "text", SLICE, SLICE_ROWS):
            starts, ends, first = words_of(data, off)
            n_words = np.diff(first)
            cover = np.zeros(len(starts) + 1, np.int64)
            flags = rows.column(2)
            for r in np.flatnonzero(np.asarray(flags.is_valid())).tolist():
                for f in flags[r].as_py():
                    bits = np.flatnonzero(np.unpackbits(np.array([f["flags"]], np.int64).view(np.uint8), bitorder="little"))
                    at = first[r] + f["begin"] + bits
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + WINDOW, -1)
            kept = np.cumsum(cover[:-1]) == 0
            norm, at = normal_bytes(data, starts[kept], ends[kept])
            total = np.concatenate([[0], np.cumsum(kept)])
            raw = norm.tobytes()
            texts = [raw[at[a]:at[b] - 1].decode() if b > a else "" for a, b in zip(total[first[:-1]].tolist(), total[first[1:]].tolist())]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n_words), pa.array(n_words - np.diff(total[first])), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "text"])

    return docs.select("id", "text", "flags").mapInArrow(run, schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, text): every row's text without the words under
    repeated windows; kept words are joined by one space."""
    share = docs.sparkSession.sparkContext.broadcast  # bitmaps: BITMAP_BITS each
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    live = share(_bitmap(_anchor_counts(texts).where("n > 1")))
    flags = cut_lineage(_judge(_sent_stretches(texts, live), 0, shard_words), "flags")
    flagged = share(_bitmap(flags.select("anchor")))
    keyed = texts.withColumn("key", _key(F.col("text")))
    per_doc = (_places(keyed, flagged).join(flags, _KEYS).select("id", "key", F.struct("begin", "flags").alias("f"))
               .groupBy("id", "key").agg(F.collect_set("f").alias("flags"))
               .select(F.col("id").alias("i"), F.col("key").alias("k"), "flags"))
    marked = keyed.join(per_doc, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left")
    return _cut(marked.select("id", "text", "flags"))


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))
