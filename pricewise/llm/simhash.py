"""SimHash near-duplicates through a segment-popcount embedding.

``fingerprints`` gives every document its 64-bit SimHash (map only). ``link`` finds
all pairs of fingerprints with at most ``max_distance`` differing bits:

1. Embedding: a fingerprint becomes the vector of the bit counts of its short
   segments. One differing bit moves one count by at most one, so the Manhattan
   distance of two vectors never exceeds the bit distance.
2. Grid range-join: the segments form ``groups`` bands. A Manhattan distance of d
   touches at most d bands, so two near vectors agree on all counts of some choice of
   ``groups - d`` bands. The cells of the grid are these counts for each choice;
   near fingerprints share a cell.
3. Inside a cell, pairs within Manhattan distance d are verified by their exact bit
   distance. A cell of up to SMALL_CELL members gives its verified pairs, a larger
   one the links of a spanning forest, at most one per member.

Equal fingerprints are one node before the join, however many documents hold them.
A cell whose members are mostly near each other (a large group of near copies) is
searched from one member after the other against those not yet reached, which
shrinks fast; members are compared in blocks of bounded size. Nothing is capped.

``cluster`` joins the links to components and returns one row per document.

Edge cases: null and empty texts have no words and fingerprint zero, and link like
any other; one or two words form one shingle; repeated rows are kept, each its row;
null doc_ids take part, and a component of null ids alone has id null; an empty table
gives an empty result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, normal_bytes, text_slices, words_of
from .graph import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
HASH_SEED = 42
SEGMENT_BITS = 2
GROUPS = 6
#: Members of a cell up to which all its pairs are formed at once.
SMALL_CELL = 32
#: Members compared with one member at a time in a larger cell.
BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash): the SimHash as a signed long and a hash of the text, which
    tells rows of one id apart. Words are parted by the characters
    0x20 and 0x09 to 0x0D after A-Z are lower-cased; shingles count with repeats."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType()), T.StructField("text_hash", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest
        for rows, data, off in text_slices(batches, "text"):
            starts, ends, first = words_of(data, off)
            norm, at = normal_bytes(_LOWER[data], starts, ends)
            raw = norm.tobytes()
            n_words = np.diff(first)
            n = np.where(n_words > 0, np.maximum(n_words - shingle_words + 1, 1), 0)
            begin = np.repeat(first[:-1] - np.cumsum(n) + n, n) + np.arange(n.sum())
            stop = np.minimum(begin + shingle_words, np.repeat(first[1:], n))
            h = np.fromiter((digest(raw[a:b], HASH_SEED) for a, b in zip(at[begin].tolist(), (at[stop] - 1).tolist())), np.uint64, len(begin))
            edges = np.concatenate([[0], np.cumsum(n)])
            fp = np.array([_majority(h[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], np.uint64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fp.view(np.int64)), rows.column(2)], names=["doc_id", "fp", "text_hash"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(run, schema)


def _majority(h: np.ndarray) -> int:
    """The number whose bits are set in over half of h (0 for none); in pieces, so that
    the bits of a very long text are never spread out at once."""
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def popcount_embedding(fp: Column) -> Column:
    """The bit counts (0 to 2) of the 32 two-bit segments, side by side in one long."""
    odd = F.lit(0x5555555555555555).cast("long")
    up = F.shiftrightunsigned(fp, 1)
    return F.shiftleft(fp.bitwiseAND(up).bitwiseAND(odd), 1).bitwiseOR(fp.bitwiseXOR(up).bitwiseAND(odd))


def _counts(x: np.ndarray) -> np.ndarray:
    """The same vector as one small integer per segment."""
    seg = (x.view(np.uint8).reshape(-1, 8)[:, :, None] >> np.arange(0, 8, SEGMENT_BITS, dtype=np.uint8)) & np.uint8(3)
    return np.bitwise_count(seg).reshape(len(x), -1).astype(np.int8)


def band_choices(groups: int = GROUPS, max_distance: int = MAX_DISTANCE) -> list[int]:
    """For each choice of ``groups - max_distance`` bands, the bits of the embedding they hold."""
    segments = 64 // SEGMENT_BITS
    if not max_distance < groups <= segments:
        raise ValueError("there must be more bands than differing bits, and a segment for each")
    edges = [i * segments // groups * SEGMENT_BITS for i in range(groups + 1)]
    bands = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(bands, groups - max_distance)]


def _forest(x: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that connect what is connected in a cell, at most one per member:
    breadth-first, each member compared with those that no other has reached."""
    vec = _counts(x)
    left = np.arange(len(x))
    src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    frontier: list[int] = []
    while len(left):
        if not frontier:
            frontier, left = [int(left[0])], left[1:]
        a = frontier.pop()
        stay = []
        for lo in range(0, len(left), BLOCK):
            part = left[lo:lo + BLOCK]
            near = part[np.abs(vec[part] - vec[a]).sum(axis=1) <= max_distance]
            hit = near[np.bitwise_count(x[near] ^ x[a]) <= max_distance]
            if len(hit):
                src.append(np.full(len(hit), a))
                dst.append(hit)
                frontier.extend(hit.tolist())
                part = np.setdiff1d(part, hit, assume_unique=True)
            stay.append(part)
        left = np.concatenate([left[:0], *stay])
    return np.concatenate(src), np.concatenate(dst)


def _cell_links(cell: np.ndarray, x: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints x (sorted by cell)."""
    edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
    size = np.diff(edge)
    out_a, out_b = [], []
    small = np.repeat((size > 1) & (size <= SMALL_CELL), size)
    for shift in range(1, min(SMALL_CELL, int(size.max(initial=1)))):
        a = np.flatnonzero(small[:-shift] & (cell[:-shift] == cell[shift:]))
        if not len(a):
            break
        b = a + shift
        near = np.abs(_counts(x[a]) - _counts(x[b])).sum(axis=1) <= max_distance
        a, b = a[near], b[near]
        hit = np.bitwise_count(x[a] ^ x[b]) <= max_distance
        out_a.append(x[a[hit]])
        out_b.append(x[b[hit]])
    for k in np.flatnonzero(size > SMALL_CELL):
        part = x[edge[k]:edge[k + 1]]
        a, b = _forest(part, max_distance)
        out_a.append(part[a])
        out_b.append(part[b])
    z = np.zeros(0, np.uint64)
    return np.concatenate([z, *out_a]), np.concatenate([z, *out_b])


def link(fps: DataFrame, max_distance: int = MAX_DISTANCE, groups: int = GROUPS) -> DataFrame:
    """(u, v): links that connect all fingerprints within ``max_distance`` bits of each
    other. ``fps`` holds distinct longs in column fp.

    The rows of a cell are met by one task in sorted order, a cell at a time. More
    bands make smaller cells and more rows.
    """
    choices = band_choices(groups, max_distance)
    vec = popcount_embedding(F.col("fp"))
    cells = F.array(*(F.xxhash64(F.lit(i), vec.bitwiseAND(F.lit(_signed(m)).cast("long"))) for i, m in enumerate(choices)))
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, x = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(c, f):
            a, b = _cell_links(c, f, max_distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy(zero_copy_only=False)])
            x = np.concatenate([x, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0  # the last cell may go on
            if whole:
                yield links(cell[:whole], x[:whole])
                cell, x = cell[whole:], x[whole:]
        if len(cell):
            yield links(cell, x)

    dealt = fps.select(F.explode(cells).alias("cell"), "fp").repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(run, schema)


def cluster(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash, component_id) for every row: component_id is the smallest doc_id of
    all documents reachable over links, the row's own included."""
    fps = cut_lineage(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = link(classes.select("fp"), max_distance)
    comp = cut_lineage(connected_components(links).select(F.col("node").alias("fp"), "label"), "components")
    named = classes.join(comp, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    per_fp = named.select("fp", "label").join(least, "label").select("fp", "component_id")
    return fps.join(per_fp, "fp").select("doc_id", "fp", "text_hash", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of the fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, clustered: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group: that whose id is its component's id.

    Rows are told apart by id and text, so of several texts under one id only those of
    the component named by it are chosen; of these one stays. Rows with a null id cannot
    be named by a component and all stay.
    """
    kept = (clustered.where(F.col("doc_id") == F.col("component_id"))
            .select(F.col("doc_id").alias("__kept_id"), F.col("text_hash").alias("__kept_hash")).distinct())
    chosen = docs.join(kept, (F.col(id_col) == F.col("__kept_id")) & (F.xxhash64(text_col) == F.col("__kept_hash")), "left_semi")
    return chosen.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull()))
