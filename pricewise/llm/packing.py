"""Sum-of-squares packing of tokenised documents into training sequences.

``token_pieces`` cuts every document into pieces of at most ``capacity`` tokens
(map only); ``pack`` places pieces into sequences. A piece goes where the sum over
all residual gaps g of N(g)^2 becomes smallest, N(g) being the number of open
sequences with gap g: balanced gap counts keep a partner for every later length.

Scale: ``pack`` moves one small row per piece (never the ids) to groups of about
GROUP_ROWS pieces, dealt by a hash of the piece, and each group is packed by one
task in bounded memory. The number of groups follows the input.

Within a group pieces come by falling length (ties: key columns), so a rerun of a
lost task gives the same placement.

Edge cases: null text is the empty document (one piece: the closing id 0); a row
repeated is packed twice; an empty table gives an empty result; input columns named
like a result column are replaced by it; other columns pass through.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, split_rows, text_slices, worker_memory

CAPACITY = 2048
GROUP_ROWS = 1 << 16
#: Words whose ids a task remembers; beyond it the memory is emptied, not the result.
CACHED_WORDS = 300_000
_NONE = np.iinfo(np.int64).max


#: Marks that the vocabulary's splitting rule always parts from a letter before them
#: (an apostrophe may stay with it; angle brackets and bars occur in special tokens).
_MARKS = """.,;:!?#*&%$"()[]{}/=+~^@_-"""


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet of the vocabulary by code point of the latin-1 reading:
    printable bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


class _Words(dict):
    """Ids (little-endian uint32 bytes) by word.

    The vocabulary drops white space and cuts at it, so a text's ids are its words'
    ids in order, and each different word is encoded once. A word of letters alone is
    one unit for the merges, so it goes straight to the tokenizer's model; anything
    else takes the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.units: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _unit(self, unit: str) -> bytes:
        ids = self.units.get(unit)
        if ids is None:
            # the sigma's lower case depends on its place in a text
            low = unicodedata.normalize("NFC", unit).lower() if unit.isalpha() and "\u03a3" not in unit else ""
            if low.isalpha():
                shown = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
                ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            else:
                ids = self._encode(unit)
            self.units[unit] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(self.units) > CACHED_WORDS:
            self.units.clear()
        text = word.decode()
        core = text.rstrip(_MARKS)
        if core and core[-1].isalpha() and len(core) < len(text):
            ids = self._unit(core) + self._unit(text[len(core):])
        else:
            ids = self._unit(text)
        self[word] = ids
        return ids


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): ``ids`` holds little-endian unsigned 32-bit
    token ids; every document ends with id 0, and only documents longer than
    ``capacity`` are cut."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = worker_memory("tokens")
        if tokenizer_path not in memory:
            memory[tokenizer_path] = _Words(tokenizer_path)
        words = memory[tokenizer_path]
        step = 4 * capacity
        for rows, data, off in text_slices(batches, "text"):
            raw = data.tobytes()
            which, piece, start, ids = [], [], [], []
            for k, (a, b) in enumerate(zip(off[:-1], off[1:])):
                all_ids = b"".join(map(words.__getitem__, raw[a:b].split())) + b"\0\0\0\0"
                for j, at in enumerate(range(0, len(all_ids), step)):
                    which.append(k)
                    piece.append(j)
                    start.append(at // 4)
                    ids.append(all_ids[at:at + step])
            keys = rows.column(0).take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, in the order given.

    Moving one open sequence from gap g to gap g - s changes the sum of squared
    counts by 2 (N(g - s) - N(g)) + 2; a full sequence is closed and counts no more.
    Of equal choices the smallest gap is taken. A new sequence is begun only where
    no open one has room: with falling lengths that needs the fewest sequences.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    seq = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    bins = 0
    for i, s in enumerate(lengths.tolist()):
        gaps = count[s:capacity]
        change = 2 * (count[:capacity - s] - gaps) + 2
        if len(change):
            change[0] = 1 - 2 * gaps[0]  # closes a sequence
            change[gaps == 0] = _NONE
        k = int(change.argmin()) if len(change) else 0
        if len(change) and change[k] != _NONE:
            gap = s + k
            b = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, bins
            bins += 1
        seq[i], offset[i] = b, capacity - gap
        rest = gap - s
        if rest:
            count[rest] += 1
            open_by_gap[rest].append(b)
    return seq, offset


def pack(pieces: DataFrame, keys: list[str], length_col: str = "length", capacity: int = CAPACITY,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (lengths 1 to ``capacity``) with sequence_id and offset.

    ``keys`` identify a piece; they deal out the groups and break ties of length.
    """
    pieces = cut_lineage(pieces.drop("sequence_id", "offset"), "pieces")
    groups = split_rows(pieces.sparkSession, pieces.count(), group_rows)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(group: pa.Table) -> pa.Table:
        number = group.column("__group")[0].as_py()
        group = group.drop_columns(["__group"]).sort_by([(length_col, "descending"), *((k, "ascending") for k in keys)])
        seq, offset = sum_of_squares(group.column(length_col).to_numpy(), capacity)
        return group.append_column("sequence_id", pa.array(seq + (number << 40))).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("long"))
    return dealt.groupBy("__group").applyInArrow(run, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, from placed pieces
    that still carry ``ids``; a sequence holds at most ``capacity`` tokens."""
    return (placed.groupBy("sequence_id")
            .agg(F.sum("length").alias("length"),
                 F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("__parts"))
            .select("sequence_id", "length",
                    F.aggregate("__parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")))
