"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Tokenizer A is a byte-level BPE (tokens are bytes; a space is part of the next token),
B a piece BPE with byte fallback (U+2581 stands for a space). Both read space+text.

Whitespace-token anchors. Every document is tokenised in full by A and by B. An anchor is
a byte offset where a token of A and a token of B both end and both next tokens begin
with a space mark; the shared end is verified on the tokens' bytes, never assumed. The
anchors cut the two id sequences into windows, and a window's alignment depends on its
id tuples alone, so it is computed once per pair of id tuples and remembered. Inside a
window the shared ends cut the tokens into groups; every A token of a group is linked
with every B token of it.

Full tokenisation is cheap because both tokenizers restart at a single space between
two characters that are not white space: A's splitting rule begins a new unit there, and
no piece of B holds a space mark behind another character (checked when the vocabulary
is loaded; otherwise whole texts are encoded). So ids are remembered by the stretch
between two such spaces. These memories are caches: bounded, cut down when full to what
was met again since the last time, and without influence on results.

Links of the corpus. ``align`` writes one row per block of documents (about BLOCK_BYTES
of text, or one longer document) to the shared folder: the documents' counts, the different id
pairs of the block with the number of its documents that hold them, and each document's
pairs as positions in that list. ``link_counts`` adds the blocks' counts up per pair (an
id pair in every document is one row per block), takes each A id's highest, and hands
every block the figures of its own pairs; ``score`` sums them by document. No table of
pairs is broadcast or collected, and no task holds more than a block.

Edge cases: a null or empty text, and one that the two tokenizers do not give back byte
for byte (a U+2581 in it, for instance), has no tokens: zeros and an empty digest;
strings of special tokens are plain text; repeated rows count as documents each; null
ids pass through; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, ramp, text_slices, worker_memory

SPACE_MARK = "▁"
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
#: Stretches and windows a Python worker remembers; cut down beyond it.
CACHED = 200_000


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable bytes stand for
    themselves, the others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """A: ids of a text and the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has its core, not the machine
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab = {**model["model"]["vocab"], **{t["content"]: t["id"] for t in model.get("added_tokens", [])}}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(map(alphabet.__getitem__, token)) if all(c in alphabet for c in token) else token.encode()

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokenizer:
    """B: ids of a text (it sets a space before it) and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece
        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.tokenizer.id_to_piece(i) for i in range(self.tokenizer.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.tokenizer.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        #: whether no piece reaches over a space from a character before it
        self.restarts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.tokenizer.encode(texts, num_threads=1)]


def stretches(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``data`` holds space+text of each row. Starts (with the total at the end) of the
    stretches that both tokenizers read alone, and the first stretch of each row.

    A stretch begins at every row and at a space between two characters that surely are
    no white space of any script (what is unsure is left inside a stretch).
    """
    n = len(data)
    wide = np.zeros(n + 2, bool)  # first bytes of characters that may be white space beyond ASCII
    first, second = data[:-1], data[1:]
    wide[:max(n - 1, 0)] = ((first == 0xC2) & ((second == 0x85) | (second == 0xA0))) | \
        ((first >= 0xE1) & (first <= 0xE3) & ((second == 0x80) | (second == 0x81) | (second == 0x9A) | (second == 0xA0)))
    blank = (data <= 0x20) | (data == 0x7F)
    space = np.flatnonzero(data == 0x20)
    space = space[(space > 0) & (space < n - 1)]
    two, three = np.maximum(space - 2, 0), np.maximum(space - 3, 0)
    good = ~blank[space - 1] & ~blank[space + 1] & ~wide[space + 1] & ~wide[two] & ~wide[three]
    starts = np.union1d(space[good], off[:-1][np.diff(off) > 0])
    return np.concatenate([starts, [n]]), np.searchsorted(starts, off)


@dataclass
class Alignment:
    """Alignments of windows, as flat arrays with offsets by window."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pair: np.ndarray  # A id << 32 | B id, different ones of each window
    times: np.ndarray  # how many links of the window have the pair
    pair_off: np.ndarray
    text: list[bytes]  # groups as text


def _counts_by(which: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(which, minlength=n).astype(np.int64)


class Sides:
    """Both vocabularies in a form numpy can read: byte lengths, all bytes, ids as text."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.length, self.flat, self.at, self.space = [], [], [], []
        for side in (a_bytes, b_bytes):
            length = np.array([len(x) for x in side], np.int64)
            self.length.append(length)
            self.at.append(np.concatenate([[0], np.cumsum(length)]))
            self.flat.append(np.frombuffer(b"".join(side), np.uint8))
            self.space.append(np.array([x[:1] == b" " for x in side], bool))
        digits = [str(i).encode() for i in range(max(len(a_bytes), len(b_bytes)))]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_len = np.array([len(d) for d in digits], np.int64)
        self.digit_at = np.concatenate([[0], np.cumsum(self.digit_len)])

    def joined(self, side: int, ids: np.ndarray) -> np.ndarray:
        return self.flat[side][ramp(self.at[side][ids], self.length[side][ids])]


def align_windows(windows: list[tuple[bytes, bytes]], sides: Sides) -> Alignment:
    """The alignment of each (A ids, B ids); both sides of a window cover the same bytes."""
    n = len(windows)
    ids = [np.frombuffer(b"".join(w[k] for w in windows), np.uint32).astype(np.int64) for k in (0, 1)]
    size = [np.array([len(w[k]) // 4 for w in windows], np.int64) for k in (0, 1)]
    of = [np.repeat(np.arange(n), s) for s in size]
    ends = [np.cumsum(sides.length[k][ids[k]]) for k in (0, 1)]  # windows tile one byte line, the same for both sides
    last = [np.append(e[1:] != e[:-1], True) if len(e) else np.zeros(0, bool) for e in ends]  # of tokens without bytes, the last ends there
    shared = np.intersect1d(ends[0][last[0]], ends[1][last[1]], assume_unique=True)
    group = [np.searchsorted(shared, e, "left") for e in ends]
    per = [_counts_by(g, len(shared)) for g in group]
    group_window = of[0][np.searchsorted(group[0], np.arange(len(shared)))] if len(shared) else np.zeros(0, np.int64)
    links = per[0] * per[1]
    # different ids of a group with their counts, then the pairs of these
    uniq = []
    for k in (0, 1):
        u, times = np.unique(group[k] << 32 | ids[k], return_counts=True)
        uniq.append((u >> 32, u & 0xFFFFFFFF, times))
    of_b = _counts_by(uniq[1][0], len(shared))
    b_at = np.concatenate([[0], np.cumsum(of_b)])
    repeat = of_b[uniq[0][0]]
    b_row = ramp(b_at[uniq[0][0]], repeat)
    a_row = np.repeat(np.arange(len(repeat)), repeat)
    pair = uniq[0][1][a_row] << 32 | uniq[1][1][b_row]
    times = uniq[0][2][a_row] * uniq[1][2][b_row]
    window = group_window[uniq[0][0][a_row]] if len(a_row) else np.zeros(0, np.int64)
    order = np.lexsort((pair, window))
    pair, times, window = pair[order], times[order], window[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (window[1:] != window[:-1])
    at = np.flatnonzero(new)
    times = np.add.reduceat(times, at) if len(at) else times
    pair_off = np.concatenate([[0], np.cumsum(_counts_by(window[at], n))])
    # text: tokens in the order (group, side, place), each with the sign behind it
    token_group = np.concatenate(group)
    token_id = np.concatenate(ids)
    side = np.repeat([0, 1], [len(ids[0]), len(ids[1])])
    order = np.argsort(token_group * 2 + side, kind="stable")
    token_group, token_id, side = token_group[order], token_id[order], side[order]
    sign = np.full(len(token_id), ord(","), np.uint8)
    if len(token_id):
        turn = np.append((side[1:] != side[:-1]) | (token_group[1:] != token_group[:-1]), True)
        sign[turn & (side == 0)] = ord("|")
        sign[turn & (side == 1)] = ord(";")
    width = sides.digit_len[token_id]
    stop = np.cumsum(width + 1)
    chars = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    chars[stop - 1] = sign
    chars[ramp(stop - 1 - width, width)] = sides.digits[ramp(sides.digit_at[token_id], width)]
    raw = chars.tobytes()
    text_size = np.bincount(group_window[token_group], width + 1, minlength=n).astype(np.int64) if len(token_id) else np.zeros(n, np.int64)
    cut = np.concatenate([[0], np.cumsum(text_size)]).tolist()
    return Alignment(size[0], size[1], _counts_by(group_window, n), np.bincount(group_window, links, minlength=n).astype(np.int64),
                     pair[at], times, pair_off, [raw[i:j] for i, j in zip(cut[:-1], cut[1:])])


class _Growing:
    """An array that grows at its end."""

    def __init__(self):
        self.held, self.n = np.empty(1 << 12, np.int64), 0

    def add(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.held):
            self.held = np.concatenate([self.held[:self.n], np.empty(max(end, 2 * self.n) - self.n, np.int64)])
        self.held[self.n:end] = values
        self.n = end

    @property
    def values(self) -> np.ndarray:
        return self.held[:self.n]


class Aligner:
    """What one Python worker remembers: ids by stretch, alignments by window."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokenizer(byte_path), PieceTokenizer(piece_path)
        self.sides = Sides(self.a.bytes, self.b.bytes)
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, tuple] = {}  # stretch -> its windows' numbers, or () if the bytes do not come back
        self.met: set[bytes] = set()  # stretches met again since the memory was last cut down
        self.windows: dict[tuple[bytes, bytes], int] = {}
        self.columns = {c: _Growing() for c in ("n_a", "n_b", "n_groups", "n_links", "pair", "times", "pair_off")}
        self.columns["pair_off"].add(np.zeros(1, np.int64))
        self.text: list[bytes] = []

    def shrink(self) -> None:
        """Keep the stretches met again, at most half of what fits, and their windows only."""
        kept = {s: self.ids[s] for s in islice(self.met, CACHED // 2)}
        old, keys, texts = self.table(), list(self.windows), self.text
        number = np.unique(np.fromiter((w for ws in kept.values() for w in ws), np.int64))
        self.clear()
        if len(number) > CACHED // 2:
            return
        of = dict(zip(number.tolist(), range(len(number))))
        self.ids = {s: tuple(map(of.__getitem__, ws)) for s, ws in kept.items()}
        self.windows = {keys[w]: i for w, i in of.items()}
        self.text = [texts[w] for w in of]
        n_pairs = np.diff(old.pair_off)[number]
        at = ramp(old.pair_off[number], n_pairs)
        self.columns["pair_off"].add(np.cumsum(n_pairs))
        for c in ("n_a", "n_b", "n_groups", "n_links"):
            self.columns[c].add(getattr(old, c)[number])
        for c in ("pair", "times"):
            self.columns[c].add(getattr(old, c)[at])

    def learn(self, new: list[bytes]) -> None:
        """Tokenise stretches, verify their bytes, cut them at anchors, align new windows."""
        texts = [s.decode() for s in new]
        a, b = self.a.encode(texts), self.b.encode([t[1:] for t in texts])
        sizes = np.array([len(s) for s in new], np.int64)
        want = np.frombuffer(b"".join(new), np.uint8)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        good = np.ones(len(new), bool)
        line, first, marked = [], [], []
        for k, side in ((0, a), (1, b)):
            ids = np.frombuffer(b"".join(side), np.uint32).astype(np.int64)
            n = np.array([len(s) // 4 for s in side], np.int64)
            at = np.concatenate([[0], np.cumsum(n)])
            length = np.concatenate([[0], np.cumsum(self.sides.length[k][ids])])
            total = length[at[1:]] - length[at[:-1]]
            good &= total == sizes
            line.append((ids, at, length))
            first.append(n > 0)
        for k in (0, 1):  # compare the bytes where the lengths agree
            ids, at, length = line[k]
            rows = np.flatnonzero(good)
            got = self.sides.joined(k, ids[ramp(at[rows], at[rows + 1] - at[rows])])
            same = got == want[ramp(bounds[rows], sizes[rows])]
            if len(rows):
                good[rows] = np.logical_and.reduceat(same, np.concatenate([[0], np.cumsum(sizes[rows])[:-1]]))
        # anchors inside a stretch: shared ends before space-marked tokens of both sides
        cuts = []
        for k in (0, 1):
            ids, at, length = line[k]
            row = np.repeat(np.arange(len(new)), np.diff(at))
            inside = np.ones(len(ids), bool)
            inside[at[:-1][np.diff(at) > 0]] = False
            here = inside & self.sides.space[k][ids] & good[row]
            pos = length[:-1][here] - length[at[row[here]]] + bounds[row[here]]
            cuts.append((pos, np.flatnonzero(here)))
        _, ia, ib = np.intersect1d(cuts[0][0], cuts[1][0], return_indices=True)
        cut_a, cut_b = np.sort(cuts[0][1][ia]), np.sort(cuts[1][1][ib])
        cut_row = np.searchsorted(line[0][1], cut_a, "right") - 1
        has_cut = {}
        for row, x, y in zip(cut_row.tolist(), (4 * (cut_a - line[0][1][cut_row])).tolist(), (4 * (cut_b - line[1][1][cut_row])).tolist()):
            has_cut.setdefault(row, []).append((x, y))
        fresh: list[tuple[bytes, bytes]] = []
        base = len(self.windows)
        for i, s in enumerate(new):
            if not good[i]:
                self.ids[s] = ()
                continue
            if i in has_cut:
                edges = [(0, 0), *has_cut[i], (len(a[i]), len(b[i]))]
                keys = [(a[i][x:x2], b[i][y:y2]) for (x, y), (x2, y2) in zip(edges[:-1], edges[1:])]
            else:
                keys = [(a[i], b[i])]
            numbers = []
            for key in keys:
                w = self.windows.get(key)
                if w is None:
                    w = self.windows[key] = base + len(fresh)
                    fresh.append(key)
                numbers.append(w)
            self.ids[s] = tuple(numbers)
        if fresh:
            new = align_windows(fresh, self.sides)
            self.columns["pair_off"].add(new.pair_off[1:] + self.columns["pair"].n)
            for c in ("n_a", "n_b", "n_groups", "n_links", "pair", "times"):
                self.columns[c].add(getattr(new, c))
            self.text += new.text

    def table(self) -> Alignment:
        """All windows remembered, as one table."""
        return Alignment(text=self.text, **{c: g.values for c, g in self.columns.items()})

    def documents(self, data: np.ndarray, off: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Counts of each row of a slice, its pairs (row, pair, links) and its groups' digest."""
        rows = len(off) - 1
        spaced = np.full(len(data) + rows, 0x20, np.uint8)
        size = np.diff(off)
        new_off = off + np.arange(rows + 1)
        spaced[ramp(new_off[:-1] + 1, size)] = data
        if self.b.restarts:
            starts, first = stretches(spaced, new_off)
        else:
            starts, first = new_off, np.arange(rows + 1)
        arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(np.ascontiguousarray(starts, np.int64)), pa.py_buffer(spaced)])
        coded = arr.dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self.ids) > CACHED or len(self.windows) > CACHED:
            self.shrink()
        unknown = [s for s in distinct if s not in self.ids]
        self.met.update(distinct)
        self.met.difference_update(unknown)
        if unknown:
            self.learn(unknown)
        table = self.table()
        of_distinct = [self.ids[s] for s in distinct]
        n_win = np.array([len(w) for w in of_distinct], np.int64)
        flat = np.fromiter((w for ws in of_distinct for w in ws), np.int64, int(n_win.sum()))
        win_at = np.concatenate([[0], np.cumsum(n_win)])
        row = np.repeat(np.arange(rows), np.diff(first))
        whole = size > 0
        whole[row[n_win[which] == 0]] = False
        keep = whole[row]
        row, which = row[keep], which[keep]
        window = flat[ramp(win_at[which], n_win[which])]
        row = np.repeat(row, n_win[which])
        at = np.searchsorted(row, np.arange(rows + 1))
        counts = {c: np.bincount(row, getattr(table, c)[window], minlength=rows).astype(np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        text = table.text
        digests = []
        numbers = window.tolist()
        for k in range(rows):
            parts = b"".join([text[w] for w in numbers[at[k]:at[k + 1]]])
            digests.append(hashlib.sha256(parts[:-1]).hexdigest() if parts else "")
        # (row, window) with its count, then the window's pairs
        seen, times = np.unique(row * len(table.n_a) + window, return_counts=True)
        row, window = np.divmod(seen, max(len(table.n_a), 1))
        n_pairs = np.diff(table.pair_off)[window]
        at = ramp(table.pair_off[window], n_pairs)
        return counts, np.repeat(row, n_pairs), table.pair[at], table.times[at] * np.repeat(times, n_pairs), digests


@dataclass
class _Block:
    """Documents gathered for one output row."""
    bytes: int = 0
    rows: list = field(default_factory=list)
    docs: int = 0
    row: list = field(default_factory=list)
    pair: list = field(default_factory=list)
    times: list = field(default_factory=list)


def _packed(values: np.ndarray) -> bytes:
    """Small whole numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw, 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of documents, see the module. ``docs`` is read once, map only."""
    doc = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in COUNTS),
                        T.StructField("groups_sha256", T.StringType()), T.StructField("n_pairs", T.LongType())])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(doc)), T.StructField("pairs", T.BinaryType()),
                           T.StructField("pair_docs", T.BinaryType()), T.StructField("position", T.BinaryType()), T.StructField("links", T.BinaryType()),
                           T.StructField("n_entries", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        memory = worker_memory("alignment")
        key = (byte_path, piece_path)
        if key not in memory:
            memory[key] = Aligner(*key)
        aligner = memory[key]
        number = TaskContext.get().partitionId() << 32
        block = _Block()

        def flush() -> pa.RecordBatch:
            row, pair, times = (np.concatenate(x) for x in (block.row, block.pair, block.times))
            pairs, position = np.unique(pair, return_inverse=True)
            # entries by (row, position), a pair of several windows summed
            at, back = np.unique(row * max(len(pairs), 1) + position, return_inverse=True)
            links = np.bincount(back, times, minlength=len(at)).astype(np.int64)
            row, position = np.divmod(at, max(len(pairs), 1))
            per_doc = _counts_by(row, block.docs)
            step = np.diff(position, prepend=0)
            heads = np.concatenate([[0], np.cumsum(per_doc)[:-1]])[per_doc > 0]
            step[heads] = position[heads]  # differences inside a document
            columns = [pa.concat_arrays([r[i] for r in block.rows]) for i in range(len(doc.fields) - 1)]
            docs_col = pa.StructArray.from_arrays([*columns, pa.array(per_doc)], names=doc.names)
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, block.docs], pa.int32()), docs_col),
                *(pa.array([x], pa.binary()) for x in (pairs.astype("<i8").tobytes(), _counts_by(position, len(pairs)).astype("<i8").tobytes(),
                                                       _packed(step), _packed(links))),
                pa.array([len(position)], pa.int64())], names=schema.names)

        for rows, data, off in text_slices(batches, "text", min(SLICE_BYTES, block_bytes), 4096):
            counts, row, pair, times, digests = aligner.documents(data, off)
            block.rows.append([rows.column(0), *(pa.array(counts[c]) for c in COUNTS), pa.array(digests, pa.string())])
            block.row.append(row + block.docs)
            block.pair.append(pair)
            block.times.append(times)
            block.docs += rows.num_rows
            block.bytes += len(data)
            if block.bytes >= block_bytes:
                yield flush()
                block, number = _Block(), number + 1
        if block.docs:
            yield flush()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, position, pair, docs): the different id pairs of each block."""
    schema = "block long, position int, pair long, docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pairs, n = (np.frombuffer(batch.column(c)[k].as_py(), "<i8") for c in (1, 2))
                for lo in range(0, len(pairs), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    size = len(pairs[part])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(size, batch.column(0)[k].as_py(), np.int64)), pa.array(np.arange(lo, lo + size, dtype=np.int32)),
                                                      pa.array(pairs[part]), pa.array(n[part])], names=["block", "position", "pair", "docs"])

    return blocks.select("block", "pairs", "pair_docs").mapInArrow(run, schema)


def link_counts(pairs: DataFrame) -> DataFrame:
    """(pair, docs, best): documents corpus-wide that hold a pair, and whether no pair of
    its A id has more. ``pairs`` has the counts of blocks."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))  # at most one row per id of A's vocabulary
    return counts.join(F.broadcast(highest), "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def score(blocks: DataFrame, pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document with its links' figures. Every block meets the figures of its own pairs."""
    figures = pairs.select("block", "position", "pair").join(counts, "pair").select("block", "position", "docs", "best")
    doc = blocks.schema["docs"].dataType.elementType
    schema = T.StructType([*(f for f in doc.fields if f.name != "n_pairs"), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        position = right.column("position").to_numpy()
        value = np.zeros(len(position), np.int64)
        best = np.zeros(len(position), np.int64)
        value[position] = right.column("docs").to_numpy()
        best[position] = right.column("best").to_numpy(zero_copy_only=False)
        out = []
        for k in range(left.num_rows):  # one row per block
            n = left.column("n_entries")[k].as_py()
            docs = left.column("docs")[k].values
            per_doc = docs.field("n_pairs").to_numpy()
            step, links = (_unpacked(left.column(c)[k].as_py(), n) for c in ("position", "links"))
            # differences summed from each document's head
            run_sum = np.concatenate([[0], np.cumsum(step)])
            heads = np.concatenate([[0], np.cumsum(per_doc)])
            at = run_sum[1:] - np.repeat(run_sum[heads[:-1]], per_doc)
            running = [np.concatenate([[0], np.cumsum(links * figure[at])]) for figure in (best, value)]
            sums = [r[heads[1:]] - r[heads[:-1]] for r in running]
            fields = [docs.field(f.name) for f in doc.fields if f.name != "n_pairs"]
            out.append(pa.Table.from_arrays([*fields, *(pa.array(s) for s in sums)], names=schema.names))
        return pa.concat_tables(out) if out else pa.Table.from_batches([], schema=_empty(left, schema))

    return blocks.select("block", "docs", "position", "links", "n_entries").groupBy("block").cogroup(figures.groupBy("block")).applyInArrow(run, schema)


def _empty(left: pa.Table, schema: T.StructType) -> pa.Schema:
    doc = left.schema.field("docs").type.value_type
    types = [doc.field(f.name).type if f.name not in ("n_best", "count_sum") else pa.int64() for f in schema.fields]
    return pa.schema(list(zip(schema.names, types)))


def align_corpus(docs: DataFrame, byte_path: str, piece_path: str, **options) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row."""
    blocks = cut_lineage(align(docs, byte_path, piece_path, **options), "alignment")
    pairs = block_pairs(blocks)
    return score(blocks, pairs, link_counts(pairs))
