"""Shared pieces: scratch tables, byte-level word splitting, small numpy helpers."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage, scratch_path  # noqa: F401  (re-exported)

#: Bytes of text that one numpy step looks at; bounds the memory of a Python worker.
SLICE_BYTES = 1 << 20
ROWS = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_rows(spark: SparkSession, rows: int, per_task: int) -> int:
    """Number of groups that keeps ``per_task`` rows in each, at least one."""
    return max(1, -(-rows // per_task))


def text_slices(batches: Iterator[pa.RecordBatch], column: str, slice_bytes: int = SLICE_BYTES, slice_rows: int = ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) with at most ``slice_bytes`` of text each, or one longer row.
    Null texts count as empty."""
    for batch in batches:
        at = batch.schema.names.index(column)
        for start in range(0, batch.num_rows, slice_rows):  # only these rows' texts are copied
            part = batch.slice(start, slice_rows)
            col = part.column(at).cast(pa.large_binary()).fill_null(b"")
            off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
            data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
            lo = 0
            while lo < len(col):
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + slice_bytes, "right")) - 1)
                yield part.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                lo = hi


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words ``[^\\x20\\x09-\\x0D]+``, and the first word
    of each row as offsets (length rows + 1). Words never cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    ink = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = ink[1:]
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def distinct_words(data: np.ndarray, off: np.ndarray, as_bytes: bool = False) -> tuple[list, np.ndarray, np.ndarray]:
    """The different words of a slice, each occurrence's word, and each row's first occurrence."""
    starts, ends, first = words_of(data, off)
    flat = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=flat[1:])
    ink = np.zeros(len(data) + 1, np.int32)
    ink[starts] += 1
    ink[ends] -= 1
    body = data[np.cumsum(ink[:-1]).astype(bool)]
    arr = pa.StringArray.from_buffers(len(starts), pa.py_buffer(flat), pa.py_buffer(np.ascontiguousarray(body)))
    d = arr.dictionary_encode()
    return (d.dictionary.cast(pa.binary()) if as_bytes else d.dictionary).to_pylist(), d.indices.to_numpy(zero_copy_only=False).astype(np.int64), first


def normal_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words joined by one space each, as bytes, and the new starts (one more than words)."""
    size = ends - starts
    new = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + 1, out=new[1:])
    out = np.full(int(new[-1]), 0x20, np.uint8)
    if len(size):
        src = ramp(starts, size)
        out[ramp(new[:-1], size)] = data[src]
    return out, new


def ramp(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each (start, size), one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = sizes > 0
    starts, sizes = starts[keep], sizes[keep]
    step = np.ones(total, np.int64)
    first = np.zeros(len(sizes), np.int64)
    np.cumsum(sizes[:-1], out=first[1:])
    step[first] = starts
    step[first[1:]] -= starts[:-1] + sizes[:-1] - 1
    return np.cumsum(step)


def worker_memory(purpose: str) -> dict:
    """What this Python worker remembers from task to task for one purpose (caches only:
    results never depend on it). Another purpose empties it, so that an executor holds
    the caches of one operator at a time."""
    held = sys.modules.setdefault("_pricewise_worker", types.ModuleType("_pricewise_worker"))
    if getattr(held, "purpose", None) != purpose:
        held.purpose, held.memory = purpose, {}
    return held.memory
