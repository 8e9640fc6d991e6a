"""Helpers shared by the corpus operators: Arrow texts as byte arrays, words, hashes, staging."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import staged

# Words are separated by the six ASCII white-space bytes only.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BATCH_BYTES = 2 << 20  # bytes of text handled at a time; a longer text is handled alone

_RANDOM = np.random.default_rng(20_240_601)
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string or binary column as one byte array, and each text's bounds.

    A null is an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    if column.null_count:
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.dtype(np.int64 if wide else np.int32)
    bounds = np.frombuffer(bounds, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def slices(bounds: np.ndarray, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a text is never cut."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = last


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; words end at white space and at the text's end."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def span_edges(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of bytes ``inside``; runs end at their text's end."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[bounds] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(bounds, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each value's bits over the whole 64 (overwrites nothing)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BATCH_BYTES + 1)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        if size > 8 * BATCH_BYTES:  # one very long text: not kept
            return up, down
        _POWERS["up"], _POWERS["down"] = up, down
    return _POWERS["up"], _POWERS["down"]


def give_back() -> None:
    """Return memory that is no longer used to the system."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run):
    """A task's function that gives its memory back when it ends.

    Python workers serve many tasks, of other operators too. Freed arrays stay with the allocators of numpy and Arrow,
    so each worker would keep the most that any task ever took.
    """

    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


class SpanHashes:
    """64-bit hashes of byte strings in ``data``, equal bytes giving equal hashes anywhere."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each ``data[start:end]``."""
        spans = (self.total[ends] - self.total[starts]) * self.down[starts]
        return mix(spans + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """The hash of the ``width`` bytes from each place on."""
        n = len(self.total) - width
        spans = self.total[width:] - self.total[:n]
        spans *= self.down[:n]
        spans += np.uint64(width)
        return mix(spans)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each ``data[start:end]``."""
    return SpanHashes(data).of(starts, ends)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``width`` words in a row, A-Z lower-cased.

    A text with fewer words has one shingle, the whole sequence; one without words has none.
    """
    data = LOWER[data]
    starts, ends, text = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    counts = np.bincount(text, minlength=len(bounds) - 1)
    first = np.concatenate(([0], np.cumsum(counts)))
    out = []
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled * np.uint64(0x2545F4914F6CDD1D) + words[k : k + len(rolled)])
    for i, n in enumerate(counts.tolist()):
        a = first[i]
        if n >= width:
            out.append(np.unique(rolled[a : a + n - width + 1]))
        elif n:
            one = np.zeros(1, np.uint64)
            for k in range(n):
                one = mix(one * np.uint64(0x2545F4914F6CDD1D) + words[a + k : a + k + 1])
            out.append(mix(one + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    return staged(df, label)


def with_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text under their usual names; every other column, whatever its name, is left out."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128 bits that stand for id and text: rows equal in both share it, null ids or not."""
    return F.struct(*(F.xxhash64(F.lit(k), F.isnull(id_col), F.col(id_col), F.isnull(text_col), F.col(text_col)).alias(c)
                      for k, c in ((1, "a"), (2, "b"))))


SMALL_IDS = 4_000_000  # ids of 8 bytes that may be broadcast: 32 MB


def without_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is not among ``ids``, all columns; rows with a null id stay.

    A counted, bounded set of ids is broadcast; a larger one is joined by a shuffle.
    """
    ids = stage(ids.select(F.col(id_col).alias("_gone")).where("_gone IS NOT NULL").distinct(), "gone")
    few = ids.count() <= SMALL_IDS
    return df.join(F.broadcast(ids) if few else ids, F.col(id_col) == F.col("_gone"), "left_anti")
