"""Array helpers over Arrow text columns: words, word hashes, batches.

A word is a run of bytes other than space and ``\\x09-\\x0D``
(``[^\\x20\\x09-\\x0D]+``). All helpers see whole texts; a null text counts as
empty. Word hashes are 64 bits: a polynomial over the bytes modulo 2^64 with
the length mixed in. Two given words collide with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text bytes that a task looks at together.
SLICE_BYTES = 4 << 20
#: Bytes hashed with one table of powers.
HASH_BYTES = 1 << 17

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def fold_case(c: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)


def words_column(c: Column) -> Column:
    """The words of a text as an array (null: empty array), JVM-side."""
    bare = F.trim(F.coalesce(c, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def free_name(columns, stem: str) -> str:
    """A column name that isn't among ``columns`` (in any case)."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def bucket_of(c: Column, n: int) -> Column:
    """crc32 of an id as text, modulo n. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit(""))), F.lit(n))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, and the offsets of its rows in them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Hand freed memory back to the system. Workers outlive their tasks, and what they
    keep counts beside the next stage; glibc by itself keeps what many small slices have left."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, name: str | int, limit: int = SLICE_BYTES):
    """The batch in runs of rows of about ``limit`` text bytes each (a longer
    text is a run of its own); then what they took is given back."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size + 16)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def _spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that stay within one row."""
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[edge] = inside[edge]
    edge = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[edge] = inside[edge]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


_TABLES: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    n = max(n, HASH_BYTES)
    if n > len(_TABLES.get("powers", ())):
        one = np.ones(1, np.uint64)
        _TABLES["powers"] = np.cumprod(np.concatenate([one, np.full(n, BASE)]))
        _TABLES["inverse"] = np.cumprod(np.concatenate([one, np.full(n, BASE_INVERSE)]))
    return _TABLES["powers"], _TABLES["inverse"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, first + HASH_BYTES, side="right")))
        last = int(ends[to - 1])
        power, inverse = _powers(last - first)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * power[:last - first], out=sums[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        out[at:to] = (sums[e] - sums[s]) * inverse[s]
        at = to
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True):
    """(hash of each word, row where each row's words begin, starts, ends).

    The second array has one entry more than there are rows.
    """
    starts, ends = _spans(~IS_SPACE[data], offsets)
    hashes = span_hashes(FOLD[data] if fold else data, starts, ends)
    return hashes, np.searchsorted(starts, offsets), starts, ends


class HashIndex:
    """Position of 64-bit keys in a sorted array, by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(1, int(np.ceil(np.log2(len(keys) + 2))) + 1)
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.first = np.searchsorted(keys, edges).astype(np.int32)
        runs = np.diff(np.concatenate([self.first, [len(keys)]]))
        self.steps = int(runs.max()) if len(keys) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position of each hash in the keys, or -1."""
        out = np.full(len(h), -1, np.int32)
        if not len(self.keys):
            return out
        at = self.first[(h >> np.uint64(64 - self.bits)).astype(np.int64)]
        left = np.arange(len(h))
        for _ in range(self.steps):
            inside = at < len(self.keys)
            left, at = left[inside], at[inside]
            key, want = self.keys[at], h[left]
            hit = key == want
            out[left[hit]] = at[hit]
            on = key < want
            left, at = left[on], at[on] + 1
            if not len(left):
                break
        return out


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker: tasks that follow one
    another share what they put there."""
    import sys
    import types
    module = sys.modules.setdefault("panelkit_llm_worker", types.ModuleType("panelkit_llm_worker"))
    return module.__dict__.setdefault("kept", {})
