"""Words and hashed word n-grams of whole texts, vectorised over Arrow batches.

Words are runs of bytes outside x20 and x09-x0D, with A-Z lower-cased on
request. A word hash is a polynomial in the word's bytes modulo 2**64 with a
fixed odd base and fixed byte values, then mixed; equal words have equal
hashes on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled by itself.
CHUNK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_TABLES: dict = {}


def release_memory() -> None:
    """Hand free memory back to the system: a Python worker outlives its task,
    beside tasks and stages that need the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's only
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and _BASE**-i modulo 2**64 for i < n."""
    if len(_TABLES.get("up", ())) < n:
        n = max(n, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
    return _TABLES["up"], _TABLES["down"]


def _byte_values(lower: bool) -> np.ndarray:
    """A fixed 64-bit value per byte; 0 for separators."""
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b = np.where((b >= 65) & (b <= 90), b + 32, b)
    values = mix((b + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
    values[SEPARATOR] = 0
    return values


SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """Words of some consecutive texts: ``hashes`` of all words; the words of
    text i are ``hashes[first[i]:first[i + 1]]``; ``data`` holds the bytes,
    ``begin`` and ``end`` the words' places in it."""

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def hash_runs(data: np.ndarray, values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes that begins at ``begin`` (until the next
    one); bytes of value 0 add nothing."""
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(data))
    return mix(np.add.reduceat(values[data] * up[: len(data)], begin) * down[begin])


def split_words(texts: pa.Array, lower: bool = True) -> Words:
    """Words of a null-free string array."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # words end where texts end
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    if len(data):
        after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(hash_runs(data, _byte_values(lower), begin), np.searchsorted(begin, offsets), data, begin, end)


def chunks(batch: pa.RecordBatch, text_col: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``size`` bytes of text each; null texts
    become empty. A slice is copied when it is its turn."""
    i = batch.schema.get_field_index(text_col)
    lengths = pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    field = pa.field(text_col, pa.large_string())
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        part = batch.slice(start, stop - start)
        yield part.set_column(i, field, part.column(i).cast(pa.large_string()).fill_null(""))
        start = stop


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words (n up to 5)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(size, n, dtype=np.uint64)
    for k in range(n):
        total += hashes[k : k + size] * np.uint64(_GRAM[k])
    return mix(total)


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct n-word shingles; a shorter text of
    at least one word has its whole sequence as the only one."""
    grams = ngrams(words.hashes, n)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        else:
            yield ngrams(words.hashes[a:b], b - a) if b > a else grams[:0]


#: Byte values with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_runs(texts: pa.Array, inside: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """All runs of bytes marked in ``inside`` (256 booleans, looked up after
    A-Z are lower-cased) in a null-free string array, as one array of words;
    those of text i are ``first[i]`` to ``first[i + 1]``."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset)
    data = LOWER[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    keep = inside[data]
    starts = np.ones(len(data), dtype=bool)
    starts[1:] = ~keep[:-1]
    starts[offsets[:-1][offsets[:-1] < len(data)]] = True  # words end where texts end
    begin = np.flatnonzero(keep & starts)
    ends = np.append(np.cumsum(keep, dtype=np.int64)[begin] - 1 if len(begin) else np.zeros(0, dtype=np.int64), int(keep.sum()))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(data[keep])])
    return words, np.searchsorted(begin, offsets)
