"""Minimal perfect hashes of term sets, in shards, with their terms.

Keys are placed level by level: at each level every key left over points at one
bit of a bitmap, and keys that are alone at their bit stay there; a key's slot
is the number of bits set before its own. Terms stand in the order of their
slots, so a term that is found is compared with the stored one: a term
that is not in the set has no slot, whatever its hash. Keys that share all 64
bits of their hash are told apart by comparison alone.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from panelsmith.llm.words import _byte_values, hash_runs, mix

#: Bits of a level per key that is left.
GAMMA = 2
_STEP = 0x9E3779B97F4A7C15


def hash_terms(terms: pa.Array) -> np.ndarray:
    """64-bit hashes of a null-free array of non-empty terms."""
    terms = terms.cast(pa.large_binary())
    offsets = np.frombuffer(terms.buffers()[1], dtype=np.int64, count=len(terms) + 1, offset=8 * terms.offset)
    data = np.frombuffer(terms.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return hash_runs(data, _byte_values(False), offsets[:-1] - offsets[0])


def _spot(hashes: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    step = np.uint64((level + 1) * _STEP % (1 << 64))
    return (mix(hashes + step) % np.asarray(size, dtype=np.uint64)).astype(np.int64)


def build(hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bitmaps (uint64 words) of the levels, and the slot of each key. Keys
    whose whole hash is shared come last, in order, without a bit."""
    slots = np.full(len(hashes), -1, dtype=np.int64)
    _, inverse, times = np.unique(hashes, return_inverse=True, return_counts=True)
    alone = times[inverse] == 1
    left, levels, placed = np.flatnonzero(alone), [], 0
    while len(left):
        size = 64 * -(-GAMMA * len(left) // 64)
        spot = _spot(hashes[left], len(levels), size)
        single = np.bincount(spot, minlength=size) == 1
        words = np.packbits(single, bitorder="little").view(np.uint64)
        stays = single[spot]
        slots[left[stays]] = placed + np.cumsum(single)[spot[stays]] - 1
        placed += int(stays.sum())
        levels.append(words)
        left = left[~stays]
    slots[~alone] = placed + np.arange(int((~alone).sum()))
    return levels, slots


class Shards:
    """Shards loaded together. Each is (levels, terms in slot order); a
    term's slot is global: its shard's terms follow those of the shards
    before."""

    def __init__(self, shards: Sequence[tuple[list[np.ndarray], pa.Array]]):
        self.first = np.concatenate([[0], np.cumsum([len(t) for _, t in shards])]).astype(np.int64)
        self.terms = pa.concat_arrays([t.cast(pa.large_binary()) for _, t in shards] or [pa.array([], pa.large_binary())])
        depth = max([len(v) for v, _ in shards], default=0)
        self.sizes = np.zeros((depth, len(shards)), dtype=np.int64)
        begin = np.zeros((depth, len(shards)), dtype=np.int64)
        words, before, at = [], [], 0
        self.twins: dict[bytes, int] = {}
        for k, (levels, terms) in enumerate(shards):
            seen = 0
            for level, bits in enumerate(levels):
                counts = np.bitwise_count(bits).astype(np.int64)
                self.sizes[level, k], begin[level, k] = 64 * len(bits), at
                words.append(bits)
                before.append(seen + np.cumsum(counts) - counts)
                seen, at = seen + int(counts.sum()), at + len(bits)
            self.twins |= {t.as_py(): int(self.first[k]) + seen + i for i, t in enumerate(terms.cast(pa.large_binary())[seen:])}
        self.begin = begin
        self.words = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
        self.before = np.concatenate(before) if before else np.zeros(0, dtype=np.int64)

    def lookup(self, shard: np.ndarray, hashes: np.ndarray, terms: pa.Array) -> np.ndarray:
        """Global slot of each term in its shard; -1 where it is not stored."""
        slots = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for level in range(len(self.sizes)):
            size = self.sizes[level, shard[left]]
            left, size = left[size > 0], size[size > 0]
            spot = _spot(hashes[left], level, size)
            at, bit = self.begin[level, shard[left]] + (spot >> 6), (spot & 63).astype(np.uint64)
            found = (self.words[at] >> bit) & np.uint64(1) == 1
            lower = self.words[at[found]] & ((np.uint64(1) << bit[found]) - np.uint64(1))
            slots[left[found]] = self.first[shard[left[found]]] + self.before[at[found]] + np.bitwise_count(lower)
            left = left[~found]
        known = np.flatnonzero(slots >= 0)
        terms = terms.cast(pa.large_binary())
        same = pc.equal(self.terms.take(pa.array(slots[known])), terms.take(pa.array(known))).to_numpy(zero_copy_only=False)
        slots[known[~same.astype(bool)]] = -1
        if self.twins:
            for i in np.flatnonzero(slots < 0).tolist():
                at = self.twins.get(terms[i].as_py(), -1)
                # the same term may be stored in another shard
                slots[i] = at if at >= 0 and self.first[shard[i]] <= at < self.first[shard[i] + 1] else -1
        return slots
