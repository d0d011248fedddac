"""Minimal perfect hash over 64-bit keys, by levels of collision-free slots.

Level after level, keys that are alone in their slot of a bit array are placed;
the others go on to the next level. A key's number is the rank of its bit, so n
keys get the numbers 0 .. n-1. A rank is a sample kept for every ``SAMPLE`` bits and the bits
set since, so a lookup reads a constant number of words: about 1.6 levels on average.

Equal keys can't be told apart here. Keys that ``LEVELS`` levels leave, which distinct keys do
with a chance far below 2**-64, are given back by their index for the caller to number. No
keys make an empty hash that knows no key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from minelake.llm.common import U, mix64

_GAMMA, LEVELS, SAMPLE = 2.0, 64, 512


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(keys + U((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % U(size)).astype(np.int64)


@dataclass
class Hash:
    sizes: np.ndarray    # slots of each level
    words: np.ndarray    # the bits of all levels, 64 a word
    samples: np.ndarray  # bits set before every SAMPLE bits

    def rank(self, slot: np.ndarray) -> np.ndarray:
        """Bits set before ``slot``."""
        word = slot >> 6
        first = slot // SAMPLE * (SAMPLE // 64)
        out = self.samples[slot // SAMPLE] + np.bitwise_count(self.words[word] & ((U(1) << (slot & 63).astype(U)) - U(1))).astype(np.int64)
        for k in range(SAMPLE // 64 - 1):  # whole words between the sample and the slot's own
            at = first + k
            inner = at < word
            out[inner] += np.bitwise_count(self.words[at[inner]]).astype(np.int64)
        return out

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some, any number for other, unknown keys."""
        out, todo, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            slot = at + _slot(keys[todo], level, int(size))
            hit = (self.words[slot >> 6] >> (slot & 63).astype(U) & U(1)) == 1
            out[todo[hit]] = self.rank(slot[hit])
            todo, at = todo[~hit], at + int(size)
        return out


def build(keys: np.ndarray, levels: int = LEVELS) -> tuple[Hash, np.ndarray]:
    """The hash of ``keys``, and the indexes of the keys it does not hold (equal ones)."""
    sizes, bits, left, level = [], [], np.arange(len(keys)), 0
    while len(left) and level < levels:
        own = keys[left]
        size = max(16, int(_GAMMA * len(left)))
        slot = _slot(own, level, size)
        alone = np.bincount(slot, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left, level = left[~alone[slot]], level + 1
    every = np.concatenate(bits) if bits else np.zeros(0, bool)
    every = np.concatenate([every, np.zeros(-len(every) % SAMPLE, bool)])
    words = np.packbits(every, bitorder="little").view(U)
    counts = np.bitwise_count(words).astype(np.int64).reshape(-1, SAMPLE // 64).sum(axis=1)
    return Hash(np.array(sizes, np.int64), words, np.cumsum(counts) - counts), left
