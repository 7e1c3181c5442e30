"""Texts as chunks that tokenize independently, and a bounded memory of tokenized chunks.

A chunk is a run of non-space characters: for the tokenizers used here no token spans a border
between chunks. Where a tokenizer's words are known, chunks are cut further, between such bytes
that no word spans. Most chunks repeat, so each distinct one of a batch is tokenized once, and what
a Python worker knows already it looks up by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa

from strucsift.llm.textscan import Words, weights, words_of

# Chunks remembered in a worker: some 30 bytes each. Beyond, the memory starts anew.
MOST_CHUNKS = 1_000_000
SPACE = {0x20, *range(0x09, 0x0E)}
CHUNK = weights(lambda b: b not in SPACE, fold_case=False)
# Runs of integers: one sequence each, or all lengths and all integers one after the other.
Runs = Sequence[Sequence[int]] | tuple[np.ndarray, np.ndarray]


class Memory:
    """A run of unsigned integers for every known hash; ``apart`` tells ``words_of`` where chunks are cut before."""

    def __init__(self, most: int = MOST_CHUNKS, apart: np.ndarray | None = None):
        self.most, self.apart = most, apart
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.values = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of every hash, -1 if unknown."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.slots[at], -1)

    def add(self, hashes: np.ndarray, runs: Runs) -> None:
        """Remember the runs of ascending hashes that are not known yet."""
        if isinstance(runs, tuple):
            lengths, flat = runs
        else:
            lengths = np.fromiter(map(len, runs), np.int64, len(runs))
            flat = np.fromiter(chain.from_iterable(runs), np.uint32, int(lengths.sum()))
        slots = len(self.first) - 1 + np.arange(len(lengths))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])
        self.values = np.concatenate([self.values, flat])
        place = np.searchsorted(self.keys, hashes)
        self.keys, self.slots = np.insert(self.keys, place, hashes), np.insert(self.slots, place, slots)

    def lookup(self, hashes: np.ndarray, compute: Callable[[np.ndarray], Runs]) -> np.ndarray:
        """Slots of all ``hashes``; ``compute`` gets the places of one occurrence of each unknown."""
        known, place, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(known) > self.most:
            self.clear()
        slots = self.find(known)
        new = np.flatnonzero(slots < 0)
        if len(new):
            self.add(known[new], compute(place[new]))
            slots[new] = self.find(known[new])
        return slots[inverse]

    def sizes(self, slots: np.ndarray) -> np.ndarray:
        return self.first[slots + 1] - self.first[slots]

    def gather(self, slots: np.ndarray) -> np.ndarray:
        """The runs of all slots, one after the other."""
        sizes = self.sizes(slots)
        before = np.cumsum(sizes) - sizes
        return self.values[np.repeat(self.first[slots] - before, sizes) + np.arange(int(sizes.sum()))]


def tokenized_chunks(column: pa.Array, memory: Memory, encode: Callable[[list[str]], Runs],
                     ) -> tuple[Words, np.ndarray, np.ndarray]:
    """The chunks of all texts of ``column``, cut as ``memory`` tells, the bytes after them, and their slots in ``memory``."""
    words: Words = words_of(column, CHUNK, memory.apart)
    ends, data = words.ends(), words.data.tobytes()

    def compute(places: np.ndarray) -> Runs:
        spans = zip(words.start[places].tolist(), ends[places].tolist(), strict=True)
        return encode([data[a:b].decode("utf-8", "surrogatepass") for a, b in spans])

    return words, ends, memory.lookup(words.hash, compute)


def tokenize(column: pa.Array, memory: Memory,
             encode: Callable[[list[str]], Runs]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts of ``column``, and the border of every text among them."""
    words, _, slots = tokenized_chunks(column, memory, encode)
    total = np.concatenate([[0], np.cumsum(memory.sizes(slots))])
    return memory.gather(slots), total[words.first]
