"""Words, lines and windows of whole batches of texts as numpy arrays.

Texts are read as UTF-8 bytes straight from Arrow's buffers. A word is a run of bytes that a table
maps to non-zero weights; equal weights make bytes equal (as upper and lower case). Words and
windows are known by 64-bit hashes: within one document, or among the windows of a test set, two
unequal ones share a hash with a chance of about n * n / 2**65. A byte enters the sum that is a
word's hash scattered together with its place, so that no rearrangement of bytes keeps the sum;
words of over ``LONG`` bytes, among which such arrangements could be sought, have a BLAKE2 digest.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Words of more bytes are hashed one by one by a cryptographic function.
LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def weights(is_word, fold_case: bool) -> np.ndarray:
    """A weight for each byte value: 0 outside words, equal for A-Z and a-z if ``fold_case``."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    table[[not is_word(b) for b in range(256)]] = 0
    if fold_case:
        table[65:91] = table[97:123]
    return table



@functools.lru_cache(maxsize=8)
def _scattered(table: bytes) -> np.ndarray:
    """What every byte value adds at every place of a word, place by place."""
    place = np.arange(1, LONG + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)
    value = np.frombuffer(table, np.uint64)
    return np.where(value != 0, mix(value[None, :] ^ place[:, None]), np.uint64(0)).ravel()


@dataclass
class Words:
    """``hash`` and byte ``start`` of every word; text i has the words first[i]:first[i + 1]."""

    hash: np.ndarray
    start: np.ndarray
    first: np.ndarray
    inside: np.ndarray
    data: np.ndarray
    edges: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def ends(self) -> np.ndarray:
        """The byte after the last one of every word."""
        last = self.inside.copy()
        last[:-1] &= ~self.inside[1:]
        before = self.start[self.start > 0] - 1
        last[before] = self.inside[before]
        return np.flatnonzero(last) + 1

    def whole(self) -> tuple[Words, np.ndarray]:
        """The words without the cuts of ``apart``, and the last piece of each. A hash is that of a word's first piece."""
        head = ~self.inside[self.start - 1]
        head[self.first[:-1][self.count > 0]] = True
        at = np.flatnonzero(head)
        words = Words(self.hash[at], self.start[at], np.searchsorted(at, self.first), self.inside, self.data, self.edges)
        return words, np.flatnonzero(np.roll(head, -1))

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty) and the border of every text among them."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edges = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    found = np.frombuffer(data, np.uint8)[edges[0]:edges[-1]] if data is not None else np.zeros(0, np.uint8)
    return found, edges - edges[0]


def per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The number of set flags in every text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def words_of(column: pa.Array, table: np.ndarray, apart: np.ndarray | None = None) -> Words:
    """The words of all texts; ``apart`` tells of two bytes of a word, first * 256 + second, whether it is cut between them."""
    data, edges = text_bytes(column)
    inside = (table != 0)[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    if apart is not None:
        pair = data[:-1].astype(np.uint16) << np.uint16(8)
        pair |= data[1:]
        begin[1:] |= apart[pair]
    border = edges[:-1][edges[:-1] < len(data)]
    begin[border] = inside[border]
    start = np.flatnonzero(begin)
    if not len(start):
        empty = np.zeros(0, np.int64)
        return Words(empty.astype(np.uint64), empty, np.zeros(len(edges), np.int64), inside, data, edges)
    at = np.arange(len(data), dtype=np.int32)
    at -= np.maximum.accumulate(np.where(begin, at, 0))
    at &= LONG - 1
    long = inside & (at == LONG - 1)
    at <<= 8
    at += data
    sums = np.add.reduceat(_scattered(table.tobytes())[at], start)
    found = Words(mix(sums), start, np.searchsorted(start, edges), inside, data, edges)
    if long.any():
        ends = found.ends()
        key = table[table != 0][:8].tobytes()
        equal = np.array([int(np.flatnonzero(table == w)[0]) for w in table], np.uint8)
        for i in np.flatnonzero(ends - start > LONG).tolist():
            digest = hashlib.blake2b(equal[data[start[i]:ends[i]]].tobytes(), digest_size=8, key=key).digest()
            found.hash[i] = int.from_bytes(digest, "little")
    return found


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words of one text, the index of their first words, and the
    border of every text among them."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(words.first), np.int64)
    out = words.hash[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words.hash[j:n + j]
    most = np.maximum(words.count - (k - 1), 0)
    border = np.concatenate([[0], np.cumsum(most)])
    owner = np.repeat(np.arange(len(most)), most)
    at = np.arange(border[-1]) - border[owner] + words.first[owner]
    return mix(out[at]), at, border


def grams(data: np.ndarray, edges: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets (a power of two of them) of all runs of ``n`` <= 4 bytes that lie in one text,
    and the border of every text among them."""
    border = np.concatenate([[0], np.cumsum(np.maximum(np.diff(edges) - (n - 1), 0))])
    if not border[-1]:
        return np.zeros(0, np.int32), border
    wide = data.astype(np.uint32)
    code = wide[:len(data) - n + 1].copy()
    for j in range(1, n):
        code |= wide[j:len(data) - n + 1 + j] << np.uint32(8 * j)
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    whole = np.ones(len(code), bool)
    for j in range(1, n):
        at = edges[1:-1] - j
        whole[at[(at >= 0) & (at < len(code))]] = False
    return (code[whole] >> np.uint32(33 - buckets.bit_length())).astype(np.int32), border
