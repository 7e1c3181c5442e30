"""Packing of documents into sequences by order-preserving dynamic programming.

The token ids of documents, each with an end id, form one stream in the order of the rows of a
partition. A cut may lie after a document, after a sentence for a penalty, and inside a sentence, for
a larger one, only where no other place is within ``GAP`` tokens, at every ``STRIDE``-th token. The cuts minimise padding plus
penalties plus a small cost of each sequence: the cheapest way to a cut comes from the cheapest
earlier cut at most ``limit`` tokens before it, kept in a monotone queue by cost + place, or from
one a power of two before it, since a sequence of such a length is not padded.

The cheapest ways to all cuts that can still be extended soon share a trunk. Up to the point where
they part it is written and forgotten, so that a task holds some hundred thousand tokens, while the
cuts stay the best of the whole partition. A partition's last ``limit`` tokens may be cut anywhere,
so that what remains splits into powers of two. Partitions are packed independently and nothing is
shuffled: range-partition and sort ``docs`` first for an order over the whole table.

A sentence ends with a chunk (a run of non-space characters) that ends in one of ``.!?``, perhaps
closed by a quote or bracket, in an ideographic stop, or before a line break.

Defined results: a null or empty text has the end id alone. Rows without an id, or that repeat one,
are documents of their own. An empty table gives no sequence. Sequence ids rise in the order of a
partition and are unique, not dense. Other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.llm.common import field, prepare, steps
from strucsift.llm.pieces import Memory, tokenized_chunks
from strucsift.llm.tokenfile import encoder, with_end
from strucsift.llm.textscan import Words

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
LIMIT = 4096
# In tokens of padding: a cut after a sentence, one inside a sentence, and a sequence.
SENTENCE, INSIDE, SEQUENCE = 32, 256, 64
# Without another place to cut for so many tokens any token of this stride may be cut after.
GAP, STRIDE = 256, 8
# Shortest power of two looked for before a partition's end.
LEAST_POWER = 64
# Chunks a worker remembers with their ids: some 60 bytes each.
KNOWN_CHUNKS = 2_000_000
# Tokens of a task that are not yet cut before it looks for a trunk.
HELD_TOKENS = 1 << 18
SEQUENCE_BITS = 33
STOPS, CLOSERS = np.isin(np.arange(256), list(b".!?")), np.isin(np.arange(256), list(b"\"')]}"))
# UTF-8 of the ideographic full stop.
WIDE_STOP = b"\xe3\x80\x82"


def powers(least: int, limit: int) -> list[int]:
    """The powers of two from ``least`` to ``limit``."""
    return [1 << k for k in range(limit.bit_length()) if least <= 1 << k <= limit]


class Cuts:
    """The cheapest ways to all places, from place 0 on; ``limit`` is the length of a sequence."""

    def __init__(self, limit: int, sequence: int = SEQUENCE):
        self.limit, self.sequence = limit, sequence
        self.places, self.costs, self.before = [0], [0], [-1]
        self.queue = deque([0])

    def extend(self, places: np.ndarray, penalties: np.ndarray, least_power: int) -> None:
        """Find the cheapest way to rising ``places`` above all known ones, at most ``limit`` apart."""
        known, limit = len(self.places), self.limit
        every = np.concatenate([np.array(self.places), places])
        hits = []
        for length in powers(least_power, limit):
            at = np.searchsorted(every, places - length)
            own = np.flatnonzero(every[at] == places - length)
            hits.append(np.stack([own + known, at[own]]))
        hit = np.concatenate(hits, axis=1) if hits else np.zeros((2, 0), np.int64)
        hit = hit[:, np.argsort(hit[0], kind="stable")]
        arrivals, origins = [*hit[0].tolist(), -1], [*hit[1].tolist(), -1]
        all_places, costs, before, queue, k = self.places, self.costs, self.before, self.queue, 0
        for j, (place, penalty) in enumerate(zip(places.tolist(), penalties.tolist(), strict=True), known):
            while all_places[queue[0]] < place - limit:
                queue.popleft()
            origin = queue[0]
            cost = costs[origin] + all_places[origin] + limit - place
            while arrivals[k] == j:
                if costs[origins[k]] < cost:
                    origin = origins[k]
                    cost = costs[origin]
                k += 1
            cost += penalty + self.sequence
            all_places.append(place)
            costs.append(cost)
            before.append(origin)
            key = cost + place
            while queue and costs[queue[-1]] + all_places[queue[-1]] >= key:
                queue.pop()
            queue.append(j)

    def _way(self, j: int) -> list[int]:
        way = []
        while j >= 0:
            way.append(self.places[j])
            j = self.before[j]
        return way[::-1]

    def trunk(self) -> list[int]:
        """The places that all ways still open have in common, which are forgotten but for the last."""
        open_from = self.places[-1] - self.limit
        used = bytearray(len(self.places))
        top = j = len(self.places) - 1
        count = 0
        while j >= 0 and self.places[j] >= open_from:
            used[j] = 1
            count, j = count + 1, j - 1
        j = top
        while count > 1:
            if used[j]:
                earlier = self.before[j]
                count -= used[earlier]
                used[earlier] = 1
            j -= 1
        while not used[j]:
            j -= 1
        way = self._way(j)
        self.places, self.costs = self.places[j:], self.costs[j:]
        self.before = [-1, *(b - j for b in self.before[j + 1:])]
        self.queue = deque(i - j for i in self.queue)
        return way

    def finish(self) -> list[int]:
        """The places of the cheapest way to the last place."""
        return self._way(len(self.places) - 1)


def sentence_ends(words: Words, ends: np.ndarray) -> np.ndarray:
    """Whether a sentence of the text goes on no further than each chunk; the last chunk counts as none."""
    if not len(ends):
        return np.zeros(0, bool)
    data = words.data
    last = data[ends - 1]
    second, third = (data[np.maximum(ends - k, 0)] for k in (2, 3))
    found = STOPS[last] | (CLOSERS[last] & STOPS[second] & (ends - words.start > 1))
    found |= (last == WIDE_STOP[2]) & (second == WIDE_STOP[1]) & (third == WIDE_STOP[0]) & (ends - words.start > 2)
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
    found[:-1] |= breaks[words.start[1:]] > breaks[ends[:-1]]
    found[words.first[1:][words.count > 0] - 1] = False
    return found


def fill_gaps(places: np.ndarray, penalties: np.ndarray, begin: int, gap: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Places with every ``stride``-th token back from one that is more than ``gap`` after the one before it;
    ``begin`` is the place before the first."""
    size = np.diff(places, prepend=begin)
    repeat = np.where(size > gap, -(-size // stride), 1)
    out, cost = np.repeat(places, repeat), np.repeat(penalties, repeat)
    back = np.repeat(np.cumsum(repeat), repeat) - 1 - np.arange(len(out))
    return out - stride * back, np.where(back > 0, INSIDE, cost)


class Packer:
    """One partition's stream: takes tokenized documents, gives the pieces of finished sequences."""

    def __init__(self, limit: int):
        self.limit, self.cuts = limit, Cuts(limit)
        self.names: list = []
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.begin = self.sequences = 0
        # Places near the end of the stream wait: they may turn out to be the last.
        self.places = self.penalties = np.zeros(0, np.int64)

    def add(self, names: list, ids: np.ndarray, border: np.ndarray, places: np.ndarray, penalties: np.ndarray) -> None:
        """Documents: their ids with end ids, their borders, and places to cut, all counted from the first."""
        base = int(self.starts[-1])
        self.names += names
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, border[1:] + base])
        self.places = np.concatenate([self.places, places + base])
        self.penalties = np.concatenate([self.penalties, penalties])
        ready = int(np.searchsorted(self.places, self.starts[-1] - self.limit))
        self._extend(ready, GAP, STRIDE, LEAST_POWER)

    def _extend(self, n: int, gap: int, stride: int, least_power: int) -> None:
        if n:
            found = fill_gaps(self.places[:n], self.penalties[:n], self.cuts.places[-1], min(gap, self.limit), stride)
            self.cuts.extend(*found, least_power)
            self.places, self.penalties = self.places[n:], self.penalties[n:]

    def pieces(self, finish: bool = False) -> pa.RecordBatch | None:
        """The pieces of the sequences that are settled, all of them if the stream is at its end."""
        if finish:
            self._extend(len(self.places), 1, 1, 1)
            way = self.cuts.finish()
        elif len(self.ids) < HELD_TOKENS:
            return None
        else:
            way = self.cuts.trunk()
        if len(way) < 2:
            return None
        windows = np.array(way)
        inside = self.starts[(self.starts > windows[0]) & (self.starts < windows[-1])]
        edges = np.union1d(windows, inside)
        window = np.searchsorted(windows, edges[:-1], "right") - 1
        doc = np.searchsorted(self.starts, edges[:-1], "right") - 1
        offsets = (4 * (edges - self.begin)).astype(np.int32)
        flat = self.ids[:edges[-1] - self.begin].astype("<u4").tobytes()
        out = pa.RecordBatch.from_arrays([
            pa.array([self.names[d] for d in doc.tolist()], pa.int64()), pa.array(edges[:-1] - self.starts[doc]),
            pa.array(np.diff(edges)), pa.array(self.starts[doc + 1] - self.starts[doc]),
            pa.array(window + self.sequences), pa.array(edges[:-1] - windows[window]),
            pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat)]),
        ], [f.name for f in PIECE])
        self.ids = self.ids[edges[-1] - self.begin:]
        self.begin, self.sequences = int(edges[-1]), self.sequences + len(windows) - 1
        gone = int(np.searchsorted(self.starts, self.begin, "right")) - 1
        self.names, self.starts = self.names[gone:], self.starts[gone:]
        return out


PIECE = [field(n, "bigint") for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [field("ids", "binary")]


def _read(batch: pa.RecordBatch, memory: Memory, encode, end_id: int) -> tuple:
    """What ``Packer.add`` takes, of a batch of texts."""
    words, ends, slots = tokenized_chunks(batch.column("text"), memory, encode)
    total = np.concatenate([[0], np.cumsum(memory.sizes(slots))])
    ids, border = with_end(memory.gather(slots), total[words.first], end_id)
    chunks, last = words.whole()
    at = total[1:][last][found := sentence_ends(chunks, ends[last])] + chunks.owner()[found]
    places = np.concatenate([border[1:], at])
    penalties = np.concatenate([np.zeros(len(border) - 1, np.int64), np.full(len(at), SENTENCE)])
    # A place known twice has the lower penalty; none lies at the begin of a document.
    order = np.lexsort((penalties, places))
    places, penalties = places[order], penalties[order]
    once = np.diff(places, prepend=-1) > 0
    once &= (places != border[np.searchsorted(border, places, "right") - 1]) | (penalties == 0)
    return batch.column("doc_id").to_pylist(), ids, border, places[once], penalties[once]


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, limit: int = LIMIT) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) in sequences of at most ``limit`` tokens.

    Per piece: doc_id, start (the document's ids before it), length, doc_tokens, sequence_id, offset
    in the sequence, and ids as little-endian unsigned 32-bit integers.
    """
    prepare(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memory = encoder(path, KNOWN_CHUNKS)
        packer = Packer(limit)
        packer.sequences = TaskContext.get().partitionId() << SEQUENCE_BITS
        for whole in batches:
            for batch in steps(whole):
                packer.add(*_read(batch, memory, encode, end_id))
                if (out := packer.pieces()) is not None:
                    yield out
        if (out := packer.pieces(finish=True)) is not None:
            yield out

    return source.mapInArrow(run, T.StructType(PIECE))


def padding(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Padding of sequences of these lengths: none at a power of two, else up to ``limit``."""
    return np.where(lengths & (lengths - 1), limit - lengths, 0)
