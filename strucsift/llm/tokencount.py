"""Token counts by a compiled transducer over the letters of a text.

The pieces of a sentencepiece BPE model are compiled into a deterministic transducer. After any
prefix of a text the state holds what later letters can depend on: the letters that may still begin
a piece, and for each place among them the last piece before it and its count relative to now. A
transition is annotated with the number of pieces it adds (a merge takes some back, so that it may
be negative). States and transitions are made when a text first needs them.

Between two letters that stand side by side in no piece, nothing can merge: the state map of what
follows is constant, it starts anew whatever came before. So it is before a space that follows another
letter, and around line breaks and tabs. A text is cut there into chunks, whose maps compose by adding
their counts in a prefix sum over all chunks of a batch. A longer chunk (a script without spaces, a text
with the model's own mark) is cut into slices of ``SLICE`` letters anywhere; their maps (``StateMap``)
compose in pairs, level by level. A slice in which all neighbours may merge keeps its letters until
it is composed with what stands before it.

Defined results: a null or empty text has no tokens and no bytes. Repeated rows are counted each
by itself. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.llm.common import field, map_texts
from strucsift.llm.pieces import Memory
from strucsift.llm.textscan import mix, weights, words_of

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
MARK = "▁"
# Bounds of what a worker compiles; beyond them it starts anew.
MOST_TRANSITIONS = 1_000_000
MOST_PAIRS = 1_000_000
# Letters up to which a chunk is one slice.
SLICE = 4_096
# White space that no piece holds together with other letters (carriage returns do occur in pieces).
SPACES = " \t\n\v\f"
CHUNK = weights(lambda b: chr(b) not in SPACES, fold_case=False)
START, UNKNOWN = None, ""


class Transducer:
    """Letters in, numbers of tokens out, for one sentencepiece BPE model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        odd = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in range(n) if not odd[i]}
        pieces = [p for p in self.score if len(p) > 1]
        self.prefixes = {p[:k] for p in pieces for k in range(1, len(p))}
        # Neighbours within a piece; nothing merges across any others.
        self.together = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
        if any(MARK in p.lstrip(MARK) or any(s in p for s in SPACES) for p in pieces) or not any(map(model.is_byte, range(n))):
            raise ValueError(f"{path}: pieces span white space, or there are none for bytes")
        self.pairs: dict[tuple, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, int] = {}
        self.known: list[tuple] = []
        self.next: dict[tuple[int, str], tuple[int, int]] = {}
        self.begin = self._state(("", ((0, START, 0),)))

    def _state(self, key: tuple) -> int:
        if key not in self.states:
            self.states[key] = len(self.known)
            self.known.append(key)
        return self.states[key]

    def merged(self, letters: str) -> list[str]:
        """The pieces of a short text of known letters, merge by merge."""
        parts = list(letters)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str | None, piece: str) -> bool:
        """Whether ``piece`` stands after ``left`` when both are encoded together."""
        if left is UNKNOWN:
            left = START
        key = (left, piece)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merged((left or "") + piece) == ([piece] if left is START else [left, piece])
        return found

    def step(self, state: int, letter: str) -> tuple[int, int]:
        """Compile one transition: the next state and the tokens it adds."""
        window, places = self.known[state]
        if letter not in self.score:
            # No piece has this letter: it is spelled in bytes and nothing spans it.
            added = len(letter.encode("utf-8", "surrogatepass"))
            return self._state(("", ((0, UNKNOWN, 0),))), added
        window += letter
        for length, last, ahead in places:
            piece = window[len(window) - length - 1:]
            if piece in self.score and self.fits(last, piece):
                break
        else:
            raise AssertionError(f"no last token after {window!r}")
        added = ahead + 1
        open_places = [(n + 1, last, d - added) for n, last, d in places if window[len(window) - n - 1:] in self.prefixes]
        longest = open_places[0][0] if open_places else 0
        return self._state((window[len(window) - longest:], (*open_places, (0, piece, 0)))), added

    def run(self, state: int, letters: str) -> tuple[int, int]:
        """The state after ``letters`` and the tokens they add, from ``state``."""
        if len(self.next) >= MOST_TRANSITIONS:
            kept = self.known[state]
            self.next = {}
            self.clear()
            state = self._state(kept)
        total, table = 0, self.next
        for letter in letters:
            found = table.get((state, letter))
            if found is None:
                found = table[state, letter] = self.step(state, letter)
            state, total = found[0], total + found[1]
        return state, total

    def count(self, letters: str) -> int:
        """Tokens of a chunk that starts where the state is the first."""
        return self.run(self.begin, letters)[1]


@dataclass(frozen=True)
class StateMap:
    """How a slice of a text maps states: ``head`` is read from the state before it; behind it,
    if ``closed``, ``count`` tokens and the letters ``tail`` from the first state on. Within head and
    tail any neighbours may merge."""

    head: str
    closed: bool = False
    count: int = 0
    tail: str = ""


def slice_map(transducer: Transducer, letters: str) -> StateMap:
    together = transducer.together
    cuts = [i for i, (a, b) in enumerate(zip(letters, letters[1:]), 1) if a + b not in together]
    if not cuts:
        return StateMap(letters)
    inner = letters[cuts[0]:cuts[-1]]
    return StateMap(letters[:cuts[0]], True, transducer.count(inner), letters[cuts[-1]:])


def compose(transducer: Transducer, first: StateMap, second: StateMap) -> StateMap:
    """The map of two adjacent slices; associative. Only their border is looked at."""
    if not first.head or not second.head:
        return second if not first.head else first
    before, behind = first.tail if first.closed else first.head, second.head
    if before[-1] + behind[0] in transducer.together:
        if not first.closed:
            return StateMap(before + behind, second.closed, second.count, second.tail)
        if not second.closed:
            return StateMap(first.head, True, first.count, before + behind)
        return StateMap(first.head, True, first.count + transducer.count(before + behind) + second.count, second.tail)
    # What is complete on either side of the border is counted.
    total = (first.count + transducer.count(before) if first.closed else 0)
    if not second.closed:
        return StateMap(first.head, True, total, behind)
    return StateMap(first.head, True, total + transducer.count(behind) + second.count, second.tail)


def count_slices(transducer: Transducer, slices: list[str]) -> int:
    """Tokens of a text given in slices, their maps composed in pairs as in a parallel scan."""
    maps = [slice_map(transducer, s) for s in slices]
    while len(maps) > 1:
        maps = [compose(transducer, *maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    if not maps:
        return 0
    last = maps[0]
    return transducer.count(last.head) + (last.count + transducer.count(last.tail) if last.closed else 0)


def count_letters(transducer: Transducer, letters: str) -> int:
    """Tokens of letters that start where the state is the first, long ones in slices."""
    if len(letters) <= SLICE:
        return transducer.count(letters)
    return count_slices(transducer, [letters[i:i + SLICE] for i in range(0, len(letters), SLICE)])


@functools.lru_cache(maxsize=2)
def compiled(path: str) -> tuple[Transducer, Memory]:
    return Transducer(path), Memory()


def spelled(gap: bytes, chunk: bytes) -> str:
    """The letters of a chunk and of the white space before it, spaces written as the model does."""
    return (gap + chunk).decode("utf-8", "surrogatepass").replace(" ", MARK)


def count_batch(column: pa.Array, transducer: Transducer, memory: Memory) -> np.ndarray:
    """Tokens of every text of ``column``."""
    words = words_of(column, CHUNK)
    ends, data, edges = words.ends(), words.data.tobytes(), words.edges
    # A text begins with a space of the model's own.
    first = np.zeros(len(words.start), bool)
    filled = np.flatnonzero(words.count > 0)
    first[words.first[filled]] = True
    before = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    before[first] = edges[filled]
    gap = words.start - before
    # The usual gaps: one space (or a text's begin), one line break. Others enter the hash as bytes.
    usual_space = ((gap == 1) & ~first & (words.data[np.maximum(words.start - 1, 0)] == 0x20)) | ((gap == 0) & first) if len(gap) else first
    usual_break = (gap == 1) & ~first & (words.data[np.maximum(words.start - 1, 0)] == 0x0A) if len(gap) else first
    key = words.hash ^ np.where(usual_break, np.uint64(0xA5A5A5A5DEADBEEF), np.uint64(0))
    for i in np.flatnonzero(~(usual_space | usual_break)).tolist():
        own = b" " * bool(first[i]) + data[before[i]:words.start[i]]
        key[i] ^= np.uint64(_gap_code(own))
    key = mix(key)

    def compute(places: np.ndarray) -> list[list[int]]:
        out = []
        for i in places.tolist():
            own = b" " * bool(first[i]) + data[before[i]:words.start[i]]
            out.append([count_letters(transducer, spelled(own, data[words.start[i]:ends[i]]))])
        return out

    slots = memory.lookup(key, compute)
    # Every chunk starts anew, so that maps compose by a prefix sum of their counts.
    total = np.concatenate([[0], np.cumsum(memory.values[memory.first[slots]].astype(np.int64))])
    counts = total[words.first[1:]] - total[words.first[:-1]]
    # White space after the last chunk, or instead of any.
    last = edges[:-1].copy()
    last[filled] = ends[words.first[filled + 1] - 1]
    for i in np.flatnonzero(last < edges[1:]).tolist():
        rest = b" " * bool(words.count[i] == 0) + data[last[i]:edges[i + 1]]
        counts[i] += count_letters(transducer, spelled(rest, b""))
    # A text with the mark itself, which the model takes for a space, is one chunk.
    for i in np.flatnonzero(pc.match_substring(column.fill_null(""), MARK).to_numpy(zero_copy_only=False)).tolist():
        counts[i] = count_letters(transducer, spelled(b" ", data[edges[i]:edges[i + 1]]))
    return counts


@functools.lru_cache(maxsize=100_000)
def _gap_code(gap: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(gap, digest_size=8).digest(), "little") | 1


FIELDS = [field("n_bytes", "bigint"), field("n_tokens", "bigint")]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per document: n_bytes of UTF-8, n_tokens, and whether they are over ``limit``."""
    path = path or public_tokenizers.path(VOCABULARY)

    def work(batch: pa.RecordBatch) -> dict:
        transducer, memory = compiled(path)
        column = batch.column("text")
        sizes = [0 if n is None else n for n in pc.binary_length(column).to_pylist()]
        return {"n_bytes": sizes, "n_tokens": count_batch(column, transducer, memory)}

    return map_texts(docs, FIELDS, work).withColumn("over_limit", F.col("n_tokens") > limit)
