"""Exact BPE by dynamic programming over prefixes, and decoding.

Every prefix of a word has one valid last token. An automaton of all tokens (Aho-Corasick) gives
the tokens that end at a place; the last token of the prefix is the one that is compatible with
the last token of what is left before it. Following these links back from the end gives the ids
without replaying any merge. Two tokens are compatible if no merge joins a right edge of the first
with a left edge of the second before the tokens' own merges have consumed these edges.

The ids are those of the library for files of this kind (BPE merges with word ends, lower-cased
words); a file of another kind is refused. Special tokens in a text are recognised first.

Defined results: a null or empty text, or one of white space only, has no ids and decodes to an
empty text. Repeated rows are encoded each by itself. Other columns are kept by ``encode`` and
``decode``, replaced if they have the name of the result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from strucsift.llm.common import field, give_back, map_texts, model
from strucsift.llm.pieces import Memory, tokenize

VOCABULARY = "word_bpe_49k.json"
# Pairs of tokens whose compatibility a worker remembers.
MOST_PAIRS = 500_000
END = "\n"  # stands for the end of a word inside this module; no byte is written like this
NEVER = 1 << 40
LATIN = "\u024f"


def byte_letters() -> list[str]:
    """The letter that stands for each byte value: itself if printable, else from 256 upwards."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PrefixBpe:
    """A tokenizer file compiled for encoding by prefixes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merging = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (merging["type"], steps, split["type"], split["behavior"], split["invert"], level["type"], level["add_prefix_space"]) != (
                "BPE", ["NFC", "Replace", "Lowercase"], "Split", "Removed", True, "ByteLevel", False):
            raise ValueError(f"{path}: a tokenizer of another kind")
        suffix = merging["end_of_word_suffix"]
        inner = lambda t: t.removesuffix(suffix) + END if t.endswith(suffix) else t
        # Of the library only the steps before merging are used: it gets no vocabulary.
        self.library = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": merging | {"vocab": {}, "merges": []}}))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.finder = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.letters = byte_letters()
        self.id = {inner(t): i for t, i in merging["vocab"].items()}
        self.text = {i: t for t, i in merging["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for rank, (a, b) in enumerate(merging["merges"]):
            a, b = inner(a), inner(b)
            if a + b in self.parts or rank <= max(self._born(a), self._born(b)):
                raise ValueError(f"{path}: token {a + b!r} isn't made once, from earlier tokens")
            self.rank[a, b], self.parts[a + b] = rank, (a, b)
        self.finals = ahocorasick.Automaton()
        for token in self.id:
            self.finals.add_word(token, token)
        self.finals.make_automaton()
        self.whole: dict[str, bool] = {}
        self.fits: dict[tuple[str, str], bool] = {}

    def _born(self, token: str) -> int:
        return self.rank[self.parts[token]] if token in self.parts else -1

    def _edge(self, token: str, side: int) -> list[tuple[str, int, int]]:
        """(part, when made, when consumed) along one edge of the token's merges."""
        out, until = [], NEVER
        while True:
            born = self._born(token)
            out.append((token, born, until))
            if token not in self.parts:
                return out
            token, until = self.parts[token][side], born

    def compatible(self, left: str, right: str) -> bool:
        """Whether ``left`` and ``right`` stay apart when their texts are encoded together."""
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= MOST_PAIRS:
                self.fits.clear()
            found = self.fits[key] = not any(
                rank is not None and rank < gone_a and rank <= gone_b and made_b < gone_a and made_a <= gone_b
                for a, made_a, gone_a in self._edge(left, 1) for b, made_b, gone_b in self._edge(right, 0)
                for rank in (self.rank.get((a, b)),))
        return found

    def single(self, token: str) -> bool:
        """Whether the token is the encoding of its own text: its parts are, and stay together."""
        found = self.whole.get(token)
        if found is None:
            if token not in self.parts:
                found = True
            else:
                a, b = self.parts[token]
                # The halves must live until their own merge: no earlier merge joins their edges.
                rank = self.rank[a, b]
                found = self.single(a) and self.single(b) and not any(
                    r is not None and (x, y) != (a, b) and r < min(gone_x, rank) and r <= min(gone_y, rank)
                    and made_y < gone_x and made_x <= gone_y
                    for x, made_x, gone_x in self._edge(a, 1) for y, made_y, gone_y in self._edge(b, 0)
                    for r in (self.rank.get((x, y)),))
            self.whole[token] = found
        return found

    def word(self, letters: str) -> list[int]:
        """Ids of one word, given as byte letters."""
        text = letters + END
        last: list[str | None] = [None] * (len(text) + 1)
        done = 0
        for at, token in self.finals.iter(text):
            at += 1
            if at == done:
                continue
            before = at - len(token)
            if before == 0:
                fits = self.single(token)
            else:
                fits = last[before] is not None and self.single(token) and self.compatible(last[before], token)
            if fits:
                last[at], done = token, at
        out, at = [], len(text)
        while at:
            token = last[at]
            out.append(self.id[token])
            at -= len(token)
        return out[::-1]

    def chunk(self, text: str) -> list[int]:
        """Ids of a text without spaces, or of any other."""
        out = []
        for i, part in enumerate(self.finder.split(text) if "<" in text else [text]):
            if i % 2:
                out.append(self.special[part])
                continue
            if part and max(part) > LATIN:
                # Beyond Latin the library's own tables decide, which follow another Unicode version.
                words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
            else:
                plain = unicodedata.normalize("NFC", part).lower()
                words = ["".join([self.letters[b] for b in w.encode()]) for w in self.words.findall(plain)]
            for word in words:
                out += self.word(word)
        return out

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [self.chunk(c) for c in chunks]

    def decode(self, ids) -> str:
        """Tokens separated by spaces, as files without a decoder have it."""
        text = self.text
        return " ".join([text[i] for i in ids])


@model
def compiled(path: str) -> tuple[PrefixBpe, Memory]:
    """One compiled tokenizer and its memory in each Python worker."""
    bpe = PrefixBpe(path)
    give_back()
    return bpe, Memory()


def _path(path: str | None) -> str:
    return path or public_tokenizers.path(VOCABULARY)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with the ids of every whole text in ``ids``."""
    path = _path(path)

    def work(batch: pa.RecordBatch) -> dict:
        bpe, memory = compiled(path)
        ids, border = tokenize(batch.column("text"), memory, bpe.encode)
        return {"ids": pa.ListArray.from_arrays(pa.array(border, pa.int32()), pa.array(ids.astype(np.int32)))}

    plain = docs.drop("ids")
    return map_texts(plain, [field("ids", "int[]")], work, keep=plain.columns, uses=compiled)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``text`` decoded from ``ids`` (null: no ids)."""
    path = _path(path)

    def run(batches):
        bpe, _ = compiled(path)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())], [*keep, "text"])

    source = encoded.drop("text")
    keep = source.columns
    return source.mapInArrow(run, T.StructType([*source.schema.fields, field("text", "string")]))


DIGEST = [field("n_tokens", "bigint"), field("ids_sha256", "string"), field("decoded_sha256", "string")]


def round_trip(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode and decode every text in one task; per document n_tokens and digests of both."""
    path = _path(path)

    def work(batch: pa.RecordBatch) -> dict:
        bpe, memory = compiled(path)
        ids, border = tokenize(batch.column("text"), memory, bpe.encode)
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        digests = []
        # One document's ids are listed at a time.
        for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
            own = ids[a:b].tolist()
            digests.append((sha(" ".join(map(str, own))), sha(bpe.decode(own))))
        return {"n_tokens": np.diff(border), "ids_sha256": [x for x, _ in digests], "decoded_sha256": [y for _, y in digests]}

    return map_texts(docs, DIGEST, work, keep=keep, uses=compiled)
