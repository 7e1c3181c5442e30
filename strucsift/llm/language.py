"""Language ID by error-correcting output codes over hashed n-grams.

Every language has a codeword. For each bit a binary classifier, a log ratio of the n-gram shares
of the languages on either side, predicts the bit of a text. Decoding adds, for each language, the
logistic losses of its codeword's bits, weighted by how well each classifier does on documents of
that language, and takes the language of the smallest sum; a small lead over the next is flagged.

Counts and weights are learned from all training documents, language by language, so that frequent
languages have no advantage. What the driver receives is bounded by buckets times languages.

Defined results: a null text, or one without letters, is ``und`` with score 0. Training rows with a
null language teach nothing. With one language every text with letters has it; with none, all are
``und``. Repeated rows are predicted each by itself. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.llm.common import field, map_texts, prepare, steps
from strucsift.llm.textscan import grams, per_text, text_bytes

SIZES = (1, 2, 3)
# Hash buckets for n-grams of each size.
BUCKETS = 1 << 15
# Languages with an exhaustive code (2 ** (k - 1) - 1 bits); more get random codewords.
EXHAUSTIVE = 6
# Leads below this are flagged as ambiguous.
LEAD = 0.1
UNDETERMINED = "und"

# Letters are lower-cased; bytes that are no letters become spaces.
PLAIN = np.full(256, 0x20, np.uint8)
PLAIN[0x61:0x7B] = PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
PLAIN[0x80:] = np.arange(0x80, 0x100)


def codewords(k: int) -> np.ndarray:
    """A matrix of +1 and -1, one row for each of ``k`` languages, rows far apart."""
    if k < 2:
        return np.zeros((k, 0))
    if k <= EXHAUSTIVE:
        # All ways to split the languages in two, the first one always +1.
        columns = [[1, *(1 if bits >> i & 1 else -1 for i in range(k - 1))] for bits in range(2 ** (k - 1) - 1)]
        return np.array(columns, float).T
    draw, best, apart = np.random.default_rng(k), None, -1.0
    for _ in range(200):
        code = draw.choice([-1.0, 1.0], (k, int(np.ceil(10 * np.log2(k)))))
        least = min((code[i] != code[j]).sum() for i, j in combinations(range(k), 2))
        if (np.abs(code.sum(axis=0)) < k).all() and least > apart:
            best, apart = code, least
    return best


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all sizes, and the borders of texts, size by size."""
    data, edges = text_bytes(column)
    plain = PLAIN[data]
    parts = [grams(plain, edges, n, BUCKETS) for n in SIZES]
    return [c + i * BUCKETS for i, (c, _) in enumerate(parts)], [b for _, b in parts]


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter, of any script."""
    data, edges = text_bytes(column)
    plain = PLAIN[data]
    found = per_text((plain >= 0x61) & (plain < 0x7B), edges) > 0
    for i in np.flatnonzero(~found & (per_text(plain >= 0x80, edges) > 0)).tolist():
        found[i] = any(map(str.isalpha, data[edges[i]:edges[i + 1]].tobytes().decode("utf-8", "replace")))
    return found


@dataclass
class Model:
    """Languages, their codewords, n-gram weights of every bit, and the losses' weights."""

    languages: list[str]
    code: np.ndarray
    weight: np.ndarray
    trust: np.ndarray

    def margins(self, column: pa.Array) -> np.ndarray:
        """A signed margin for every text and bit: mean log ratio by the root of the n-grams."""
        out = np.zeros((len(column), self.weight.shape[1]))
        total = np.zeros(len(column))
        for codes, border in zip(*_codes(column), strict=True):
            total += np.diff(border)
            for bit in range(self.weight.shape[1]):
                run = np.concatenate([[0.0], np.cumsum(self.weight[codes, bit])])
                out[:, bit] += run[border[1:]] - run[border[:-1]]
        return np.clip(out / np.sqrt(np.maximum(total, 1))[:, None], -30, 30)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest language of every row, its score and its lead over the next."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        far = (loss * self.trust[None]).sum(axis=2)
        order = np.sort(far, axis=1)
        score = 1 / np.exp(order[:, :1] - far).sum(axis=1)
        lead = order[:, 1] - order[:, 0] if far.shape[1] > 1 else np.full(len(far), np.inf)
        return far.argmin(axis=1), score, lead


def _gather(rows: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def learn(training: DataFrame) -> Model:
    """Fit the classifiers and their weights to all of ``training`` (text, lang)."""
    prepare(training.sparkSession)
    known = training.filter(F.col("lang").isNotNull()).select(F.col("text").cast("string").alias("text"), "lang")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in steps(whole):
                langs = np.array(batch.column("lang").to_pylist(), object)
                for codes, border in zip(*_codes(batch.column("text")), strict=True):
                    owner = np.repeat(langs, np.diff(border))
                    for lang in set(langs):
                        own = total.setdefault(lang, np.zeros(len(SIZES) * BUCKETS, np.int64))
                        own += np.bincount(codes[owner == lang], minlength=len(own))
        for lang, own in total.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(own[used])],
                                             ["lang", "bucket", "n"])

    found = known.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), len(SIZES) * BUCKETS))
    counts[found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), found["bucket"].to_numpy(int)] = found["n"]
    share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5)
    code = codewords(len(languages))
    weight = np.stack([np.log(share[code[:, j] > 0].mean(axis=0)) - np.log(share[code[:, j] < 0].mean(axis=0))
                       for j in range(code.shape[1])], axis=1) if code.shape[1] else np.zeros((len(SIZES) * BUCKETS, 0))
    model = Model(languages, code, weight.astype(np.float32), np.ones_like(code))
    if code.shape[1]:
        model.trust = _trust(known, model)
    return model


def _trust(known: DataFrame, model: Model) -> np.ndarray:
    """Each classifier's share of right bits on each language, scaled to a mean of 1."""
    shared = known.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        m = shared.value
        right, total = np.zeros_like(m.code), np.zeros(len(m.languages))
        place = {x: i for i, x in enumerate(m.languages)}
        for whole in batches:
            for batch in steps(whole):
                of = np.array([place[x] for x in batch.column("lang").to_pylist()], int)
                np.add.at(right, of, (m.margins(batch.column("text")) * m.code[of] > 0))
                np.add.at(total, of, 1)
        yield _gather([(i, j, float(right[i, j]), float(total[i])) for i, j in np.ndindex(*right.shape)],
                      ["i", "j", "right", "total"], [pa.int32(), pa.int32(), pa.float64(), pa.float64()])

    rows = known.mapInArrow(judge, "i int, j int, right double, total double").groupBy("i", "j").agg(
        (F.sum("right") / F.sum("total")).alias("share")).collect()
    trust = np.zeros_like(model.code)
    for r in rows:
        trust[r.i, r.j] = r.share or 0.0
    return trust / np.maximum(trust.mean(axis=1, keepdims=True), 1e-9)


FIELDS = [field("lang_pred", "string"), field("score", "double"), field("ambiguous", "boolean")]


def predict(docs: DataFrame, model: Model, lead: float = LEAD) -> DataFrame:
    """Per document: lang_pred, score from 0 to 1, and whether the decision is ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> dict:
        m, column = shared.value, batch.column("text")
        letters = has_letter(column)
        if not m.languages:
            n = len(column)
            return {"lang_pred": [UNDETERMINED] * n, "score": [0.0] * n, "ambiguous": [True] * n}
        best, score, ahead = m.decode(m.margins(column))
        return {"lang_pred": [m.languages[i] if ok else UNDETERMINED for i, ok in zip(best, letters, strict=True)],
                "score": np.where(letters, score, 0.0), "ambiguous": ~letters | (ahead < lead)}

    return map_texts(docs, FIELDS, work)
