"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, maps letters that look alike (other scripts, full width) and digits that stand
for letters, and drops invisible characters, so that disguised words are matched as plain ones. The
lexicon is learned: beginnings of words that are significantly more frequent in toxic documents,
with the log ratio of document shares as weight. Phrases that contain an entry but occur in clean
documents are exceptions: hits inside them do not count. The sum of the hits' weights is divided by
the root of the number of words, and a logistic curve fitted to the labels makes it a score.

Learning uses at most ``FIT_ROWS`` labelled documents (those of the smallest hashes of their ids);
every document is scored over its whole text. What the driver receives is bounded by the rows and
candidates named below.

Defined results: a null or empty text has no hit and the score of a text without hits. Labels that
are null are ignored. Without toxic training rows the lexicon is empty and every score is the same,
below the threshold. Repeated rows are scored each by itself. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field as default

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.llm.common import field, map_texts, prepare
from strucsift.session import cut_lineage

# Labelled documents that the lexicon and the curve are fitted to.
FIT_ROWS = 20_000
# Word beginnings considered, and entries and exceptions kept, at most.
CANDIDATES, ENTRIES = 100_000, 2_000
SHORTEST, LONGEST = 3, 8
# Log-likelihood ratio that an entry needs: one in some millions by chance.
SIGNIFICANT = 30.0
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones, and signs read as letters. The
# digit 1 stands for i and for l, so that these two are folded into one.
ALIKE = dict(zip("аеорсухіјѕкмтвнԁԛԝαορνικτυεı", "aeopcyxijskmtbhdqwaopviktuei", strict=True))
DIGITS = dict(zip("01345789@$!", "oieastbgasi", strict=True))
INVISIBLE = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF])
TABLE = {ord(k): v for k, v in ALIKE.items()} | INVISIBLE
STANDING_IN = re.compile(r"(?<=[^\W\d_])[01345789]+|[01345789@$]+(?=[^\W\d_])|(?<=[^\W\d_])!(?=[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(TABLE)
    text = STANDING_IN.sub(lambda m: "".join(DIGITS.get(c, c) for c in m[0]), text)
    return WORD.findall(text.replace("l", "i"))


@dataclass
class Lexicon:
    """Word beginnings with weights, exceptions (words or phrases), and the curve's two numbers.

    Entries and exceptions are words of letters; they are folded as texts are.
    """

    weights: dict[str, float]
    exceptions: list[str] = default(default_factory=list)
    slope: float = 0.0
    level: float = -10.0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for stem, weight in self.weights.items():
            entry = f" {' '.join(fold(stem))}"
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            entry = f" {' '.join(fold(phrase))} "
            found.add_word(entry, (len(entry), None))
        if len(found):
            found.make_automaton()
        return found

    def hits(self, automaton: ahocorasick.Automaton, words: list[str]) -> list[tuple[int, float]]:
        """(place of the word, weight) of every hit that is in no exception."""
        if not len(automaton) or not words:
            return []
        line = f" {' '.join(words)} "
        best: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        for end, (length, weight) in automaton.iter(line):
            begin = end - length + 1
            if weight is None:
                free.append((begin, end))
            else:
                best[begin] = max(weight, best.get(begin, weight))
        return [(b, w) for b, w in sorted(best.items()) if not any(lo <= b < hi for lo, hi in free)]

    def density(self, automaton: ahocorasick.Automaton, text: str | None) -> tuple[float, int]:
        """The hits' weights over the root of the number of words, and the number of hits."""
        words = fold(text)
        found = self.hits(automaton, words)
        return sum(w for _, w in found) / max(1, len(words)) ** 0.5, len(found)

    def score(self, density: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * density + self.level, -50, 50))))


def _tally(docs: DataFrame, features: Callable[[str | None], set[str]]) -> DataFrame:
    """(feature, pos, neg): toxic and clean documents with each feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts[not toxic].update(features(text))
        names = list({**counts[0], **counts[1]})
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts]],
                                         ["feature", "pos", "neg"])

    return docs.select("text", "toxic").mapInArrow(run, "feature string, pos bigint, neg bigint").groupBy("feature").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def stems_of(text: str | None) -> set[str]:
    return {w[:k] for w in set(fold(text)) for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _surprise(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    """Twice the log-likelihood ratio of unequal against equal shares."""
    total, out = pos + neg, 0.0
    for seen, size in ((pos, n_pos), (neg, n_neg)):
        expected = total * size / (n_pos + n_neg)
        for o, e in ((seen, expected), (size - seen, size - expected)):
            out += o * np.log(o / e) if o > 0 and e > 0 else 0.0
    return 2 * out


def choose(rows: list[tuple[str, int, int]], n_pos: int, n_neg: int) -> dict[str, float]:
    """Entries by weight. A beginning that nearly always goes on in one way gives way to the longer
    one; a longer one is left out if it is hardly more telling than a shorter entry."""
    support = {stem: pos for stem, pos, _ in rows}
    longer: dict[str, int] = {}
    for stem, pos in support.items():
        longer[stem[:-1]] = max(pos, longer.get(stem[:-1], 0))
    kept: dict[str, float] = {}
    for stem, pos, neg in sorted(rows, key=lambda r: (len(r[0]), -r[1], r[0])):
        weight = float(np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1)))
        if 20 * longer.get(stem, 0) >= 19 * pos or weight < 1.5 or _surprise(pos, neg, n_pos, n_neg) < SIGNIFICANT:
            continue
        if all(kept.get(stem[:k], 0) < weight - 1 for k in range(SHORTEST, len(stem))):
            kept[stem] = weight
    return dict(sorted(kept.items(), key=lambda r: (-support[r[0]], r[0]))[:ENTRIES])


def _curve(density: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve, by Newton's method with a small penalty."""
    x = np.stack([density, np.ones_like(density)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (toxic - p) - np.array([0.01, 0.01]) * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Lexicon:
    """A lexicon from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic)."""
    prepare(docs.sparkSession)
    chosen = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    # At most fit_rows ids and flags: small enough for a broadcast.
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = cut_lineage(sample.drop("doc_id"), "labelled")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_pos, n_neg = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos:
        return Lexicon({})
    found = _tally(sample.filter("toxic"), stems_of).orderBy(F.desc("pos"), "feature").limit(CANDIDATES).select("feature", "pos").collect()
    positive = {r.feature: r.pos for r in found if 2 * r.pos * np.log((n_pos + n_neg) / n_pos) >= SIGNIFICANT}
    names = frozenset(positive)
    clean = {r.feature: r.neg for r in _tally(sample.filter("NOT toxic"), lambda t: stems_of(t) & names).collect()}
    lexicon = Lexicon(choose([(s, p, clean.get(s, 0)) for s, p in positive.items()], n_pos, n_neg))
    if not lexicon.weights:
        return lexicon
    lexicon.exceptions = _exceptions(sample, lexicon, n_pos, n_neg)

    def measure(batch: pa.RecordBatch) -> dict:
        automaton = lexicon.automaton()
        return {"density": [lexicon.density(automaton, t)[0] for t in batch.column("text").to_pylist()]}

    rows = map_texts(sample, [field("density", "double")], measure, keep=("toxic",)).toPandas()
    lexicon.slope, lexicon.level = _curve(rows["density"].to_numpy(float), rows["toxic"].to_numpy(float))
    return lexicon


def _exceptions(sample: DataFrame, lexicon: Lexicon, n_pos: int, n_neg: int) -> list[str]:
    """Words, and pairs of words, that hold an entry but are no rarer in clean documents."""
    stems = tuple(lexicon.weights)

    def held(text: str | None) -> set[str]:
        words = fold(text)
        at = [i for i, w in enumerate(words) if w.startswith(stems)]
        pairs = {" ".join(words[j:j + 2]) for i in at for j in (i - 1, i) if 0 <= j < len(words) - 1}
        return {words[i] for i in at} | pairs

    often = _tally(sample, held).filter((F.col("neg") >= 3) & (F.col("neg") * n_pos >= F.col("pos") * n_neg))
    return sorted(r.feature for r in often.orderBy(F.desc("neg"), "feature").limit(ENTRIES).collect())


FIELDS = [field("score", "double"), field("n_hits", "bigint")]


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: score from 0 to 1, the number of hits, and predicted (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batch: pa.RecordBatch) -> dict:
        own = shared.value
        automaton = own.automaton()
        found = [own.density(automaton, t) for t in batch.column("text").to_pylist()]
        return {"score": [own.score(d) for d, _ in found], "n_hits": [n for _, n in found]}

    return map_texts(docs, FIELDS, work).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
