"""Collocations against plain counting, with small budgets, many words and odd tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strucsift.llm import phrases

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, least, best):
    """The contract's rows for (lang, text)."""
    counts = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            own.update(tuple(words[i:i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        covered = set()
        for p, c in found.items():
            for k in range(2, len(p)):
                covered.update(s for s in (p[i:i + k] for i in range(len(p) - k + 1)) if 100 * c >= 100 * found[s])
        lines = []
        for p, a in found.items():
            if p not in covered:
                score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                lines.append((score, a, " ".join(p), left, right))
        lines.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, left, right, n, score) for i, (score, a, p, left, right) in enumerate(lines[:best], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def pairs(table):
    return [(r.lang, r.text) for r in table.collect()]


def test_equal_to_plain_counting(table, pairs):
    expected = plain(pairs, 20, 2000)
    assert len(expected) > 100 and rows_of(phrases.collocations(table, least=20)) == expected


@pytest.mark.parametrize("options", [dict(budget=3), dict(budget=60, few_words=0), dict(bits=10, budget=1_000_000), dict(ranked=7, best=5)])
def test_every_way_gives_the_same(table, pairs, options, monkeypatch):
    """Prefixes extended to whole suffixes, words in a bitmap, codes that clash at first, shares of a ranking."""
    monkeypatch.setattr(phrases, "PAIR_BITS", 12)
    monkeypatch.setattr(phrases, "HEAVY_BITS", 9)
    monkeypatch.setattr(phrases, "STEP_WORDS", 997)
    best = options.get("best", 2000)
    assert rows_of(phrases.collocations(table, least=12, **options)) == plain(pairs, 12, best)


def test_odd_rows_and_repeated_ones(spark):
    rnd = random.Random(4)
    rows = [(None, None), ("en", None), (None, ""), ("en", " \t\n..;"), ("en", "A b a B a b.\na\tb"), (None, "a b"), ("und", "a b a b"),
            ("fr", "é è é è"), ("en", "x " * 5000), ("", "a b a b"), ("en", "q" * 100_000 + " z"), ("de", "a\x01b a\x01 b\x0bc c")]
    rows += [(rnd.choice(["en", None]), " ".join(rnd.choice("abc") for _ in range(30))) for _ in range(40)]
    rows += rows[-5:]
    df = spark.createDataFrame(rows, "lang string, text string")
    df = df.withColumns({c: F.lit("x") for c in ("phrase", "a", "n", "code", "word", "score", "doc_id", "codes")})
    assert rows_of(phrases.collocations(df, least=2, budget=40)) == plain(rows, 2, 2000)
    assert rows_of(phrases.collocations(df.limit(0))) == []


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**14 + 7
    found = spark.createDataFrame([([1, 2], big)], "phrase array<bigint>, a bigint")
    words = spark.createDataFrame([("en", "x", 1, big + 1), ("en", "y", 2, big + 5)], "lang string, word string, code bigint, n bigint")
    totals = spark.createDataFrame([("en", 10**17 + 3)], "lang string, n bigint")
    row = phrases.scored(found, words, totals).first()
    assert row.score == 1000 * big * (10**17 + 3) // ((big + 1) * (big + 5)) and (row.l, row.r) == (big + 1, big + 5)
