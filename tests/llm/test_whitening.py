"""Whitening against dense linear algebra, on close and missing components and odd tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strucsift.llm import whitening

SMALL = "/root/testdata/sf0.001"


def plain(vectors, components=16):
    """(n, deviations, whitened rows up to sign, explained) of finite vectors of one dimension."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    away = (n * fit - sums) / n
    values, q = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-values)[:components]
    deviation = [sum(int(d) ** 2 for d in n * row.astype(object) - sums) for row in x]
    return n, deviation, (n * x - sums) / n @ q[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def agrees(df, rows, within):
    """Whether the whitened ``df`` has what dense linear algebra gives for ``rows`` {id: vector}."""
    n, deviation, white, explained = plain(list(rows.values()))
    found = {(r.vec_id, r.component): r for r in df.collect()}
    assert len(found) == white.size and {r.n for r in found.values()} == {n}
    signs = [np.sign(sum(found[i, k + 1].whitened * white[at, k] for at, i in enumerate(rows))) for k in range(white.shape[1])]
    for at, i in enumerate(rows):
        for k, sign in enumerate(signs):
            r = found[i, k + 1]
            assert r.deviation == deviation[at] and abs(r.whitened - sign * white[at, k]) < within
            assert abs(r.explained / explained[k] - 1) < 1e-9 and r.identity_error < 1e-9


def test_query_equals_dense_algebra(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    agrees(whitening.whiten(table), {r.vec_id: r.embedding for r in table.collect()}, 1e-9)


def test_odd_rows_are_dropped_and_names_may_clash(spark):
    draw = np.random.default_rng(3)
    good = {i: draw.standard_normal(5).tolist() for i in range(40)}
    good[40] = good[39]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [-inf] * 5, [1.0, 2.0]]
    rows = [*good.items(), *((100 + i, v) for i, v in enumerate(odd)), (None, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.withColumns({c: F.lit("x") for c in ("__x", "i", "j", "v", "n", "x", "size", "component", "whitened")})
    agrees(whitening.whiten(df), good, 1e-10)
    null_id = whitening.whiten(df.select(F.lit(None).cast("bigint").alias("vec_id"), "embedding"))
    assert null_id.count() == 41 * 5 and null_id.filter("vec_id IS NULL").count() == 41 * 5


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance_gives_no_component(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = whitening.whiten(df)
    assert found.count() == 0 and "whitened" in found.columns


def test_components_of_lower_rank(spark):
    """Vectors in a plane have two components; the covariance of what remains is the identity."""
    rows = [(i, [float(i % 7), float(i // 7), float(i % 7 + i // 7), 0.0]) for i in range(49)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert len(found) == 2 * 49 and max(r.identity_error for r in found) < 1e-10
    assert abs(sum({r.component: r.explained for r in found}.values()) - 1) < 1e-12


def test_subspace_iteration_finds_close_and_hidden_components():
    """A dense matrix with close eigenvalues, some of which the first block hardly contains."""
    draw = np.random.default_rng(11)
    q = np.linalg.qr(draw.standard_normal((120, 120)))[0]
    values = np.sort(np.concatenate([50 + np.arange(16) * 0.01, draw.uniform(30, 49.9, 104)]))[::-1]
    matrix = (q * values) @ q.T
    found, vectors = whitening.principal(lambda y: matrix @ y, 120)
    assert np.abs(found - values[:16]).max() < 1e-10
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-10
    # A block without a direction of 60: the probe finds it, and nothing where nothing is.
    more = matrix + 10 * np.outer(q[:, 60], q[:, 60]) + (50 - values[60]) * np.outer(q[:, 60], q[:, 60])
    sought = lambda block: whitening._missed(lambda y: more @ y, block, values[15], 30.0, draw, 10, 60.0)
    missed = sought(q[:, :20])
    assert missed is not None and abs(missed[:, 0] @ q[:, 60]) > 0.99
    assert sought(q[:, [*range(20), 60]]) is None


def test_deviations_beyond_64_bits_are_refused(spark):
    df = spark.createDataFrame([(1, [1e12]), (2, [-1e12])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(df).collect()
