"""Whitening: the updates against a direct eigendecomposition, the query against exact integers and plain numpy."""

import math
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from scrubline.llm import whitening
from scrubline.llm.queries import QUERIES
from scrubline.llm.whitening import Spectrum, Whitening

COLUMNS = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def plain(vectors, components=8):
    """(n, deviations, whitened, explained) from (vec_id, list) rows, by exact sums and one dense eigendecomposition."""
    good = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * Fraction(c)) + 100000 for c in v] for _, v in good]
    n, dims = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(dims)]
    apart = [[n * r[k] - sums[k] for k in range(dims)] for r in x]
    centred = np.array([[a / n for a in r] for r in apart])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    with np.errstate(all="ignore"):
        white = centred @ basis / np.sqrt(values)
    return n, [sum(a * a for a in r) for r in apart], white, values / np.trace(centred.T @ centred / n)


def same(rows, vectors, components=8):
    n, deviations, white, explained = plain(vectors, components)
    good = [i for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    k = min(components, white.shape[1])
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(got) == n * k
    for c in range(k):
        mine = np.array([got[i, c + 1].whitened for i in good])
        sign = np.sign(mine @ white[:, c])
        assert np.allclose(mine, sign * white[:, c], rtol=1e-7, atol=1e-7)
        assert math.isclose(got[good[0], c + 1].explained, explained[c], rel_tol=1e-9)
    assert [got[i, 1].deviation for i in good] == deviations
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9


def frame(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")


def test_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.01"
    table = pq.read_table(f"{path}/embeddings.parquet")
    rows = QUERIES["op13_embedding_whitening"](spark, path)
    assert tuple(rows.columns) == COLUMNS
    same(rows.collect(), list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist())))


@pytest.mark.parametrize("dims", [1, 2, 3, 17, 40])
def test_updates_equal_a_direct_decomposition(dims):
    rng = np.random.default_rng(dims)
    values, vectors, whole = np.zeros(dims), np.eye(dims), np.zeros((dims, dims))
    for i in range(200):
        update = rng.normal(size=dims) * 10 ** rng.uniform(-3, 3)
        if i % 5 == 0:  # a direction that meets one axis only, or all but one
            update = np.eye(dims)[rng.integers(dims)] * (1 + i % 3)
        elif i % 7 == 0:
            update[rng.integers(dims)] = 0
        whole += np.outer(update, update)
        values, vectors = whitening.rank_one(values, vectors, update)
    direct = np.linalg.eigvalsh(whole)
    assert np.allclose(values, direct, rtol=0, atol=1e-12 * direct[-1])
    assert np.allclose(vectors.T @ vectors, np.eye(dims), atol=1e-12)
    assert np.allclose(vectors * values @ vectors.T, whole, rtol=0, atol=1e-11 * direct[-1])


def test_equal_eigenvalues_are_deflated():
    values, vectors = whitening.rank_one(np.ones(6), np.eye(6), np.full(6, 2.0))
    assert np.allclose(values, [1, 1, 1, 1, 1, 25]) and np.allclose(np.abs(vectors[:, -1]), 1 / np.sqrt(6))
    # Nothing to turn.
    assert whitening.rank_one(np.ones(3), np.eye(3), np.zeros(3))[0].tolist() == [1, 1, 1]


def test_spectra_combine_to_that_of_all_rows():
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(500, 9)) * 100 + np.arange(9) * 1000)
    parts = [Spectrum.empty(9) for _ in range(4)]
    for part, own in zip(parts, np.split(rows, [3, 7, 300])):
        part.add_rows(own)
    first, *others = parts
    for other in others:
        first.add_spectrum(other)
    centred = rows - rows.mean(axis=0)
    assert first.n == 500 and first.sums == [int(x) for x in rows.sum(axis=0)]
    assert np.allclose(first.values, np.linalg.eigvalsh(centred.T @ centred), rtol=1e-10)


@pytest.mark.parametrize("rule", [Whitening(), Whitening(components=3, block_rows=16, group_bytes=1)])
def test_partitions_and_blocks_do_not_matter(spark, rule):
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.normal(size=12) * np.arange(1, 13)).tolist()) for i in range(300)]
    same(whitening.whiten(frame(spark, vectors).repartition(23), rule).collect(), vectors, rule.components)


def test_missing_entries_lengths_and_repeats(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 2.0, 3.0]), (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1e300, 0.0, 0.0, 0.0]), (106, [1.0, 2.0])]
    same(whitening.whiten(frame(spark, good + bad)).collect(), good)
    repeated = whitening.whiten(frame(spark, good + [good[0]] * 50 + [(None, good[1][1])])).collect()
    assert len(repeated) == 81 * 4 and {r.n for r in repeated} == {81} and sum(r.vec_id is None for r in repeated) == 4
    assert len({r.whitened for r in repeated if r.vec_id == 0 and r.component == 1}) == 1


def test_no_variance_and_no_rows(spark):
    alike = whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 5)).collect()
    assert len(alike) == 10 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.identity_error is None for r in alike)
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)])).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True, 3: True}
    assert max(r.identity_error for r in line) < 1e-9
    for rows in ([], [(1, None), (2, [])]):
        empty = whitening.whiten(frame(spark, rows))
        assert empty.columns == list(COLUMNS) and empty.collect() == []


def test_large_entries_stay_exact(spark):
    vectors = [(i, [float(2**40 + i * i), -float(i)]) for i in range(20)]
    n, deviations, *_ = plain(vectors)
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, vectors)).collect()}
    assert got == dict(enumerate(deviations))
    # No long holds these sums.
    far = whitening.whiten(frame(spark, [(1, [2.0**51]), (2, [-(2.0**51)])])).collect()
    assert [r.deviation for r in far] == [None, None]


def test_other_columns_and_floats(spark):
    vectors = [(i, [float(np.float32(np.sin((i + 1) ** 2 * (k + 1)))) for k in range(5)]) for i in range(40)]
    rows = frame(spark, vectors).selectExpr("vec_id", "cast(embedding as array<float>) embedding", "'x' as n", "1 as component", "2 as part")
    same(whitening.whiten(rows).collect(), vectors)
