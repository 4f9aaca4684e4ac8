from __future__ import annotations

import math

import numpy as np
import pytest

from strata.llm import whitening


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.linspace(1, 0.1, d)[:, None]
    return (rng.normal(size=(n, d)) @ mix).astype(np.float32)


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, _index long, x string").repartition(parts)


def rows_of(values, start=0):
    return [(start + k, [float(c) for c in v], 3, "x") for k, v in enumerate(values)]


def brute_force(values):
    x = np.floor(1024 * values.astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum(int(v) ** 2 for v in n * row - s) for row in x]
    centred = (n * x - s) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    return deviation, centred, e[::-1], v[:, ::-1], np.trace(cov)


def check(got, values, components=8):
    deviation, centred, e, v, trace = brute_force(values)
    k = min(components, values.shape[1])
    assert len(got) == len(values) * k
    by = {(r["vec_id"], r["component"]): r for r in got}
    for j in range(k):
        want = centred @ v[:, j] / math.sqrt(e[j])
        have = np.array([by[i, j + 1]["whitened"] for i in range(len(values))])
        sign = 1 if want @ have > 0 else -1
        assert np.abs(have - sign * want).max() < 1e-6
        assert by[0, j + 1]["explained"] == pytest.approx(e[j] / trace, rel=1e-6)
    assert [by[i, 1]["deviation"] for i in range(len(values))] == deviation
    assert {r["n"] for r in got} == {len(values)}
    assert len({r["identity_error"] for r in got}) == 1 and 0 <= got[0]["identity_error"] < 1e-8


@pytest.mark.parametrize("n, d, block", [(700, 12, 64), (300, 5, 4_096), (257, 16, 256)])
def test_equals_numpy(spark, monkeypatch, n, d, block):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", block)
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 2)
    values = vectors(n, d)
    check(whitening.whitened_rows(frame(spark, rows_of(values))).collect(), values)


def test_unsound_and_short_vectors_are_dropped(spark):
    values = vectors(200, 6)
    odd = [
        (900, None, 1, "x"), (901, [None] * 6, 1, "x"), (902, [1.0, 2.0, None, 0.0, 0.0, 0.0], 1, "x"),
        (903, [math.nan] + [0.0] * 5, 1, "x"), (904, [math.inf] + [0.0] * 5, 1, "x"),
        (905, [-math.inf] + [0.0] * 5, 1, "x"), (906, [1e38] + [0.0] * 5, 1, "x"), (907, [], 1, "x"), (908, [1.0], 1, "x"),
    ]
    check(whitening.whitened_rows(frame(spark, rows_of(values) + odd)).collect(), values)


def test_one_vector_many_times_and_odd_ids(spark):
    values = np.concatenate([vectors(60, 4), np.repeat(vectors(1, 4, seed=9), 40, axis=0)])
    rows = rows_of(values)
    rows[3] = (None, *rows[3][1:])
    rows[4] = (5, *rows[4][1:])
    got = whitening.whitened_rows(frame(spark, rows)).collect()
    assert len(got) == 400
    by_id = sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1)
    deviation = brute_force(values)[0]
    assert by_id == sorted((str(r[0]), d) for r, d in zip(rows, deviation, strict=True))


def test_flat_directions_have_no_rows(spark):
    values = vectors(100, 6)
    values[:, 3:] = 0.25
    got = whitening.whitened_rows(frame(spark, rows_of(values))).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-8
    assert whitening.whitened_rows(frame(spark, rows_of(np.full((9, 3), 0.5)))).count() == 0
    assert whitening.whitened_rows(frame(spark, rows_of(vectors(1, 3)))).count() == 0


def test_a_deviation_beyond_64_bits_is_null(spark):
    values = vectors(50, 3)
    values[7] = 8e11
    got = whitening.whitened_rows(frame(spark, rows_of(values))).collect()
    assert len(got) == 50 * len({r["component"] for r in got}) and got[0]["identity_error"] < 1e-4
    assert all(r["deviation"] is None for r in got)


def test_empty_tables(spark):
    none = whitening.whitened_rows(frame(spark, []))
    assert none.count() == 0
    assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whitened_rows(frame(spark, [(1, None, 1, "x"), (2, [], 1, "x")])).count() == 0
