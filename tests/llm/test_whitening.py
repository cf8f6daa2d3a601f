"""Whitening against the eigenvectors of the covariance."""

import math

import numpy as np
import pytest
from cases import workspace

from scoreloom.llm import whitening as module
from scoreloom.llm.whitening import factored, held, solved, taken, whitening


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, n STRING, component INT, x DOUBLE")


def brute(rows, count=16):
    size = max((len(v) for _, v in rows if v is not None), default=0)
    kept = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept])
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(0)
    centred = distinct - sums / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    lead = min(count, size)
    with np.errstate(all="ignore"):
        z = np.abs((x - sums / n) @ axes[:, :lead]) / np.sqrt(np.where(e[:lead] > 1e-9 * max(1, e[0]), e[:lead], np.nan))
    deviation = ((n * x.astype(object) - sums) ** 2).sum(1)
    return [(i, k + 1, n, int(deviation[r]) if deviation[r] < 2**63 else None, z[r, k], e[k] / e.sum()) for r, (i, _) in enumerate(kept) for k in range(lead)]


def check(spark, rows, **settings):
    got = sorted(whitening(table(spark, rows), workspace(spark), **settings).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["component"]))
    want = sorted(brute(rows, settings.get("components", 16)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [tuple(r)[:4] for r in got] == [w[:4] for w in want]
    for r, w in zip(got, want, strict=True):
        if math.isnan(w[4]):
            assert r["whitened"] is None and r["explained"] == pytest.approx(0, abs=1e-12)
        else:
            assert abs(r["whitened"]) == pytest.approx(w[4], abs=1e-8) and r["explained"] == pytest.approx(w[5], rel=1e-9)
            assert r["identity_error"] < 1e-9
    return got


def rows_of(rng, n, d, scale=None):
    x = rng.normal(0, 1, (n, d)) * (np.arange(1, d + 1) if scale is None else scale)
    return [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(1)
    rows = rows_of(rng, 300, 20)
    rows += rows[:40] + [(None, rows[0][1]), (900, None), (901, [None, *rows[1][1][1:]]), (902, [float("nan"), *rows[1][1][1:]]), (903, [float("inf"), *rows[1][1][1:]]), (904, [1.0]), (905, [])]
    rows += [(2000 + i, rows[3][1]) for i in range(200)]  # a third are one vector
    check(spark, rows)
    check(spark, rows, components=3)
    check(spark, rows_of(rng, 50, 4))


def test_signs_are_the_same_for_all_rows(spark):
    rows = rows_of(np.random.default_rng(2), 100, 5)
    got = check(spark, rows)
    model = brute(rows)
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    z = np.array([[by[i, k] for k in range(1, 6)] for i in range(100)])
    assert np.allclose(z.T @ z / 100, np.eye(5), atol=1e-8) and len(model) == 500


def test_ill_conditioned_and_singular(spark):
    rng = np.random.default_rng(3)
    check(spark, rows_of(rng, 200, 6, np.array([1e3, 1e2, 50, 10, 5, 1])))
    base = rng.normal(0, 5, (80, 3))
    exact = np.round(np.hstack([base, base[:, :1], np.full((80, 1), 7)]) * 64) / 64  # an equal column and a constant one
    check(spark, [(i, v.tolist()) for i, v in enumerate(exact)])
    few = rows_of(rng, 4, 9)
    got = check(spark, few)
    assert sum(r["whitened"] is None for r in got) == 4 * 6  # four vectors span three directions


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [float("nan")])], [(1, [])]):
        assert whitening(table(spark, rows), workspace(spark)).count() == 0
    got = whitening(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), workspace(spark)).collect()
    assert [tuple(r)[1:] for r in got] == [(k, 1, 0, None, None, None) for k in (1, 2)] * 2


def test_extreme_components_do_not_stop_the_job(spark):
    got = whitening(table(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 5.0])]), workspace(spark)).collect()
    assert len(got) == 6 and got[0]["deviation"] is None


def test_sums_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(module, "FAN_IN", 2)
    rows = rows_of(np.random.default_rng(4), 90, 3)
    many = table(spark, rows).repartition(9)
    got = whitening(many, workspace(spark)).where("component = 1").select("deviation").collect()
    assert sorted(r[0] for r in got) == sorted(w[3] for w in brute(rows) if w[1] == 1)


def test_kept_matrices_and_solves():
    rng = np.random.default_rng(5)
    for values in (rng.normal(size=(3, 4)), np.array([1, 2**70, -5], object)):
        assert (taken(held(values)) == values).all()
    r = np.triu(rng.normal(size=(5, 5))) + 5 * np.eye(5)
    x = rng.normal(size=(7, 5))
    assert np.allclose(solved(x, r) @ r, x)
    assert np.allclose(np.tril(factored(np.zeros((3, 3)) + 1.0, 0.0), -1), 0)
