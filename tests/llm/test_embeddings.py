"""Hard negatives and whitening against brute force in plain Python and numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from meterloom.llm import feast, hard_negatives, whitening
from meterloom.llm.queries import llm_queries

SCHEMA = "vec_id long, embedding array<float>, label int, x string, uid string, slot string, n string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)


def _usable(rows):
    kept = []
    for vec_id, vector, label in rows:
        if vector is None or label is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        exact = [np.float64(np.float32(c)) for c in vector]
        kept.append((vec_id, label, [math.floor(256 * c) for c in exact]))
    return kept


def _mined(rows, rules=hard_negatives.MiningRules()):
    rows, found = _usable(rows), []

    def key(r):
        return (r[0] is None, r[0] or 0)

    for a, (anchor, label, x) in enumerate(rows):
        if anchor is None or anchor % 50:
            continue
        scored = [
            (-sum(u * v for u, v in zip(x, y)), key((i,)), i, other == label)
            for b, (i, other, y) in enumerate(rows) if b != a
        ]
        scored.sort(key=lambda r: r[:2])
        for p, _, positive, _ in [r for r in scored if r[3]][: rules.n_positives]:
            near = [
                r for r in scored
                if not r[3] and rules.least * -p <= 100 * -r[0] <= rules.most * -p
            ]
            for rank, (n, _, negative, _) in enumerate(near[: rules.n_negatives], 1):
                found.append((anchor, positive, rank, negative, -p, -n))
    return sorted(found, key=str)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def odd():
    """Clusters, copies under one label and another, ties, nulls, repeated rows, a zero vector."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((5, 24)) / 5
    rows = []
    for i in range(700):
        centre = centres[i % 5]
        rows.append((i, (centre + rng.standard_normal(24) / 20).tolist(), int(i % 3)))
    rows += [(700 + i, rows[3][1], 0 if i % 2 else 1) for i in range(150)]  # one vector, many rows
    rows += [(900, None, 1), (950, [math.nan] * 24, 1), (1000, [None] + [0.1] * 23, 2)]
    rows += [(1050, [math.inf] + [0.1] * 23, 2), (1100, rows[0][1], None), (None, rows[0][1], 0)]
    rows += [(50, rows[50][1], rows[50][2])] * 2 + [(1150, [0.0] * 24, 1), (1200, [0.2] * 24, 77)]
    return rows


def test_hard_negatives_equal_brute_force(spark, odd, monkeypatch):
    frame = _frame(spark, odd)
    assert _found(hard_negatives.mine(spark, frame)) == _mined(odd)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "TASK_ANCHORS", 5)
    wide = hard_negatives.MiningRules(n_positives=4, n_negatives=6, least=10, most=100)
    assert _found(hard_negatives.mine(spark, frame, rules=wide)) == _mined(odd, wide)


def test_hard_negatives_of_few_rows(spark):
    assert _found(hard_negatives.mine(spark, _frame(spark, []))) == []
    for n in (0, 1, 3):
        rows = [(50 * i, [0.5] * n, i % 2) for i in range(6)]
        assert _found(hard_negatives.mine(spark, _frame(spark, rows))) == _mined(rows)
    with pytest.raises(ValueError, match="components"):
        hard_negatives.mine(spark, _frame(spark, [(0, [0.5], 1), (1, [0.5, 1.0], 1)]))


def test_large_components_are_scored_exactly(spark):
    rows = [(0, [3e7, -2.0], 0), (1, [3e7, 1.0], 0), (2, [2e7, 5.0], 1), (3, [2e7, 5.0], 2)]
    rows = [(i, [c / 16 for c in x], label) for i, x, label in rows]
    assert _found(hard_negatives.mine(spark, _frame(spark, rows))) == _mined(rows)


@pytest.mark.parametrize("size", [1, 5, 64, 70, 130])
def test_intervals_hold_every_score(size):
    rng = np.random.default_rng(size)
    x = np.floor(rng.standard_normal((300, size)) * rng.choice([1, 40, 1e5], (300, 1))).astype(np.int64)
    x[:5] = 0
    x[5:20] = x[30]
    low, high = hard_negatives.Codes(x).intervals(x[:60], slice(0, 300))
    scores = x[:60] @ x.T
    assert (low <= scores).all() and (scores <= high).all()
    # They are no trivial bounds either: narrower than the product of the norms.
    norms = np.linalg.norm(x.astype(float), axis=1)
    assert (high - low).mean() < 2 * (norms[:60, None] * norms).mean()


def test_mining_keeps_labels_and_copies_apart(spark, odd):
    """Blocks are dealt by row, so one label or vector does not fill a task."""
    rows = [(i, odd[3][1], 1) for i in range(4000)] + [(5000 + i, odd[i][1], 2) for i in range(200)]
    frame = _frame(spark, rows)
    usable = frame.selectExpr("vec_id", "CAST(label AS BIGINT) AS label", "CAST(null AS array<bigint>) AS x")
    usable = usable.selectExpr("vec_id", "label", "array(1L) AS x")
    search = hard_negatives.Search(spark, usable, "vec_id % 50 = 0")
    dealt = search.dealt(search.anchors).filter("kind = 0").groupBy("slot", "part").count().collect()
    assert len(dealt) == search.n_slots == 4
    assert max(r["count"] for r in dealt) < 1.2 * 4200 / 4


@pytest.mark.parametrize("seed", range(12))
def test_feast_equals_dense_solver(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 70))
    x = rng.standard_normal((int(rng.integers(1, 150)), d)) * np.exp(2 * rng.standard_normal(d))
    if seed % 4 == 0:  # equal eigenvalues
        x = np.repeat(np.eye(d), 2, axis=0)
    matrix = np.cov(x.T, bias=True).reshape(d, d)
    values, vectors = feast.largest_pairs(matrix, 4)
    expected = np.linalg.eigvalsh(matrix)[::-1][:4]
    top = max(np.linalg.norm(matrix), 1e-300)
    assert np.abs(values - expected).max() <= 1e-13 * top
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * top
    for shift in rng.uniform(-1, top, 5):
        assert feast.n_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()


def _check_whitened(rows, found, k=4, apart=()):
    kept = [(r[0], [math.floor(256 * np.float64(np.float32(c))) for c in r[1]]) for r in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    kept = [r for r in kept if r[0] not in apart]
    found, got = [r for r in found if r["vec_id"] not in apart], {}
    for r in found:
        got.setdefault(r["vec_id"], []).append(r)
    assert sorted(map(str, got)) == sorted({str(i) for i, _ in kept})
    assert len(found) == k * len(kept)
    signs = None
    for i, x in kept:
        mine = sorted(got[i], key=lambda r: r["component"])
        expected = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
        values_found = np.array([r["whitened"] for r in mine])
        if signs is None:
            signs = np.sign(expected) * np.sign(values_found)
        assert np.abs(values_found - signs * expected).max() < 1e-9
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for r in mine:
            assert r["deviation"] == deviation and r["n"] == n
            exact = Fraction(float(values[r["component"] - 1])) / Fraction(np.trace(centred.T @ centred / n))
            assert abs(r["explained"] / float(exact) - 1) < 1e-9
            assert r["identity_error"] < 1e-9


def test_whitening_query_equals_dense_solver(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = llm_queries()["op13_whitening"](spark, sf_dir)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["n"] == "bigint"
    _check_whitened(rows, found.collect())


def test_whitening_of_odd_rows(spark, odd):
    bad = {900, 950, 1000, 1050}
    kept = [r for r in odd if r[0] not in bad]
    found = whitening.whiten(spark, _frame(spark, odd)).collect()
    _check_whitened(kept, found, apart=(50, None))
    assert len([r for r in found if r["vec_id"] == 50]) == 12
    assert len([r for r in found if r["vec_id"] is None]) == 4


def test_whitening_without_variance(spark):
    for rows in ([], [(1, [0.5, 0.5], 0)] * 3, [(1, None, 0)], [(1, [], 0), (2, [], 1)]):
        found = whitening.whiten(spark, _frame(spark, rows))
        assert found.collect() == []
        assert dict(found.dtypes)["whitened"] == "double"
    # Two distinct vectors span one component.
    found = whitening.whiten(spark, _frame(spark, [(1, [0.5, 0.25], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0], 0)]))
    assert sorted((r["vec_id"], r["component"], abs(r["whitened"])) for r in found.collect()) == [
        (1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0),
    ]
    with pytest.raises(ValueError, match="components"):
        whitening.whiten(spark, _frame(spark, [(0, [0.5], 1), (1, [0.5, 1.0], 1)]))
