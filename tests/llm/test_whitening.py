import math
from collections import Counter

import numpy as np
import pytest

from logquarry.llm import whitening as W
from tests.llm.cases import MEDIUM, SMALL

NAN, INF = float("nan"), float("inf")


def exact(data, components=16):
    """By a dense eigenvector routine and Python's integers: id to rows by component."""
    kept = [
        (key, [math.floor(64 * c) + 1_000_000 for c in v])
        for key, v in data
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fitted = sorted(set(tuple(x) for _, x in kept))
    n, sums = len(fitted), [sum(c) for c in zip(*fitted, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fitted])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, int((values > 1e-12 * max(values[0], 1e-300)).sum()))
    out = []
    for key, x in kept:
        centre = np.array([(n * c - s) / n for c, s in zip(x, sums, strict=True)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        white = centre @ vectors[:, :count] / np.sqrt(values[:count])
        out.append((key, n, deviation, white, values[:count] / values.sum()))
    return out


def compare(got, want):
    """Rows of a query against ``exact``; a component's sign is the same in all rows."""
    by_key, found = {}, {}
    for r in got:
        found.setdefault((r.vec_id, r.n, r.deviation), []).append(r)
    for key, n, deviation, white, shares in want:
        by_key.setdefault((key, n, deviation), []).append((white, shares))
    assert {k: len(v) for k, v in found.items()} == {k: sum(len(w[0]) for w in v) for k, v in by_key.items() if len(v[0][0])}
    signs = {}
    for key, rows in found.items():
        for component in {r.component for r in rows}:
            mine = sorted(r.whitened for r in rows if r.component == component)
            theirs = sorted(w[0][component - 1] for w in by_key[key])
            if len(mine) == 1 and abs(theirs[0]) > 1e-6:
                sign = signs.setdefault(component, 1 if mine[0] * theirs[0] > 0 else -1)
                assert mine[0] == pytest.approx(sign * theirs[0], abs=1e-8)
            shares = [w[1][component - 1] for w in by_key[key]]
            assert all(r.explained == pytest.approx(shares[0], rel=1e-9) for r in rows if r.component == component)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_query(spark, folder):
    read = spark.read.parquet(f"{folder}/embeddings.parquet")
    data = [(r.vec_id, r.embedding) for r in read.collect()]
    got = W.op11_chebyshev_whitening(spark, folder)
    assert got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    compare(got.collect(), exact(data))


def table(spark, data, clashing=False):
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
    for name in ("x", "c", "block", "n", "slot", "component", "whitened") if clashing else ():
        df = df.selectExpr("*", f"'kept' AS `{name}`")
    return df


rng = np.random.default_rng(5)
GIVEN = [(k, (rng.standard_normal(6) * [9, 6, 4, 3, 2, 1]).astype(np.float32).tolist()) for k in range(60)]
ODD = [
    *GIVEN, GIVEN[0], (0, GIVEN[1][1]), (None, GIVEN[2][1]), (900, GIVEN[3][1]), (None, None), (901, None),
    (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [NAN] * 6), (904, [1.0, INF, 1.0, 1.0, 1.0, 1.0]), (905, [-INF] * 6),
    (906, []), (907, [-0.0, 0.0, 1e-9, -1e-9, 3.0, -3.0]),
]


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(spark, clashing):
    compare(W.whitened(table(spark, ODD, clashing)).collect(), exact(ODD))


def test_other_lengths_go(spark):
    data = [*GIVEN, (950, [1.0]), (951, [1.0] * 7)]
    got = W.whitened(table(spark, data))
    assert {r.vec_id for r in got.collect()} == set(range(60))


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]])
def test_nothing_to_whiten(spark, data):
    got = W.whitened(table(spark, data))
    assert got.columns[0] == "vec_id" and got.collect() == []


def test_low_rank_has_fewer_components(spark):
    data = [(k, [float(k % 7), float(k % 7) * 2, float(k % 5)]) for k in range(70)]
    got = W.whitened(table(spark, data)).collect()
    assert Counter(r.component for r in got) == {1: 70, 2: 70}
    compare(got, exact(data))


def test_large_entries(spark):
    for step in (45_000, 1_000_003):
        data = [(k, [float(k * step), float(k % 3 * step)]) for k in range(40)]
        got = W.whitened(table(spark, data)).collect()
        want = {key: d if d < 1 << 63 else None for key, _, d, _, _ in exact([(k, np.float32(v).tolist()) for k, v in data])}
        assert all(r.deviation == want[r.vec_id] for r in got) and len(got) == 80
        assert (None in want.values()) == (step > 1_000_000)
    far = W.whitened(table(spark, [(k, [float(k) * 1e30, 1.0]) for k in range(9)])).collect()
    assert len(far) == 9 and {r.deviation for r in far if r.vec_id} == {None}


@pytest.mark.parametrize("order", [1, 7])
def test_any_partitions(spark, order):
    compare(W.whitened(table(spark, ODD).repartition(order)).collect(), exact(ODD))


@pytest.mark.parametrize(
    "spectrum",
    [
        10.0 ** -np.arange(64), np.ones(64), np.r_[np.ones(5), np.zeros(59)], np.arange(8.0) + 1, np.zeros(40),
        np.r_[np.linspace(100, 60, 20), np.linspace(59.9, 1, 280)], np.r_[np.full(16, 2.0), np.full(84, 1.999)],
    ],
)
def test_subspace(spectrum):
    size = len(spectrum)
    basis = np.linalg.qr(np.random.default_rng(1).standard_normal((size, size)))[0]
    matrix = (basis * spectrum) @ basis.T
    wanted = min(16, size)
    values, vectors, residual = W.subspace(lambda block: matrix @ block, size, wanted)
    largest = max(np.max(spectrum), 1e-300)
    assert residual <= W.CERTIFIED
    assert np.abs(values - np.sort(spectrum)[::-1][:wanted]).max() <= 1e-12 * largest
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12


def test_passes_are_few(spark):
    read = W.integer_rows(spark.read.parquet(f"{SMALL}/embeddings.parquet"), "vec_id", "embedding")
    model = W.fit(read)
    assert model.passes < 60 and model.residual <= W.CERTIFIED and len(model.values) == 16
