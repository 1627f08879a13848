import math

import numpy as np
import pytest

from tagloom.llm import whitening as wh


def table(spark, vectors, kind="float"):
    rows = [(i, v if v is None else [None if c is None else float(c) for c in v], 1, "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n int, component string")


def brute(vectors, components=8):
    """Sums, deviations, components by plain whole numbers."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    y = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    cov = np.array([[sum(r[i] * r[j] for r in y) / n**3 for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    white = np.array([[float(c) / n for c in r] for r in y]) @ axes / np.sqrt(np.maximum(values, 1e-300))
    return n, [sum(c * c for c in r) for r in y], values / np.trace(cov), white


@pytest.mark.parametrize("d", [3, 20])
def test_against_brute_force(spark, d):
    rng = np.random.default_rng(d)
    vectors = (rng.normal(size=(400, d)) * np.linspace(3, 0.5, d) @ rng.normal(size=(d, d)) + 5).astype(np.float32).tolist()
    got = wh.whiten(table(spark, vectors).repartition(7)).collect()
    n, deviation, explained, white = brute(vectors)
    k = min(8, d)
    assert len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    signs = {}
    for r in got:
        want = white[r.vec_id, r.component - 1]
        if abs(want) > 0.1:
            signs.setdefault(r.component, set()).add(np.sign(want * r.whitened))
        assert r.n == n and r.deviation == deviation[r.vec_id] and abs(abs(r.whitened) - abs(want)) < 1e-8
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    assert all(len(x) == 1 for x in signs.values())


def test_sums_are_exact(spark):
    """Also where neither the numbers nor their squares fit 64 bits."""
    rng = np.random.default_rng(1)
    x = rng.integers(-(10**6), 10**6, size=(50, 4))
    assert wh.pair_squares(x) == [
        sum(int(r[i] + (r[j] if i != j else 0)) ** 2 for r in x) for i in range(4) for j in range(i, 4)
    ]
    big = (x.astype(object) * 10**15).tolist()
    assert wh.pair_squares(np.array(big, dtype=object))[1] == sum((r[0] + r[1]) ** 2 for r in big)
    wide = x.astype(np.int64) * 10**12
    assert wh.pair_squares(wide)[2] == sum((int(r[0]) + int(r[2])) ** 2 for r in wide)
    values = [0, 5, -7, 1 << 100, -(1 << 64), (1 << 32) - 1]
    back = [0] * len(values)
    for at, power, part in wh.parts(values):
        back[at] += part << (32 * power)
    assert back == values
    vectors = [[1e15 * i, -3e14 * i * i] for i in range(30)]
    got = wh.whiten(table(spark, vectors, "double")).collect()
    n, deviation, explained, white = brute(vectors)
    for r in got:
        assert r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 1 << 63 else None)
        assert abs(abs(r.whitened) - abs(white[r.vec_id, r.component - 1])) < 1e-6


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1, 2, 3], [2, 2, 1], [5, 1, 0], [1, 2, 3], [1, 2, 3]]
    odd = [None, [], [1, None, 3], [nan, 1, 2], [inf, 1, 2], [-inf, 1, 2], [1, 2]]
    got = wh.whiten(table(spark, good + odd)).collect()
    n, deviation, _, white = brute(good)
    assert {r.vec_id for r in got} == set(range(5)) and {r.n for r in got} == {n}
    for r in got:
        assert r.deviation == deviation[r.vec_id]
        if r.component < 3:
            assert abs(abs(r.whitened) - abs(white[r.vec_id, r.component - 1])) < 1e-9
    third = {r.whitened for r in got if r.component == 3}
    assert third == {None} or None not in third


def test_no_variance_and_no_rows(spark):
    got = wh.whiten(table(spark, [[1, 2]] * 3)).collect()
    assert {(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {
        (c, 3, 0, None, None, None) for c in (1, 2)
    }
    assert wh.whiten(table(spark, [[1, 2]]).limit(0)).collect() == []
    assert wh.whiten(table(spark, [None, []])).collect() == []
