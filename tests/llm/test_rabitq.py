import numpy as np
import pytest

from tagloom.llm import rabitq as q


def table(spark, vectors, first=0):
    rows = [(i, [float(x) for x in v] if v is not None else None, 1) for i, v in enumerate(vectors, first)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")


def brute(vectors, k=20):
    out = {}
    x = np.asarray(vectors, dtype=np.float32).astype(float)
    for i in range(0, len(x), 20):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((np.arange(len(x)), -score)) if j != i][:k]
        out[i] = [(int(j), float(score[j])) for j in order]
    return out


@pytest.mark.parametrize("rows", [4096, 64])
def test_recall_against_brute_force(spark, rows):
    rng = np.random.default_rng(rows)
    vectors = rng.normal(size=(1500, 48)) * rng.uniform(0.5, 2, size=(1500, 1))
    vectors[100:140] = vectors[100]  # ties
    s = q.CodeSettings(query_rows=rows // 2, vector_rows=rows)
    got = q.nearest(table(spark, vectors), lambda i: i % 20 == 0, s).collect()
    want, found = brute(vectors), {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert found.keys() == want.keys() and all(sorted(r for r, *_ in v) == list(range(1, 21)) for v in found.values())
    hits = sum(len({i for _, i, _ in found[a]} & {i for i, _ in want[a]}) for a in want)
    assert hits / (20 * len(want)) >= 0.97
    for v in found.values():
        order = [(-score, i) for _, i, score in sorted(v)]
        assert order == sorted(order)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(2000, 64)), rng.normal(size=(40, 64))
    centre, turn = x.mean(axis=0), q.rotation(64, 7)
    guess, bound = q.estimate(y, centre, turn, *q.encode(x, centre, turn), 1.9)
    assert (np.abs(guess - y @ x.T) <= bound).mean() > 0.93
    assert np.allclose(turn @ turn.T, np.eye(64))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [0, 0], None, [nan, 1], [inf, 1], [1, 1], [1, 1, 1], [1, 0], []]
    df = table(spark, vectors).union(spark.createDataFrame([(None, [1.0, 1.0], 1), (30, [1.0, None], 1)], "vec_id long, embedding array<float>, id int"))
    got = q.nearest(df, lambda i: i % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got)] == [(0, 1, 5, 1.0), (0, 2, 7, 1.0)]
    assert q.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0
    same = q.nearest(table(spark, [[1, 2]] * 30), lambda i: i % 20 == 0).collect()
    assert sorted(r.vec_id for r in same if r.query_id == 20) == list(range(20))
