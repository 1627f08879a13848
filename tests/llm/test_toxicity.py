import random
from itertools import combinations

import numpy as np
import pytest

from tagloom.llm import toxicity as t

S = t.ToxicSettings()


def brute(a, b, p, decay):
    def spans(x):
        out = {}
        for c in combinations(range(len(x)), p):
            key = "".join(x[i] for i in c)
            out[key] = out.get(key, 0) + decay ** (c[-1] - c[0] + 1)
        return out

    u, v = spans(a), spans(b)
    return sum(w * v.get(k, 0) for k, w in u.items())


def test_kernel_against_brute_force():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 20))) for _ in range(60)]
    pairs = [(a, rng.choice(words)) for a in words]
    got = t.kernel_of([a for a, _ in pairs], [b for _, b in pairs], S)
    assert np.allclose(got, [brute(a, b, S.order, S.decay) for a, b in pairs], rtol=1e-4)


def test_gaps_and_inserted_letters_stay_like():
    like = t.Landmarks(["^villain$"], S).similar(["^villain$", "^vilxlain$", "^viillain$", "^banana$", "^village$"])[:, 0]
    assert like[0] == pytest.approx(1, abs=1e-3) and min(like[1:3]) > 0.45 and like[3] == 0 and like[4] < like[1]
    assert t.units_of("v-i.l_l@in!") == ["^villain$"] and t.units_of("...") == [] and t.units_of("ab") == []
    assert t.tokens("you v i l l a i n a b") == ["you", "villainab"] and t.tokens("a b") == ["a", "b"]
    assert len(t.units_of("x" * 100)) > 3


def test_generations_forget_and_agree(monkeypatch):
    words = [f"villain{i}" for i in range(300)]
    whole = t.Reader(t.Landmarks(["^villain$"], S))
    want = [x.tolist() for x in whole.read(words)]
    monkeypatch.setattr(t, "CACHED", 20)
    small = t.Reader(t.Landmarks(["^villain$"], S))
    assert [x.tolist() for w in words for x in small.read([w])] == want and len(small.rows) < 100


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    plain = ["river", "stone", "garden", "window", "paper", "music", "winter", "bread", "silver", "market"]
    rude = ["villain", "rascal", "scoundrel"]

    def text(toxic, i):
        words = [rng.choice(plain) for _ in range(60)]
        if toxic:
            bad = rng.choice(rude)
            words[rng.randrange(60)] = bad if i % 2 else bad[:2] + "x" + bad[2:]
        return " ".join(words) + "."

    rows = [(i, text(i % 4 == 0, i), i % 4 == 0) for i in range(1200)]
    docs = spark.createDataFrame([(i, x) for i, x, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    return docs, labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    scored = t.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 150 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    assert sum(r.predicted == r.toxic for r in scored) / len(scored) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", t.F.when(t.is_held_out(t.F.col("doc_id")), 1 - t.F.col("toxic")).otherwise(t.F.col("toxic")))
    one, two = (dict(t.score_toxicity(docs, x).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert one == two


def test_odd_rows(spark, odd, empty, corpus):
    docs, labels = corpus
    rows = t.score_toxicity(odd, labels).collect()
    assert len(rows) == 8 and all(r.score is not None and r.predicted == 0 for r in rows)
    rows = t.score_toxicity(docs.unionByName(odd), labels).collect()
    assert len(rows) == 1208 and all(r.score is not None for r in rows)
    assert t.score_toxicity(empty, labels).count() == 0
    assert t.score_toxicity(docs, labels.limit(0)).where("score <> 0").count() == 0
