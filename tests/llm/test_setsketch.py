import random
import re

import numpy as np
import pytest

from tagloom.llm import setsketch as k
from tagloom.llm.components import components

S = k.SketchSettings()


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts):
    """Component of each place by comparing all pairs."""
    sets, up = [shingles(x) for x in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = up[i], up[j]
                up = [min(a, b) if x in (a, b) else x for x in up]
    return up


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("block", [512, 16])
def test_components_against_brute_force(spark, docs, block):
    rng = random.Random(block)
    texts = [None, "", " ", "one", "ONE", "a b c d", "a b c d", "a b c e", "a b c d e", "A b c d e"]
    for _ in range(6):  # groups around the threshold
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([40, 120, 300]))]
        texts += [edited(rng, words, rng.choice([0, 1, 1, 2, 3])) for _ in range(25)]
    rng.shuffle(texts)
    got = k.near_duplicates(docs(*texts), k.SketchSettings(block=block, lane=40)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(brute(texts)))
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(texts[r.doc_id])) for r in got)


def test_joint_likelihood_and_merging():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    factors = k.multipliers(S)
    a, b = items[:2000], items[200:2300]
    ra, rb = k.registers(a, S, factors), k.registers(b, S, factors)
    assert (np.maximum(ra, rb) == k.registers(items[:2300], S, factors)).all()
    greater, less = np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()])
    guess = k.similarity(greater, less, 2000.0, np.array([2100.0]), S)[0]
    assert abs(guess - 1800 / 2300) < 0.09
    assert (k.registers(items[:0], S, factors) == 0).all()
    assert k.linked(np.arange(85), np.arange(100), 85) and not k.linked(np.arange(84), np.arange(100), 85)


def test_rows_with_one_id_and_without(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (2, "other text of six whole words"), (2, long), (None, long), (3, None), (3, None)]
    got = k.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True), (3, 3, True)
    ]


def test_odd_rows(spark, odd, empty):
    rows = k.near_duplicates(odd).collect()
    assert len(rows) == 8 and {r.doc_id: r.n_shingles for r in rows}[6] == 2
    assert all(r.kept for r in rows)
    assert k.near_duplicates(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    assert {r.id: r.component for r in got} == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0
