import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from tagloom.llm import lm

S = lm.LmSettings(classes=20, near=30)


def corpus(docs):
    texts = [None, "", "The cat SAT", "É é X"] + [f"the cat sat on the mat and the dog w{i} ran to the park w{i % 7}" for i in range(300)]
    return texts, docs(*texts)


@pytest.mark.parametrize("settings", [S, lm.LmSettings()])
def test_base_scores_against_brute_force(spark, docs, settings):
    texts, df = corpus(docs)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    c = Counter(w for i, x in enumerate(texts) if not held[i] for w in lm.tokens(x or ""))
    n, v = sum(c.values()), len(c)
    rows = lm.score_texts(df, settings=settings).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = lm.tokens(texts[r.doc_id] or "")
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words), n)
        assert r.n_known == sum(c[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(log10((c[w] + 1) / (n + v + 1)) for w in words))
    out = [r for r in rows if r.held_out and r.doc_id > 3]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # word order says more than counts


def test_the_model_is_normalised(spark, docs):
    texts, df = corpus(docs)
    model, counts = lm.fit(df.select(lm.F.coalesce("text", lm.F.lit("")).alias("text")), S)
    know = lm.Scorer(model)
    classes = np.arange(model.classes + 1)
    for w1, w2 in ((0, 1), (3, model.classes + 1), (model.classes + 1, model.classes + 1)):
        p = 10 ** know.log10(classes, np.full_like(classes, w1), np.full_like(classes, w2))
        assert p.sum() == pytest.approx(1, abs=1e-4)
    assert counts.count() == model.distinct and model.total == sum(len(lm.tokens(x or "")) for x in texts)


def test_odd_rows(spark, odd, empty, docs):
    rows = lm.score_texts(odd).collect()
    assert len(rows) == 8 and all(r.score is not None and r.base_score is not None for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert lm.score_texts(empty).count() == 0
    alone = lm.score_texts(docs("a b"), is_held_out=lambda i: i >= 0).first()
    assert (alone.train_tokens, alone.n_known, alone.base_score) == (0, 0, 0.0)
