import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagloom.llm import bpe
from tagloom.llm.queries import VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(PATH)


def same(own, reference, text):
    want = reference.encode(text, add_special_tokens=False).ids
    (got,) = own.encode([text])
    assert np.frombuffer(got, "<u4").tolist() == want
    assert own.decode(got) == reference.decode(want, skip_special_tokens=False)


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_text(own, reference, text):
    same(own, reference, text)


@pytest.mark.parametrize(
    "text",
    ["", "It's WE'LL 'S don't", "a<|endoftext|>b<|startoftext|>", "ΣΑΣ İ é ½ Ⅷ", "x" * 5000, "a\u0085b c\x1cd", "🙂" * 50],
)
def test_odd_texts(own, reference, text):
    same(own, reference, text)


def test_merges_follow_rank_and_place(own):
    """The segment tree against a plain search for the leftmost lowest rank."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeinostr") for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    ranks = {(k >> 32, k & 0xFFFFFFFF): r for k, r in zip(own.keys.tolist(), own.ranks.tolist(), strict=True)}
    for word, got in zip(words, own.encode_words(words), strict=True):
        raw = word.encode()
        ids = [int(own.inner[b]) for b in raw[:-1]] + [int(own.last[raw[-1]])]
        while True:
            best = min(((ranks[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks), default=None)
            if best is None:
                break
            ids[best[1] : best[1] + 2] = [int(own.made[best[0]])]
        assert np.frombuffer(got, "<u4").tolist() == ids


def test_rows(spark, odd, empty):
    got = bpe.round_trip(odd, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = got.collect()
    assert len(rows) == 8 and sum(r.doc_id is None for r in rows) == 1
    by = {r.doc_id: r for r in rows}
    assert [by[i].n_tokens for i in (1, 2, 3)] == [0, 0, 0] and by[1].decoded == ""
    assert by[6].n_tokens == 60_000
    assert bpe.round_trip(empty, PATH).count() == 0


def test_the_cache_stays_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    texts = [f"w{i} v{i}" for i in range(200)]
    alone = [bpe.WordBpe(PATH).encode([t])[0] for t in texts[::40]]
    fresh = bpe.WordBpe(PATH)
    assert [fresh.encode([t])[0] for t in texts][::40] == alone and len(fresh.cache) < 200
