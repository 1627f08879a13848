import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import passages as p
from tagloom.llm.words import SHORT, TextWords


def brute(texts):
    """Words kept of each text, by walking through all windows in order."""
    seen, out = set(), []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("load, patterns", [(20_000, 50_000), (40, 7)])
def test_against_brute_force(spark, docs, load, patterns):
    rng = random.Random(load)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    hot, cold = noise(45), noise(30)
    texts = [None, "", "is onhe. " * 60, "a " * 19, "a " * 20, "a " * 21]
    for i in range(60):
        cut = rng.randrange(20)
        words = noise(rng.randrange(30)) + (hot[cut:] if i % 3 else hot) + noise(rng.randrange(5))
        texts.append(" ".join(words + (cold if i % 7 == 0 else [])))
    texts += [texts[10], texts[11], " ".join(hot[:10] + ["Z"] + hot[11:])]
    got = p.drop_repeated(docs(*texts), p.PassageSettings(load=load, patterns=patterns)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == dict(enumerate(brute(texts)))


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (2, text)]
    got = p.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 30)]


def test_odd_rows(spark, odd, empty):
    rows = p.drop_repeated(odd).collect()
    assert len(rows) == 8
    long = next(r for r in rows if r.doc_id == 6)
    assert (long.n_words, long.n_removed, long.kept) == brute(["long word " * 30_000])[0]
    assert p.drop_repeated(empty).count() == 0


def test_words_of_many_texts():
    odd = ["", "a", "b a", " \t", "a\x0bb\r\n a ", "", "é\u2003x \x85 \xa0 日本 a", "y" * SHORT + " " + "y" * (SHORT + 1), "a", "ab ba ab  ", ""]
    texts = pa.array(["left out", *odd, "left out"])
    for array in (texts.slice(1, len(odd)), texts.cast(pa.large_string()).slice(1, len(odd)), texts.slice(1, 1), texts.slice(0, 0)):
        words = [re.findall(r"[^\x20\x09-\x0d]+", t) for t in array.to_pylist()]
        flat = [w for ws in words for w in ws]
        got = TextWords(array)
        assert np.diff(got.first).tolist() == [len(ws) for ws in words]
        assert [got.raw[a:b].tobytes().decode() for a, b in zip(got.start, got.end, strict=True)] == flat
        hashes = got.hashes().tolist()
        assert len(set(hashes)) == len(set(flat)) == len(set(zip(hashes, flat, strict=True)))
        for kept in (np.ones(len(flat), dtype=bool), np.arange(len(flat)) % 2 == 0, np.zeros(len(flat), dtype=bool)):
            left = iter(kept.tolist())
            assert got.joined(kept).to_pylist() == [" ".join([w for w in ws if next(left)]) for ws in words]


def test_small_pieces_against_brute_force(spark, docs):
    rng = random.Random(1)
    known = [f"k{i}" for i in range(60)]
    texts = [" ".join(known[rng.randrange(30) :] + [f"n{rng.random()}"] * (i % 3) + known[: rng.randrange(60)]) for i in range(40)]
    got = p.drop_repeated(docs(*texts, ""), p.PassageSettings(piece=500, load=30)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == dict(enumerate(brute([*texts, ""])))


def test_words_and_anchors_take_no_python_step_per_word():
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(500)) for _ in range(2000)]
    array, s = pa.array(texts), p.PassageSettings()

    def cpu(run):
        begun = time.process_time()
        run()
        return time.process_time() - begun

    def anchors():
        words = TextWords(array)
        assert len(p.anchors_of(words.hashes(), words.text_of(), s)[0]) > 2000

    def scan():
        return [re.findall(r"[^\x20\x09-\x0d]+", t) for t in texts]

    assert min(cpu(anchors) for _ in range(3)) < 2 * min(cpu(scan) for _ in range(3))
