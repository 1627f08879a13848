import random
import re
from collections import Counter, defaultdict

import pytest

from tagloom.llm import phrases as ph

SMALL = ph.PhraseSettings(least=4, top=30)
UPPERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, s):
    """Rows of the result from ``(lang, text)`` pairs."""
    count, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPERS)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            count[lang].update(tuple(w[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(w) - n + 1))
    out = []
    for lang, f in count.items():
        held = {p: c for p, c in f.items() if c >= s.least and len(p) > 1}
        covered = defaultdict(int)
        for p, c in held.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    covered[p[i : i + n]] = max(covered[p[i : i + n]], c)
        scored = []
        for p, a in held.items():
            if 100 * covered[p] >= s.covered * a and covered[p]:
                continue
            score, _, le, ri = min((s.scale * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), le, ri))
        for rank, (score, a, p, le, ri) in enumerate(sorted(scored)[: s.top], 1):
            out.append((lang, rank, p.decode(), -a, le, ri, words[lang], -score))
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "naïve", " ", "x y", "tail", "New", "York", "city", "hall"] + [f"w{i}" for i in range(30)]
    idioms = ["New York city hall", "out of the blue", "a a a a a", "one\t two  three"]
    rows = []
    for _ in range(n):
        words = [rng.choice(idioms) if rng.random() < 0.25 else rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", " ", "\t", ", ", ".", "\n", " ! ", "  "]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return rows + [("en", None), ("en", ""), ("fr", " .,\n"), ("en", "one more row")] * 3


def run(spark, rows, s):
    df = spark.createDataFrame([(i, t, lang, 1, "x") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string")
    got = ph.collocations(df, s=s).collect()
    return sorted(tuple(r)[:8] for r in got), got


@pytest.mark.parametrize("seed,bits,block", [(1, 64, 2 << 20), (2, 64, 64), (3, 4, 400), (4, 12, 3000)])
def test_against_brute_force(spark, seed, bits, block):
    """Also with blocks that cut texts, and with fingerprints so short that most collide."""
    rows = corpus(seed)
    s = ph.PhraseSettings(least=4, top=30, bits=bits, block=block, merged=500)
    got, full = run(spark, rows, s)
    assert got == brute(rows, s) and len(got) > 40
    for r in full[::7]:  # the phrase stands where the operator says
        text = rows[r.place.id][1].translate(UPPERS).encode()[r.place.at :].decode()
        assert " ".join(re.findall(r"[^\x20\x09]+", text)).startswith(r.phrase)


def test_long_texts_and_hot_phrases(spark):
    """A text of many blocks without any stop, a word of many blocks, one text in a third of all rows."""
    words = [f"v{i % 50}" for i in range(40_000)]
    rows = [("en", " ".join(words)), ("en", "z" * 200_000 + " tail of it"), *[("en", "the hot line of all")] * 300, *corpus(5, 100)]
    s = ph.PhraseSettings(least=30, top=2000, block=4096)
    assert run(spark, rows, s)[0] == brute(rows, s)


def test_exact_beyond_64_bits(spark):
    s = ph.PhraseSettings(least=2, scale=10**7 - 1)
    rows = [("en", "ab cd")] * 3
    assert run(spark, rows, s)[0] == [("en", 1, "ab cd", 3, 3, 3, 6, (10**7 - 1) // 2)]


def test_odd_rows(spark, odd, empty):
    from pyspark.sql import functions as F

    df = odd.withColumn("lang", F.lit(None).cast("string"))
    rows = [(None, r.text) for r in df.collect()]
    s = ph.PhraseSettings(least=2)
    assert sorted(tuple(r)[:8] for r in ph.collocations(df, s=s).collect()) == brute(rows, s)
    assert ph.collocations(empty).collect() == []


def test_filter_never_forgets(spark):
    """Even where it is far too small."""
    import numpy as np

    prints = np.random.default_rng(1).integers(0, 1 << 63, 200_000).astype(np.int64)
    df = spark.createDataFrame([(int(x),) for x in prints[:50_000]], "print long")
    for bits in (1 << 19, 1 << 28):  # the smallest there is, and as large as it takes
        known = ph.build_filter(df, ph.PhraseSettings(filter_bits=bits))
        assert known.has(prints[:50_000].view(np.uint64)).all()
    assert known.has(prints[50_000:].view(np.uint64)).mean() < 0.05
