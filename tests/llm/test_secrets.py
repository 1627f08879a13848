import re
from math import log2

import pytest
from pyspark.sql import functions as F

from tagloom.llm import secrets
from tagloom.llm.spans import find_all

ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEY = "a8Xk29LmQz81PwRt55Yb"


def base_of(text):
    found = [("assign", m.start(), m.end()) for m in re.finditer(ASSIGN, text) if len(m[1]) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return found + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]


TEXTS = [
    None,
    "",
    "token=token: abcdefghijklmnop",
    "PassWord' : \"abcdef.ghi/jk=l end secret=short",
    "é🙂 AKIAAKIA0123456789 AKIA1 0123456789abcdef0 deadbeefdeadbeef",
    f"key {KEY} and uuid 123e4567-e89b-12d3-a456-426614174000 and aaaaaaaaaaaaaaaaaaaaaaaaa",
    "api_key=abcdef0123456789abcdef apikey:abcdefabcdef token = = x",
    "word " * 20_000 + "token=abcdefghijklmno",
]


def test_base_spans(spark, docs):
    rows = secrets.find_secrets(docs(*TEXTS)).collect()
    for r in rows:
        got = sorted((s.kind, s.start, s.end) for s in r.spans if s.kind != "entropy")
        assert got == sorted(base_of(TEXTS[r.doc_id] or ""))
        assert [(s.start, s.place) for s in r.spans] == sorted((s.start, s.place) for s in r.spans)


def test_entropy_spans_and_allow_list(spark, docs):
    (row,) = secrets.find_secrets(docs(TEXTS[5])).collect()
    assert [TEXTS[5][s.start : s.end] for s in row.spans if s.kind == "entropy"] == [KEY]
    words = "internationalization of/the/path-like-things pneumonoultramicroscopic"
    assert secrets.find_secrets(docs(words)).first().spans == []


def test_window_entropy(spark):
    def entropy(w):
        return -sum(w.count(c) / len(w) * log2(w.count(c) / len(w)) for c in set(w))

    for text in (KEY + "aaaaaaa", "abab" * 10, "aB3/" * 4 + KEY + "zz", "short"):
        (got,) = spark.range(1).select(secrets.window_entropy(F.lit(text), 20)).first()
        want = max((entropy(text[i : i + 20]) for i in range(len(text) - 19)), default=None)
        assert got == (pytest.approx(want) if want is not None else None)


def test_odd_rows(spark, odd, empty):
    rows = secrets.find_secrets(odd).collect()
    assert len(rows) == 8 and all(r.spans == [] for r in rows)
    assert secrets.find_secrets(empty).count() == 0


def test_matches_at_every_place(spark, docs):
    text = "ab12 " * 50 + "x" * 3
    (r,) = docs(text).select(find_all(F.col("text"), "[0-9]++").alias("s")).collect()
    assert [(s.start, s.end, s.value) for s in r.s] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]


def test_redact(spark, docs):
    text = f"a token={KEY} b {KEY} c"
    spans = secrets.secret_spans(F.col("text"))
    assert docs(text).select(secrets.redact(F.col("text"), spans)).first()[0] == "a [SECRET] b [SECRET] c"
    assert docs("plain").select(secrets.redact(F.col("text"), spans)).first()[0] == "plain"
