import re

from tagloom.llm import pii


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def digits(v):
    return re.sub("[^0-9]", "", v)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
}
TEXTS = [
    None,
    "",
    "a@b.cd%x@e.f @x.y a..b@c.d..e@f.g x@y é@a.b 🙂u@v.w",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3",
    "4316522678525456 4316 5226 7852 5456 12 4316-5226-7852-5457 5  6",
    "+1 (743) 555-3824 +12 +49 30 1234567 +1.2.3.4.5.6.7.8.9.10.11.12.13.14.15.16",
    "call me at (743) 555-3824 or mail bob (at) mail.com",
    "a." * 20_000 + "b@" + "c." * 20_000 + "d " + "9" * 50_000,
]


def test_base_spans(spark, docs):
    for r in pii.find_pii(docs(*TEXTS)).collect():
        text = TEXTS[r.doc_id] or ""
        want = [(k, m.start(), m.end()) for k, (p, ok) in BASE.items() for m in re.finditer(p, text) if ok(m[0])]
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == want
        base = [s for s in r.spans if s.base]
        assert not any(b.start < s.end and s.start < b.end for s in r.spans if not s.base for b in base)


def test_reliabilities_follow_the_votes(spark):
    """Two labelers that agree are trusted more than one that contradicts them at random."""
    rows = [("phone", [1, 1, (i % 3) - 1, 0]) for i in range(60)] + [("phone", [-1, -1, (i % 3) - 1, 0]) for i in range(60)]
    states = pii.reliabilities(spark.createDataFrame(rows, "kind string, votes array<int>"), pii.PiiSettings())
    state = states.first().state
    assert 0.4 < state.prior < 0.6 and state.right[0] > 0.9 and state.wrong[1] > 0.9 and state.right[2] < 0.7


def test_planted_numbers_without_a_country_code(spark, docs):
    texts = [f"please call +1 (743) 555-{i:04d} today" for i in range(200)]
    texts += [f"please call (743) 555-{i:04d} today" for i in range(200)]
    texts += [f"order number {i * 7919 + 1000000} of the series" for i in range(200)]
    found = {r.doc_id: r.spans for r in pii.find_pii(docs(*texts)).collect()}
    added = [i for i in range(200, 400) if found[i]]
    assert len(added) > 180 and not any(s for i in range(400, 600) for s in found[i] if not s.base)


def test_odd_rows(spark, odd, empty):
    rows = pii.find_pii(odd).collect()
    assert len(rows) == 8 and all(r.spans == [] for r in rows)
    assert pii.find_pii(empty).count() == 0
