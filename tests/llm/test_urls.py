import pytest

from tagloom.llm import urls


def judged(spark, *given, **more):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(given)], "page_id long, url string, host string")
    return {r.page_id: r for r in urls.filter_urls(df, **more).collect()}


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://Example.ORG/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        ("https://a.example.org/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("https://a.example.org/en/2", "a.example.org", "/en/2", "org/", "allow"),
        ("x://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        ("http://b.com/fr/", "b.com", "/fr/", "com/fr/", "allow"),
        ("http://b.com/de/x", "b.com", "/de/x", "com/de/", "block"),
        ("http://b.com/de", "b.com", "/de", None, None),
        ("http://b.org", "b.org", "", None, None),
        ("http://b.org?u=http://c.org/", "b.org", "", None, None),
        ("http://É.org/a", "É.org", "/a", "org/", "allow"),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
        ("http:///p", "", "/p", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("http://x/" + "y" * 100_000, "x", "/" + "y" * 100_000, None, None),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    (r,) = judged(spark, url).values()
    assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
    assert r.verdict in ("allow", "block")


def test_templates_learn_from_labels(spark):
    """Labelled spam paths of a host condemn their template, other paths of the host stay."""
    given = [f"http://shop.net/buy/{i}/now" for i in range(60)] + [f"http://shop.net/news/{i}" for i in range(60)]
    given += [f"http://shop.net/{'x' * i}y/z" for i in range(1, 60)]
    labels = spark.createDataFrame(
        [("shop.net", f"/buy/{i}/now", 1) for i in range(500, 540)] + [("shop.net", f"/news/{i}", 0) for i in range(500, 540)],
        "host string, path string, bad int",
    )
    rows = judged(spark, *given, labels=labels)
    assert {rows[i].verdict for i in range(60)} == {"block"} and {rows[i].template for i in range(60)} == {"/buy/#/now"}
    assert {rows[i].verdict for i in range(60, 179)} == {"allow"}
    assert {rows[i].template for i in range(120, 179)} == {"/*/z"}


def test_deep_paths_are_told_apart(spark):
    """Six segments, verdicts that differ by the fifth; a null id is judged like any other."""
    spam, good = "/a/b/c/d/pills/{}", "/a/b/c/d/notes/{}"
    labels = spark.createDataFrame(
        [("h.net", spam.format(i), 1) for i in range(40)] + [("h.net", good.format(i), 0) for i in range(40)], "host string, path string, bad int"
    )
    rows = [(i, "http://h.net" + (spam if i % 2 else good).format(i)) for i in range(20)] + [(None, "http://h.net" + spam.format(7))]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), labels=labels).collect()
    assert len(got) == 21 and {(r.template, r.verdict) for r in got} == {("/a/b/c/d/pills/#", "block"), ("/a/b/c/d/notes/#", "allow")}
    assert [r.verdict for r in got if r.page_id is None] == ["block"]


def test_siblings_merge_by_their_counts(spark):
    """One bad label of one is no proof against a clean sibling of two; forty of forty are against four hundred clean ones."""
    data = {"/x/few": (1, 1), "/x/clean": (2, 0), "/y/many": (40, 40), "/y/clean": (400, 0), "/y/none": (0, 0)}
    known = [("h.net", path[1:].split("/"), int(i < bad)) for path, (n, bad) in data.items() for i in range(n)] + [("h.net", ["y", "none"], None)]
    tree = urls.template_tree(spark.createDataFrame(known, "host string, segs array<string>, bad int")).collect()
    got = {r.template[1]: (r.labelled, r.bad) for r in tree}
    assert {k: v for k, v in got.items() if k != "clean"} == {"few": (3, 1), "many": (40, 40), "none": (0, 0)}
    assert {r.template[0]: (r.labelled, r.bad) for r in tree if r.template[1] == "clean"} == {"x": (3, 1), "y": (400, 0)}


def test_repeated_rows_and_empty_table(spark):
    rows = judged(spark, *["http://a.net/q"] * 3)
    assert len(rows) == 3
    df = spark.createDataFrame([], "page_id long, url string")
    assert urls.filter_urls(df).count() == 0
