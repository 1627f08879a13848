import random

from pyspark.sql import functions as F

from tagloom.operators import aggregate, lookup, postings
from tagloom.session import listed

from .conftest import rows


def written(spark, tmp_path, pairs, buckets):
    postings.write_postings(pairs, str(tmp_path / "p"), buckets)
    return postings.read_postings(spark, str(tmp_path / "p"))


def test_audiences_against_sets(spark, tmp_path):
    rng = random.Random(1)
    pairs = {(f"d{rng.randrange(400)}", f"t{int(rng.paretovariate(0.7))}") for _ in range(3000)}
    frame = spark.createDataFrame([*pairs, (None, "t1")], "device string, tag string")
    p = written(spark, tmp_path, frame, 3)
    by_tag = {}
    for d, t in pairs:
        by_tag.setdefault(t, set()).add(d)
    assert {r.tag: r.cnt for r in postings.reach(p.tags).collect()} == {t: len(d) for t, d in by_tag.items()}
    assert set(rows(postings.members(p.devices, p.tags))) == {(t, d) for d, t in pairs}

    def found(df):
        return {r.device for r in postings.members(p.devices, df).collect()}

    one, two, three = (by_tag[t] for t in ("t1", "t2", "t3"))
    assert found(postings.any_of(p.tags, ["t1", "t3", "none"])) == one | three
    assert found(postings.all_of(p.tags, ["t1", "t2", "t3", "t1"])) == one & two & three
    assert found(postings.all_of(p.tags, ["t1", "none"])) == found(postings.any_of(p.tags, [])) == set()
    mixed = postings.both(postings.any_of(p.tags, ["t2", "t3"]), postings.all_of(p.tags, ["t1"]))
    assert found(mixed) == (two | three) & one
    assert found(postings.either(mixed, postings.any_of(p.tags, ["t9"]))) == (two | three) & one | by_tag["t9"]
    assert rows(postings.size(mixed)) == [(len((two | three) & one),)]
    assert rows(postings.size(postings.any_of(p.tags, []))) == [(0,)]


def test_a_hot_tag_is_many_records_of_one_size(spark, tmp_path):
    """Seventy thousand devices in one bucket: three pages, places in order of the ids."""
    pairs = spark.range(70_000).select(F.format_string("d%06d", "id").alias("device"), F.lit("hot").alias("tag"))
    pairs = pairs.unionByName(spark.range(0, 70_000, 7_000).select(F.format_string("d%06d", "id").alias("device"), F.lit("rare").alias("tag")))
    p = written(spark, tmp_path, pairs, 1)
    pages = p.tags.select("tag", "page", F.bitmap_count("bits").alias("n"), F.octet_length("bits").alias("size"))
    assert rows(pages) == [("hot", 0, 32_768, 4096), ("hot", 1, 32_768, 4096), ("hot", 2, 4_464, 4096), ("rare", 0, 5, 4096), ("rare", 1, 5, 4096)]
    last = p.devices.where("page = 2").agg(F.min("device"), F.max("device"), F.max("bit")).first()
    assert tuple(last) == ("d065536", "d069999", 4463)
    both = postings.members(p.devices, postings.all_of(p.tags, ["hot", "rare"]))
    assert rows(both) == [(f"d{i:06d}",) for i in range(0, 70_000, 7_000)]


def test_same_as_the_audience_filter(spark, tmp_path, cells):
    rng = random.Random(2)
    table = cells(*[(f"k{rng.randrange(60)}:x", f"{rng.choice(['kd', 'mh'])}_{rng.randrange(8)}", rng.randrange(3)) for _ in range(300)])
    p = written(spark, tmp_path, postings.key_tags(table), 5)
    ids = spark.createDataFrame([(f"k{i}:x", i) for i in range(80)], "row_key string, n int")
    hits = postings.members(p.devices, postings.any_of(p.tags, ["3", "5", "7"])).withColumnRenamed("device", "row_key")
    want = lookup.audience_filter(ids, table, listed(spark, ["3", "5", "7"], "tag"))
    assert rows(ids.join(hits, "row_key", "left_semi")) == rows(want)
    assert rows(aggregate.tag_index(table).select("tag", "rowkey")) == rows(postings.members(p.devices, p.tags).select("tag", F.regexp_replace("device", ":x$", "")))
