import hashlib
import random
import zlib

import pytest

from tagloom.llm import splitters as sp

SMALL = sp.ShardSettings(shards=5, ranges=16, range_rows=50, samples=4)


def brute(rows, s):
    """Shard and slot of ``(id, text)`` pairs, placed one after the other."""
    full = [(int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16), i is not None, i or 0, t or "") for i, t in rows]
    full.sort()
    sizes = [len(t.encode()) + 8 for *_, t in full]
    total, at, starts, groups = sum(sizes), 0, [], {}
    for row, size in zip(full, sizes, strict=True):
        starts.append(at)
        first, share = groups.get(row[0], (at, 0))
        groups[row[0]] = (first, share + size)
        at += size
    out, slots = [], {}
    for (key, known, i, t), size, start in zip(full, sizes, starts, strict=True):
        first, share = groups[key]
        small = share * s.shards * s.whole <= total
        middle = 2 * first + share if small else 2 * start + size
        shard = middle * s.shards // (2 * total)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i if known else None, size, zlib.crc32(t.encode()), shard, slots[shard]))
    return sorted(out, key=repr)


def run(df, s):
    return sorted((tuple(r) for r in sp.shard_rows(df, s=s).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    """A third of all rows share one text; sizes differ by a factor of hundreds."""
    rng = random.Random(seed)
    rows = [(i, "é" * rng.choice([0, 3, 40, 40, 700])) if rng.random() < 0.6 else (i, "the hot text") for i in range(1500)]
    rows = [(i, t + str(rng.randrange(400)) if t and "é" in t else t) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df, SMALL) == brute(rows, SMALL)


def test_sizes_are_near_equal_and_copies_stay_together(spark):
    rng = random.Random(3)
    rows = [(i, f"text {rng.randrange(1500)} " + "x" * rng.randrange(60)) for i in range(3000)]
    rows = [(i, t if i % 2 else f"copy {i % 300}") for i, t in rows]
    got = sp.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), s=SMALL).collect()
    sizes, homes = {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    mean = sum(sizes.values()) / SMALL.shards
    assert len(sizes) == SMALL.shards and all(abs(x - mean) <= 0.02 * mean for x in sizes.values())
    assert all(len(h) == 1 for h in homes.values())


def test_rows_that_are_alike_in_all(spark):
    """One id and text in half of all rows: dealt out by number, still near equal and gapless."""
    rows = [(7, "same")] * 600 + [(i, f"text {i}") for i in range(600)]
    got = sp.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), s=SMALL).collect()
    sizes, slots = {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    mean = sum(sizes.values()) / SMALL.shards
    assert all(abs(x - mean) <= 0.02 * mean for x in sizes.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len(got) == 1200 and sum(r.doc_id == 7 for r in got) == 601


def test_odd_rows(spark, odd, empty):
    rows = [tuple(r) for r in odd.collect()]
    assert run(odd, sp.ShardSettings()) == brute(rows, sp.ShardSettings())
    assert run(empty, sp.ShardSettings()) == []


def test_string_ids(spark):
    rows = [(f"d{i}", f"text {i % 7}") for i in range(60)] + [(None, "text 1")]
    got = sp.shard_rows(spark.createDataFrame(rows, "doc_id string, text string"), s=SMALL).collect()
    assert sorted(r.doc_id or "" for r in got) == sorted(i or "" for i, _ in rows)


def test_written_shards(spark, docs, tmp_path):
    """All columns arrive, in the order of the slots, whatever their names."""
    df = docs(*[f"text {i}" * (i % 5) for i in range(200)]).selectExpr("*", "doc_id % 3 as shard", "1 as slot", "2 as cell")
    path = str(tmp_path / "out")
    sp.write_shards(df, path, s=SMALL)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == sorted([*df.columns, "shard_"])
    assert sorted(map(repr, back.select(*df.columns).collect())) == sorted(map(repr, df.collect()))
    want = {r.doc_id: r.shard for r in sp.shard_rows(df, s=SMALL).collect()}
    assert {r.doc_id: r.shard_ for r in back.collect()} == want
