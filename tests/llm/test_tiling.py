import random

import pytest

from tagloom.llm import tiling as t

S = t.TilingSettings()
VOCABULARY = [f"w{i}" for i in range(400)]


def brute(item, doc, least):
    """Greedy string tiling by plain search."""
    item, doc, tiles = list(item), list(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] is not None and item[i + n] == doc[d + n]:
                    n += 1
                best = max(best, (n, -i, -d))
        if best[0] < least:
            return tiles
        n, i, d = best[0], -best[1], -best[2]
        tiles.append(n)
        item[i : i + n] = [None] * n
        doc[d : d + n] = [0] * n


@pytest.mark.parametrize("seed", range(8))
def test_tiles_against_brute_force(seed):
    rng = random.Random(seed)
    hasher = t.WordHasher(fold=True)
    item = [rng.choice("abcdefghij") + str(rng.randrange(3)) for _ in range(rng.choice([6, 30, 70]))]
    cuts = sorted(rng.sample(range(1, len(item)), 3))
    parts = [item[a:b] for a, b in zip([0, *cuts], [*cuts, len(item)], strict=True)]
    rng.shuffle(parts)
    doc = ["x"] + [w for p in parts for w in [*p, rng.choice(VOCABULARY)]]
    got = t.tile(hasher.hashes(item), hasher.hashes(doc), S)
    assert sum(k for k, _, _ in got) == sum(brute(item, doc, S.least))
    assert all(item[i : i + k] == doc[d : d + k] for k, i, d in got)
    assert len({i for k, a, _ in got for i in range(a, a + k)}) == sum(k for k, _, _ in got)


def test_reordered_passages_are_caught(spark, docs):
    rng = random.Random(1)
    items = [[rng.choice(VOCABULARY) for _ in range(n)] for n in (60, 40, 20, 3)]
    noise = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    a, b = items[0], items[1]
    texts = [
        None,
        noise(300),
        f"{noise(20)} {' '.join(a[30:])} {noise(9)} {' '.join(a[:30])}".upper().replace("W", "w"),
        " ".join(b[10:]) + " " + noise(5),
        f"{noise(5)} {' '.join(b[:15])} {noise(30)}",
        f"{' '.join(items[2])} {' '.join(items[3])}",
    ]
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None), (None, texts[1]), (8, "")], "item_id long, text string")
    for size in (2_000_000, 50):  # one block of items, and several
        rows = {r.doc_id: r for r in t.find_contaminated(docs(*texts), table, t.TilingSettings(block_words=size)).collect()}
        assert [rows[i].contaminated for i in range(6)] == [False, False, True, False, False, True]
        assert rows[2].item_id == 0 and rows[2].coverage == 1.0 and sorted(h.item_id for h in rows[5].hits) == [2, 3]


def test_odd_rows(spark, odd, empty, docs):
    table = spark.createDataFrame([(1, "same text"), (2, "long word " * 40)], "item_id long, text string")
    rows = t.find_contaminated(odd, table).collect()
    assert len(rows) == 8 and sorted(r.doc_id for r in rows if r.contaminated) == [4, 4, 6]
    assert t.find_contaminated(empty, table).count() == 0
    assert t.find_contaminated(docs("a"), table.limit(0)).first().contaminated is False


def test_a_task_holds_one_block(spark, docs):
    """Several blocks give what one gives, and none of them stays in the plan of the result."""
    rng = random.Random(4)
    items = [" ".join(rng.choice(VOCABULARY) for _ in range(n)) for n in (30, 30, 25, 40, 3)]
    texts = [None, "", items[0], items[0], f"{items[3]} x {items[1]} y {items[0]}", f"{items[2]} {items[4]}", "none of them"]
    df = docs(*texts).union(docs(items[1]))  # id 0 twice, with other texts
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one, many = (t.find_contaminated(df, table, t.TilingSettings(block_words=n)) for n in (2_000_000, 40))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
    rows = lambda f: sorted((r.doc_id, r.contaminated, r.item_id or 0, r.coverage or 0, sorted(r.hits)) for r in f.collect())
    assert rows(many) == rows(one) and sum(r[1] for r in rows(one)) == 5
