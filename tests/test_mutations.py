import hashlib
import random
import uuid
from pathlib import Path

import pytest

from tagloom.operators import buckets, mutate
from tagloom.operators.mutate import apply_mutations, current_state, delete_column, delete_rows, puts_of, put_cell

from testbed import tables

from .conftest import rows

A = "a" * 32
KEY = f"{A}:didmd5"


def keyed(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "row_key string")


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_put_is_idempotent(spark, cells):
    base = cells((KEY, "kd_1", 1))
    put = put_cell(spark, KEY, "ap_9", 5)
    once = rows(apply_mutations(base, put))
    assert once == [(KEY, "cf", "ap_9", 5, "1"), (KEY, "cf", "kd_1", 1, "1")]
    assert rows(apply_mutations(base, put, put)) == once


def test_delete_rows(spark, cells):
    base = cells((KEY, "kd_1", 1), (KEY, "kd_2", 5), (KEY, "kd_3", 6), ("other:ifa", "kd_1", 1))
    left = rows(apply_mutations(base, delete_rows(keyed(spark, KEY, KEY), 5)))
    assert left == [(KEY, "cf", "kd_3", 6, "1"), ("other:ifa", "cf", "kd_1", 1, "1")]
    # keys are used as given
    assert len(rows(apply_mutations(base, delete_rows(keyed(spark, KEY.upper()), 9)))) == 4
    # a later put comes back
    again = apply_mutations(base, delete_rows(keyed(spark, KEY), 9), put_cell(spark, KEY, "kd_1", 10))
    assert rows(again) == [(KEY, "cf", "kd_1", 10, "1"), ("other:ifa", "cf", "kd_1", 1, "1")]


def test_delete_column_modes(spark, cells):
    base = cells((KEY, "kd_1", 1, "old"), (KEY, "kd_1", 3, "new"), (KEY, "kd_2", 2))
    log = puts_of(base)
    latest = log.unionByName(delete_column(log, ids(spark, A.upper()), "kd_1", 9))
    assert rows(current_state(latest)) == [(KEY, "cf", "kd_1", 1, "old"), (KEY, "cf", "kd_2", 2, "1")]
    rerun = latest.unionByName(delete_column(latest, ids(spark, A), "kd_1", 9))
    assert rows(current_state(rerun)) == rows(current_state(latest))
    late = rerun.unionByName(puts_of(cells((KEY, "kd_1", 50, "later"))))
    again = late.unionByName(delete_column(late, ids(spark, A), "kd_1", 9))
    assert rows(current_state(again)) == [(KEY, "cf", "kd_1", 50, "later"), (KEY, "cf", "kd_2", 2, "1")]
    twice = latest.unionByName(delete_column(latest, ids(spark, A), "kd_1", 10))
    assert rows(current_state(twice)) == [(KEY, "cf", "kd_2", 2, "1")]
    thrice = twice.unionByName(delete_column(twice, ids(spark, A), "kd_1", 11))
    assert rows(current_state(thrice)) == [(KEY, "cf", "kd_2", 2, "1")]
    every = log.unionByName(delete_column(log, ids(spark, A), "kd_1", 9, mode="all"))
    assert rows(current_state(every)) == [(KEY, "cf", "kd_2", 2, "1")]
    with pytest.raises(ValueError):
        delete_column(log, ids(spark, A), "kd_1", 9, mode="some")


def test_retarget_and_taglist_puts(spark):
    devices = spark.createDataFrame([("AB", "0"), ("CD", None)], "did string, os string")
    assert [r[:4] for r in rows(mutate.retarget_puts(devices, "9", 5))] == [
        ("put", "ab:didmd5", "cf", "ap_9"),
        ("put", "cd:ifa", "cf", "ap_9"),
    ]
    lists = spark.createDataFrame([("AB:ifa", "x,y,,"), ("k", ","), ("m", "")], "did string, tags string")
    assert [r[1:4] for r in rows(mutate.taglist_puts(lists, 5))] == [
        ("ab:ifa", "cf", "x"),
        ("ab:ifa", "cf", "y"),
        ("m", "cf", ""),
    ]


def fold(log):
    """The meaning of a log, cell by cell."""
    versions = {}
    for op, key, family, q, ts, value, _ in log:
        if op == "put":
            cell = versions.setdefault((key, family, q), {})
            cell[ts] = max(value, cell.get(ts, value))
    for op, key, family, q, ts, *_ in log:
        for (k, f, c), cell in versions.items():
            for at in list(cell):
                row = op == "delete_row" and k == key and at <= ts
                column = op == "delete_column" and (k, f, c) == (key, family, q) and at <= ts
                version = op == "delete_version" and (k, f, c) == (key, family, q) and at == ts
                if row or column or version:
                    del cell[at]
    return versions


@pytest.mark.parametrize("seed", range(4))
def test_fold_against_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    log = []
    for _ in range(600):
        # one key holds most of the log
        key, q, ts = rng.choice(["hot", "hot", "k1", "k2"]), f"kd_{rng.randrange(4)}", rng.randrange(40)
        op = rng.choice(["put"] * 12 + ["delete_version"] * 3 + ["delete_column"])
        log.append((op, key, "cf", q, ts, str(rng.randrange(3)) if op == "put" else None, None))
    log += [("delete_row", "k1", None, None, 15, None, None), ("delete_row", "hot", None, None, 2, None, None)]
    path = str(tmp_path / "log")
    for part in (log[:300], log[300:], log[:50]):  # a batch that was written twice changes nothing
        mutate.upsert_cells(spark.createDataFrame(part, mutate.MUTATIONS), path)
    want = fold(log)
    newest = sorted((*cell, max(v), v[max(v)]) for cell, v in want.items() if v)
    stored = mutate.read_log(spark, path)
    assert rows(current_state(stored)) == newest
    assert rows(current_state(buckets.folded(stored))) == newest


def file_names(path):
    """Data files by bucket folder."""
    out = {}
    for f in Path(path).glob("*/*.parquet"):
        out.setdefault(f.parent.name, set()).add(f.name)
    return out


def store(spark, tmp_path, base, count=16):
    b = buckets.Buckets(str(tmp_path / "table"), count)
    staging = str(tmp_path / "staging")
    buckets.fold_batch(spark, b, puts_of(base), 0, staging)
    return b, staging


@pytest.mark.parametrize("seed", range(3))
def test_batches_folded_by_bucket(spark, tmp_path, seed):
    """However the log is cut into batches, the state is that of the whole log; also with late puts of old times."""
    rng = random.Random(seed)
    log = []
    for _ in range(800):
        key, q, ts = rng.choice(["hot", "hot", *[f"k{i}" for i in range(30)]]), f"kd_{rng.randrange(3)}", rng.randrange(40)
        op = rng.choice(["put"] * 12 + ["delete_version"] * 3 + ["delete_column", "delete_row"])
        cell = (None, None) if op == "delete_row" else ("cf", q)
        log.append((op, key, *cell, ts if op == "put" else ts // 3, str(rng.randrange(3)) if op == "put" else None, None))
    b, staging = buckets.Buckets(str(tmp_path / "table"), 8), str(tmp_path / "staging")
    for number in range(4):
        batch = spark.createDataFrame(log[number * 200 : number * 200 + 200], mutate.MUTATIONS)
        assert buckets.fold_batch(spark, b, batch, number, staging)
    want = sorted((*cell, max(v), v[max(v)]) for cell, v in fold(log).items() if v)
    assert rows(current_state(buckets.read_log(spark, b))) == want
    held = buckets.read_stored(spark, b)
    assert held.count() < len(log)  # hidden versions are gone
    assert {r.batch for r in buckets.watermarks(spark, b).collect()} <= {0, 1, 2, 3}


def test_only_touched_buckets_are_rewritten(spark, tmp_path, cells):
    """A batch on one key in a hundred leaves the files of all other buckets as they are."""
    base = cells(*[(f"key{i}", f"kd_{i % 5}", 1) for i in range(400)])
    b, staging = store(spark, tmp_path, base, 64)
    before = file_names(b.path)
    assert len(before) > 50
    some = [f"key{i}" for i in range(4)]
    want = {r[0] for r in keyed(spark, *some).select(b.of("row_key")).collect()}
    puts = puts_of(cells(*[(k, "kd_9", 5) for k in some]))
    assert set(buckets.fold_batch(spark, b, puts, 1, staging)) == want
    after = file_names(b.path)
    changed = {name for name in before if before[name] != after[name]}
    assert changed == {f"{b.column}={n}" for n in want} and len(changed) <= 4
    assert rows(current_state(buckets.read_log(spark, b))) == rows(apply_mutations(base, puts))
    assert {r.bucket: r.batch for r in buckets.watermarks(spark, b).collect() if r.batch} == dict.fromkeys(want, 1)


def test_a_batch_that_died_is_run_again(spark, tmp_path, cells, monkeypatch):
    base = cells(*[(f"key{i}", "kd_1", ts) for i in range(60) for ts in (1, 2)])
    b, staging = store(spark, tmp_path, base)

    def batch():  # made from the table itself
        known = spark.createDataFrame([(f"key{i}",) for i in range(0, 60, 2)], "row_key string")
        newest = current_state(buckets.read_log(spark, b).join(known, "row_key", "left_semi"))
        return mutate._mutations(newest.withColumn("op", mutate.F.lit("delete_version")))

    want = sorted((f"key{i}", "cf", "kd_1", 2 if i % 2 else 1, "1") for i in range(60))
    # it died while the buckets were put in place: one is not there, one is the old one
    real = buckets._write
    kept = tmp_path / "kept"

    def dying(rows, to, path):
        if path == b.path:
            real(rows.where(mutate.F.col(b.column) % 3 == 0), to, path)
            gone = next(p for p in sorted(Path(b.path).iterdir()) if p.name.endswith("=1"))
            gone.rename(kept)
            raise RuntimeError("died")
        real(rows, to, path)

    monkeypatch.setattr(buckets, "_write", dying)
    with pytest.raises(RuntimeError):
        buckets.fold_batch(spark, b, batch(), 1, staging)
    monkeypatch.setattr(buckets, "_write", real)
    todo = buckets.fold_batch(spark, b, batch(), 1, staging)
    assert todo and not any(n % 3 == 0 for n in todo)
    assert rows(current_state(buckets.read_log(spark, b))) == want
    # once more, also after a later batch, changes nothing
    assert buckets.fold_batch(spark, b, batch(), 1, staging) == []
    buckets.fold_batch(spark, b, puts_of(cells(("key0", "kd_1", 9))), 2, staging)
    assert buckets.fold_batch(spark, b, batch(), 1, str(tmp_path / "elsewhere")) == []
    want[0] = ("key0", "cf", "kd_1", 9, "1")
    assert rows(current_state(buckets.read_log(spark, b))) == want


def test_empty_batch_and_table(spark, tmp_path, cells):
    b, staging = store(spark, tmp_path, cells(("a", "kd_1")).limit(0))
    assert rows(current_state(buckets.read_log(spark, b))) == []
    assert buckets.fold_batch(spark, b, puts_of(cells((None, "kd_1"), ("a", None))), 1, staging)
    assert buckets.read_log(spark, b).count() == 2


def by_kind(log):
    return buckets._of_kinds(log, buckets._kinds(log))


@pytest.mark.parametrize("seed", range(2))
def test_a_batch_meets_a_folded_log(spark, tmp_path, seed):
    """Old rows that meet only the deletes of a batch: the same as folding all of it, nulls and doubles included."""
    rng = random.Random(seed)

    def some(ops):
        out = []
        for _ in range(300):
            op, key, q = rng.choice(ops), rng.choice(["hot", "hot", "k1", "k2", None]), rng.choice(["kd_1", "kd_2", None])
            cell = (None, None) if op == "delete_row" else ("cf", q)
            ts = rng.choice([*range(30), None])
            out.append((op, key, *cell, ts, rng.choice(["1", "2", None]) if op == "put" else None, None))
        return spark.createDataFrame(out, mutate.MUTATIONS)

    every = ["put"] * 12 + ["delete_version"] * 3 + ["delete_column", "delete_row"]
    old = buckets.folded(some(every)).localCheckpoint()
    for ops in (every, ["put"], ["delete_row"], ["delete_column"], ["put", "delete_row"], ["other"]):
        fresh = some(ops).localCheckpoint()
        kinds = buckets._kinds(fresh)
        got = buckets.merged(by_kind(old), buckets._of_kinds(fresh, kinds), kinds, str(tmp_path / "fresh"))
        want = buckets.folded(old.unionByName(fresh))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_what_a_batch_leaves_alone_is_not_shuffled(spark, tmp_path, cells, monkeypatch):
    """Few puts find the old rows by broadcast, buckets go in place as they lie, and a log of puts alone joins nothing."""
    plans = []
    real = buckets._writer
    monkeypatch.setattr(buckets, "_writer", lambda df, b: plans.append(plan(df)) or real(df, b))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    b, staging = store(spark, tmp_path, cells(*[(f"key{i}", "kd_1", ts) for i in range(60) for ts in (1, 2)]))
    assert "Join" not in plan(current_state(buckets.read_log(spark, b)))
    buckets.fold_batch(spark, b, puts_of(cells(("key0", "kd_1", 9), ("key1", "kd_1", 2))), 1, staging)
    _, placed, merged, replaced = plans
    assert "Exchange" not in placed and "Exchange" not in replaced
    assert "BroadcastHashJoin" in merged and "SortMergeJoin" not in merged
    assert merged.count("Exchange hashpartitioning") + merged.count("Exchange rebalance") <= 1
    assert len(rows(current_state(buckets.read_log(spark, b)))) == 60
    assert buckets.read_log(spark, b).count() == 121


def test_a_device_id_is_digested_once(spark):
    n = spark.range(-3, 400).select("id").union(spark.sql("select cast(null as bigint)"))
    made = tables.device_id(mutate.F.col("id"))
    assert str(made._jc.toString()).count("md5") <= 2
    for number, found in n.select("id", made).collect():
        digest = None if number is None else hashlib.md5(str(number).encode()).hexdigest()
        assert found == (str(uuid.UUID(digest)) if number and number % 2 and number > 0 else digest)
