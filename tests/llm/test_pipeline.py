import hashlib
import random
import re
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as p

from ..check import compare, duck
from .test_secrets import base_of
from .test_setsketch import edited, shingles

SF = "/root/testdata/sf0.001"
# Rows of a result against those of a table, where they go together.
SIZES = {"op9_url_filter": ("pages", 1), "op13_whitening": ("embeddings", 8), "op8_neighbours": None, "op12_phrases": None}


def test_stages_and_registration():
    assert [n for n, _ in p.STAGES] == ["toxicity", "near-duplicates", "decontamination", "secrets", "bpe"]
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [q for q in entry.LLM_QUERIES if q.startswith("op")])
def test_query_over_the_small_tables(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = df.count()
    table, times = SIZES.get(name, ("documents", 1)) or (None, 0)
    assert rows == times * spark.read.parquet(f"{SF}/{table}.parquet").count() if table else rows > 0


@pytest.mark.parametrize("name", list(entry.LLM_SQL))
def test_query_equals_sql(spark, name):
    ok, note = compare(spark, duck(SF), SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note


def test_each_stage_on_its_input(spark):
    """Every stage drops what its operator says and nothing else; columns stay."""
    docs = p.table(spark, SF, "documents")
    extra = docs.withColumn("hits", p.F.lit("kept")).withColumn("spans", p.F.lit(1))
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.columns == extra.columns and out.where("hits <> 'kept'").count() == 0
    scored = p.toxicity.score_toxicity(docs, p.table(spark, SF, "labels"))
    want = {r.doc_id for r in scored.where("predicted = 0").collect()}
    assert {r.doc_id for r in p.drop_toxic(spark, docs, SF).collect()} == want
    near = {r.doc_id for r in p.setsketch.near_duplicates(docs).where("kept").collect()}
    assert {r.doc_id for r in p.drop_near_duplicates(spark, docs, SF).collect()} == near
    assert p.redact_secrets(spark, docs, SF).count() == docs.count()


def test_stages_with_odd_rows(spark, odd, empty):
    for _, stage in p.STAGES:
        assert stage(spark, odd, SF).where("doc_id is null").count() == 1
        assert stage(spark, empty, SF).count() == 0


def test_redacted_texts(spark, docs):
    df = docs("a token=abcdefghijklmnop b", None, "clean").withColumn("n_chars", p.F.lit(7))
    rows = {r.doc_id: r for r in p.redact_secrets(spark, df, SF).collect()}
    assert rows[0].text == "a [SECRET] b" and rows[0].n_chars == 12
    assert rows[1].text is None and rows[2].text == "clean" and rows[2].n_chars == 7


def test_near_duplicates_from_four_fifths(spark, docs):
    """Against all pairs: what is alike to 0.80 falls, what is alike to less stays."""
    rng = random.Random(80)
    texts = [None, "", "one", "ONE"]
    for _ in range(8):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([100, 150]))]
        texts += [" ".join(words), edited(rng, words, 2), edited(rng, words, 3), edited(rng, words, 5)]
    # 90 shingles, and the first 72 or 71 of them: exactly 0.80 and just below
    words = [f"x{i}" for i in range(94)]
    texts += [" ".join(words), " ".join(words[:76])]
    words = [f"y{i}" for i in range(94)]
    texts += [" ".join(words), " ".join(words[:75])]
    sets = [shingles(x) for x in texts]
    shares = {(i, j): len(a & b) / len(a | b) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a & b}
    assert 0.8 in shares.values() and any(0.8 < x < 0.85 for x in shares.values()) and any(0.78 < x < 0.8 for x in shares.values())
    up = list(range(len(texts)))
    for (i, j), share in shares.items():
        if share >= 0.8:
            a, b = up[i], up[j]
            up = [min(a, b) if x in (a, b) else x for x in up]
    want = {i for i, top in enumerate(up) if i == top}
    assert {r.doc_id for r in p.drop_near_duplicates(spark, docs(*texts), SF).collect()} == want


def planted(rng, items):
    """Texts, with what is to become of them: they stay, or fall as copies of an earlier one or as holders of an item."""
    words = lambda n: [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(900)}" for _ in range(n)]
    out = [("stays", " ".join(words(rng.randrange(1, 120)))) for _ in range(30)]
    for _ in range(5):
        text = words(100)
        out += [("stays", " ".join(text)), ("copy", " ".join(text)), ("copy", edited(rng, text, 2))]
    for item in items:
        half = len(item) // 2
        out.append(("leak", " ".join([*words(30), *item[half:], *words(7), *item[:half], *words(9)])))
    out += [("stays", f"{' '.join(words(20))} token=abcdefgh{i}jklmnop {' '.join(words(5))} AKIA{i}ABCDEFGHIJKLMNOP") for i in range(5)]
    abuse = ["idiot", "moron", "stupid", "pathetic", "loser", "scumbag"]
    out += [("toxic", " ".join([*words(6), rng.choice(abuse), *words(5), rng.choice(abuse), *words(8)])) for _ in range(60)]
    return out + [("stays", None), ("stays", ""), ("stays", " \t\n")]


def redacted(text, extra):
    """Every stretch that secrets cover as one mark; ``extra`` are spans of high entropy."""
    out, at = "", 0
    for start, end in sorted([*[(a, b) for _, a, b in base_of(text)], *extra]):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_whole_run_against_brute_force(spark, tmp_path):
    """Given rows and planted ones; every stage is followed by plain means on what the stage before it left."""
    rng = random.Random(13)
    items = [[f"i{rng.randrange(5000)}" for _ in range(n)] for n in (24, 40, 60)]
    extra = planted(rng, items)
    given = p.table(spark, SF, "documents")
    rows = [(10_000 + i, text, "en", "planted", len(text) if text else 0) for i, (_, text) in enumerate(extra)]
    docs = given.unionByName(spark.createDataFrame(rows, given.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = p.table(spark, SF, "labels")
    marks = [(i, 1, int(what == "toxic")) for i, (what, _) in enumerate(extra, 10_000)]
    labels.unionByName(spark.createDataFrame(marks, labels.schema)).write.parquet(f"{tmp_path}/labels.parquet")
    known = p.table(spark, SF, "benchmark")
    known.unionByName(spark.createDataFrame([(10**6 + i, " ".join(x)) for i, x in enumerate(items)], known.schema)).write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    got = {r.doc_id: r for r in p.run(spark, str(tmp_path)).collect()}

    # toxicity: the classifier's word is taken, and held against what was planted
    texts = {r.doc_id: r.text for r in docs.collect()}
    scored = p.toxicity.score_toxicity(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()
    toxic = {r.doc_id for r in scored if r.predicted == 1}
    left = sorted(set(texts) - toxic)
    assert len({i for i, _, y in marks if y} & toxic) >= 50

    # near duplicates: all pairs
    sets, top = {i: shingles(texts[i]) for i in left}, {i: i for i in left}
    for n, i in enumerate(left):
        for j in left[:n]:
            a, b = sets[i], sets[j]
            if a & b and 100 * len(a & b) >= 80 * len(a | b) and top[i] != top[j]:
                low, high = sorted((top[i], top[j]))
                top = {k: low if v == high else v for k, v in top.items()}
    left = [i for i in left if top[i] == i]

    # decontamination: words of an item in runs of five that the document has, too
    fold = lambda text: re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    bench = [fold(r.text) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    clean = []
    for i in left:
        w = fold(texts[i])
        runs = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        shares = [len({k + j for k in range(len(b) - 4) if tuple(b[k : k + 5]) in runs for j in range(5)}) / len(b) for b in bench if len(b) >= 5]
        if max(shares, default=0) < 0.8:
            clean.append(i)
    assert sorted(got) == clean
    fate = {10_000 + i: what for i, (what, _) in enumerate(extra)}
    # texts without words have no shingles and are nobody's copies
    assert {i for i, what in fate.items() if what == "stays"} - toxic <= set(clean)
    assert not {i for i, what in fate.items() if what == "leak"} & set(clean)

    # secrets and tokens
    entropy = {
        r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "entropy"]
        for r in p.secrets.find_secrets(docs.where(p.F.col("doc_id").isin(clean))).collect()
    }
    tokenizer = Tokenizer.from_file(public_tokenizers.path(p.VOCABULARY))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for i in clean:
        text = redacted(texts[i] or "", entropy[i])
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        plain = tokenizer.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(plain.encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want
    assert sum("[SECRET]" in redacted(texts[i] or "", entropy[i]) for i in clean) >= 5
