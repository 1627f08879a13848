"""A corpus-cleaning pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that stay,
with all their columns; the last one returns what the tokenizer made of them.
Stages join their decision to the rows by id: rows that share an id share the
decision, rows with a null id are never dropped, and every other column passes
through untouched.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, secrets, setsketch, tiling, toxicity
from tagloom.llm.common import stored
from tagloom.llm.queries import VOCABULARY, table
from tagloom.llm.spans import let

ID = "doc_id"


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows whose id is not among the rejected ones."""
    return docs.join(rejected.select(F.col(ID)).distinct(), ID, "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic. Labels are those of the kept documents' table."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return without(docs, stored(scored.where("predicted = 1").select(ID), "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that are alike to 0.8 or more only the one with the smallest id stays."""
    found = setsketch.near_duplicates(docs, setsketch.FOUR_FIFTHS)
    return without(docs, found.where("not kept"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark items."""
    found = tiling.find_contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, stored(found.where("contaminated").select(ID), "leaks"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mark; ``n_chars`` follows a text that changes."""
    text = F.col("text")
    clean = F.when(text.isNotNull(), let(secrets.secret_spans(text), lambda spans: secrets.redact(text, spans)))
    size = F.when(F.col("clean.text").eqNullSafe(text), F.col("n_chars")).otherwise(F.length("clean.text"))
    new = {"text": F.col("clean.text"), "n_chars": size.cast("bigint")}
    changed = docs.withColumn("clean", F.struct(clean.alias("text")))
    return changed.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of ids and of the text decoded from them."""
    coded = bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))
    return coded.select(
        ID, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("bpe", encode_bpe),
]

# No SQL twin: a trained classifier comes first. tests/llm has a brute-force twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
