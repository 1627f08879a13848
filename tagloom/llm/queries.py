"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, lm, passages, phrases, pii, rabitq, secrets, setsketch, splitters, tiling, toxicity, twins, urls, whitening
from tagloom.llm.spans import count_of, joined

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY)).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id", *[count_of(F.col("spans"), k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), setsketch.SketchSettings(percent=85))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[count_of(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.drop_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, sf_dir, "pages"))
    return judged.withColumn("share", F.round("share", 9))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = splitters.shard_rows(table(spark, sf_dir, "documents"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("place")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe, op2_secrets, op3_toxicity, op4_near_duplicates, op5_pii, op6_decontamination, op7_passages, op8_neighbours,
        op9_url_filter, op10_language_model, op11_sharding, op12_phrases, op13_whitening,
    )
}
SQL = {
    "op4_near_duplicates": twins.NEAR_DUPLICATES,
    "op7_passages": twins.PASSAGES,
    "op9_url_filter": twins.URL_FILTER,
    "op11_sharding": twins.SHARDING,
    "op12_phrases": twins.PHRASES,
}
