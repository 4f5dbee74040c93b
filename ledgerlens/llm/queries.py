"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import alignment, fingerprints, langid, merkle, mixing, multiindex, neardup, oracle, packing, pii, secrets, topk, toxicity, urlfilter
from ledgerlens.llm.common import ascii_lower, remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    found = toxicity.score(docs, model, ["doc_id"])
    return found.select("doc.doc_id", "score", "worst").select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "worst")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents"), width=2).drop("node", "root")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, remainder("doc_id", 5) != 0)
    found = langid.identify(docs, model, ["doc_id"])
    return found.select("doc.doc_id", "lang_pred", "score", "spans").withColumn("held_out", remainder("doc_id", 5) == 0).select(
        "doc_id", "held_out", "lang_pred", "score", "spans")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc.doc_id", *alignment.COUNTS, "groups_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.leaf(*before, F.col("text"))
    tampered = F.when(remainder("doc_id", 3) == 0, merkle.leaf(*before, ascii_lower(F.col("text")))).otherwise(F.col("leaf"))
    claims = docs.select("doc_id", "lang", leaf.alias("leaf"), "source", "n_chars", "text").select("doc_id", "lang", "leaf", tampered.alias("claimed"))
    listed = merkle.manifest(claims, ["doc_id", "claimed"], "lang", "doc_id", "leaf")
    found = listed.select("doc.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                          merkle.folded(F.col("doc.claimed"), F.col("proof")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.nearest(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


OPERATORS = (op1_toxicity, op2_packing, op3_fingerprints, op4_near_duplicates, op5_mixing, op6_url_filter, op7_secrets, op8_language,
             op9_personal_data, op10_topk_search, op11_alignment, op12_merkle_manifest, op13_nearest_neighbours)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (*OPERATORS, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op4_near_duplicates": oracle.NEAR_DUPLICATES, "op7_secrets": oracle.SECRETS, "op10_topk_search": oracle.TOP_K,
            "op12_merkle_manifest": oracle.MERKLE}
