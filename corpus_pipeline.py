"""From raw documents to packed training sequences, in five stages.

Every stage reads the table that the one before it wrote, works on all of its
rows and returns the columns of documents; the last one returns the packed
pieces.  ``run`` writes each stage's result under the shared checkpoint folder.

Defined results: an empty table passes through every stage as an empty table.
Rows with null or empty text have no language and leave in the first stage.  A
row without an id or source is treated like any other.  Extra columns are kept up
to the last stage.  SQL cannot express the stages (trained models, tokenizer);
they are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import langid, mixing, neardup, packing, secrets
from ledgerlens.llm.common import table, written

ORACLE_SQL = None
LEAST_SHARE = 0.4  # of a text's letters in its main language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language stay: texts without letters, and texts of
    which no language has LEAST_SHARE of the letters, go."""
    model = langid.train(docs, F.lit(True))
    found = langid.identify(docs, model, docs.columns, spans=False)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the
    smallest id (of rows repeated under that id in that group, any one).

    Ids that have one row are decided by id alone, and the documents are joined to
    those that go, the smaller side.  Rows repeated under an id are told apart by
    their sets."""
    judged = written(neardup.link(docs).withColumnRenamed("doc_id", "_id"), "judged")
    per = judged.groupBy("_id").agg(F.count("*").alias("n"), F.bool_or("kept").alias("stays"))
    leaving = written(per.filter("n > 1 OR NOT stays").select("_id", F.col("n").alias("_n")), "leaving")
    slim = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))  # names of extra columns stay apart
    own = F.col("doc.doc_id").eqNullSafe(F.col("_id"))
    alone = slim.join(leaving, own, "left_anti").select("doc.*")
    many = leaving.filter("_n > 1")
    if many.isEmpty():
        return alone
    again = slim.join(many, own, "left_semi")
    rows = written(again.select("doc", F.col("doc.text").alias("text"), F.monotonically_increasing_id().alias("row")), "repeated")
    nodes = neardup.features(rows, "row", "text", neardup.WIDTH).select(F.col("doc_id").alias("_row"), F.col("node").alias("_node"))
    sets = judged.filter("node IS NOT NULL").select("_id", "node", "root", "kept").distinct()
    found = (rows.join(nodes, F.col("row") == F.col("_row"))
             .join(sets, F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("_node") == F.col("node")), "left"))
    first = F.row_number().over(Window.partitionBy("_id", "root").orderBy("row"))
    found = found.withColumn("first", first).filter("_node IS NULL OR (kept AND first = 1)")
    return alone.unionByName(found.select("doc.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay."""
    masked = secrets.mask(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mix(docs).select("doc", F.explode(F.sequence(F.lit(0), F.col("copies"))).alias("copy")).filter("copy > 0").select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
