"""From raw documents to packed training sequences: five stages, each of which uses one corpus operator.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that the one before kept and returns a DataFrame; all
but the last return the columns of ``documents``. :func:`run` writes each result as Parquet to the shared folder and
gives it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import staging
from gridloom.llm.minhash import near_duplicates
from gridloom.llm.mixing import cycle_weights, first_words, mix
from gridloom.llm.packing import pack_documents
from gridloom.llm.pii import redact
from gridloom.llm.toxicity import score_texts, train

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine trained on all labels scores below one half. Null and empty texts have the score of no
    evidence; repeated rows and null ids are scored each for itself. Empty table: no rows."""
    model = train(docs, staging.table(spark, sf_dir, "labels"))
    return score_texts(docs.select(*COLUMNS), model).where(F.col("score") < 0.5).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity 0.8): the one with the least id, null
    ids last, ties by a hash of the row. Null texts and those without words are alike with nothing and stay. Different
    rows of one id, or of none, are documents of their own; rows alike in every column are one. Empty table: no rows."""
    rows = docs.select(*COLUMNS).withColumn("row", F.xxhash64(*COLUMNS))
    found = near_duplicates(rows, id_col="row", k=5, percent=80).select("row", "component_id")
    first = F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row")
    kept = found.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(first)
    return rows.join(kept.select("row"), "row", "left_semi").dropDuplicates(["row"]).select(*COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data and secrets replaced by their kind. Null texts stay null (``n_chars`` too);
    repeated rows and null ids stay as they are. Empty table: no rows."""
    return redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1, repeating; 150% of all words, no document more than twice: documents that the mix
    takes twice come twice, and one at a source's boundary comes with its first words only. Texts without words
    come as often as every text of their source does at least. Null sources are one source; rows that repeat an id, or have none, are documents of their own. Empty
    table: no rows."""
    taken = mix(docs, cycle_weights((5, 2, 1)), share=1.5, cap=2.0, keep=COLUMNS).select("kept", "repeats", "partial").where("repeats > 0 or partial > 0")
    # Each copy's words: 0 for all of them
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), F.col("repeats").cast("int")), F.when(F.col("partial") > 0, F.array("partial")).otherwise(F.array().cast("array<long>")))
    each = taken.withColumn("words", F.explode(copies)).select("kept.*", "words")
    text = F.when(F.col("words") > 0, first_words(F.col("text"), F.col("words"))).otherwise(F.col("text"))
    n_chars = F.when(F.col("words") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return each.withColumn("text", text).withColumn("n_chars", n_chars).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 1024. Null text: empty, so one end token. Rows that repeat an id and
    null ids have pieces of their own. Empty table: no rows."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("packing", packing)]

#: The first stage learns a classifier, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = staging.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
