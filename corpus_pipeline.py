"""Corpus preparation: five stages over ``documents``, each written as Parquet and reread.

Language ID drops letterless documents, line dedup drops recurring lines, MinHash
near-dedup keeps the first document of each group (five-word shingles, similarity
0.8), decontamination drops documents with a benchmark passage, and packing
returns the pieces of the training sequences. Every stage but the last returns the
columns of documents.

Rows decide, not ids: a row without doc_id, or one that repeats another's, is judged by
its own text. Of equal rows near-dedup keeps one (they are near duplicates of each other),
of a group the one with the least doc_id, rows without one last; the other stages treat
equal rows alike. Texts that are null or without letters go in the first stage; a document
whose lines all recur stays with the empty text, which is near nothing. Long texts are whole,
an empty table gives no rows, and columns other than those of documents are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickflow.llm import op2_minhash, op5_templates, op6_packing, op7_qgrams, op10_langid
from clickflow.llm.common import numbered, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, also if no language could be learned; the others go."""
    model = op10_langid.fit(docs)
    return op10_langid.predict(docs, model, *COLUMNS).where("n_letters > 0").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines of recurring templates."""
    return op5_templates.drop_templates(docs.select(COLUMNS)).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group, and all that are linked with none."""
    # a number for each row, in the order of doc_id
    rows = numbered(docs.select(COLUMNS), [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")], "dedup-rows", "__row")
    linked = op2_minhash.link(rows.select(F.col("__row").alias("doc_id"), "text"), width=5, percent=80)
    gone = linked.where("NOT kept").select(F.col("doc_id").alias("__row"))
    return rows.join(gone, "__row", "left_anti").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark passage was found."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return op7_qgrams.free_rows(docs.select(COLUMNS), items)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return op6_packing.pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: Parsing, similarity search, alignment and packing have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
