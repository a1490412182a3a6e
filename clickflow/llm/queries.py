"""Registered queries of the subpackage: each applies one operator, with its production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (op1_lineblocks, op2_minhash, op3_repair, op4_ring, op5_templates, op6_packing, op7_qgrams, op8_chat,
               op9_hosts, op10_langid, op11_structure, op12_mixing, op13_divergence)
from .oracle_sql import SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_blocks(spark, sf_dir):
    return op1_lineblocks.extract(_table(spark, sf_dir, "pages"))


def op2_minhash_neardup(spark, sf_dir):
    return op2_minhash.link(_table(spark, sf_dir, "documents"))


def op3_repair_shards(spark, sf_dir):
    return op3_repair.token_shards(_table(spark, sf_dir, "documents"))


def op4_ring_shards(spark, sf_dir):
    return op4_ring.shard_documents(_table(spark, sf_dir, "documents"))


def op5_template_lines(spark, sf_dir):
    return op5_templates.drop_templates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", "text")


def op6_retrieval_packing(spark, sf_dir):
    return op6_packing.pack(_table(spark, sf_dir, "documents"))


def op7_qgram_matches(spark, sf_dir):
    return op7_qgrams.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_chat_format(spark, sf_dir):
    return op8_chat.formatted_digests(_table(spark, sf_dir, "conversations"))


def op9_host_rules(spark, sf_dir):
    return op9_hosts.judge(_table(spark, sf_dir, "documents")).withColumn("host_rate", F.round("host_rate", 9))


def op10_cross_parsing(spark, sf_dir):
    return op10_langid.identify(_table(spark, sf_dir, "documents"))


def op11_structure_repair(spark, sf_dir):
    return op11_structure.repaired_digests(_table(spark, sf_dir, "conversations"))


def op12_pareto_mixing(spark, sf_dir):
    return op12_mixing.mix(_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark, sf_dir):
    return op13_divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_blocks, op2_minhash_neardup, op3_repair_shards, op4_ring_shards, op5_template_lines,
    op6_retrieval_packing, op7_qgram_matches, op8_chat_format, op9_host_rules, op10_cross_parsing,
    op11_structure_repair, op12_pareto_mixing, op13_source_divergence)}
