"""From raw documents to packed token sequences: rules, line dedup, near dedup, decontamination, packing.

Every stage takes the rows that the one before has kept and returns ``documents``' columns, the last the
packed pieces. Near dedup and decontamination judge rows: those without an id, or with another's, too.
A stage is written once, by whoever calls it, and sets the session to remove a query's shuffle files when it ends.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemaque.llm import decontam, linededup, minhash, packing, quality
from telemaque.llm.linking import CLEANUP, passing, sent, stored

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(CLEANUP, "true")
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(CLEANUP, "true")
    return linededup.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the first of the smallest id; rows without an id come last."""
    spark.conf.set(CLEANUP, "true")
    with passing(spark):
        rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows", keep=True)  # read again with the same numbers
        near = minhash.near_duplicates(rows, doc_id="__row").select(F.col("doc_id").alias("__row"), "component_id")
        near = stored(near, "near")
        order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "__row")
        several = stored(near.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id"), "several")
        copies = stored(near.join(sent(several), "component_id", "left_semi"), "copies")
        ids = rows.select("doc_id", "__row")
        named = stored(ids.join(sent(copies), "__row").select("component_id", order.alias("place")), "named")
        first = named.groupBy("component_id").agg(F.min("place").alias("first"))
        gone = named.join(first, "component_id").where("place.__row <> first.__row").select("place.__row")
        gone = stored(gone, "firsts", keep=True)  # all but the firsts
    # Who goes is sent to the texts, as long as it is not too much; who stays grows with the corpus.
    return rows.join(sent(gone), "__row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a passage of the benchmark go."""
    spark.conf.set(CLEANUP, "true")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.without_contaminated(docs, items)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(CLEANUP, "true")
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: Sketches, merges and packing are no SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
