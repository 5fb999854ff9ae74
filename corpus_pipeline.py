"""Cleaning and packing of ``documents`` in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``.

Nulls, empty and very long texts, repeated rows, empty tables and further columns
are treated as each operator's docstring says; documents without text fail the
quality rules.  Of rows that share a doc_id, near-duplicate removal keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treepref.llm import neardup, packing, pii, quality, toxicity
from treepref.llm.queries import PII_KEY, vocabulary
from treepref.session import drop_path, materialize, scratch_path, ship_package, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality.repetition_quality(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


def toxic_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the classifier learns from the labels of the stage's own documents."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where("score < 0.5").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group."""
    groups = neardup.near_duplicates(docs)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("k")).distinct()
    out = docs.select(*COLUMNS).join(kept, F.col("doc_id").eqNullSafe(F.col("k")), "left_semi")
    ids = groups.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1")
    if ids.isEmpty():
        return out
    # Rows that share an id: one of them, by its columns.
    several = out.join(ids, out["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    one = several.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")
    return out.join(ids, out["doc_id"].eqNullSafe(ids["doc_id"]), "left_anti").unionByName(one)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return pii.pseudonymise(docs.select(*COLUMNS), PII_KEY).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 1024."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end=0, window=1024)


STAGES = [("quality_rules", quality_rules), ("toxicity", toxic_removal), ("near_dedup", near_dedup),
          ("pii", pii_surrogates), ("packing", packed)]

#: Trained weights, MinHash and keyed hashes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship_package(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        docs = materialize(stage(spark, docs, sf_dir), path=path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
