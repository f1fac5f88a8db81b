"""Training-data pipeline over ``documents``: each stage sees all that its predecessor kept.

Rows that repeat a ``doc_id`` are one document to every stage and stay or go together; null and empty texts go with the
first stage, texts that lose all their content later stay as empty texts. Columns that a stage does not know pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgraph.llm import decontamination, jaccard_join, language_id, packing, sentence_dedup
from sensorgraph.operators.storage import scratch_path, stored


def _text_changed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, ``n_chars`` counted anew."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without text or whose language stays open; the text's hash tells repeated ids apart.

    Without any labelled text there is no model and all documents pass.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = language_id.document_rows(docs.select("doc_id", "text", "lang", "source"))
    rows = rows.withColumn("kind", F.xxhash64(F.coalesce("text", F.lit(""))).cast("string"))
    found = language_id.identify(rows).where(~F.col("accepted") & F.col("language").isNotNull())
    gone = stored(found.select(F.col("id").alias("__id"), F.col("kind").cast("long").alias("__hash")).distinct(), "rejected")
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (text_hash == F.col("__hash")), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each class."""
    classes = jaccard_join.near_duplicate_classes(docs.select("doc_id", "text"))
    gone = classes.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(stored(gone, "near-copies"), "doc_id", "left_anti").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts sentences in repeated runs out of the texts."""
    clash = {"n_removed": "__n_removed"} if "n_removed" in docs.columns else {}
    found = sentence_dedup.remove_repeated_sentences(docs.withColumnsRenamed(clash)).drop("n_removed")
    return _text_changed(found.withColumnsRenamed({v: k for k, v in clash.items()}), docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of the texts."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    others = {f"__other_{k}": c for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    renamed = docs.withColumnsRenamed({c: k for k, c in others.items()})  # an extra column may be named as a result
    found = decontamination.find_passages(renamed, items, keep=list(others))
    cut = F.when(F.size("spans") > 0, decontamination.without_spans()).otherwise(F.col("text"))
    found = found.select("doc_id", cut.alias("text"), *[F.col(k).alias(c) for k, c in others.items()])
    return _text_changed(found, docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substrings),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packed),
]

#: The stages are models and packing that SQL does not express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
