"""Corpus cleaning as stages, each one operator over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import cascade, minhash, packing, suffix, toxicity
from stockflow.llm.queries import vocabulary
from stockflow.llm.shipping import ship
from stockflow.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``: a number of each row's own in the order of ids, null where the id is.

    Ids that do not repeat are such numbers themselves; otherwise rows are sorted, numbered and stored.
    """
    docs = docs.select(COLUMNS)
    again = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if again.isEmpty():
        return docs.withColumn("row", F.col("doc_id"))
    placed = docs.withColumn("at", F.monotonically_increasing_id()).orderBy("doc_id", "at").drop("at")
    return stored(placed.withColumn("row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "rows")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the chain does not call toxic; trained on the labelled documents of the same tables."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxic(docs, docs, labels, carry=tuple(COLUMNS[1:])).filter("not toxic").select(COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the cascade keeps."""
    ship(spark)
    return cascade.quality(docs, carry=tuple(COLUMNS[1:])).filter("kept").select(COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near copies (five words, similarity 0.8), and all rows without an id."""
    ship(spark)
    rows = _rows(docs)
    verdicts = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), width=5, percent=80)
    kept = verdicts.filter("kept and doc_id is not null").select(F.col("doc_id").alias("row"))
    with_id = rows.filter("row is not null").join(kept.hint("merge"), "row", "left_semi")
    return with_id.select(COLUMNS).union(rows.filter("row is null").select(COLUMNS))


def passage_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without bytes of 100-byte strings that start earlier; n_chars is of what is left.

    A row without an id has no place in the order and keeps its text.
    """
    ship(spark)
    rows = _rows(docs).select(F.col("row").alias("doc_id"), "text", F.col("doc_id").alias("id"), "lang", "source")
    rest = suffix.dedup_texts(rows, length=100, carry=("id", "lang", "source"))
    return rest.withColumn("doc_id", F.col("id")).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids packed into sequences of 2048."""
    ship(spark)
    return packing.packed(docs, vocabulary("word_bpe_49k.json"), capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("passage_dedup", passage_dedup_stage),
    ("packing", packing_stage),
]

# The tokenizer of the last stage and the classifier of the first are outside SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
