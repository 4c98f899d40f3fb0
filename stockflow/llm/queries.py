"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import (
    bpe,
    cascade,
    codes,
    fingerprint,
    html_text,
    lattice,
    minhash,
    packing,
    ranking,
    sharding,
    suffix,
    toxicity,
    warc,
)
from stockflow.llm.shipping import ship
from stockflow.llm.storage import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return shipped


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the package that holds it is part of the installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxic(docs, docs, table(spark, sf_dir, "labels"))


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_report(table(spark, sf_dir, "documents"), length=100)


@query
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=2048)


@query
def op7_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), count=16)


@query
def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.quality(table(spark, sf_dir, "documents"))


@query
def op9_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.sampled(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), k=2)


@query
def op10_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.coded(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


@query
def op12_byte_pair_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.code_report(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
