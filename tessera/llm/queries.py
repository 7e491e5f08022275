"""Queries of the training-data operators, as the driver runs them, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, licences, neighbours, pages, pieces, quality, secrets, simhash, tokenstore, toxicity


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find(_read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.digests(spark, tokenstore.write(_read(spark, sf_dir, "documents")))


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(_read(spark, sf_dir, "pages"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(_read(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_licences": op2_licences,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_tokens": op5_tokens,
    "op6_pages": op6_pages,
    "op7_secrets": op7_secrets,
    "op8_neighbours": op8_neighbours,
    "op9_pieces": op9_pieces,
    "op10_decontamination": op10_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op2_licences": licences.oracle_sql(),
}
