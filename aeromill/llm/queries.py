"""Queries of the corpus operators, with SQL where SQL can express them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from aeromill.llm import html_extract, line_dedup, media, mixing, neighbours, packing, repeats, secrets, simhash, toxicity
from aeromill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op8(table(spark, sf_dir, "documents"))


QUERIES["op8_mix_sources"] = op8_mix_sources
ORACLES["op8_mix_sources"] = mixing.OP8_SQL


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.op5(table(spark, sf_dir, "documents"))


QUERIES["op2_secret_scan"] = op2_secret_scan
QUERIES["op5_media_columns"] = op5_media_columns


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op7(table(spark, sf_dir, "documents"), packing.vocabulary())


QUERIES["op7_best_fit_packing"] = op7_best_fit_packing


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op4(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op6(table(spark, sf_dir, "documents"))


QUERIES["op4_line_dedup"] = op4_line_dedup
QUERIES["op6_simhash_near_dedup"] = op6_simhash_near_dedup


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op9(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op9_toxicity"] = op9_toxicity


def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


QUERIES["op10_html_main_text"] = op10_html_main_text


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


QUERIES["op3_nearest_neighbours"] = op3_nearest_neighbours


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op1(table(spark, sf_dir, "documents"))


QUERIES["op1_suffix_dedup"] = op1_suffix_dedup


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
