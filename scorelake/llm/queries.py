"""The operators of this folder over whole tables, as queries with fixed result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import align
from .contamination import contaminated
from .license_rules import scan
from .line_templates import dropped_lines
from .lm_scores import scored_texts
from .near_copies import near_copies
from .oracle import ORACLE as ORACLE
from .packing import pack
from .patched_ids import token_ids
from .private_data import private_spans
from .repetition import quality_report
from .rule_ensemble import scored
from .suffix_dedup import without_repeats
from .whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_suffix_dedup(spark, sf_dir):
    return without_repeats(documents(spark, sf_dir)).drop("spans", "kept")


@query
def op2_private_spans(spark, sf_dir):
    return private_spans(documents(spark, sf_dir))


@query
def op3_token_ids(spark, sf_dir):
    return token_ids(documents(spark, sf_dir))


@query
def op4_rule_ensemble(spark, sf_dir):
    return scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op5_repetition_rules(spark, sf_dir):
    return quality_report(documents(spark, sf_dir))


@query
def op6_license_rules(spark, sf_dir):
    return scan(documents(spark, sf_dir)).drop("detections")


@query
def op7_best_fit_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))


@query
def op8_near_copies(spark, sf_dir):
    return near_copies(documents(spark, sf_dir))


@query
def op9_line_templates(spark, sf_dir):
    return dropped_lines(documents(spark, sf_dir))


@query
def op10_contamination(spark, sf_dir):
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op11_whitening(spark, sf_dir):
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_lm_scores(spark, sf_dir):
    return scored_texts(documents(spark, sf_dir))


@query
def op13_alignment(spark, sf_dir):
    return align(documents(spark, sf_dir))
