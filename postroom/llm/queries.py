"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .alignment import op13_alignment
from .common import table
from .conversations import op12_repair
from .decontamination import op1_leaks
from .licences import OP10_SQL, op10_licence_scan
from .line_quality import OP2_SQL, op2_line_rules
from .mixing import OP3_SQL, op3_mix
from .near_copies import op8_links
from .personal_data import op5_spans
from .sharding import op4_byte_shards
from .substrings import op7_repeats
from .token_counts import op9_counts
from .token_ids import op11_round_trip
from .toxicity import op6_ftrl


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_line_rules(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_mix(table(spark, sf_dir, "documents"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_byte_shards(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_spans(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_ftrl(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_repeats(table(spark, sf_dir, "documents"))


def op8_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_links(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return op9_counts(table(spark, sf_dir, "documents"), path)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_licence_scan(table(spark, sf_dir, "documents"))


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return op11_round_trip(table(spark, sf_dir, "documents"), path)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_repair(table(spark, sf_dir, "conversations"))


def op13_token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("byte_bpe_50k.json", "piece_bpe_32k.model")
    return op13_alignment(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, names))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_shards": op4_shards,
    "op5_personal_data": op5_personal_data,
    "op6_toxicity": op6_toxicity,
    "op7_substrings": op7_substrings,
    "op8_near_copies": op8_near_copies,
    "op9_token_counts": op9_token_counts,
    "op10_licences": op10_licences,
    "op11_token_ids": op11_token_ids,
    "op12_conversations": op12_conversations,
    "op13_token_pairs": op13_token_pairs,
}

#: Only what SQL can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op2_quality": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op10_licences": OP10_SQL,
}
