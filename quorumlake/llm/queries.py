"""Queries of this subpackage, by name; each takes the session and the folder of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quorumlake.io import table
from quorumlake.llm import canonical, leaks, names, packing, pieces, reading, scans, turns


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.found(table(spark, folder, "motions"), table(spark, folder, "value_list"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.found(table(spark, folder, "documents"))


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.split_texts(table(spark, folder, "documents"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.found(table(spark, folder, "votes_by_member_raw"), table(spark, folder, "speakers"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return turns.found(table(spark, folder, "transcript_lines"), table(spark, folder, "speakers"))


def p4_turns(spark: SparkSession, folder: str) -> DataFrame:
    return turns.speaker_turns(table(spark, folder, "transcript_lines"), table(spark, folder, "speakers"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return scans.found(table(spark, folder, "motions"))


def p6_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.found(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return reading.found(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_pieces, p3_found, p4_found, p4_turns, p5_found, p6_pack, p7_found, p8_found)}
