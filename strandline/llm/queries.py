"""Queries of the operators tagged llm; `QUERIES` and `SQL` are merged into `__spark_entry__`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table as t
from . import canon_map, entity_match, leakage, names, packing, subjects, unify

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canon_map.found(t(spark, d, "measurements"), t(spark, d, "diagnoses"), t(spark, d, "analytes_builtin"), t(spark, d, "disease_aliases"))


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return canon_map.unmatched(t(spark, d, "measurements"), t(spark, d, "diagnoses"), t(spark, d, "analytes_builtin"), t(spark, d, "disease_aliases"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return unify.found(t(spark, d, "measurements"), t(spark, d, "documents"))


def p2_spellings(spark: SparkSession, d: str) -> DataFrame:
    return unify.class_sizes(t(spark, d, "measurements"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return names.found(t(spark, d, "documents"))


def p4_entities(spark: SparkSession, d: str) -> DataFrame:
    return names.entities(t(spark, d, "documents"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return entity_match.found(t(spark, d, "individuals"), t(spark, d, "documents"))


def p5_confidences(spark: SparkSession, d: str) -> DataFrame:
    return entity_match.confidences(t(spark, d, "individuals"), t(spark, d, "documents"))


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(t(spark, d, "documents"), t(spark, d, "pack_budgets"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(p7_packed(spark, d), t(spark, d, "pack_budgets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.found(t(spark, d, "documents"), t(spark, d, "eval_items"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.report(t(spark, d, "documents"), t(spark, d, "eval_items"))


def p8_clean(spark: SparkSession, d: str) -> DataFrame:
    return leakage.clean(t(spark, d, "documents"), t(spark, d, "eval_items")).select("doc_id", "pmid", "n_chars")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.found(t(spark, d, "documents"), t(spark, d, "subjects"), t(spark, d, "subject_labels"))


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(t(spark, d, "documents"), t(spark, d, "subjects"), t(spark, d, "subject_labels"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p1_unmatched": p1_unmatched,
    "p2_found": p2_found,
    "p2_spellings": p2_spellings,
    "p4_found": p4_found,
    "p4_entities": p4_entities,
    "p5_found": p5_found,
    "p5_confidences": p5_confidences,
    "p7_packed": p7_packed,
    "p7_fill": p7_fill,
    "p8_found": p8_found,
    "p8_report": p8_report,
    "p8_clean": p8_clean,
    "p9_found": p9_found,
    "p9_composition": p9_composition,
}

SQL: dict[str, str] = {}
