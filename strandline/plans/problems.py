"""Queries of the data problems that belong to the core, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import harmonise, nested
from ..session import table as t


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return harmonise.found(t(spark, d, "measurements"), t(spark, d, "analytes_builtin"))


def p6_model_report(spark: SparkSession, d: str) -> DataFrame:
    return harmonise.model_report(t(spark, d, "measurements"), t(spark, d, "analytes_builtin"))


def p6_held_out(spark: SparkSession, d: str) -> DataFrame:
    return harmonise.held_out(t(spark, d, "measurements"), t(spark, d, "analytes_builtin"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.found(t(spark, d, "individuals"))


def p3_links(spark: SparkSession, d: str) -> DataFrame:
    return nested.links(t(spark, d, "individuals"))


def p3_genetic_findings(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_table(t(spark, d, "individuals"), "record.genetic_findings").select("record_id", F.col("pos").cast("bigint").alias("idx"), "gene_symbol", "variant_hgvs_c", "variant_hgvs_p", "zygosity", "novel").distinct()


def p3_tables(spark: SparkSession, d: str) -> DataFrame:
    return nested.tables(t(spark, d, "individuals"))


def _table(tag: str):
    return lambda spark, d: nested.flat_table(t(spark, d, "individuals"), tag)


QUERIES: dict = {f"p3_{tag.replace('.', '_')}": _table(tag) for tag in nested.TABLES}
QUERIES |= {"p3_found": p3_found, "p3_links": p3_links, "p3_tables": p3_tables, "p3_genetic_findings": p3_genetic_findings, "p6_found": p6_found, "p6_model_report": p6_model_report, "p6_held_out": p6_held_out}
SQL: dict = {
    "p3_genetic_findings": """
        WITH one AS (SELECT DISTINCT record_id, record.genetic_findings AS g FROM individuals WHERE record.genetic_findings IS NOT NULL),
        idx AS (SELECT record_id, g, unnest(range(len(g))) AS i FROM one)
        SELECT DISTINCT record_id, i AS idx, g[i + 1].gene_symbol AS gene_symbol, g[i + 1].variant_hgvs_c AS variant_hgvs_c,
               g[i + 1].variant_hgvs_p AS variant_hgvs_p, g[i + 1].zygosity AS zygosity, g[i + 1].novel AS novel
        FROM idx WHERE g[i + 1] IS NOT NULL""",
}
