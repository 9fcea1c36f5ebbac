"""Problem 2: one consistent form for texts that look the same.

Every text gets its look-alike-mapped form (`functions.lookalike.unify`, Arrow batches; plain ASCII passes through). The
mapped forms are grouped in SQL under the accent-sensitive Unicode collation, each class gets one deterministic canonical
member, and that member is joined back to every row. Accents, case and dashes of other length keep texts apart.

The canonical member is the smallest text (by code point) of the class that equals its own mapped form; where the class
has none, it is the smallest mapped form. So the result never depends on the order or number of repeated rows.

Cases: null texts and null row keys give no row; empty texts form their own class; very long texts are mapped whole; repeated
rows are kept (one output row each); extra columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.lookalike import fold, unify
from ..session import materialise


@F.pandas_udf(T.StructType([T.StructField("mapped", T.StringType()), T.StructField("folded", T.BooleanType())]))
def _map(texts: pd.Series) -> pd.DataFrame:
    codes, uniques = pd.factorize(texts)
    mapped = [unify(x) for x in uniques]
    folded = [fold(x) != x for x in uniques]
    return pd.DataFrame({"mapped": [mapped[c] if c >= 0 else None for c in codes], "folded": [folded[c] if c >= 0 else None for c in codes]})


def unify_texts(rows: DataFrame) -> DataFrame:
    """`rows(field, row_key, text)` → `(field, row_key, text, canonical, lookalike)`; `lookalike` marks rows whose text held
    at least one character that only looks like an ordinary one."""
    spark = rows.sparkSession
    rows = rows.select("field", "row_key", "text").where("text is not null and row_key is not null")
    # Printable ASCII maps to itself: such rows never enter a Python worker.
    plain = rows.where(~F.col("text").rlike(r"[^\x00-\x7e]")).withColumns({"mapped": F.col("text"), "folded": F.lit(False)})
    other = rows.where(F.col("text").rlike(r"[^\x00-\x7e]")).withColumn("m", _map("text")).select("field", "row_key", "text", "m.mapped", "m.folded")
    both = materialise(plain.unionByName(other), "mapped")  # read by the classes and by the join
    classes = spark.sql(
        """
        SELECT field, mapped COLLATE UNICODE AS class_key,
               coalesce(min(CASE WHEN text = mapped THEN text END), min(mapped)) AS canonical
        FROM {rows} GROUP BY field, mapped COLLATE UNICODE
        """,
        rows=both,
    )
    return spark.sql(
        """
        SELECT r.field, r.row_key, r.text, c.canonical, r.folded AS lookalike
        FROM {rows} r JOIN {classes} c ON r.field = c.field AND r.mapped COLLATE UNICODE = c.class_key
        """,
        rows=both,
        classes=classes,
    )


def found(measurements: DataFrame, documents: DataFrame) -> DataFrame:
    """(field, row_key) of every text with a look-alike character whose stored form isn't the canonical one."""
    a = measurements.select(F.lit("analyte_text").alias("field"), F.col("fact_id").alias("row_key"), F.col("analyte_text").alias("text"))
    b = documents.select(F.lit("abstract").alias("field"), F.col("doc_id").cast("string").alias("row_key"), F.col("abstract").alias("text"))
    return unify_texts(a.unionByName(b)).where("lookalike and text <> canonical").select("field", "row_key").distinct()


def class_sizes(measurements: DataFrame) -> DataFrame:
    """How many stored spellings each consistent analyte text has: (canonical, n_spellings, n_facts)."""
    a = measurements.select(F.lit("analyte_text").alias("field"), F.col("fact_id").alias("row_key"), F.col("analyte_text").alias("text"))
    return unify_texts(a).distinct().groupBy("canonical").agg(F.countDistinct("text").alias("n_spellings"), F.count("*").alias("n_facts")).where("n_spellings > 1")
