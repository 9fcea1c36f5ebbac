"""The engine's scalar functions for SQL users: `register(spark)` adds them to the session under the prefix `sl_`.

Column functions become temporary SQL functions, so the optimiser inlines them (no Python worker); fuzzy ratios are Arrow-batched.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F, types as T

from . import fuzzy, numbers, text

COLUMNS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "sl_slug": ("string", text.slug), "sl_squash": ("string", text.squash), "sl_key": ("string", lambda c: text.key(c, "disease")), "sl_phenotype_key": ("string", lambda c: text.key(c, "phenotype")), "sl_analyte_key": ("string", lambda c: text.key(c, "analyte")),
    "sl_unit": ("string", text.unit_normal), "sl_clean_term": ("string", text.clean_term), "sl_age_days": ("double", numbers.age_days),
}
RATIOS = {"sl_token_sort": fuzzy.token_sort_ratio, "sl_token_set": fuzzy.token_set_ratio, "sl_weighted": fuzzy.weighted_ratio}


def _sql(spark: SparkSession, column: Column) -> str:
    """A column expression over `x` as SQL text."""
    plan = spark.createDataFrame([], "x string").select(column.alias("v"))._jdf.queryExecution().analyzed()
    return plan.expressions().head().child().sql()


def _ratio(function: Callable[[str, str], float]):  # noqa: ANN202
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else float(function(x, y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    return F.pandas_udf(run, T.DoubleType())


def register(spark: SparkSession) -> list[str]:
    """Register all functions; returns their names. `NULL` gives `NULL`."""
    for name, (kind, make) in COLUMNS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {_sql(spark, make(F.col('x')))}")
    for name, function in RATIOS.items():
        spark.udf.register(name, _ratio(function))
    return [*COLUMNS, *RATIOS]
