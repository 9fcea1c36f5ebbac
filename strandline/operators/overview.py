"""Overview tables of a corpus: dense time axes, percentiles, crosstabs with totals, interpolation between anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import age_days
from .scope import tag


def dense_axis(counts: DataFrame, key: str, value: str, low: int, high: int) -> DataFrame:
    """`counts` with 0 for every missing key between two bounds."""
    axis = counts.sparkSession.range(low, high + 1).select(F.col("id").cast(counts.schema[key].dataType).alias(key))
    return axis.join(counts, key, "left").select(key, F.coalesce(value, F.lit(0)).alias(value))


def percentiles(rows: DataFrame, col: str, by: list[str], points: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Exact percentiles with linear interpolation, with minimum, maximum, mean and count."""
    p = [F.percentile(col, q).alias(f"p{round(q * 100)}") for q in points]
    return rows.where(F.col(col).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.min(col).alias("low"), F.max(col).alias("high"), F.round(F.avg(col), 4).alias("mean"), *p)


def age_band(years: Column) -> Column:
    return (
        F.when(years.isNull(), "unknown").when(years < 1, "<1").when(years < 5, "1-4").when(years < 12, "5-11").when(years < 18, "12-17").when(years < 40, "18-39").when(years < 65, "40-64").otherwise("65+")
    )


def licence_group(licence: Column) -> Column:
    t = F.lower(F.coalesce(licence, F.lit("")))
    return F.when(t == "", "none").when(t.contains("nc"), "non-commercial").when(t.contains("cc0") | t.contains("cc by"), "open").otherwise("other")


def interpolate(keys: DataFrame, anchors: DataFrame, key: str = "k", value: str = "v") -> DataFrame:
    """Linear interpolation of `value` between the neighbouring anchors of each key; beyond the ends the nearest anchor.

    A sort-merge on ranges, for any number of anchors: keys and anchors are cut into the same ranges of keys, each range gets the
    last anchor before it and the first one after it (aggregates per range), and the neighbours within are windows over one range.
    Without anchors the value is NULL.
    """
    points = anchors.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(key).cast("double").alias("_k")).agg(F.max(F.col(value).cast("double")).alias("_v"))
    keys = keys.where(F.col(key).isNotNull())
    span = points.agg(F.min("_k").alias("low"), F.max("_k").alias("high"), F.count("*").alias("n")).first()
    if not span.n:
        return keys.withColumn(value, F.lit(None).cast("double"))
    ranges = max(1, min(span.n, 4096))
    width = (span.high - span.low) / ranges or 1.0
    cut = lambda c: F.least(F.greatest(F.floor((c - span.low) / width), F.lit(0)), F.lit(ranges - 1)).cast("int")
    p = points.withColumn("_r", cut(F.col("_k")))
    ends = p.groupBy("_r").agg(F.min(F.struct("_k", "_v")).alias("_first"), F.max(F.struct("_k", "_v")).alias("_last"))
    axis = keys.sparkSession.range(ranges).select(F.col("id").cast("int").alias("_r")).join(ends, "_r", "left")
    order = Window.orderBy("_r")  # over at most 4,096 rows
    axis = axis.select("_r", F.last("_last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.first("_first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    cols = keys.columns
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in keys.schema]
    rows = keys.select(*cols, F.col(key).cast("double").alias("_k"), F.lit(None).cast("double").alias("_v"), cut(F.col(key).cast("double")).alias("_r"), F.lit(True).alias("_is_key")).unionByName(p.select(*nothing, "_k", "_v", "_r", F.lit(False).alias("_is_key")))
    w = Window.partitionBy("_r").orderBy("_k")
    point = F.when(F.col("_v").isNotNull(), F.struct("_k", "_v"))
    near = rows.withColumns({"_a": F.last(point, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0)), "_b": F.first(point, ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))})
    x = near.where("_is_key").join(F.broadcast(axis), "_r")
    a, b = F.coalesce("_a", "_before"), F.coalesce("_b", "_after")
    line = a["_v"] + (b["_v"] - a["_v"]) * (F.col("_k") - a["_k"]) / F.nullif(b["_k"] - a["_k"], F.lit(0.0))
    return x.select(*cols, F.coalesce(line, a["_v"], b["_v"]).alias(value))


def patients(records: DataFrame, documents: DataFrame, diseases: DataFrame) -> DataFrame:
    """One row per patient: `records(patient_uid, pmid, gender, age, patient, genes)`, `documents(pmid, title, approx_year, license)`,
    `diseases(term, id)`.

    Adds age in years and band, words of the summary, patients of the paper, diseases named in the title (lexical), and the flags:
    a disease in the title, or a gene symbol of four and more characters.
    """
    titles = tag(documents.where("title is not null").select(F.col("pmid").alias("key"), F.col("title").alias("text")), diseases)
    titles = titles.select(F.col("key").alias("pmid"), F.array_join("terms", "|").alias("title_mondo_labels"), F.array_join("ids", "|").alias("title_mondo"))
    n = records.groupBy("pmid").agg(F.count("*").alias("patients_in_article"))
    years = F.round(age_days(F.col("age")) / 365.25, 2)
    x = records.join(n, "pmid").join(documents, "pmid", "left").join(titles, "pmid", "left")
    symbols = F.filter(F.split(F.coalesce("genes", F.lit("")), " "), lambda g: F.length(g) >= 4)
    named = F.coalesce("title_mondo", F.lit("")) != ""
    words = F.when(F.trim(F.coalesce("patient", F.lit(""))) == "", 0).otherwise(F.size(F.split(F.trim("patient"), r"\s+")))
    return x.select(
        "patient_uid", "pmid", "approx_year", licence_group(F.col("license")).alias("licence_group"), "gender", years.alias("age_years"), age_band(years).alias("age_band"), words.cast("bigint").alias("n_words"), "patients_in_article",
        (named | (F.size(symbols) > 0)).alias("iem"), named.alias("iem_title"), F.array_join(F.array_distinct(symbols), "|").alias("iem_genes"), F.coalesce("title_mondo_labels", F.lit("")).alias("title_mondo_labels"), F.coalesce("title_mondo", F.lit("")).alias("title_mondo"), "title",
    )


def sheets(patients_: DataFrame) -> DataFrame:
    """The counts behind the overview's sheets in one pass: (sheet, value, n)."""
    parts = [("gender", F.coalesce("gender", F.lit("unknown"))), ("age_band", F.col("age_band")), ("licence_group", F.col("licence_group")), ("year", F.coalesce(F.round("approx_year").cast("int").cast("string"), F.lit("unknown"))), ("iem", F.when(F.col("iem"), "yes").otherwise("no")), ("iem_title", F.when(F.col("iem_title"), "yes").otherwise("no")), ("patients_in_article", F.col("patients_in_article").cast("string"))]
    x = patients_.select(F.explode(F.array(*[F.struct(F.lit(k).alias("sheet"), v.alias("value")) for k, v in parts])).alias("p"))
    return x.groupBy("p.sheet", "p.value").agg(F.count("*").alias("n"))
