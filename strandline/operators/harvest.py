"""Harvest layers over metadata tables: what a remote search would answer, as filters, unions and anti-joins.

A seed is the union of per-disease matches (many-to-many tags); the lag layer is what newer terms match within a date window
and the seed does not; the recall layer is what is matched and not in the catalogue yet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import truthy
from .scope import tag

LAG_LENGTH, RECALL_LENGTH, GENE_LENGTH = 8, 10, 3
SYNTAX = r'[()\[\]":*?]'


def lag_term(c: Column) -> Column:
    """Fit for a fielded search: eight characters and more, none of the query syntax."""
    return (F.length(c) >= LAG_LENGTH) & ~c.rlike(SYNTAX)


def recall_term(c: Column) -> Column:
    """Fit for a full-text search: ten characters and more, at least two words."""
    return (F.length(c) >= RECALL_LENGTH) & F.contains(c, F.lit(" "))


def gene_term(c: Column) -> Column:
    return F.length(c) >= GENE_LENGTH


def tag_text(title: Column, abstract: Column, keywords: Column, mesh: Column | None = None) -> Column:
    """What a document is tagged by: title, abstract, keywords and headings, one per line; missing parts leave no line."""
    parts = [truthy(title), truthy(abstract), *[truthy(F.array_join(c, "\n")) for c in (keywords, mesh) if c is not None]]
    return F.concat_ws("\n", *parts)


def entry_window(edat: Column, low: str = "1900", high: str = "3000") -> Column:
    """Entered between two dates (given as years, months or days), both included."""
    return (edat >= low) & (edat <= F.lit(high + "~"))


def years_back(today: Column, n: int) -> Column:
    """The first day of the window that reaches `n` years back, as text."""
    return F.concat((F.year(today) - n).cast("string"), F.lit("/01/01"))


def seed(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """`texts(key, text)` matched by `terms(term, id)` → distinct `(key, id)`."""
    t = tag(texts, terms)
    return t.select("key", F.explode("ids").alias("id")).distinct()


def count(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(id, n): how many documents each query hits."""
    return seed(texts, terms).groupBy("id").agg(F.count("*").alias("n"))


def union(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Results of several searches as one table of distinct tags."""
    return reduce(DataFrame.unionByName, parts).select(*keys).distinct()


def lag(matched: DataFrame, seeded: DataFrame, window: Column) -> DataFrame:
    """Matches within the window that the seed did not find."""
    return matched.where(window).join(seeded.select("pmid"), "pmid", "left_anti")


def not_in_catalogue(candidates: DataFrame, catalogue: DataFrame) -> DataFrame:
    return candidates.join(catalogue.select("pmid"), "pmid", "left_anti")


def not_enriched(documents: DataFrame) -> DataFrame:
    return documents.where("in_epmc is null")


def first_few(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """A harvest that stops after `n` rows (`TakeOrderedAndProject`: no full sort)."""
    return rows.orderBy(*order).limit(n)


def of_prefix(sets: DataFrame, prefix: str) -> DataFrame:
    """Sets whose name begins with a prefix, in any case of ASCII letters."""
    return sets.where(F.startswith(F.lower("set_name"), F.lit(prefix.lower())))


def sorted_terms(terms: DataFrame) -> DataFrame:
    """Distinct terms with their place in the order that ignores case (ties by code point).

    Ranks come from counts per first letters, so no single task sorts all terms.
    """
    from pyspark.sql import Window

    x = terms.select("term").distinct().withColumns({"low": F.lower("term"), "p": F.substring(F.lower("term"), 1, 2)})
    before = x.groupBy("p").agg(F.count("*").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = x.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy("low", "term")))
    return ranked.join(before, "p").select("term", (F.col("r") + F.col("before")).cast("bigint").alias("place"))


def scope_build(subtree: DataFrame, nodes: DataFrame, genes: DataFrame) -> DataFrame:
    """Diseases of a scope with their genes: `subtree(id)`, `nodes(id, label, exact, omim, orphanet, definition)` and `genes(disease_id,
    genes)` by cross-reference → one row per disease, genes as a sorted distinct list."""
    x = nodes.join(subtree.select("id"), "id", "left_semi")
    refs = x.select("id", F.explode(F.concat("omim", F.transform("orphanet", lambda o: F.regexp_replace(o, "^Orphanet:", "ORPHA:")))).alias("disease_id"))
    found = refs.join(genes, "disease_id").select("id", F.explode("genes").alias("g")).groupBy("id").agg(F.array_sort(F.collect_set("g")).alias("genes"))
    return x.join(found, "id", "left").withColumn("genes", F.coalesce("genes", F.array().cast("array<string>")))


def write_scope(scope: DataFrame, path: str) -> None:
    """The scope as JSON, as tab-separated table, and its terms and genes as text, in the order that ignores case."""
    scope.write.mode("overwrite").json(f"{path}/scope.json")
    scope.select("id", "label", F.array_join("genes", "|").alias("genes")).write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{path}/scope.tsv")
    terms = scope.select(F.explode(F.concat(F.array("label"), F.coalesce("exact", F.array().cast("array<string>")))).alias("term")).where("term is not null").distinct()
    terms.orderBy(F.lower("term"), "term").write.mode("overwrite").text(f"{path}/terms.txt")
    scope.select(F.explode("genes").alias("gene")).distinct().orderBy("gene").write.mode("overwrite").text(f"{path}/genes.txt")


def release_date(version_iri: Column) -> Column:
    """The date within an ontology's version IRI."""
    return truthy(F.regexp_extract(version_iri, r"(\d{4}-\d{2}-\d{2})", 1))
