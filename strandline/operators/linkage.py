"""Blocked, scored self-join: records of different papers that share a variant key and may be one individual."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import birth_year, round_binary
from ..functions.text import variant_key

SHARED, SAME_SEX, OTHER_SEX, SAME_YEAR, OTHER_YEAR, SHARED_AUTHOR = 0.5, 0.1, -0.5, 0.2, -0.3, 0.15


def features(records: DataFrame, papers: DataFrame) -> DataFrame:
    """(record_id, pmid, sex, birth_year, authors, keys) of valid records; keys are the distinct variant keys."""
    g = F.filter("record.genetic_findings", lambda x: x.isNotNull())
    keys = F.array_distinct(F.flatten(F.transform(g, lambda x: F.filter(F.array(*[variant_key(x["gene_symbol"], x[n]) for n in ("variant_hgvs_c", "variant_hgvs_p", "variant_text")]), lambda k: k.isNotNull()))))
    r = records.where("valid = 1").join(papers.select("pmid", "pub_year", "authors"), "pmid", "left")
    s = "record.subject"
    return r.select("record_id", "pmid", F.col(f"{s}.sex").alias("sex"), birth_year(F.col("pub_year"), *[F.col(f"{s}.{a}.iso8601") for a in ("age_at_last_followup", "age_at_presentation", "age_at_onset")]).alias("birth_year"), "authors", keys.alias("keys"))


def link(feats: DataFrame, min_score: float = 0.6) -> DataFrame:
    """`(record_a, record_b, shared_key, n_authors, score, evidence)` of pairs that reach the score.

    The join is on the key only with what the score needs; the smallest shared key is cited, record a is the smaller id.
    """
    k = feats.select(F.explode("keys").alias("key"), "record_id", "pmid")
    b = k.select("key", F.col("record_id").alias("record_b"), F.col("pmid").alias("pmid_b"))
    pairs = k.select("key", F.col("record_id").alias("record_a"), F.col("pmid").alias("pmid_a")).join(b, "key").where("record_a < record_b and not (pmid_a <=> pmid_b)")
    pairs = pairs.groupBy("record_a", "record_b").agg(F.min("key").alias("shared_key"))
    side = lambda s: feats.select(F.col("record_id").alias(f"record_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("sex", "birth_year", "authors")])
    x = pairs.join(side("a"), "record_a").join(side("b"), "record_b")
    known = lambda c: c.isNotNull() & ~c.isin("", "UNKNOWN_SEX")
    both_sex = known(F.col("sex_a")) & known(F.col("sex_b"))
    ya, yb = F.nullif("birth_year_a", F.lit(0)), F.nullif("birth_year_b", F.lit(0))
    near = F.abs(ya - yb) <= 2
    empty = F.array().cast("array<string>")
    shared = F.size(F.array_intersect(F.coalesce("authors_a", empty), F.coalesce("authors_b", empty)))
    score = (
        F.lit(SHARED)
        + F.when(both_sex, F.when(F.col("sex_a") == F.col("sex_b"), SAME_SEX).otherwise(OTHER_SEX)).otherwise(0.0)
        + F.when(near, SAME_YEAR).when(~near, OTHER_YEAR).otherwise(0.0)
        + F.when(shared > 0, SHARED_AUTHOR).otherwise(0.0)
    )
    evidence = F.concat_ws(
        "; ", F.concat(F.lit("shared variant "), "shared_key"),
        F.when(both_sex, F.when(F.col("sex_a") == F.col("sex_b"), "same sex").otherwise("different sex")),
        F.when(near, F.concat(F.lit("birth year ~"), "birth_year_a")).when(~near, F.concat(F.lit("birth years "), "birth_year_a", F.lit(" vs "), "birth_year_b")),
        F.when(shared > 0, F.concat(shared.cast("string"), F.lit(" shared authors"))),
    )
    x = x.select("record_a", "record_b", "shared_key", shared.cast("bigint").alias("n_authors"), round_binary(score, 2).alias("score"), evidence.alias("evidence"))
    return x.where(F.col("score") >= min_score)
