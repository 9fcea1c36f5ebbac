"""Extraction as a table contract: any callable that turns rendered texts into JSON is an extractor; errors stay in a column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .anchors import verify_quotes

Extractor = Callable[[str, str], str]


def extract(items: DataFrame, extractor: Extractor) -> DataFrame:
    """`items(pmid, local_id, text)` → `(pmid, local_id, payload, error)`; one failing item does not stop the others."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for pmid, local_id, text in zip(pdf["pmid"], pdf["local_id"], pdf["text"], strict=True):
                try:
                    out.append((pmid, local_id, extractor(text, local_id), None))
                except Exception as e:  # noqa: BLE001 - an extractor may raise anything
                    out.append((pmid, local_id, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(out, columns=["pmid", "local_id", "payload", "error"])

    return items.select("pmid", "local_id", "text").mapInPandas(run, "pmid string, local_id string, payload string, error string")


def pending(items: DataFrame, done: DataFrame) -> DataFrame:
    """Items without a result yet."""
    return items.join(done.where("error is null").select("pmid", "local_id"), ["pmid", "local_id"], "left_anti")


CLAIMS = "claims array<struct<claim_type:string,as_stated:string,enzyme:struct<gene_symbol:string>,quantities:array<struct<kind:string,value:double,value_text:string,evidence:struct<quote:string,anchor:string>>>,evidence:struct<quote:string,anchor:string>>>"


def claims(texts: DataFrame) -> DataFrame:
    """`texts(pmid, payload)` → one row per claim `(pmid, idx, claim_type, gene_symbol, quote, anchor, n_quantities)`."""
    c = texts.select("pmid", F.posexplode(F.from_json("payload", CLAIMS)["claims"]).alias("idx", "c")).where("c is not null")
    return c.select("pmid", F.col("idx").cast("bigint").alias("idx"), "c.claim_type", F.col("c.enzyme.gene_symbol").alias("gene_symbol"), F.col("c.evidence.quote").alias("quote"), F.col("c.evidence.anchor").alias("anchor"), F.coalesce(F.size("c.quantities"), F.lit(0)).cast("bigint").alias("n_quantities"))


def claim_summary(c: DataFrame) -> DataFrame:
    """Counts and distinct genes per claim type."""
    return c.groupBy("claim_type").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("gene_symbol")).alias("genes"))


def claim_issues(c: DataFrame, documents: DataFrame) -> DataFrame:
    """Claims whose quote is missing or occurs nowhere in the document."""
    v = verify_quotes(c.select("pmid", "anchor", "quote"), documents)
    j = c.join(v.select("pmid", "anchor", "quote", "in_document"), ["pmid", "anchor", "quote"], "left")
    return j.select("pmid", "idx", F.when(F.coalesce("quote", F.lit("")) == "", "no evidence quote").when(~F.coalesce("in_document", F.lit(False)), "quote not found").alias("issue")).where("issue is not null")


# Closed vocabularies of claims.
CLAIM_TYPES = ("enzyme_activity", "transport", "localization", "presence", "absence", "directionality", "regulation", "physiology", "disease_mechanism")
QUANTITY_KINDS = ("Km", "kcat", "Vmax", "Ki", "IC50", "specific_activity", "flux", "uptake_rate", "secretion_rate", "growth_rate", "yield", "concentration", "pH_optimum", "temperature", "other")
_EV = "struct<quote:string,anchor:string>"
CHECKED = f"claims array<struct<claim_type:string,as_stated:string,organism:string,evidence_type:string,evidence:{_EV},quantities:array<struct<kind:string,value:double,evidence:{_EV}>>>>"


def check_claims(texts: DataFrame, documents: DataFrame) -> DataFrame:
    """`texts(pmid, payload)` → (pmid, path, issue): what the schema asks of claims and their quantities, and quotes of either that
    occur nowhere in the document. One explode of all evidences, one join with the documents."""
    c = texts.select("pmid", F.posexplode(F.from_json("payload", CHECKED)["claims"]).alias("i", "c")).where("c is not null").withColumn("p", F.concat(F.lit("claims/"), "i"))
    req = [F.when(F.col(f"c.{f}").isNull(), F.concat("p", F.lit(f"/{f}: is required"))) for f in ("claim_type", "organism", "evidence_type", "evidence", "as_stated")]
    bad = [F.when(~F.col("c.claim_type").isin(*CLAIM_TYPES), F.concat("p", F.lit("/claim_type: not an allowed value")))]
    per = F.transform(F.coalesce("c.quantities", F.array()), lambda q, j: F.when(~q["kind"].isin(*QUANTITY_KINDS), F.concat(F.col("p"), F.lit("/quantities/"), j, F.lit("/kind: not an allowed value"))))
    schema = c.select("pmid", F.explode(F.filter(F.concat(F.array(*req, *bad), per), lambda x: x.isNotNull())).alias("x"))
    schema = schema.select("pmid", F.split("x", ": ")[0].alias("path"), F.split("x", ": ")[1].alias("issue"))
    one = lambda path, ev: F.struct(path.alias("path"), ev["anchor"].alias("anchor"), ev["quote"].alias("quote"))
    evs = F.concat(F.array(one(F.concat("p", F.lit("/evidence")), F.col("c.evidence"))), F.transform(F.coalesce("c.quantities", F.array()), lambda q, j: one(F.concat(F.col("p"), F.lit("/quantities/"), j, F.lit("/evidence")), q["evidence"])))
    e = c.select("pmid", F.explode(evs).alias("e")).select("pmid", "e.*").where("quote is not null")
    v = verify_quotes(e.select("pmid", "anchor", "quote"), documents).select(F.col("pmid").alias("_p"), F.col("anchor").alias("_a"), F.col("quote").alias("_q"), "in_document")
    same = F.col("pmid").eqNullSafe(F.col("_p")) & F.col("anchor").eqNullSafe(F.col("_a")) & F.col("quote").eqNullSafe(F.col("_q"))
    quotes = e.join(v, same, "left").where(~F.coalesce("in_document", F.lit(False))).select("pmid", "path", F.lit("quote not found").alias("issue"))
    return schema.unionByName(quotes)
