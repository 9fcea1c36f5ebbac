"""Work items for an extractor, their prompts as versioned data, and the check of what comes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Prompts are data: name -> (version, template); `{...}` is filled per document.
PROMPTS = {
    "triage": ("1", "Decide whether the document below describes individual patients within the scope, and list them.\nTitle: {title}\nSource: {tier}\n\n{text}"),
    "extract": ("1", "Extract one record for the individual named by the caller. Quote the document verbatim and give the anchor of every quote.\nTitle: {title}\nSource: {tier}\n\n{text}"),
    "claims": ("1", "List every biochemical claim of the document with its quote and anchor.\n\n{text}"),
}


def prompt(name: str, **fields: Column) -> Column:
    """A prompt with its fields filled in (missing ones are empty); braces in the fields stay as they are."""
    out, rest = [], PROMPTS[name][1]
    while "{" in rest:
        head, _, rest = rest.partition("{")
        field, _, rest = rest.partition("}")
        out += [F.lit(head), F.coalesce(fields[field], F.lit("")) if field in fields else F.lit("")]
    return F.concat(*out, F.lit(rest))


def items(documents: DataFrame) -> DataFrame:
    """`documents(pmid, title, fulltext_tier, text)` → `(pmid, input, triage_prompt, extract_prompt, meta)`; `meta` is JSON."""
    fields = {"title": F.col("title"), "tier": F.col("fulltext_tier"), "text": F.col("text")}
    meta = F.to_json(F.struct("pmid", F.col("fulltext_tier").alias("tier"), F.length("text").alias("chars"), F.lit(PROMPTS["extract"][0]).alias("prompt_version")))
    return documents.select("pmid", F.col("text").alias("input"), prompt("triage", **fields).alias("triage_prompt"), prompt("extract", **fields).alias("extract_prompt"), meta.alias("meta"))


def claim_items(documents: DataFrame) -> DataFrame:
    return documents.select("pmid", F.col("text").alias("input"), prompt("claims", text=F.col("text")).alias("claims_prompt"))


def write_items(items_: DataFrame, path: str) -> None:
    """One JSON object per item, partitioned by paper."""
    items_.write.mode("overwrite").partitionBy("pmid").json(path)


def check(verified: DataFrame, anchors: DataFrame, units: DataFrame) -> DataFrame:
    """(record_id, quotes, missing, unresolved): `verified(record_id, in_document)`, narrative `anchors(record_id, pmid, anchor)` and
    the papers' units; an anchor is resolved by a unit of its own or by units below it. A run fails where any count is above 0."""
    q = verified.groupBy("record_id").agg(F.count("*").alias("quotes"), F.count_if(~F.col("in_document")).alias("missing"))
    there = units.where("unit <> ''").select("pmid", F.explode(F.array_distinct(F.array("anchor", F.split("anchor", " ")[0]))).alias("anchor")).distinct()
    lost = anchors.join(there, ["pmid", "anchor"], "left_anti").groupBy("record_id").agg(F.count("*").alias("unresolved"))
    x = q.join(lost, "record_id", "full_outer")
    return x.select("record_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("quotes", "missing", "unresolved")])


def failed(checked: DataFrame) -> bool:
    return not checked.where("missing > 0 or unresolved > 0").isEmpty()

