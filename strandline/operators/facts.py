"""Records flattened into reviewable facts and export tables; ids are `record_id#group:index`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import shortest
from ..functions.text import age_label, truthy
from .phenopacket import with_added

GROUPS = ("subject", "family", "phenotype", "measurement", "genetic_finding", "diagnosis", "treatment", "outcome")
_FACT = ["item", "detail", "grounded", "quote", "anchor", "verification"]


def evidence_status(ev: Column) -> Column:
    """in anchor, in document, NOT FOUND, unverified, or empty without evidence."""
    v = ev["verification"]
    return (
        F.when(ev.isNull(), "").when(v.isNull(), "unverified").when(F.coalesce(v["in_anchor"], F.lit(False)), "in anchor").when(F.coalesce(v["in_document"], F.lit(False)), "in document").otherwise("NOT FOUND")
    )


def _text(*parts: Column, sep: str = "; ") -> Column:
    return F.concat_ws(sep, *[truthy(p) for p in parts])


def _fact(item: Column, detail: Column, grounded: Column, ev: Column | None) -> Column:
    blank = F.lit("")
    quote, anchor, status = (blank, blank, blank) if ev is None else (F.coalesce(ev["quote"], blank), F.coalesce(ev["anchor"], blank), evidence_status(ev))
    return F.struct(F.coalesce(item, blank).alias("item"), F.coalesce(detail, blank).alias("detail"), F.coalesce(grounded, blank).alias("grounded"), quote.alias("quote"), anchor.alias("anchor"), status.alias("verification"))


def _list(group: str, items: Column, fact) -> Column:  # noqa: ANN001
    """Facts of an array's live elements, numbered by their place in it."""
    each = F.transform(items, lambda x, i: F.struct(F.lit(group).alias("grp"), i.cast("bigint").alias("i"), F.when(x.isNotNull(), fact(x)).alias("f")))
    return F.coalesce(F.filter(each, lambda e: e["f"].isNotNull()), F.array())


def _packed(group: str, facts: list[Column]) -> Column:
    """Optional facts of a group, numbered in order without gaps."""
    there = F.filter(F.array(*facts), lambda f: f.isNotNull())
    return F.transform(there, lambda f, i: F.struct(F.lit(group).alias("grp"), i.cast("bigint").alias("i"), f.alias("f")))


def _enzyme(x: Column) -> Column:
    number = F.when(x["value"].isNotNull(), F.trim(F.concat_ws(" ", shortest(x["value"]), truthy(x["unit"]))))
    percent = F.when(x["percent_of_control"].isNotNull(), F.concat(shortest(x["percent_of_control"]), F.lit("% of control")))
    detail = _text(number, percent, F.concat(F.lit("tissue "), truthy(x["tissue"])), x["interpretation"], x["reference_text"])
    return _fact(x["enzyme_text"], detail, _text(x["gene_symbol"], x["ec_number"], sep=" "), x["evidence"])


def facts(records: DataFrame) -> DataFrame:
    """One row per fact: `(fact_id, record_id, pmid, grp, i, item, detail, grounded, quote, anchor, verification)`. One scan, one
    explode of all groups together."""
    records = with_added(records)
    s, fam = F.col("record.subject"), F.col("record.family")
    plain = [("sex", s["sex"]), ("vital_status", s["vital_status"]), ("ancestry_as_stated", s["ancestry_as_stated"]), ("country_of_care", s["country_of_care"]), ("gestational_age_weeks", shortest(s["gestational_age_weeks"])), ("birth_weight_g", shortest(s["birth_weight_g"]))]
    subject = [F.when(truthy(v).isNotNull() & ~v.isin("UNKNOWN_SEX", "UNKNOWN"), _fact(F.lit(k), v, F.lit(""), None)) for k, v in plain]
    subject += [F.when(truthy(s[k]["iso8601"]).isNotNull() | truthy(s[k]["text"]).isNotNull(), _fact(F.lit(k), age_label(s[k]), F.lit(""), s[k]["evidence"])) for k in ("age_at_onset", "age_at_presentation", "age_at_last_followup", "age_at_death")]
    family = [
        F.when(fam["consanguinity"].isNotNull(), _fact(F.lit("consanguinity"), F.when(fam["consanguinity"], "yes").otherwise("no"), F.lit(""), None)),
        F.when(truthy(fam["family_history_text"]).isNotNull(), _fact(F.lit("family history"), fam["family_history_text"], F.lit(""), None)),
    ]
    pre = lambda label, c: F.concat(F.lit(label), truthy(c))

    def phenotype(x: Column) -> Column:
        item = F.concat(F.when(F.coalesce(x["excluded"], F.lit(False)), "ABSENT: ").otherwise(""), F.coalesce(x["text"], F.lit("")))
        return _fact(item, _text(pre("onset ", age_label(x["onset"])), x["severity"], x["modifier"]), _text(x["hpo_id"], x["hpo_label"], sep=" "), x["evidence"])

    def measurement(x: Column) -> Column:
        number = F.concat(F.coalesce(shortest(x["value"]), F.lit("")), F.coalesce(F.concat(F.lit(" "), truthy(x["unit"])), F.lit("")))
        signed = F.when(truthy(x["comparator"]).isNotNull() & x["value"].isNotNull(), F.concat(x["comparator"], number)).otherwise(number)
        rr = x["reference_range"]
        ref = F.when(rr.isNotNull(), F.concat(F.lit("ref "), F.coalesce(truthy(rr["text"]), F.concat_ws("–", shortest(rr["low"]), shortest(rr["high"])))))
        interp = F.when(x["interpretation"] != "UNKNOWN", x["interpretation"])
        specimen = F.when(x["specimen"] != "other", F.concat(F.lit("specimen "), truthy(x["specimen"])))
        return _fact(x["analyte_text"], _text(F.coalesce(truthy(x["value_text"]), signed), ref, interp, specimen, pre("timing ", x["timing"]), pre("age ", age_label(x["age"]))), _text(x["analyte"]["chebi"], x["analyte"]["label"], sep=" "), x["evidence"])

    def variant(x: Column) -> Column:
        item = F.coalesce(truthy(_text(x["gene_symbol"], x["variant_hgvs_c"], x["variant_hgvs_p"], sep=" ")), x["variant_text"])
        return _fact(item, _text(x["zygosity"], x["inheritance_as_stated"], x["classification_as_reported"], x["method"], pre("transcript ", x["transcript"]), F.when(x["novel"], "novel")), x["hgnc_id"], x["evidence"])

    def diagnosis(x: Column) -> Column:
        prior = F.when(F.size(x["prior_misdiagnoses"]) > 0, F.concat(F.lit("prior: "), F.array_join(x["prior_misdiagnoses"], "; ", "")))
        return _fact(x["disease_text"], _text(x["status"], x["confidence_tier"], x["diagnostic_route"], pre("age at dx ", age_label(x["age_at_diagnosis"])), prior), _text(x["disease"]["mondo"], x["disease"]["label"], sep=" "), x["evidence"])

    def treatment(x: Column) -> Column:
        return _fact(x["text"], _text(x["type"], x["agent"], pre("response: ", x["response"]), x["response_text"]), F.lit(""), x["evidence"])

    o = F.col("record.outcome")
    at = lambda field: F.col(f"record.{field}")
    parts = [
        _packed("subject", subject), _packed("family", family), _list("phenotype", at("phenotypes"), phenotype), _list("measurement", at("measurements"), measurement),
        _list("genetic_finding", at("genetic_findings"), variant), _list("diagnosis", at("diagnoses"), diagnosis), _list("treatment", at("treatments"), treatment),
        _packed("outcome", [F.when(truthy(o["text"]).isNotNull(), _fact(F.lit("outcome"), o["text"], F.lit(""), o["evidence"]))]),
    ]
    if "enzyme_activities" in records.schema["record"].dataType.names:
        parts.append(_list("enzyme_activity", at("enzyme_activities"), _enzyme))
    out = records.select("record_id", "pmid", F.explode(F.concat(*parts)).alias("e")).select("record_id", "pmid", "e.*")
    return out.select(F.concat("record_id", F.lit("#"), "grp", F.lit(":"), "i").alias("fact_id"), "record_id", "pmid", "grp", "i", *[F.col(f"f.{c}").alias(c) for c in _FACT])


MARKS = {"in anchor": "✓", "in document": "~", "NOT FOUND": "✗"}


def case_sheets(records: DataFrame) -> DataFrame:
    """(record_id, sheet): a readable sheet of every record, its facts by group with a mark for where each quote was found."""
    order = F.array_position(F.array(*map(F.lit, GROUPS)), F.col("grp"))
    mark = F.coalesce(*[F.when(F.col("verification") == k, F.lit(v)) for k, v in MARKS.items()], F.lit("·"))
    line = F.concat(F.lit("- "), mark, F.lit(" "), "item", F.when(F.col("detail") != "", F.concat(F.lit(" — "), "detail")).otherwise(F.lit("")), F.when(F.col("anchor") != "", F.concat(F.lit(" ["), "anchor", F.lit("]"))).otherwise(F.lit("")))
    f = facts(records).select("record_id", "grp", order.alias("o"), "i", line.alias("line"))
    groups = f.groupBy("record_id", "grp", "o").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), "\n").alias("body"))
    parts = F.array_sort(F.collect_list(F.struct("o", F.concat(F.lit("## "), "grp", F.lit("\n"), "body").alias("t"))))
    return groups.groupBy("record_id").agg(F.concat(F.lit("# "), F.first("record_id"), F.lit("\n\n"), F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n")).alias("sheet"))


def final_diagnosis(diagnoses: Column) -> Column:
    """The first diagnosis with status FINAL, or NULL."""
    return F.try_element_at(F.filter(diagnoses, lambda x: F.coalesce(x["status"] == "FINAL", F.lit(False))), F.lit(1))


def _n(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)).cast("bigint")


def _evidence_columns() -> list[Column]:
    ev = F.col("x.evidence")
    return [ev["quote"].alias("quote"), ev["anchor"].alias("anchor"), ev["verification"]["in_anchor"].alias("quote_in_anchor"), ev["verification"]["in_document"].alias("quote_in_document")]


ENZYMES = "enzyme_text string, gene_symbol string, ec_number string, tissue string, value double, unit string, percent_of_control double, reference_text string, interpretation string"


def export_tables(records: DataFrame, documents: DataFrame, links: DataFrame | None = None, narratives: DataFrame | None = None, verified: DataFrame | None = None) -> dict[str, DataFrame]:
    """The ten flat columnar tables of the export, each with its declared columns (empty ones too).

    `records` grounded or not (what grounding adds is null then), `narratives(record_id, source, passages
    array<struct<anchor,text,chars>>)` and `verified(record_id, total, in_anchor, in_document)`; without them their columns are null.
    """
    records = with_added(records)
    s, r = F.col("record.subject"), F.col("record")
    fd = final_diagnosis(r["diagnoses"])
    spark = records.sparkSession

    def at(field: str, *cols: str | Column) -> DataFrame:
        x = records.select("record_id", "pmid", F.explode(f"record.{field}").alias("x")).where("x is not null")
        return x.select("record_id", "pmid", *[F.col(f"x.{c}").alias(c.split(".")[-1]) if isinstance(c, str) else c for c in cols])

    status = F.col("x.grounding.status").alias("grounding")
    if narratives is None:
        narratives = spark.createDataFrame([], "record_id string, source string, passages array<struct<anchor:string,text:string,chars:int>>")
    if verified is None:
        verified = spark.createDataFrame([], "record_id string, total bigint, in_anchor bigint, in_document bigint")
    narratives = narratives.select("record_id", "source", "passages")
    told = narratives.select("record_id", F.aggregate("passages", F.lit(0).cast("bigint"), lambda n, u: n + F.coalesce(u["chars"], F.lit(0))).alias("narrative_chars"), _n(F.col("passages")).alias("narrative_units"), F.col("source").alias("narrative_source"))
    quotes = verified.select("record_id", *[F.col(c).alias(f"quotes_{c}") for c in ("total", "in_anchor", "in_document")])
    people = records.join(told, "record_id", "left").join(quotes, "record_id", "left")
    enzymes = [c.split()[0] for c in ENZYMES.split(", ")]
    if "enzyme_activities" in records.schema["record"].dataType.names:
        enzyme_table = at("enzyme_activities", *enzymes, F.col("x.evidence.quote").alias("quote"), F.col("x.evidence.anchor").alias("anchor"))
    else:
        enzyme_table = spark.createDataFrame([], f"record_id string, pmid string, {ENZYMES}, quote string, anchor string")
    tables = {
        "documents": documents.drop("abstract", "text"),
        "individuals": people.select(
            "record_id", "pmid", "local_id", "valid", "confidence", s["sex"].alias("sex"), *[s[a]["iso8601"].alias(a) for a in ("age_at_onset", "age_at_presentation", "age_at_last_followup")], s["vital_status"].alias("vital_status"), r["family"]["consanguinity"].alias("consanguinity"),
            s["ancestry_as_stated"].alias("ancestry"), s["country_of_care"].alias("country"), fd["disease_text"].alias("final_diagnosis"), fd["disease"]["mondo"].alias("final_diagnosis_mondo"), fd["disease"]["omim"].alias("final_diagnosis_omim"), fd["confidence_tier"].alias("confidence_tier"),
            _n(r["phenotypes"]).alias("n_phenotypes"), _n(r["measurements"]).alias("n_measurements"), _n(r["genetic_findings"]).alias("n_variants"), r["clinical_summary"].alias("clinical_summary"), "model", "prompt_version",
            F.coalesce("narrative_chars", F.lit(0)).alias("narrative_chars"), F.coalesce("narrative_units", F.lit(0)).alias("narrative_units"), "narrative_source", "quotes_total", "quotes_in_anchor", "quotes_in_document",
        ),
        "narratives": narratives.join(records.select("record_id", "pmid"), "record_id").select("record_id", "pmid", "source", F.posexplode("passages").alias("order", "u")).select("record_id", "pmid", F.col("order").cast("bigint").alias("order"), "u.anchor", "u.chars", "source", "u.text"),
        "phenotypes": at("phenotypes", "text", "hpo_id", "hpo_label", "excluded", F.col("x.onset.iso8601").alias("onset"), "modifier", status, *_evidence_columns()),
        "measurements": at(
            "measurements", "analyte_text", F.col("x.analyte.label").alias("analyte_label"), F.col("x.analyte.chebi").alias("chebi"), F.col("x.analyte.vmh").alias("vmh"), "specimen", "value", "value_text", "unit", "unit_ucum", F.col("x.reference_range.low").alias("ref_low"), F.col("x.reference_range.high").alias("ref_high"),
            F.col("x.reference_range.text").alias("ref_text"), "interpretation", "timing", "condition", F.col("x.age.iso8601").alias("age"), "panel", "method", status, *_evidence_columns(),
        ),
        "enzyme_activities": enzyme_table,
        "genetic_findings": at("genetic_findings", "gene_symbol", "hgnc_id", "variant_hgvs_c", "variant_hgvs_p", "variant_hgvs_g", "transcript", "variant_text", "zygosity", "inheritance_as_stated", "classification_as_reported", "method", "novel", status, *_evidence_columns()),
        "diagnoses": at(
            "diagnoses", "disease_text", *[F.col(f"x.disease.{c}").alias(c) for c in ("label", "mondo", "omim", "orphanet")], "status", "confidence_tier", "diagnostic_route", F.col("x.age_at_diagnosis.iso8601").alias("age_at_diagnosis"), "time_to_diagnosis_text",
            F.coalesce(F.array_join("x.prior_misdiagnoses", "|", ""), F.lit("")).alias("prior_misdiagnoses"), status, *_evidence_columns(),
        ),
        "treatments": at("treatments", "text", "type", "agent", "response", "response_text", F.col("x.evidence.quote").alias("quote"), F.col("x.evidence.anchor").alias("anchor")),
        "links": links if links is not None else spark.createDataFrame([], "record_a string, record_b string, relation string, evidence string, score double"),
    }
    return tables


def escaped_json(c: Column) -> Column:
    """JSON text in ASCII: other characters as \\uXXXX, those beyond the basic plane as two."""
    j = F.to_json(c)

    def one(x: Column) -> Column:
        utf16 = F.hex(F.encode(x, "UTF-16BE"))
        pair = F.concat(F.lit("\\u"), F.lower(F.substring(utf16, 1, 4)), F.when(F.length(utf16) > 4, F.concat(F.lit("\\u"), F.lower(F.substring(utf16, 5, 4)))).otherwise(F.lit("")))
        return F.when(F.length(F.encode(x, "UTF-8")) > 1, pair).otherwise(x)

    return F.when(j.rlike(r"[^\x00-\x7f]"), F.array_join(F.transform(F.split(j, ""), one), "")).otherwise(j)


def export_all(records: DataFrame, documents: DataFrame, path: str, links: DataFrame | None = None, fmt: str = "both", **kw: DataFrame) -> dict[str, int]:
    """Write every table as Parquet and/or CSV (arrays as JSON text in CSV); returns the rows of each."""
    counts = {}
    for name, df in export_tables(records, documents, links, **kw).items():
        if fmt in ("parquet", "both"):
            df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
        if fmt in ("csv", "both"):
            flat = df.select(*[escaped_json(F.col(c)).alias(c) if k.startswith(("array", "struct", "map")) else F.col(c) for c, k in df.dtypes])
            flat.write.mode("overwrite").option("header", True).csv(f"{path}/{name}.csv")
        counts[name] = df.sparkSession.read.parquet(f"{path}/{name}.parquet").count() if fmt != "csv" else df.count()
    return counts
