"""Record validation as arrays of issues `(severity, path, msg)`, and the confidence derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import ISO_DURATION, age_days, round_binary
from ..functions.text import truthy

# The accepted shapes of coding and protein variants and of phenotype identifiers.
HGVS_C = r"^c\.[\d_+\-*]+[ACGTacgt]*(>|del|dup|ins|inv|delins)?[ACGTacgt]*$|^c\.[\d_+\-*]+(del|dup|ins|inv|delins)[ACGTacgt]*\d*$"
HGVS_P = r"^p\.\(?[A-Z][a-z]{2}\d+(?:[A-Z][a-z]{2}|\*|=|Ter|fs.*|del.*|dup.*|ins.*)?\)?$|^p\.\(?[A-Z]\d+[A-Z*=]\)?$"
HPO_ID = r"^HP:\d{7}$"
OLDEST_DAYS = 120 * 365.25
AGES = ("age_at_onset", "age_at_presentation", "age_at_last_followup", "age_at_death")
WARN_COST = 0.03
#: Closed vocabularies of the record's fields (checked by `enum_issues`).
ENUMS = {
    "subject.sex": ("MALE", "FEMALE", "OTHER_SEX", "UNKNOWN_SEX"),
    "subject.vital_status": ("ALIVE", "DECEASED", "UNKNOWN_STATUS", "UNKNOWN"),
}


def _issue(cond: Column, severity: str, path: Column, msg: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(severity).alias("severity"), path.alias("path"), msg.alias("msg")))


def _present(issues: Column) -> Column:
    return F.filter(issues, lambda x: x.isNotNull())


def _each(array: Column, rules) -> Column:
    """Issues of every element; `rules(x, i)` gives a list of columns; null elements and arrays give none."""
    per = F.transform(array, lambda x, i: F.when(x.isNotNull(), F.array(*rules(x, i.cast("string")))))
    return F.coalesce(_present(F.flatten(F.filter(per, lambda a: a.isNotNull()))), F.array().cast("array<struct<severity:string,path:string,msg:string>>"))


def _no_quote(x: Column, path: Column) -> Column:
    return _issue(truthy(x["evidence"]["quote"]).isNull(), "warn", path, F.lit("no evidence quote"))


def issues(r: str = "record", has_enzymes: bool = False) -> Column:
    """All issues of a record struct, in rule order."""
    s = F.col(f"{r}.subject")
    at = lambda name, i, field: F.concat(F.lit(f"{name}/"), i, F.lit(f"/{field}"))
    days = {a: age_days(s[a]["iso8601"]) for a in AGES}
    subject = F.array(
        *[_issue((truthy(s[a]["iso8601"]).isNotNull()) & ~s[a]["iso8601"].rlike(ISO_DURATION), "error", F.lit(f"subject/{a}/iso8601"), F.lit("not an ISO 8601 duration")) for a in AGES],
        _issue(days["age_at_onset"] > days["age_at_presentation"] + 1, "warn", F.lit("subject/age_at_onset"), F.lit("onset after presentation")),
        _issue(days["age_at_death"] < days["age_at_last_followup"] - 1, "warn", F.lit("subject/age_at_death"), F.lit("death before last follow-up")),
        _issue((s["vital_status"] == "DECEASED") & s["age_at_death"].isNull(), "info", F.lit("subject/age_at_death"), F.lit("deceased without age at death")),
        _issue(F.greatest(*days.values()) > OLDEST_DAYS, "error", F.lit("subject"), F.lit("age > 120 years")),
    )
    phenotypes = _each(F.col(f"{r}.phenotypes"), lambda x, i: [
        _issue((truthy(x["hpo_id"]).isNotNull()) & ~x["hpo_id"].rlike(HPO_ID), "error", at("phenotypes", i, "hpo_id"), F.lit("malformed HPO id")),
        _no_quote(x, at("phenotypes", i, "evidence")),
    ])

    def measured(x: Column, i: Column) -> list[Column]:
        v, low, high, said = x["value"], x["reference_range"]["low"], x["reference_range"]["high"], x["interpretation"]
        expected = F.when(v > high, "HIGH").when(v < low, "LOW").otherwise("NORMAL")
        ranged = v.isNotNull() & low.isNotNull() & high.isNotNull() & said.isin("HIGH", "LOW", "NORMAL")
        return [
            _issue(v.isNotNull() & truthy(x["unit"]).isNull() & ~said.eqNullSafe(F.lit("UNKNOWN")), "warn", at("measurements", i, "unit"), F.lit("numeric value without unit")),
            _issue(ranged & (said != expected), "warn", at("measurements", i, "interpretation"), F.concat(F.lit("interpretation "), said, F.lit(" disagrees with reference range ("), expected, F.lit(")"))),
            _issue((v < 0) & (F.coalesce(x["unit_ucum"], F.lit("")) != "mm[Hg]"), "warn", at("measurements", i, "value"), F.lit("negative value")),
            _no_quote(x, at("measurements", i, "evidence")),
        ]

    def variant(x: Column, i: Column) -> list[Column]:
        c, p = truthy(x["variant_hgvs_c"]), truthy(x["variant_hgvs_p"])
        return [
            _issue(c.isNotNull() & ~F.trim(c).rlike(HGVS_C), "warn", at("genetic_findings", i, "variant_hgvs_c"), F.concat(F.lit("HGVS c. not recognised: "), c)),
            _issue(p.isNotNull() & ~F.trim(p).rlike(HGVS_P), "warn", at("genetic_findings", i, "variant_hgvs_p"), F.concat(F.lit("HGVS p. not recognised: "), p)),
            _issue((x["zygosity"] == "HEMIZYGOUS") & (s["sex"] == "FEMALE"), "warn", at("genetic_findings", i, "zygosity"), F.lit("hemizygous in a female")),
            _issue(x["grounding"]["status"] == "unresolved", "warn", at("genetic_findings", i, "gene_symbol"), F.concat(F.lit("gene symbol not recognised: "), F.coalesce(x["gene_symbol"], F.lit("None")))),
        ]

    dx = F.col(f"{r}.diagnoses")
    finals = F.coalesce(F.exists(dx, lambda x: F.coalesce(x["status"] == "FINAL", F.lit(False))), F.lit(False))
    no_variants = F.coalesce(F.size(F.col(f"{r}.genetic_findings")), F.lit(0)) <= 0
    no_enzymes = F.coalesce(F.size(F.col(f"{r}.enzyme_activities")), F.lit(0)) <= 0 if has_enzymes else F.lit(True)
    tiers = _each(dx, lambda x, i: [
        _issue((x["confidence_tier"] == "MOLECULAR") & no_variants, "warn", at("diagnoses", i, "confidence_tier"), F.lit("MOLECULAR tier without genetic findings")),
        _issue((x["confidence_tier"] == "ENZYMATIC") & no_enzymes, "warn", at("diagnoses", i, "confidence_tier"), F.lit("ENZYMATIC tier without enzyme activities")),
    ])
    return F.concat(_present(subject), phenotypes, _each(F.col(f"{r}.measurements"), measured), _each(F.col(f"{r}.genetic_findings"), variant), _present(F.array(_issue(~finals, "warn", F.lit("diagnoses"), F.lit("no FINAL diagnosis")))), tiers)


def confidence(found: Column, r: str = "record") -> Column:
    """Grounded share of phenotypes, measurements, variants and diagnoses less a cost per warning, at least 0, 3 digits."""
    groups = [F.filter(F.coalesce(F.col(f"{r}.{g}"), F.array()), lambda x: x.isNotNull()) for g in ("phenotypes", "measurements", "genetic_findings", "diagnoses")]
    n = sum(F.size(g) for g in groups)
    grounded = sum(F.size(F.filter(g, lambda x: F.coalesce(x["grounding"]["status"] == "grounded", F.lit(False)))) for g in groups)
    warns = F.size(F.filter(found, lambda x: x["severity"] == "warn"))
    return F.when(n > 0, round_binary(F.greatest(F.lit(0.0), grounded / n - WARN_COST * warns), 3)).otherwise(0.0)


def valid(found: Column) -> Column:
    return ~F.exists(found, lambda x: x["severity"] == "error")


def enum_issues(records: DataFrame, r: str = "record") -> DataFrame:
    """(record_id, path, value) where a closed vocabulary does not know the value."""
    parts = [records.select("record_id", F.lit(p).alias("path"), F.col(f"{r}.{p}").alias("value")).where(F.col("value").isNotNull() & ~F.col("value").isin(*values)) for p, values in ENUMS.items()]
    return parts[0].unionByName(parts[1])


def unknown_keys(json_text: Column, declared: list[str]) -> Column:
    """Keys of a JSON object that its schema doesn't declare (private ones beginning with `_` are left out)."""
    keys = F.coalesce(F.json_object_keys(json_text), F.array().cast("array<string>"))
    return F.filter(F.array_except(keys, F.array(*map(F.lit, declared))), lambda k: ~F.startswith(k, F.lit("_")))
