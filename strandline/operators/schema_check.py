"""Closed schemas of records and manifests, checked as expressions: required parts, closed vocabularies, identifier shapes.

`(severity, path, msg)` as in `validation`; a null part is a missing one. Unknown keys are checked on the JSON text
(`validation.unknown_keys`), since a struct can't hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .validation import _each, _issue, _present

# What every element of a record's arrays must have.
REQUIRED = {
    "phenotypes": ("text", "excluded", "evidence"), "measurements": ("analyte_text", "specimen", "interpretation", "evidence"), "genetic_findings": ("gene_symbol", "evidence"),
    "diagnoses": ("disease_text", "status", "confidence_tier", "evidence"), "treatments": ("text", "type", "evidence"),
}
REQUIRED_TOP = ("local_id", "subject", "phenotypes", "measurements", "genetic_findings", "diagnoses", "narrative_anchors")
# Closed vocabularies of a record.
VOCABULARIES = {
    "measurements": {"specimen": ("plasma", "serum", "blood", "dried_blood_spot", "urine", "csf", "fibroblasts", "leukocytes", "liver", "muscle", "amniotic_fluid", "other", "unknown"), "comparator": ("<", "<=", ">", ">=", "~"), "interpretation": ("HIGH", "LOW", "NORMAL", "ABNORMAL", "UNKNOWN")},
    "genetic_findings": {
        "zygosity": ("HOMOZYGOUS", "HETEROZYGOUS", "COMPOUND_HETEROZYGOUS", "HEMIZYGOUS", "MOSAIC", "HOMOPLASMIC", "HETEROPLASMIC", "UNKNOWN"), "inheritance_as_stated": ("de_novo", "maternal", "paternal", "biparental", "unknown"),
        "classification_as_reported": ("pathogenic", "likely_pathogenic", "uncertain_significance", "likely_benign", "benign", "not_stated"),
    },
    "diagnoses": {"status": ("FINAL", "PROVISIONAL", "DIFFERENTIAL", "REVISED_FROM", "EXCLUDED"), "confidence_tier": ("MOLECULAR", "ENZYMATIC", "BIOCHEMICAL", "CLINICAL", "PROVISIONAL", "UNKNOWN"), "diagnostic_route": ("newborn_screening", "symptomatic", "family_screening", "prenatal", "postmortem", "incidental", "unknown")},
    "treatments": {"type": ("diet", "cofactor_vitamin", "drug", "enzyme_replacement", "substrate_reduction", "transplant", "dialysis_or_extracorporeal", "gene_therapy", "supportive", "other"), "response": ("improved", "stable", "worsened", "no_response", "not_stated")},
}
SUBJECT = {"sex": ("MALE", "FEMALE", "OTHER_SEX", "UNKNOWN_SEX"), "vital_status": ("ALIVE", "DECEASED", "UNKNOWN")}
# Vocabularies of a manifest.
DOCUMENT_TYPES = ("case_report", "case_series", "cohort_with_individual_data", "cohort_summary_only", "review_with_case", "review_of_published_cases", "family_study", "other")
CASE_TYPES = ("typical_presentation", "atypical_presentation", "novel_variant_or_genotype", "treatment_or_response", "diagnostic_odyssey_or_misdiagnosis", "complication_or_natural_history", "screening_detected", "other")


def _required(c: Column, path: Column) -> Column:
    return _issue(c.isNull(), "error", path, F.lit("is required"))


def _allowed(c: Column, values: tuple[str, ...], path: Column) -> Column:
    return _issue(c.isNotNull() & ~c.isin(*values), "error", path, F.concat(F.lit("not an allowed value: "), c))


def record_issues(r: Column) -> Column:
    """Schema issues of a record struct, in document order of its parts."""

    def group(name: str) -> Column:
        def rules(x: Column, i: Column) -> list[Column]:
            at = lambda f: F.concat(F.lit(f"{name}/"), i, F.lit(f"/{f}"))
            out = [_required(x[f], at(f)) for f in REQUIRED[name]] + [_allowed(x[f], v, at(f)) for f, v in VOCABULARIES.get(name, {}).items()]
            ev = x["evidence"]
            return out + [_issue(ev.isNotNull() & ev[f].isNull(), "error", at(f"evidence/{f}"), F.lit("is required")) for f in ("quote", "anchor")]

        return _each(r[name], rules)

    s = r["subject"]
    top = F.array(*[_required(r[f], F.lit(f)) for f in REQUIRED_TOP], _issue(s.isNotNull() & s["sex"].isNull(), "error", F.lit("subject/sex"), F.lit("is required")), *[_allowed(s[f], v, F.lit(f"subject/{f}")) for f, v in SUBJECT.items()])
    return F.concat(_present(top), *[group(name) for name in REQUIRED])


def manifest_issues(m: Column) -> Column:
    """Schema issues of a manifest struct (`ingest.MANIFEST`)."""
    top = F.array(*[_required(m[f], F.lit(f)) for f in ("in_scope", "document_type", "individuals", "reasons")], _allowed(m["document_type"], DOCUMENT_TYPES, F.lit("document_type")))

    def rules(x: Column, i: Column) -> list[Column]:
        at = lambda f: F.concat(F.lit("individuals/"), i, F.lit(f"/{f}"))
        return [_required(x["local_id"], at("local_id")), _required(x["where"], at("where")), _allowed(x["case_type"], CASE_TYPES, at("case_type"))]

    return F.concat(_present(top), _each(m["individuals"], rules))


def unknown_terms(items: Column, known: Column, field: str = "phenotypes") -> Column:
    """Identifiers that the ontology does not hold (unknown or obsolete); `known` is the array of those of this record that it holds."""
    bad = lambda x, i: F.when(x["hpo_id"].isNotNull() & (x["hpo_id"] != "") & ~F.array_contains(known, x["hpo_id"]), F.struct(F.lit("error").alias("severity"), F.concat(F.lit(f"{field}/"), i, F.lit("/hpo_id")).alias("path"), F.concat(F.lit("unknown or obsolete HPO id: "), x["hpo_id"]).alias("msg")))
    return F.coalesce(_present(F.transform(items, lambda x, i: bad(x, i.cast("string")))), F.array().cast("array<struct<severity:string,path:string,msg:string>>"))
