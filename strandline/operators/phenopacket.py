"""Records as phenopackets (JSON text), built as one nested expression.

Identifiers that grounding adds (`measurements.analyte`, `diagnoses.disease`) are optional fields of the record: where its
schema lacks them they count as null. `prefix` names the vocabulary of identifiers made up here. The creation time is a column
of the caller's, so that results stay reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import lookup, truthy

# Zygosity terms and pathogenicity classes.
ZYGOSITY_ID = {"HOMOZYGOUS": "GENO:0000136", "HETEROZYGOUS": "GENO:0000135", "COMPOUND_HETEROZYGOUS": "GENO:0000402", "HEMIZYGOUS": "GENO:0000134", "MOSAIC": "GENO:0000135", "HOMOPLASMIC": "GENO:0000602", "HETEROPLASMIC": "GENO:0000603"}
ZYGOSITY_LABEL = {"HOMOZYGOUS": "homozygous", "HETEROZYGOUS": "heterozygous", "COMPOUND_HETEROZYGOUS": "compound heterozygous", "HEMIZYGOUS": "hemizygous", "MOSAIC": "heterozygous", "HOMOPLASMIC": "homoplasmic", "HETEROPLASMIC": "heteroplasmic"}
ACMG = {"pathogenic": "PATHOGENIC", "likely_pathogenic": "LIKELY_PATHOGENIC", "uncertain_significance": "UNCERTAIN_SIGNIFICANCE", "likely_benign": "LIKELY_BENIGN", "benign": "BENIGN"}


PREFIX = "strandline"
ECO_STATEMENT = ("ECO:0000033", "author statement supported by traceable reference")
# The vocabularies that identifiers come from.
RESOURCES = (
    ("hp", "human phenotype ontology", "http://purl.obolibrary.org/obo/hp.owl", "HP", "http://purl.obolibrary.org/obo/HP_"),
    ("mondo", "Mondo Disease Ontology", "http://purl.obolibrary.org/obo/mondo.owl", "MONDO", "http://purl.obolibrary.org/obo/MONDO_"),
    ("omim", "Online Mendelian Inheritance in Man", "https://www.omim.org", "OMIM", "https://omim.org/entry/"),
    ("geno", "Genotype Ontology", "http://purl.obolibrary.org/obo/geno.owl", "GENO", "http://purl.obolibrary.org/obo/GENO_"),
    ("chebi", "Chemical Entities of Biological Interest", "http://purl.obolibrary.org/obo/chebi.owl", "CHEBI", "http://purl.obolibrary.org/obo/CHEBI_"),
    ("hgnc", "HUGO Gene Nomenclature Committee", "https://www.genenames.org", "HGNC", "https://www.genenames.org/data/gene-symbol-report/#!/hgnc_id/"),
)
# What grounding may add to a record's elements.
ADDED = {"measurements": ("analyte", "struct<label:string,chebi:string,vmh:string>"), "diagnoses": ("disease", "struct<label:string,mondo:string,omim:string,orphanet:string>")}


def _adder(field: str, value: Column):  # noqa: ANN202
    return lambda x: F.when(x.isNotNull(), x.withField(field, value))


def with_added(records: DataFrame, col: str = "record") -> DataFrame:
    """The records with null structs where grounding has not added its fields."""
    kind = records.schema[col].dataType
    for name, (field, added) in ADDED.items():
        if field not in kind[name].dataType.elementType.names:
            none = F.lit(None).cast(added)
            filled = F.transform(F.col(f"{col}.{name}"), _adder(field, none))
            records = records.withColumn(col, F.col(col).withField(name, filled))
    return records


def _named(**fields: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _age(a: Column) -> Column:
    return F.when(truthy(a["iso8601"]).isNotNull(), _named(age=_named(iso8601duration=a["iso8601"])))


def _kept(array: Column) -> Column:
    """NULL for an empty array, so that it leaves no key in the JSON."""
    return F.when(F.size(array) > 0, array)


def _items(c: Column) -> Column:
    return F.filter(c, lambda x: x.isNotNull())


def features(phenotypes: Column, pmid: Column) -> Column:
    """Phenotypes with an identifier."""
    coded = F.filter(phenotypes, lambda x: x.isNotNull() & truthy(x["hpo_id"]).isNotNull())

    def one(x: Column) -> Column:
        quote = truthy(x["evidence"]["quote"])
        ev = F.when(quote.isNotNull(), F.array(_named(evidenceCode=_named(id=F.lit(ECO_STATEMENT[0]), label=F.lit(ECO_STATEMENT[1])), reference=_named(id=F.concat(F.lit("PMID:"), pmid), description=F.substring(quote, 1, 200)))))
        return _named(type=_named(id=x["hpo_id"], label=F.coalesce(truthy(x["hpo_label"]), x["text"])), excluded=F.when(x["excluded"], F.lit(True)), onset=_age(x["onset"]), evidence=ev)

    return F.transform(coded, one)


def measurements(ms: Column, prefix: str = PREFIX) -> Column:
    """A quantity where there is a number, else a class; the reference range only with both ends."""

    def made(kind: str, c: Column) -> Column:
        return F.concat(F.lit(f"{prefix}:{kind}/"), c)

    def one(x: Column) -> Column:
        unit = _named(id=F.concat(F.lit("UCUM:"), F.coalesce(truthy(x["unit_ucum"]), truthy(x["unit"]), F.lit("unknown"))), label=F.coalesce(truthy(x["unit"]), F.lit("unknown")))
        rr, name = x["reference_range"], F.coalesce(truthy(x["analyte"]["label"]), x["analyte_text"])
        bounds = F.when(rr["low"].isNotNull() & rr["high"].isNotNull(), _named(unit=unit, low=rr["low"], high=rr["high"]))
        quantity = F.when(x["value"].isNotNull(), _named(unit=unit, value=x["value"], referenceRange=bounds))
        word = F.coalesce(x["interpretation"], F.lit("UNKNOWN"))
        klass = F.when(x["value"].isNull(), _named(id=made("interpretation", word), label=F.coalesce(truthy(x["value_text"]), word)))
        specimen = F.when(truthy(x["specimen"]).isNotNull(), _named(code=_named(id=made("specimen", x["specimen"]), label=x["specimen"])))
        description = truthy(F.concat_ws("; ", truthy(x["timing"]), truthy(x["condition"]), truthy(x["panel"])))
        return _named(
            assay=_named(id=F.coalesce(truthy(x["analyte"]["chebi"]), made("analyte", name)), label=name), value=_named(quantity=quantity, ontologyClass=klass),
            procedure=specimen, timeObserved=_age(x["age"]), description=description,
        )

    return F.transform(_items(ms), one)


def disease_id(x: Column) -> Column:
    return F.coalesce(truthy(x["disease"]["omim"]), truthy(x["disease"]["mondo"]), truthy(x["disease"]["orphanet"]))


def diseases(dx: Column, onset: Column) -> Column:
    """Diagnoses with an identifier, but differential and excluded ones; revised ones are marked as excluded."""
    kept = F.filter(dx, lambda x: x.isNotNull() & disease_id(x).isNotNull() & ~F.coalesce(x["status"].isin("DIFFERENTIAL", "EXCLUDED"), F.lit(False)))
    return F.transform(kept, lambda x: _named(term=_named(id=disease_id(x), label=F.coalesce(truthy(x["disease"]["label"]), x["disease_text"])), onset=onset, excluded=F.when(x["status"] == "REVISED_FROM", F.lit(True))))


def interpretation(record_id: Column, local_id: Column, dx: Column, findings: Column, prefix: str = PREFIX) -> Column:
    """One interpretation where there is a final diagnosis or a variant; SOLVED only for a final molecular one."""
    final = F.try_element_at(F.filter(dx, lambda x: F.coalesce(x["status"] == "FINAL", F.lit(False))), F.lit(1))

    def one(g: Column) -> Column:
        expressions = F.filter(
            F.array(*[F.when(truthy(g[c]).isNotNull(), _named(syntax=F.lit(s), value=F.concat(F.coalesce(F.concat(truthy(g["transcript"]), F.lit(":")), F.lit("")) if s == "hgvs.c" else F.lit(""), g[c]))) for c, s in (("variant_hgvs_c", "hgvs.c"), ("variant_hgvs_p", "hgvs.p"), ("variant_hgvs_g", "hgvs.g"))]),
            lambda e: e.isNotNull(),
        )
        state = F.when(lookup(ZYGOSITY_ID, g["zygosity"]).isNotNull(), _named(id=lookup(ZYGOSITY_ID, g["zygosity"]), label=lookup(ZYGOSITY_LABEL, g["zygosity"])))
        name = F.coalesce(truthy(g["variant_hgvs_c"]), truthy(g["variant_text"]), F.lit("var"))
        ident = F.substring(F.translate(F.concat(record_id, F.lit("-"), F.coalesce(g["gene_symbol"], F.lit("None")), F.lit("-"), name), " ", "_"), 1, 120)
        descriptor = _named(id=ident, geneContext=_named(valueId=F.coalesce(truthy(g["hgnc_id"]), F.concat(F.lit("HGNC:"), F.coalesce(g["gene_symbol"], F.lit("None")))), symbol=g["gene_symbol"]), moleculeContext=F.lit("unspecified_molecule_context"), expressions=_kept(expressions), description=F.when(F.size(expressions) == 0, truthy(g["variant_text"])), allelicState=state)
        return _named(
            subjectOrBiosampleId=F.coalesce(local_id, F.lit("individual")), interpretationStatus=F.when(final.isNotNull(), "CAUSATIVE").otherwise("UNKNOWN_STATUS"),
            variantInterpretation=_named(variationDescriptor=descriptor, acmgPathogenicityClassification=F.coalesce(lookup(ACMG, g["classification_as_reported"]), F.lit("NOT_PROVIDED"))),
        )

    g = F.coalesce(_items(findings), F.array())
    body = _named(id=F.concat(record_id, F.lit("-interp")), progressStatus=F.when(F.coalesce(final["confidence_tier"] == "MOLECULAR", F.lit(False)), "SOLVED").otherwise("IN_PROGRESS"), diagnosis=_named(disease=_named(id=F.coalesce(disease_id(final), F.lit(f"{prefix}:diagnosis/unknown")), label=F.coalesce(truthy(final["disease"]["label"]), final["disease_text"], F.lit(""))), genomicInterpretations=F.transform(_items(findings), one)))
    return F.when(final.isNotNull() | (F.size(g) > 0), F.array(body))


def phenopacket(record: Column, record_id: Column, pmid: Column, title: Column | None = None, created: Column | None = None, prefix: str = PREFIX) -> Column:
    """The phenopacket of a record (as `with_added` leaves it) as a struct; empty lists and nulls leave no key in its JSON."""
    s = record["subject"]
    seen = F.coalesce(_age(s["age_at_last_followup"]), _age(s["age_at_presentation"]))
    vital = F.when(s["vital_status"].isin("ALIVE", "DECEASED"), _named(status=s["vital_status"], timeOfDeath=_age(s["age_at_death"])))
    final = F.try_element_at(F.filter(record["diagnoses"], lambda x: F.coalesce(x["status"] == "FINAL", F.lit(False))), F.lit(1))
    target = _named(id=F.lit(f"{prefix}:diagnosis"), label=F.coalesce(final["disease_text"], F.lit("")))
    kind = lambda x: F.concat(F.lit(f"{prefix}:treatment/"), F.coalesce(x["type"], F.lit("None")))
    actions = F.transform(_items(record["treatments"]), lambda x: _named(treatment=_named(agent=_named(id=kind(x), label=F.coalesce(truthy(x["agent"]), x["text"]))), treatmentTarget=target))
    resources = F.array(*[_named(**dict(zip(("id", "name", "url", "namespacePrefix", "iriPrefix"), map(F.lit, r), strict=True)), version=F.lit("")) for r in RESOURCES])
    reference = _named(id=F.concat(F.lit("PMID:"), pmid), reference=F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid), description=F.coalesce(title if title is not None else F.lit(None).cast("string"), F.lit("")))
    meta = _named(created=created if created is not None else F.lit(None).cast("string"), createdBy=F.lit(prefix), resources=resources, phenopacketSchemaVersion=F.lit("2.0"), externalReferences=F.array(reference))
    return _named(
        id=record_id, subject=_named(id=F.coalesce(record["local_id"], F.lit("individual")), sex=F.coalesce(s["sex"], F.lit("UNKNOWN_SEX")), timeAtLastEncounter=seen, vitalStatus=vital),
        phenotypicFeatures=_kept(features(record["phenotypes"], pmid)), measurements=_kept(measurements(record["measurements"], prefix)), interpretations=interpretation(record_id, record["local_id"], record["diagnoses"], record["genetic_findings"], prefix),
        diseases=_kept(diseases(record["diagnoses"], _age(s["age_at_onset"]))), medicalActions=_kept(actions), metaData=meta,
    )


def utc_now() -> Column:
    """The time as a phenopacket states it."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def phenopacket_json(record: Column, record_id: Column, pmid: Column, title: Column | None = None, created: Column | None = None) -> Column:
    return F.to_json(phenopacket(record, record_id, pmid, title, created))


def structural_issues(text: Column) -> Column:
    """What a phenopacket's JSON lacks: not an object, no id, no subject, no metadata."""
    v = F.try_parse_json(text)
    has = lambda p: F.try_variant_get(v, p, "string").isNotNull()
    return F.filter(F.array(F.when(v.isNull(), "no JSON"), F.when(v.isNotNull() & ~has("$.id"), "no id"), F.when(v.isNotNull() & ~has("$.subject"), "no subject"), F.when(v.isNotNull() & ~has("$.metaData"), "no metaData")), lambda x: x.isNotNull())
