"""From extracted records and triage manifests to grounded, checked records, as one set of joins.

A manifest is one row per paper with its individuals; a record belongs to the manifest entry of its `local_id`. Papers out of
scope give a triage row only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import truthy, unit_normal
from .grounding import small

MANIFEST = (
    "in_scope boolean, document_type string, reasons string, scope_diseases_mentioned array<string>, languages array<string>, individuals array<struct<local_id:string,where:array<string>,family_id:string,is_affected:boolean,"
    "case_type:string,case_type_reason:string,is_rereport:boolean,rereport_reference:string>>, has_individual_level_table boolean, notes array<string>, cited_case_references array<string>"
)


def manifests(texts: DataFrame) -> DataFrame:
    """`texts(pmid, payload)` → (pmid, m struct, valid JSON or not)."""
    return texts.select("pmid", F.from_json("payload", MANIFEST).alias("m"), F.try_parse_json("payload").isNotNull().alias("readable"))


def affected(i: Column) -> Column:
    """Individuals count as affected unless the manifest says otherwise."""
    return F.coalesce(i["is_affected"], F.lit(True))


def triage(manifest: DataFrame) -> DataFrame:
    """One triage row per paper: `(pmid, in_scope, n_individuals, individual_ids, is_rereport, document_type, reasons)`."""
    people = F.filter(F.coalesce("m.individuals", F.array()), lambda i: i.isNotNull())
    return manifest.where("readable").select(
        "pmid", F.coalesce("m.in_scope", F.lit(False)).cast("int").alias("in_scope"), F.size(F.filter(people, affected)).cast("bigint").alias("n_individuals"), F.transform(people, lambda i: i["local_id"]).alias("individual_ids"),
        F.exists(people, lambda i: F.coalesce(i["is_rereport"], F.lit(False))).cast("int").alias("is_rereport"), F.col("m.document_type").alias("document_type"), F.col("m.reasons").alias("reasons"),
    )


def admitted(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records of papers in scope, with their manifest entry as `entry` (null where the manifest does not name them; the last of
    several entries of one name counts) and the paper's `document_type`."""
    inside = manifest.where("readable and coalesce(m.in_scope, false)")
    people = inside.select("pmid", F.posexplode("m.individuals").alias("i", "e")).where("e is not null").groupBy("pmid", F.col("e.local_id").alias("local_id")).agg(F.max_by("e", "i").alias("entry"))
    return records.join(inside.select("pmid", F.col("m.document_type").alias("document_type")), "pmid").join(people, ["pmid", "local_id"], "left")


def provenance(records: DataFrame, documents: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds `_source` (catalogue facts of the paper, digest of its text, its sets) and `_triage` (what the manifest said)."""
    named = sets.groupBy("pmid").agg(F.array_sort(F.collect_set("set_name")).alias("sets"))
    docs = documents.select("pmid", "pmcid", "doi", "title", "journal", F.col("pub_year").alias("year"), "license", F.col("fulltext_tier").alias("tier"), F.when(truthy(F.col("text")).isNotNull(), F.sha2("text", 256)).alias("input_sha256"))
    x = records.join(docs, "pmid", "left").join(named, "pmid", "left")
    source = F.struct("pmid", "pmcid", "doi", "title", "journal", "year", "license", "tier", "input_sha256", F.coalesce("sets", F.array().cast("array<string>")).alias("sets"))
    said = F.struct("document_type", *[F.col(f"entry.{c}").alias(c) for c in ("case_type", "case_type_reason", "is_rereport", "family_id")])
    return x.select(*records.columns, source.alias("_source"), said.alias("_triage"))


def evidence_issues(records: DataFrame, totals: DataFrame, narratives: DataFrame) -> DataFrame:
    """(record_id, severity, path, msg): quotes that are not in the document, and records without a narrative.

    `totals(record_id, total, missing)`, `narratives(record_id)` of those that have one.
    """
    t = totals.where("missing > 0").select("record_id", F.lit("warn").alias("severity"), F.lit("evidence").alias("path"), F.concat("missing", F.lit(" of "), "total", F.lit(" evidence quotes not found verbatim in the document")).alias("msg"))
    n = records.select("record_id").distinct().join(narratives.select("record_id").distinct(), "record_id", "left_anti")
    n = n.select("record_id", F.lit("warn").alias("severity"), F.lit("narrative_anchors").alias("path"), F.lit("no narrative could be assembled (anchors missing or unresolvable)").alias("msg"))
    return t.unionByName(n)


def _put_back(records: DataFrame, field: str, put) -> DataFrame:  # noqa: ANN001
    """Rebuild `record.<field>` of every record from `put(items)`, where `items(record_id, pos, x)` are its live elements and
    `put` answers with the same columns. Null elements stay where they were; only the elements are shuffled."""
    items = records.select("record_id", F.posexplode(f"record.{field}").alias("pos", "x")).where("x is not null")
    new = put(items).groupBy("record_id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "x"))).alias("_new"))
    kind = new.schema["_new"].dataType.valueType.simpleString()
    full = F.transform(F.col(f"record.{field}"), lambda x, i: F.when(x.isNotNull(), F.try_element_at(F.col("_new"), i)))
    return records.join(new, "record_id", "left").withColumn("record", F.col("record").withField(field, F.when(F.col(f"record.{field}").isNotNull(), full.cast(f"array<{kind}>")))).drop("_new")


GROUNDING = "struct<status:string,confidence:double,method:string,candidates:array<struct<id:string,label:string,score:double>>>"


def ground_records(records: DataFrame, phenotypes: DataFrame | None = None, analytes: DataFrame | None = None, genes: DataFrame | None = None, diseases: DataFrame | None = None) -> DataFrame:
    """Records (one row per `record_id`) with the answers of the cascades put into their arrays.

    Each vocabulary is the result of a cascade over the distinct texts of the records (`ground_phenotypes`, `ground_analyte_names`,
    `ground_genes`, `ground_disease_names`). Analyte identifiers overwrite only where there is one; units are normalised on the way.
    """
    state = F.struct("status", "confidence", "method", "candidates").cast(GROUNDING)
    if phenotypes is not None:
        p = small(phenotypes.select(F.col("text").alias("_t"), F.col("supplied").alias("_s"), F.col("id").alias("_id"), F.col("label").alias("_label"), state.alias("_g")))
        records = _put_back(records, "phenotypes", lambda items: items.join(p, (F.col("x.text") == F.col("_t")) & F.col("x.hpo_id").eqNullSafe(F.col("_s")), "left").select("record_id", "pos", F.col("x").withField("hpo_id", F.col("_id")).withField("hpo_label", F.col("_label")).withField("grounding", F.col("_g")).alias("x")))
    if analytes is not None:
        a = small(analytes.select(F.col("text").alias("_t"), F.col("supplied").alias("_s"), F.struct("label", "chebi", "vmh").alias("_a"), state.alias("_g")))

        def measured(items: DataFrame) -> DataFrame:
            has = "analyte" in items.schema["x"].dataType.names
            old = F.col("x.analyte") if has else F.lit(None).cast("struct<label:string,chebi:string,vmh:string>")
            j = items.join(a, (F.col("x.analyte_text") == F.col("_t")) & old["chebi"].eqNullSafe(F.col("_s")), "left")
            new = F.struct(*[F.coalesce(truthy(F.col(f"_a.{c}")), old[c]).alias(c) for c in ("label", "chebi", "vmh")])
            unit = F.when(truthy(F.col("x.unit")).isNotNull(), unit_normal(F.col("x.unit"))).otherwise(F.col("x.unit_ucum"))
            return j.select("record_id", "pos", F.col("x").withField("analyte", new).withField("unit_ucum", unit).withField("grounding", F.col("_g")).alias("x"))

        records = _put_back(records, "measurements", measured)
    if genes is not None:
        known = F.when(F.col("gene").isNotNull(), "grounded").otherwise("unresolved")
        g = small(genes.select(F.col("text").alias("_t"), F.coalesce("gene", "text").alias("_gene"), F.col("hgnc_id").alias("_id"), F.struct(known.alias("status"), "confidence", F.lit("symbol").alias("method"), F.array().cast("array<struct<id:string,label:string,score:double>>").alias("candidates")).cast(GROUNDING).alias("_g")))
        put = lambda items: items.join(g, F.col("x.gene_symbol") == F.col("_t"), "left").select("record_id", "pos", F.col("x").withField("gene_symbol", F.coalesce("_gene", "x.gene_symbol")).withField("hgnc_id", F.col("_id")).withField("grounding", F.col("_g")).alias("x"))
        records = _put_back(records, "genetic_findings", put)
    if diseases is not None:
        dis = small(diseases.select(F.col("text").alias("_t"), F.struct("label", F.col("id").alias("mondo"), F.col("id_omim").alias("omim"), F.col("id_orphanet").alias("orphanet")).alias("_d"), state.alias("_g")))
        records = _put_back(records, "diagnoses", lambda items: items.join(dis, F.col("x.disease_text") == F.col("_t"), "left").select("record_id", "pos", F.col("x").withField("disease", F.col("_d")).withField("grounding", F.col("_g")).alias("x")))
    return records


def write_records(records: DataFrame, path: str) -> None:
    """Record, phenopacket (valid ones only) and case sheet as partitioned JSON and text: `(record_id, pmid, record, phenopacket,
    valid, sheet)` below `<path>/records|phenopackets|sheets/pmid=…`."""
    records.select("pmid", "record_id", F.to_json("record").alias("record")).write.mode("overwrite").partitionBy("pmid").json(f"{path}/records")
    records.where("valid").select("pmid", "record_id", "phenopacket").write.mode("overwrite").partitionBy("pmid").json(f"{path}/phenopackets")
    records.select("pmid", "record_id", "sheet").write.mode("overwrite").partitionBy("pmid").json(f"{path}/sheets")


def statistics(triaged: DataFrame, records: DataFrame) -> DataFrame:
    """(name, n): manifests, papers in scope, records, valid and invalid ones."""
    a = triaged.agg(F.count("*").alias("manifests"), F.coalesce(F.sum("in_scope"), F.lit(0)).alias("in_scope"))
    b = records.agg(F.count("*").alias("records"), F.count_if(F.col("valid")).alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))
    stack = "stack(5, 'manifests', manifests, 'in_scope', in_scope, 'records', records, 'valid', valid, 'invalid', invalid) as (name, n)"
    return a.join(b).selectExpr(stack)
