"""Queries on what leaves the engine: exports, phenopackets, review tables, overviews, samples, registered functions; with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import register, text
from ..operators import anchors, catalogue, extraction, facts, linkage, overview, phenopacket, review, sampling, work
from ..session import table as t
from .catalogue import SQL as _CAT_SQL, _DISEASE_KEEP, _key_sql
from .documents import SQL as _DOC_SQL, _DOCS, _EVIDENCE, _LINES, _docs, _records, _verified, evidence
from .flow import _DGROUND, _ONER, _ONTO, _disease_ontology, _grounded
from .records import SQL as _REC_SQL, _FINAL, _QUOTES, _S, _days_sql, _pool, _recs, _x


# -- export ----------------------------------------------------------------------------------------------------------
def _narratives(spark: SparkSession, d: str) -> DataFrame:
    u = anchors.units(_docs(spark, d, "pmid", "text").select("pmid", "text"))
    a = _records(spark, d).select("record_id", "pmid", F.explode("record.narrative_anchors").alias("anchor"))
    return anchors.narratives(a, u).withColumn("source", F.lit("extractor"))


_PLAIN = ("enzyme_activities", "genetic_findings", "treatments", "documents")


def _tables(spark: SparkSession, d: str, name: str) -> dict[str, DataFrame]:
    from .documents import verification_totals
    from .records import entity_links

    links = entity_links(spark, d).select("record_a", "record_b", F.lit("possible_same_individual").alias("relation"), "evidence", "score") if name == "links" else None
    told = _narratives(spark, d) if name in ("individuals", "narratives") else None
    verified = verification_totals(spark, d) if name == "individuals" else None
    records = _recs(spark, d) if name in (*_PLAIN, "links", "narratives") else _grounded(spark, d, "diagnoses" if name == "individuals" else name)
    return facts.export_tables(records, t(spark, d, "documents"), links, told, verified)


def _export(name: str):  # noqa: ANN202
    def q(spark: SparkSession, d: str) -> DataFrame:
        return _tables(spark, d, name)[name]

    q.__name__ = f"export_{name}"
    return q


def export_documents(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows with their lists as ASCII JSON, as the CSV export has them."""
    x = _tables(spark, d, "documents")["documents"]
    return x.select("doc_id", "pmid", "journal", "pub_year", *[facts.escaped_json(F.coalesce(c, F.array().cast("array<string>"))).alias(c) for c in ("pub_types", "keywords", "authors")], "corpus_layer", "license", "n_chars")


# -- phenopackets ----------------------------------------------------------------------------------------------------
def _packets(spark: SparkSession, d: str, *parts: str) -> DataFrame:
    title = _docs(spark, d, "pmid", "title").select("pmid", "title")
    x = phenopacket.with_added(_grounded(spark, d, *parts)).join(title, "pmid", "left")
    return x.select("record_id", phenopacket.phenopacket(F.col("record"), F.col("record_id"), F.col("pmid"), F.col("title")).alias("p"))


_NEEDS = {"p.phenotypicFeatures": "phenotypes", "p.measurements": "measurements", "p.diseases": "diagnoses", "p.medicalActions": "diagnoses"}


def _rows(spark: SparkSession, d: str, path: str, *cols) -> DataFrame:  # noqa: ANN002
    return _packets(spark, d, _NEEDS[path]).select("record_id", F.posexplode(path).alias("i", "x")).select("record_id", F.col("i").cast("bigint").alias("i"), *cols)


def packet_features(spark: SparkSession, d: str) -> DataFrame:
    ev = F.col("x.evidence")[0]
    return _rows(spark, d, "p.phenotypicFeatures", F.col("x.type.id").alias("id"), F.col("x.type.label").alias("label"), F.col("x.excluded").alias("excluded"), F.col("x.onset.age.iso8601duration").alias("onset"), ev["evidenceCode"]["id"].alias("code"), ev["reference"]["id"].alias("reference"), ev["reference"]["description"].alias("quote"))


def packet_measurements(spark: SparkSession, d: str) -> DataFrame:
    q, k = F.col("x.value.quantity"), F.col("x.value.ontologyClass")
    return _rows(spark, d, "p.measurements", F.col("x.assay.id").alias("assay_id"), F.col("x.assay.label").alias("assay"), q["value"].alias("value"), q["unit"]["id"].alias("unit_id"), q["referenceRange"]["low"].alias("low"), q["referenceRange"]["high"].alias("high"), q["referenceRange"]["unit"]["id"].alias("range_unit"), k["id"].alias("class_id"), k["label"].alias("class_label"), F.col("x.procedure.code.id").alias("specimen"), F.col("x.timeObserved.age.iso8601duration").alias("age"), F.col("x.description").alias("description"))


def packet_diseases(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "p.diseases", F.col("x.term.id").alias("id"), F.col("x.term.label").alias("label"), F.col("x.onset.age.iso8601duration").alias("onset"), F.col("x.excluded").alias("excluded"))


def packet_variants(spark: SparkSession, d: str) -> DataFrame:
    """Variants of the interpretations, with what each says of the diagnosis."""
    x = _packets(spark, d, "diagnoses").select("record_id", F.col("p.interpretations")[0].alias("n"))
    x = x.where("n is not null").select("record_id", F.col("n.id").alias("interpretation"), F.col("n.progressStatus").alias("progress"), F.col("n.diagnosis.disease.id").alias("disease"), F.posexplode_outer("n.diagnosis.genomicInterpretations").alias("i", "g"))
    v, c = F.col("g.variantInterpretation.variationDescriptor"), F.col("g.variantInterpretation.acmgPathogenicityClassification")
    said = F.array_join(F.transform(v["expressions"], lambda e: F.concat_ws("=", e["syntax"], e["value"])), ";")
    return x.select("record_id", "interpretation", "progress", "disease", F.col("i").cast("bigint").alias("i"), v["id"].alias("variant"), v["geneContext"]["valueId"].alias("gene_id"), v["geneContext"]["symbol"].alias("gene"), said.alias("expressions"), v["description"].alias("description"), v["allelicState"]["id"].alias("zygosity"), c.alias("acmg"), F.col("g.interpretationStatus").alias("status"))


def packet_actions(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "p.medicalActions", F.col("x.treatment.agent.id").alias("agent_id"), F.col("x.treatment.agent.label").alias("agent"), F.col("x.treatmentTarget.label").alias("target"))


def packet_heads(spark: SparkSession, d: str) -> DataFrame:
    """Subject and metadata of every phenopacket."""
    p = _packets(spark, d, "diagnoses")
    m, s = F.col("p.metaData"), F.col("p.subject")
    return p.select("record_id", s["id"].alias("subject"), s["sex"].alias("sex"), s["vitalStatus"]["status"].alias("vital"), s["vitalStatus"]["timeOfDeath"]["age"]["iso8601duration"].alias("death"), s["timeAtLastEncounter"]["age"]["iso8601duration"].alias("seen"), F.size(m["resources"]).cast("bigint").alias("resources"), m["externalReferences"][0]["reference"].alias("reference"), m["externalReferences"][0]["description"].alias("title"))


# -- review ----------------------------------------------------------------------------------------------------------
def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Two made-up reviewers' verdicts on the diagnosis facts: the first from status, the second also from the tier."""
    x = t(spark, d, "diagnoses").where("fact_id is not null and disease_text is not null").groupBy("fact_id", "record_id").agg(F.min("status").alias("status"), F.min("confidence_tier").alias("tier"))
    first = F.when(F.col("status") == "FINAL", "Correct").when(F.col("status") == "DIFFERENTIAL", "Partly correct").otherwise("Wrong value")
    second = F.when(F.col("tier").isin("MOLECULAR", "ENZYMATIC"), first).when(F.col("tier") == "CLINICAL", "Correct").otherwise("Unsure")
    return x.select("fact_id", "record_id", F.lit("ada").alias("reviewer"), first.alias("verdict"), F.lit(1).alias("n")).unionByName(x.where("tier is not null").select("fact_id", "record_id", F.when(F.col("tier") == "CLINICAL", "ada").otherwise("ben").alias("reviewer"), second.alias("verdict"), F.lit(2).alias("n")))


def _missed(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "measurements").where("value is null").select("record_id", F.coalesce("specimen", F.lit("none")).alias("grp"))


def review_agreement(spark: SparkSession, d: str) -> DataFrame:
    return review.agreement_of_pairs(review.double_reviews(_verdicts(spark, d), [F.col("n")]))


def review_counts(spark: SparkSession, d: str) -> DataFrame:
    return review.counts(_verdicts(spark, d), _missed(spark, d))


def missed_facts(spark: SparkSession, d: str) -> DataFrame:
    """Missed facts of reviewed records per group and over all."""
    m = review.missed_in_reviewed(_missed(spark, d), _verdicts(spark, d))
    return m.rollup("grp").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).select(F.when(F.col("g") == 1, "all").otherwise(F.col("grp")).alias("grp"), "n")


def record_answers(spark: SparkSession, d: str) -> DataFrame:
    x = _records(spark, d).select(
        F.when(F.col("record.diagnoses")[0]["status"] == "FINAL", "yes").otherwise("no").alias("diagnosis_correct"), F.col("record.diagnoses")[0]["confidence_tier"].alias("tier_correct"), F.when(F.size("record.narrative_anchors") > 1, "yes").otherwise("").alias("narrative_complete"),
        F.lit(None).cast("string").alias("narrative_has_others"), F.when(F.size("record.phenotypes") > 2, F.size("record.phenotypes")).cast("double").alias("quality"),
    )
    return review.record_answers(x)


def reviewer_facts(spark: SparkSession, d: str) -> DataFrame:
    """How many facts of each group a reviewer finds in a batch."""
    a = sampling.assign(_recs(spark, d), ["ada", "ben", "cai"], 20, 0.2, seed=1)
    return review.batches(a, facts.facts(_recs(spark, d)).select("record_id", "grp", "fact_id").where("grp in ('phenotype', 'diagnosis')")).groupBy("reviewer", "batch", "role", "grp").agg(F.count("*").alias("n"))


def review_units(spark: SparkSession, d: str) -> DataFrame:
    """The paper text sheet: every unit of papers with records, with the records whose narrative holds it."""
    r = _records(spark, d).select("pmid").distinct()
    u = anchors.units(_docs(spark, d, "pmid", "text").select("pmid", "text").join(r, "pmid", "left_semi")).select("pmid", "kind", "anchor").distinct()
    n = _narratives(spark, d).select("record_id", "pmid", F.explode("passages.anchor").alias("anchor"))
    return review.units_of_records(u, n)


# -- overview, samples, work items -----------------------------------------------------------------------------------
def overview_patients(spark: SparkSession, d: str) -> DataFrame:
    """One row per patient: paper, approximate year, licence, sex, age and band, words, patients of the paper, disease flags."""
    r = _recs(spark, d).select(F.col("record_id").alias("patient_uid"), "pmid", F.col("record.subject.sex").alias("gender"), F.col("record.subject.age_at_last_followup.iso8601").alias("age"), F.col("record.clinical_summary").alias("patient"), F.concat_ws(" ", F.transform(F.filter("record.genetic_findings", lambda x: x.isNotNull()), lambda x: x["gene_symbol"])).alias("genes"))
    docs = _docs(spark, d, "pmid", "title", "pub_year", "license").select("pmid", "title", F.col("pub_year").cast("double").alias("approx_year"), "license")
    terms = t(spark, d, "disease_aliases").where("length(alias) >= 8").select(F.lower(F.trim("alias")).alias("term"), F.col("omim").alias("id"))
    return overview.patients(r, docs, terms).drop("title")


def overview_sheets(spark: SparkSession, d: str) -> DataFrame:
    """Counts behind the overview's sheets: (sheet, value, n)."""
    return overview.sheets(overview_patients(spark, d))


def sample_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The twelve columns of the sample table, with the other sets of each paper."""
    pool = _pool(spark, d)
    more = pool.select("pmid", F.concat(F.lit("layer:"), F.coalesce("lang", F.lit("none"))).alias("set_name")).unionByName(pool.select("pmid", "set_name"))
    cat = _docs(spark, d, "pmid", "pub_year", "fulltext_tier", "pmcid", "doi", "journal", "title")
    return sampling.sheet(sampling.draw(pool), more, cat)


def sample_set(spark: SparkSession, d: str) -> DataFrame:
    """The drawn sample registered as a set in place of its former rows, with its origin as JSON."""
    s = sampling.draw(_pool(spark, d))
    old = s.limit(3).select("pmid", F.lit("sample").alias("set_name"), F.lit("old").alias("source")).unionByName(t(spark, d, "subject_labels").select(F.col("doc_id").cast("string").alias("pmid"), F.lit("rated").alias("set_name"), F.lit("x").alias("source")).distinct())
    return sampling.register(old, s, "sample").select("pmid", "set_name", "source")


def work_items(spark: SparkSession, d: str) -> DataFrame:
    """Work items of papers: digest of the input, of the two prompts, and the metadata."""
    x = work.items(_docs(spark, d, "pmid", "text", "title", "fulltext_tier").where("text is not null"))
    return x.select("pmid", F.sha2("input", 256).alias("input_sha256"), F.md5("triage_prompt").alias("triage_prompt"), F.md5("extract_prompt").alias("extract_prompt"), "meta")


def work_check(spark: SparkSession, d: str) -> DataFrame:
    """Per record: quotes in all, missing ones, narrative anchors that resolve to nothing."""
    u = anchors.units(_docs(spark, d, "pmid", "text").select("pmid", "text"))
    a = _records(spark, d).select("record_id", "pmid", F.explode("record.narrative_anchors").alias("anchor")).where("anchor is not null").distinct()
    return work.check(_verified(spark, d), a, u)


def claim_checks(spark: SparkSession, d: str) -> DataFrame:
    """Claims of made-up payloads, checked: vocabulary, quote, quotes of quantities."""
    u = anchors.units(_docs(spark, d, "pmid", "text").select("pmid", "text"))
    first = u.where("kind = 'paragraph'").groupBy("pmid").agg(F.min_by(F.struct("anchor", "unit"), F.struct("n", "m")).alias("p"))
    last = F.substring("pmid", -1, 1)
    quote = F.when(last == "1", "never said anywhere").otherwise(F.substring("p.unit", 1, 30))
    ev = F.struct(quote.alias("quote"), F.col("p.anchor").alias("anchor"))
    qty = F.array(F.struct(F.when(last == "2", "shoe_size").otherwise("Km").alias("kind"), F.lit(1.0).alias("value"), F.struct(F.when(last == "3", "nor this").otherwise(F.substring("p.unit", 1, 12)).alias("quote"), F.col("p.anchor").alias("anchor")).alias("evidence")))
    c = F.struct(F.when(last == "4", "gossip").otherwise("transport").alias("claim_type"), F.lit("x").alias("as_stated"), F.when(last != "5", "human").alias("organism"), F.lit("review_statement").alias("evidence_type"), F.when(last != "6", ev).alias("evidence"), qty.alias("quantities"))
    texts = first.select("pmid", F.to_json(F.struct(F.array(c).alias("claims"))).alias("payload"))
    return extraction.check_claims(texts, _docs(spark, d, "pmid", "text").select("pmid", "text"))


def claim_summary(spark: SparkSession, d: str) -> DataFrame:
    from .intake import stub_extraction

    c = stub_extraction(spark, d).withColumn("gene_symbol", F.upper(F.substring("quote", 1, 3)))
    s = extraction.claim_summary(c)
    return s.select("claim_type", "n", F.array_join("genes", "|").alias("genes"))


def run_log(spark: SparkSession, d: str) -> DataFrame:
    """Runs of made-up commands: a failed one keeps no end."""
    e = t(spark, d, "events").where("event_type is not null").groupBy("event_type").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    started = catalogue.start_runs(e.select(F.col("event_type").alias("run_id"), F.lit("ingest").alias("command"), F.lit("{}").alias("args"), F.lit("1").alias("version"), F.col("a").cast("timestamp").cast("double").alias("started_at")))
    ended = e.where("event_type <> 'error'").select(F.col("event_type").alias("run_id"), F.col("b").cast("timestamp").cast("double").alias("finished_at"), F.to_json(F.struct("n")).alias("summary"))
    return catalogue.finish_runs(started, ended)


def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The registered functions from SQL."""
    register.register(spark)
    t(spark, d, "disease_aliases").createOrReplaceTempView("sl_aliases")
    return spark.sql("SELECT alias, sl_slug(alias) AS slug, sl_key(alias) AS disease_key, sl_age_days('P2Y3M') AS days, sl_token_sort(alias, alias) AS same FROM sl_aliases")


def display_helpers(spark: SparkSession, d: str) -> DataFrame:
    """Marks of evidence and numbers as sheets print them."""
    x = evidence(spark, d).groupBy("record_id", "grp").agg(F.count("*").alias("n"))
    m = _recs(spark, d).select("record_id", F.posexplode("record.measurements").alias("i", "x")).where("x is not null")
    mark = text.mark(facts.evidence_status(F.col("x.evidence")))
    return m.select("record_id", F.col("i").cast("bigint").alias("i"), mark.alias("mark"), text.quantity(F.col("x.comparator"), F.col("x.value").cast("bigint").cast("string"), F.col("x.unit")).alias("quantity")).join(x.where("grp = 'measurements'").select("record_id", "n"), "record_id", "left")


def decoded_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON decoded, invalid text kept as it is."""
    x = t(spark, d, "individuals").where("record_id is not null")
    return x.groupBy("record_id").agg(F.max("phenopacket").alias("p")).select("record_id", text.decoded(F.col("p")).alias("v")).select("record_id", F.col("v.raw").isNotNull().alias("kept_raw"), F.md5("v.raw").alias("raw"), F.try_variant_get("v.value", "$.id", "string").alias("id"))


QUERIES = {f.__name__: f for f in (
    *[_export(n) for n in ("individuals", "narratives", "phenotypes", "measurements", "enzyme_activities", "genetic_findings", "diagnoses", "treatments", "links")], export_documents,
    packet_features, packet_measurements, packet_diseases, packet_variants, packet_actions, packet_heads, review_agreement, review_counts, missed_facts, record_answers, reviewer_facts, review_units,
    overview_patients, overview_sheets, sample_sheet, sample_set, work_items, work_check, claim_checks, claim_summary, run_log, sql_functions, display_helpers, decoded_json,
)}

# -- SQL -------------------------------------------------------------------------------------------------------------
_ITEMS = lambda f: f"(SELECT record_id, pmid, i, record.{f}[i + 1] AS x FROM (SELECT *, unnest(range(len(record.{f}))) AS i FROM one) WHERE record.{f}[i + 1] IS NOT NULL)"
_DTEXTS = "dtexts AS (SELECT DISTINCT x.disease_text AS text, NULL::VARCHAR AS supplied FROM (SELECT unnest(record.diagnoses) AS x FROM one) WHERE x.disease_text IS NOT NULL)"
_G = f"one AS {_ONER}, {_ONTO}, {_DTEXTS}, {_DGROUND}, dd AS (SELECT dg.text, dg.id, coalesce(lb.label, dg.text) AS label, lb.omim, CASE WHEN dg.id IS NULL THEN 'unresolved' ELSE 'grounded' END AS status FROM dg LEFT JOIN lb ON lb.id = dg.id)"
_GA = "ga AS (SELECT g.text, g.label, a.chebi, a.vmh FROM (" + _CAT_SQL["ground_analytes"].replace("analyte_text AS text FROM measurements WHERE analyte_text IS NOT NULL", "x.analyte_text AS text FROM (SELECT unnest(record.measurements) AS x FROM one) WHERE x.analyte_text IS NOT NULL") + ") g LEFT JOIN (SELECT label, min(chebi) AS chebi, min(vmh) AS vmh FROM analytes_builtin GROUP BY label) a ON a.label = g.label)"
_PHG = """pt AS (SELECT x."text" AS text, x.hpo_id AS id, x.hpo_label AS label FROM (SELECT unnest(record.phenotypes) AS x FROM individuals) WHERE x IS NOT NULL AND x."text" IS NOT NULL), lab AS (SELECT id, min(label) AS label FROM pt WHERE id IS NOT NULL AND label IS NOT NULL GROUP BY id),
    pe AS (SELECT key, min(id) AS id FROM (SELECT id, {k1} AS key FROM lab) WHERE key <> '' GROUP BY key),
    pg AS (SELECT r.*, CASE WHEN s.id IS NOT NULL THEN s.id ELSE pe.id END AS gid FROM (SELECT *, {k2} AS key FROM {items}) r LEFT JOIN lab s ON s.id = r.x.hpo_id LEFT JOIN pe ON pe.key = r.key), ph AS (SELECT pg.*, lab.label AS glabel FROM pg LEFT JOIN lab ON lab.id = gid)""".format(k1=_key_sql("label", r"a-z0-9 \-/"), k2=_key_sql('x."text"', r"a-z0-9 \-/"), items=_ITEMS("phenotypes"))
_NAR = rf"""docs AS {_DOCS}, {_LINES},
    na AS (SELECT DISTINCT record_id, pmid, anchor FROM (SELECT record_id, pmid, unnest(record.narrative_anchors) AS anchor FROM one) WHERE anchor IS NOT NULL),
    ne AS (SELECT DISTINCT na.record_id, na.pmid, u.kind, u.n, u.m, u.anchor, u.unit FROM na JOIN docs d USING (pmid) JOIN units u ON u.k = d.doc_id AND (u.anchor = na.anchor OR (regexp_matches(na.anchor, '^(sec|tab):\d+$') AND starts_with(u.anchor, na.anchor || ' '))) WHERE u.unit <> ''),
    nar AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY CASE kind WHEN 'title' THEN -1 WHEN 'abstract' THEN 0 WHEN 'paragraph' THEN 1 WHEN 'row' THEN 2 ELSE 3 END, coalesce(n, 0), coalesce(m, 0), anchor) - 1 AS ord FROM ne)"""
_VER = """vd AS (SELECT fact_id, record_id, min(status) AS status, min(confidence_tier) AS tier FROM diagnoses WHERE fact_id IS NOT NULL AND disease_text IS NOT NULL GROUP BY fact_id, record_id),
    v1 AS (SELECT *, CASE WHEN status = 'FINAL' THEN 'Correct' WHEN status = 'DIFFERENTIAL' THEN 'Partly correct' ELSE 'Wrong value' END AS a FROM vd),
    v2 AS (SELECT *, CASE WHEN tier IN ('MOLECULAR', 'ENZYMATIC') THEN a WHEN tier = 'CLINICAL' THEN 'Correct' ELSE 'Unsure' END AS b FROM v1 WHERE tier IS NOT NULL),
    ver AS (SELECT fact_id, record_id FROM v1 UNION ALL SELECT fact_id, record_id FROM v2)"""
_MIS = "mis AS (SELECT record_id, coalesce(specimen, 'none') AS grp FROM measurements WHERE value IS NULL)"
_AGE = lambda c: f"nullif({c}.iso8601, '')"
_ZYG = "CASE x.zygosity WHEN 'HOMOZYGOUS' THEN 'GENO:0000136' WHEN 'HETEROZYGOUS' THEN 'GENO:0000135' WHEN 'COMPOUND_HETEROZYGOUS' THEN 'GENO:0000402' WHEN 'HEMIZYGOUS' THEN 'GENO:0000134' WHEN 'MOSAIC' THEN 'GENO:0000135' WHEN 'HOMOPLASMIC' THEN 'GENO:0000602' WHEN 'HETEROPLASMIC' THEN 'GENO:0000603' END"
_BANDS = "CASE WHEN y IS NULL THEN 'unknown' WHEN y < 1 THEN '<1' WHEN y < 5 THEN '1-4' WHEN y < 12 THEN '5-11' WHEN y < 18 THEN '12-17' WHEN y < 40 THEN '18-39' WHEN y < 65 THEN '40-64' ELSE '65+' END"
_PATIENTS = rf"""one AS {_ONER}, docs AS {_DOCS}, terms AS (SELECT DISTINCT lower(trim(alias, ' ')) AS term, omim FROM disease_aliases WHERE length(alias) >= 8),
    th AS (SELECT pmid, string_agg(DISTINCT term, '|' ORDER BY term) AS labels, string_agg(DISTINCT omim, '|' ORDER BY omim) AS ids FROM docs, terms WHERE contains(lower(title), term) AND regexp_matches(lower(title), '(^|[^a-z0-9])' || regexp_escape(term) || '($|[^a-z0-9])') GROUP BY pmid),
    r AS (SELECT record_id, pmid, record.subject.sex AS gender, round({_days_sql(f'{_S}.age_at_last_followup.iso8601')} / 365.25, 2) AS y, trim(coalesce(record.clinical_summary, ''), ' ') AS patient, list_filter(list_transform(list_filter(record.genetic_findings, lambda z: z IS NOT NULL), lambda z: trim(z.gene_symbol)), lambda z: length(z) >= 4) AS genes, count(*) OVER (PARTITION BY pmid) AS k FROM one),
    pat AS (SELECT record_id AS patient_uid, r.pmid, CAST(pub_year AS DOUBLE) AS approx_year, CASE WHEN coalesce(license, '') = '' THEN 'none' WHEN contains(lower(license), 'nc') THEN 'non-commercial' WHEN contains(lower(license), 'cc0') OR contains(lower(license), 'cc by') THEN 'open' ELSE 'other' END AS licence_group, gender, y AS age_years, {_BANDS} AS age_band,
        CASE WHEN patient = '' THEN 0 ELSE len(regexp_split_to_array(patient, '\s+')) END AS n_words, k AS patients_in_article, coalesce(ids, '') <> '' OR coalesce(len(genes), 0) > 0 AS iem, coalesce(ids, '') <> '' AS iem_title,
        coalesce(array_to_string(list_filter(genes, lambda g, i: list_position(genes, g) = i), '|'), '') AS iem_genes, coalesce(labels, '') AS title_mondo_labels, coalesce(ids, '') AS title_mondo FROM r LEFT JOIN docs d ON d.pmid = r.pmid LEFT JOIN th ON th.pmid = r.pmid)"""
_ASCII = lambda c: f"coalesce('[' || array_to_string(list_transform({c}, lambda v: coalesce('\"' || array_to_string(list_transform(string_split(replace(replace(replace(v, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(9), chr(92) || 't'), ''), lambda ch: CASE WHEN unicode(ch) > 65535 THEN printf('\\u%04x\\u%04x', 55296 + (unicode(ch) - 65536) // 1024, 56320 + (unicode(ch) - 65536) % 1024) WHEN unicode(ch) > 127 THEN printf('\\u%04x', unicode(ch)) ELSE ch END), '') || '\"', 'null')), ',') || ']', '[]')"
_POOLSQL = _REC_SQL["stratified_sample"].removeprefix("WITH ").removesuffix(" SELECT * FROM sample")
_CL = rf"""docs AS {_DOCS}, {_LINES}, f1 AS (SELECT d.pmid, arg_min(u.anchor, (u.n, u.m)) AS anchor, arg_min(u.unit, (u.n, u.m)) AS unit, right(d.pmid, 1) AS l FROM units u JOIN docs d ON d.doc_id = u.k WHERE u.kind = 'paragraph' GROUP BY d.pmid)"""
SQL = {
    "export_individuals": f"""WITH {_G}, {_NAR}, n AS (SELECT record_id, CAST(sum(length(unit)) AS BIGINT) AS c, count(*) AS k FROM nar GROUP BY record_id), q AS ({_DOC_SQL['verification_totals']})
        SELECT o.record_id, pmid, local_id, valid, confidence, {_S}.sex AS sex, {_S}.age_at_onset.iso8601 AS age_at_onset, {_S}.age_at_presentation.iso8601 AS age_at_presentation, {_S}.age_at_last_followup.iso8601 AS age_at_last_followup, {_S}.vital_status AS vital_status, record.family.consanguinity AS consanguinity, {_S}.ancestry_as_stated AS ancestry, {_S}.country_of_care AS country,
        {_FINAL}.disease_text AS final_diagnosis, dd.id AS final_diagnosis_mondo, dd.omim AS final_diagnosis_omim, {_FINAL}.confidence_tier AS confidence_tier, coalesce(len(record.phenotypes), 0) AS n_phenotypes, coalesce(len(record.measurements), 0) AS n_measurements, coalesce(len(record.genetic_findings), 0) AS n_variants, record.clinical_summary AS clinical_summary, model, prompt_version,
        coalesce(n.c, 0) AS narrative_chars, coalesce(n.k, 0) AS narrative_units, CASE WHEN n.k IS NOT NULL THEN 'extractor' END AS narrative_source, q.total AS quotes_total, q.in_anchor AS quotes_in_anchor, q.in_document AS quotes_in_document
        FROM one o LEFT JOIN n ON n.record_id = o.record_id LEFT JOIN q ON q.record_id = o.record_id LEFT JOIN dd ON dd.text = {_FINAL}.disease_text""",
    "export_narratives": f"WITH one AS {_ONER}, {_NAR} SELECT record_id, pmid, ord AS \"order\", anchor, length(unit) AS chars, 'extractor' AS source, unit AS text FROM nar",
    "export_phenotypes": f"WITH one AS {_ONER}, {_PHG} SELECT record_id, pmid, x.text AS text, gid AS hpo_id, glabel AS hpo_label, x.excluded AS excluded, x.onset.iso8601 AS onset, x.modifier AS modifier, CASE WHEN x.text IS NULL THEN NULL WHEN gid IS NULL THEN 'unresolved' ELSE 'grounded' END AS \"grounding\", {_QUOTES} FROM ph",
    "export_measurements": f"""WITH one AS {_ONER}, {_GA} SELECT record_id, pmid, x.analyte_text AS analyte_text, ga.label AS analyte_label, ga.chebi AS chebi, ga.vmh AS vmh, x.specimen AS specimen, x.value AS value, x.value_text AS value_text, x.unit AS unit, CASE WHEN coalesce(x.unit, '') <> '' THEN u.ucum ELSE x.unit_ucum END AS unit_ucum, x.reference_range.low AS ref_low, x.reference_range.high AS ref_high, x.reference_range.text AS ref_text, x.interpretation AS interpretation, x.timing AS timing, x.condition AS condition, x.age.iso8601 AS age, x.panel AS panel, x.method AS method, CASE WHEN x.analyte_text IS NULL THEN NULL WHEN ga.label IS NULL THEN 'unresolved' ELSE 'grounded' END AS "grounding", {_QUOTES}
        FROM {_ITEMS('measurements')} LEFT JOIN ga ON ga.text = x.analyte_text LEFT JOIN ({_CAT_SQL['unit_normalise'].replace('FROM measurements WHERE unit IS NOT NULL', 'FROM (SELECT y.unit AS unit FROM (SELECT unnest(record.measurements) AS y FROM one)) WHERE unit IS NOT NULL')}) u ON u.unit = x.unit""",
    "export_enzyme_activities": "SELECT NULL::VARCHAR AS record_id, NULL::VARCHAR AS pmid, NULL::VARCHAR AS enzyme_text, NULL::VARCHAR AS gene_symbol, NULL::VARCHAR AS ec_number, NULL::VARCHAR AS tissue, NULL::DOUBLE AS value, NULL::VARCHAR AS unit, NULL::DOUBLE AS percent_of_control, NULL::VARCHAR AS reference_text, NULL::VARCHAR AS interpretation, NULL::VARCHAR AS quote, NULL::VARCHAR AS anchor WHERE false",
    "export_genetic_findings": f"WITH one AS {_ONER} SELECT record_id, pmid, {', '.join(f'x.{c} AS {c}' for c in ('gene_symbol', 'hgnc_id', 'variant_hgvs_c', 'variant_hgvs_p', 'variant_hgvs_g', 'transcript', 'variant_text', 'zygosity', 'inheritance_as_stated', 'classification_as_reported', 'method', 'novel'))}, x.\"grounding\".status AS \"grounding\", {_QUOTES} FROM {_x('genetic_findings')}",
    "export_diagnoses": f"WITH {_G} SELECT record_id, pmid, x.disease_text AS disease_text, dd.label AS label, dd.id AS mondo, dd.omim AS omim, NULL::VARCHAR AS orphanet, x.status AS status, x.confidence_tier AS confidence_tier, x.diagnostic_route AS diagnostic_route, x.age_at_diagnosis.iso8601 AS age_at_diagnosis, x.time_to_diagnosis_text AS time_to_diagnosis_text, coalesce(array_to_string(list_transform(x.prior_misdiagnoses, lambda z: coalesce(z, '')), '|'), '') AS prior_misdiagnoses, dd.status AS \"grounding\", {_QUOTES} FROM {_ITEMS('diagnoses')} LEFT JOIN dd ON dd.text = x.disease_text",
    "export_treatments": f"WITH one AS {_ONER} SELECT record_id, pmid, x.text AS text, x.type AS type, x.agent AS agent, x.response AS response, x.response_text AS response_text, x.evidence.quote AS quote, x.evidence.anchor AS anchor FROM {_x('treatments')}",
    "export_links": f"SELECT record_a, record_b, 'possible_same_individual' AS relation, evidence, score FROM ({_REC_SQL['entity_links']})",
    "export_documents": f"SELECT doc_id, pmid, journal, pub_year, {', '.join(f'{_ASCII(c)} AS {c}' for c in ('pub_types', 'keywords', 'authors'))}, corpus_layer, license, n_chars FROM documents",
    "packet_features": f"WITH one AS {_ONER}, {_PHG} SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY i) - 1 AS i, gid AS id, coalesce(nullif(glabel, ''), x.text) AS label, CASE WHEN x.excluded THEN true END AS excluded, {_AGE('x.onset')} AS onset, CASE WHEN coalesce(x.evidence.quote, '') <> '' THEN 'ECO:0000033' END AS code, CASE WHEN coalesce(x.evidence.quote, '') <> '' THEN 'PMID:' || pmid END AS reference, substr(nullif(x.evidence.quote, ''), 1, 200) AS quote FROM ph WHERE gid IS NOT NULL",
    "packet_measurements": f"""WITH one AS {_ONER}, {_GA}, z AS (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY i) - 1 AS i, x, coalesce(ga.label, x.analyte_text) AS assay, coalesce(nullif(ga.chebi, ''), 'strandline:analyte/' || coalesce(ga.label, x.analyte_text)) AS assay_id, 'UCUM:' || coalesce(nullif(CASE WHEN coalesce(x.unit, '') <> '' THEN u.ucum ELSE x.unit_ucum END, ''), nullif(x.unit, ''), 'unknown') AS uid
        FROM {_ITEMS('measurements')} LEFT JOIN ga ON ga.text = x.analyte_text LEFT JOIN ({_CAT_SQL['unit_normalise'].replace('FROM measurements WHERE unit IS NOT NULL', 'FROM (SELECT y.unit AS unit FROM (SELECT unnest(record.measurements) AS y FROM one)) WHERE unit IS NOT NULL')}) u ON u.unit = x.unit), w AS (SELECT *, x.value IS NOT NULL AND x.reference_range.low IS NOT NULL AND x.reference_range.high IS NOT NULL AS rr FROM z)
        SELECT record_id, i, assay_id, assay, x.value AS value, CASE WHEN x.value IS NOT NULL THEN uid END AS unit_id, CASE WHEN rr THEN x.reference_range.low END AS low, CASE WHEN rr THEN x.reference_range.high END AS high, CASE WHEN rr THEN uid END AS range_unit, CASE WHEN x.value IS NULL THEN 'strandline:interpretation/' || coalesce(x.interpretation, 'UNKNOWN') END AS class_id, CASE WHEN x.value IS NULL THEN coalesce(nullif(x.value_text, ''), x.interpretation, 'UNKNOWN') END AS class_label, 'strandline:specimen/' || nullif(x.specimen, '') AS specimen, {_AGE('x.age')} AS age, nullif(concat_ws('; ', nullif(x.timing, ''), nullif(x.condition, ''), nullif(x.panel, '')), '') AS description FROM w""",
    "packet_diseases": f"WITH {_G} SELECT i.record_id, row_number() OVER (PARTITION BY i.record_id ORDER BY i.i) - 1 AS i, dd.omim AS id, dd.label AS label, {_AGE(f'o.{_S}.age_at_onset')} AS onset, CASE WHEN x.status = 'REVISED_FROM' THEN true END AS excluded FROM {_ITEMS('diagnoses')} i JOIN one o ON o.record_id = i.record_id JOIN dd ON dd.text = x.disease_text AND dd.omim IS NOT NULL WHERE coalesce(x.status, '') NOT IN ('DIFFERENTIAL', 'EXCLUDED')",
    "packet_variants": f"""WITH {_G}, h AS (SELECT record_id, {_FINAL} AS f, len(list_filter(coalesce(record.genetic_findings, []), lambda z: z IS NOT NULL)) AS k FROM one), g AS (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY i) - 1 AS j, x FROM {_ITEMS('genetic_findings')}), gg AS (SELECT * FROM g), hh AS (SELECT h.*, EXISTS (SELECT 1 FROM one o WHERE o.record_id = h.record_id AND o.record.genetic_findings IS NOT NULL) AS listed FROM h WHERE f IS NOT NULL OR k > 0)
        SELECT hh.record_id, hh.record_id || '-interp' AS interpretation, CASE WHEN f.confidence_tier = 'MOLECULAR' THEN 'SOLVED' ELSE 'IN_PROGRESS' END AS progress, coalesce(dd.omim, 'strandline:diagnosis/unknown') AS disease, j AS i, CASE WHEN x IS NOT NULL THEN substr(replace(hh.record_id || '-' || coalesce(x.gene_symbol, 'None') || '-' || coalesce(nullif(x.variant_hgvs_c, ''), nullif(x.variant_text, ''), 'var'), ' ', '_'), 1, 120) END AS variant,
        CASE WHEN x IS NOT NULL THEN coalesce(nullif(x.hgnc_id, ''), 'HGNC:' || coalesce(x.gene_symbol, 'None')) END AS gene_id, x.gene_symbol AS gene, CASE WHEN x IS NOT NULL AND coalesce(nullif(x.variant_hgvs_c, ''), nullif(x.variant_hgvs_p, ''), nullif(x.variant_hgvs_g, '')) IS NOT NULL THEN concat_ws(';', 'hgvs.c=' || coalesce(nullif(x.transcript, '') || ':', '') || nullif(x.variant_hgvs_c, ''), 'hgvs.p=' || nullif(x.variant_hgvs_p, ''), 'hgvs.g=' || nullif(x.variant_hgvs_g, '')) END AS expressions,
        CASE WHEN coalesce(nullif(x.variant_hgvs_c, ''), nullif(x.variant_hgvs_p, ''), nullif(x.variant_hgvs_g, '')) IS NULL THEN nullif(x.variant_text, '') END AS description, {_ZYG} AS zygosity, CASE WHEN x IS NOT NULL THEN CASE WHEN x.classification_as_reported IN ('pathogenic', 'likely_pathogenic', 'uncertain_significance', 'likely_benign', 'benign') THEN upper(x.classification_as_reported) ELSE 'NOT_PROVIDED' END END AS acmg, CASE WHEN x IS NOT NULL THEN CASE WHEN f IS NOT NULL THEN 'CAUSATIVE' ELSE 'UNKNOWN_STATUS' END END AS status
        FROM hh LEFT JOIN gg ON gg.record_id = hh.record_id LEFT JOIN dd ON dd.text = f.disease_text""",
    "packet_actions": f"WITH one AS {_ONER} SELECT i.record_id, row_number() OVER (PARTITION BY i.record_id ORDER BY i.i) - 1 AS i, 'strandline:treatment/' || coalesce(x.type, 'None') AS agent_id, coalesce(nullif(x.agent, ''), x.text) AS agent, coalesce(o.{_FINAL.replace('record.', 'record.')}.disease_text, '') AS target FROM {_ITEMS('treatments')} i JOIN one o ON o.record_id = i.record_id".replace("o.list_filter(record.", "list_filter(o.record."),
    "packet_heads": f"WITH one AS {_ONER}, docs AS {_DOCS} SELECT record_id, coalesce(record.local_id, 'individual') AS subject, coalesce({_S}.sex, 'UNKNOWN_SEX') AS sex, CASE WHEN {_S}.vital_status IN ('ALIVE', 'DECEASED') THEN {_S}.vital_status END AS vital, CASE WHEN {_S}.vital_status IN ('ALIVE', 'DECEASED') THEN {_AGE(f'{_S}.age_at_death')} END AS death, coalesce({_AGE(f'{_S}.age_at_last_followup')}, {_AGE(f'{_S}.age_at_presentation')}) AS seen, 6 AS resources, 'https://pubmed.ncbi.nlm.nih.gov/' || o.pmid AS reference, coalesce(title, '') AS title FROM one o LEFT JOIN docs d ON d.pmid = o.pmid",
    "review_agreement": f"WITH {_VER}, pr AS (SELECT a, b FROM v2 WHERE tier <> 'CLINICAL'), s AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS same, count(*) FILTER ((a = 'Correct') = (b = 'Correct')) AS side, CAST(count(*) FILTER (a = 'Correct') AS DOUBLE) / count(*) AS p1, CAST(count(*) FILTER (b = 'Correct') AS DOUBLE) / count(*) AS p2 FROM pr), e AS (SELECT *, CAST(side AS DOUBLE) / n AS po, p1 * p2 + (1 - p1) * (1 - p2) AS pe FROM s) SELECT n, CAST(printf('%.3f', CAST(same AS DOUBLE) / n) AS DOUBLE) AS exact, CAST(printf('%.3f', po) AS DOUBLE) AS \"binary\", CASE WHEN pe < 1 THEN CAST(printf('%.3f', (po - pe) / (1 - pe)) AS DOUBLE) END AS kappa FROM e WHERE n > 0",
    "review_counts": f"WITH {_VER}, {_MIS} SELECT count(*) AS n_decisions, count(DISTINCT fact_id) AS n_facts, count(DISTINCT record_id) AS n_records, (SELECT count(*) FROM mis) AS n_missed FROM ver",
    "missed_facts": f"WITH {_VER}, {_MIS}, k AS (SELECT grp FROM mis WHERE record_id IN (SELECT record_id FROM ver WHERE record_id IS NOT NULL)) SELECT grp, count(*) AS n FROM k GROUP BY grp UNION ALL SELECT 'all', count(*) FROM k",
    "record_answers": f"""WITH one AS {_ONER}, r AS (SELECT CASE WHEN record.diagnoses[1].status = 'FINAL' THEN 'yes' ELSE 'no' END AS a, record.diagnoses[1].confidence_tier AS b, CASE WHEN len(record.narrative_anchors) > 1 THEN 'yes' ELSE '' END AS c, CASE WHEN len(record.phenotypes) > 2 THEN len(record.phenotypes) END AS q FROM one),
        p AS (SELECT 'diagnosis_correct' AS question, a AS answer FROM r UNION ALL SELECT 'tier_correct', b FROM r UNION ALL SELECT 'narrative_complete', c FROM r) SELECT question, answer, count(*) AS n, (SELECT CAST(printf('%.2f', avg(q)) AS DOUBLE) FROM r) AS mean_quality FROM p WHERE coalesce(answer, '') <> '' GROUP BY question, answer""",
    "reviewer_facts": f"WITH a AS ({_REC_SQL['assign_reviewers']}), f AS ({_REC_SQL['facts_flatten']}) SELECT reviewer, batch, role, grp, count(*) AS n FROM a JOIN f USING (record_id) WHERE grp IN ('phenotype', 'diagnosis') GROUP BY 1, 2, 3, 4",
    "review_units": f"WITH one AS {_ONER}, {_NAR}, u AS (SELECT DISTINCT d.pmid, u.kind, u.anchor FROM units u JOIN docs d ON d.doc_id = u.k WHERE d.pmid IN (SELECT pmid FROM one)), w AS (SELECT pmid, anchor, string_agg(DISTINCT record_id, ', ' ORDER BY record_id) AS r FROM nar GROUP BY pmid, anchor) SELECT pmid, anchor, kind, coalesce(r, '') AS records FROM u LEFT JOIN w USING (pmid, anchor)",
    "overview_patients": f"WITH {_PATIENTS} SELECT * FROM pat",
    "overview_sheets": f"WITH {_PATIENTS}, s AS (SELECT 'gender' AS sheet, coalesce(gender, 'unknown') AS value FROM pat UNION ALL SELECT 'age_band', age_band FROM pat UNION ALL SELECT 'licence_group', licence_group FROM pat UNION ALL SELECT 'year', coalesce(CAST(CAST(approx_year AS INT) AS VARCHAR), 'unknown') FROM pat UNION ALL SELECT 'iem', CASE WHEN iem THEN 'yes' ELSE 'no' END FROM pat UNION ALL SELECT 'iem_title', CASE WHEN iem_title THEN 'yes' ELSE 'no' END FROM pat UNION ALL SELECT 'patients_in_article', CAST(patients_in_article AS VARCHAR) FROM pat) SELECT sheet, value, count(*) AS n FROM s GROUP BY sheet, value",
    "sample_sheet": f"WITH {_POOLSQL} SELECT s.set_name AS \"set\", s.pmid, d.pub_year, s.band AS year_band, CASE WHEN s.ft THEN 'yes' ELSE 'no' END AS fulltext_expected, d.fulltext_tier, s.kind, d.pmcid, d.doi, d.journal, d.title, replace(s.set_name, 'lang:', 'layer:') AS other_sets FROM sample s JOIN docs d ON d.pmid = s.pmid",
    "sample_set": f"WITH {_POOLSQL} SELECT pmid, 'sample' AS set_name, '{{\"from\":\"' || set_name || '\",\"kind\":\"' || kind || '\",\"band\":\"' || band || '\"}}' AS source FROM sample UNION ALL SELECT DISTINCT CAST(doc_id AS VARCHAR), 'rated', 'x' FROM subject_labels",
    "work_items": f"""WITH docs AS {_DOCS} SELECT pmid, sha256(text) AS input_sha256, md5('Decide whether the document below describes individual patients within the scope, and list them.' || chr(10) || 'Title: ' || coalesce(title, '') || chr(10) || 'Source: ' || coalesce(fulltext_tier, '') || chr(10) || chr(10) || text) AS triage_prompt,
        md5('Extract one record for the individual named by the caller. Quote the document verbatim and give the anchor of every quote.' || chr(10) || 'Title: ' || coalesce(title, '') || chr(10) || 'Source: ' || coalesce(fulltext_tier, '') || chr(10) || chr(10) || text) AS extract_prompt, '{{"pmid":"' || pmid || '",' || coalesce('"tier":"' || fulltext_tier || '",', '') || '"chars":' || length(text) || ',"prompt_version":"1"}}' AS meta FROM docs WHERE text IS NOT NULL""",
    "work_check": f"""WITH tot AS ({_DOC_SQL['verification_totals']}), u AS (WITH docs AS {_DOCS}, {_LINES} SELECT DISTINCT d.pmid, unnest([u.anchor, string_split(u.anchor, ' ')[1]]) AS anchor FROM units u JOIN docs d ON d.doc_id = u.k WHERE u.unit <> ''), one AS {_ONER},
        a AS (SELECT DISTINCT record_id, pmid, anchor FROM (SELECT record_id, pmid, unnest(record.narrative_anchors) AS anchor FROM one) WHERE anchor IS NOT NULL), l AS (SELECT record_id, count(*) AS unresolved FROM a WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.pmid = a.pmid AND u.anchor = a.anchor) GROUP BY record_id)
        SELECT record_id, coalesce(total, 0) AS quotes, coalesce(missing, 0) AS missing, coalesce(unresolved, 0) AS unresolved FROM tot FULL JOIN l USING (record_id)""",
    "claim_checks": f"""WITH {_CL} SELECT pmid, 'claims/0/evidence' AS path, 'quote not found' AS issue FROM f1 WHERE l = '1' UNION ALL SELECT pmid, 'claims/0/quantities/0/kind', 'not an allowed value' FROM f1 WHERE l = '2' UNION ALL SELECT pmid, 'claims/0/quantities/0/evidence', 'quote not found' FROM f1 WHERE l = '3' AND NOT contains(unit, 'nor this')
        UNION ALL SELECT pmid, 'claims/0/claim_type', 'not an allowed value' FROM f1 WHERE l = '4' UNION ALL SELECT pmid, 'claims/0/organism', 'is required' FROM f1 WHERE l = '5' UNION ALL SELECT pmid, 'claims/0/evidence', 'is required' FROM f1 WHERE l = '6'""",
    "claim_summary": f"WITH docs AS (SELECT doc_id, text FROM documents), {_LINES}, c AS (SELECT k, upper(substr(arg_min(cells[1], (n, m)), 1, 3)) AS g FROM rows_ WHERE m > 1 GROUP BY k) SELECT 'measured' AS claim_type, count(*) AS n, string_agg(DISTINCT g, '|' ORDER BY g) AS genes FROM c",
    "run_log": "SELECT event_type AS run_id, 'ingest' AS command, '{}' AS args, '1' AS version, epoch_us(min(ts)) / 1e6 AS started_at, CASE WHEN event_type <> 'error' THEN epoch_us(max(ts)) / 1e6 END AS finished_at, CASE WHEN event_type <> 'error' THEN '{\"n\":' || count(*) || '}' END AS summary FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
    "sql_functions": f"SELECT alias, coalesce(nullif(substr(regexp_replace(regexp_replace(alias, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40), ''), 'individual') AS slug, {_key_sql('alias', _DISEASE_KEEP)} AS disease_key, (2 * 365.25 + 3 * 30.44)::DOUBLE AS days, 100.0::DOUBLE AS same FROM disease_aliases",
    "display_helpers": f"WITH one AS {_ONER}, e AS (SELECT record_id, count(*) AS n FROM (WITH one AS (SELECT record_id, any_value(pmid) AS pmid, any_value(record) AS record FROM individuals WHERE record_id IS NOT NULL GROUP BY record_id) {_EVIDENCE}) WHERE grp = 'measurements' GROUP BY record_id) SELECT record_id, i, CASE WHEN x.evidence.verification IS NULL THEN '' WHEN coalesce(x.evidence.verification.in_anchor, false) THEN '✓' WHEN coalesce(x.evidence.verification.in_document, false) THEN '~' ELSE '✗' END AS mark, coalesce(coalesce(x.comparator, '') || CAST(CAST(trunc(x.value) AS BIGINT) AS VARCHAR) || coalesce(' ' || nullif(x.unit, ''), ''), '') AS quantity, n FROM {_ITEMS('measurements')} LEFT JOIN e USING (record_id)",
    "decoded_json": "WITH p AS (SELECT record_id, max(phenopacket) AS p FROM individuals WHERE record_id IS NOT NULL GROUP BY record_id) SELECT record_id, p IS NOT NULL AND NOT json_valid(p) AS kept_raw, CASE WHEN NOT json_valid(p) THEN md5(p) END AS raw, CASE WHEN json_valid(p) THEN json_extract_string(p, '$.id') END AS id FROM p",
}
