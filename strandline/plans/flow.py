"""Queries on harvesting, remote sources, grounding cascades and ingest, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import anchors, grounding, harvest, ingest, schema_check
from ..session import table as t
from ..sources import fulltext, remote, xml
from .catalogue import SQL as _CAT_SQL, _DISEASE_KEEP, _key_sql
from .documents import SQL as _DOC_SQL, _DOCS, _docs, _records

STUB = "strandline.sources.stub"
FAST = 1e9  # requests per second of the stub


# -- harvest ---------------------------------------------------------------------------------------------------------
def _terms(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "disease_aliases").where(harvest.lag_term(F.col("alias")))
    return a.select(F.lower(F.trim("alias")).alias("term"), F.col("omim").alias("id")).distinct()


def _tag_texts(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select(F.col("doc_id").alias("key"), harvest.tag_text(F.col("title"), F.col("abstract"), F.col("keywords")).alias("text"))


def hit_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many documents each disease's query hits in title, abstract and keywords."""
    return harvest.count(_tag_texts(spark, d), _terms(spark, d)).select(F.col("id").alias("omim"), "n")


def _seeded(spark: SparkSession, d: str) -> DataFrame:
    s = harvest.seed(_tag_texts(spark, d), _terms(spark, d)).withColumnRenamed("key", "doc_id")
    return s.join(t(spark, d, "documents").select("doc_id", "pmid"), "doc_id").where("pmid is not null")


def seed_harvest(spark: SparkSession, d: str) -> DataFrame:
    """The seed layer: per-disease results as one table of distinct tags (paper, set)."""
    rated = t(spark, d, "subject_labels").join(t(spark, d, "documents").select("doc_id", "pmid"), "doc_id").where("pmid is not null").select("pmid", F.concat(F.lit("subject:"), "subject").alias("set_name"))
    return harvest.union([_seeded(spark, d).select("pmid", F.concat(F.lit("disease:"), "id").alias("set_name")), rated], ["pmid", "set_name"])


def lag_harvest(spark: SparkSession, d: str) -> DataFrame:
    """Papers on genetics entered in the last 20 years before 2026 that the disease seed does not hold."""
    low = F.regexp_replace(harvest.years_back(F.lit("2026-01-01").cast("date"), 20), "/", "-")
    x = _docs(spark, d, "pmid", "edat", "keywords").where(F.array_contains("keywords", "genetics"))
    return harvest.lag(x, _seeded(spark, d), (F.col("edat") >= low) & harvest.entry_window(F.col("edat"), "1900", "2025")).select("pmid", "edat")


def recall_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Papers on metabolism that the first two layers do not hold."""
    x = _docs(spark, d, "pmid", "corpus_layer", "keywords")
    return harvest.not_in_catalogue(x.where(F.array_contains("keywords", "metabolism")).select("pmid"), x.where("corpus_layer in ('A_seed', 'A_lag')"))


def entry_years(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "documents").where(harvest.entry_window(F.col("edat"), "2000-06", "2015"))
    return x.groupBy(F.substring("edat", 1, 4).alias("year")).agg(F.count("*").alias("n"))


def term_eligibility(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "disease_aliases").select("alias").distinct()
    return a.select("alias", harvest.lag_term(F.col("alias")).alias("lag"), harvest.recall_term(F.col("alias")).alias("recall"), harvest.gene_term(F.col("alias")).alias("gene"))


def not_enriched(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "documents").withColumn("in_epmc", F.when(F.col("is_open_access").isNotNull(), 1))
    return harvest.not_enriched(x).select("doc_id", "pmid")


def prefixed_sets(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "subject_labels").select(F.concat(F.lit("Subject:"), "subject").alias("set_name"), "doc_id")
    return harvest.of_prefix(x, "sUBJECT:n").groupBy("set_name").agg(F.countDistinct("doc_id").alias("n"))


def first_harvested(spark: SparkSession, d: str) -> DataFrame:
    """A limited harvest: the first fifty rows by time of arrival."""
    return harvest.first_few(t(spark, d, "documents").where("added_at is not null").select("doc_id", "added_at"), [F.col("added_at"), F.col("doc_id")], 50)


def terms_in_order(spark: SparkSession, d: str) -> DataFrame:
    return harvest.sorted_terms(t(spark, d, "disease_aliases").select(F.col("alias").alias("term")))


def tag_texts(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "documents")
    return x.select("doc_id", F.md5(harvest.tag_text(F.col("title"), F.col("abstract"), F.col("keywords"), F.transform("pub_types", F.upper))).alias("digest"))


def scope_build(spark: SparkSession, d: str) -> DataFrame:
    """A scope over the alias list: diseases of even numbers with the genes of their cross-references."""
    a = t(spark, d, "disease_aliases").where("omim is not null")
    nodes = a.groupBy(F.col("omim").alias("id")).agg(F.min("alias").alias("label"), F.array_sort(F.collect_set("alias")).alias("exact"), F.array(F.first("omim")).alias("omim"), F.array(F.concat(F.lit("Orphanet:"), F.substring(F.first("omim"), -3, 3))).alias("orphanet"))
    nodes = nodes.withColumn("definition", F.lit(None).cast("string"))
    genes = a.select(F.col("omim").alias("disease_id"), F.array(F.upper(F.substring("alias", 1, 3))).alias("genes")).unionByName(a.select(F.concat(F.lit("ORPHA:"), F.substring("omim", -3, 3)).alias("disease_id"), F.array(F.lit("SHARED")).alias("genes")))
    inside = nodes.where("cast(right(id, 1) as int) % 2 = 0").select("id")
    return harvest.scope_build(inside, nodes, genes).select("id", "label", F.array_join("genes", "|").alias("genes"))


# -- remote sources (a stub stands for the network) -------------------------------------------------------------------
def history_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a search kept at the server, planned from its hit count, in two tasks."""
    remote.register(spark)
    r = lambda **o: spark.read.format("citation_history").options(transport=f"{STUB}:citations", term="x", tasks="2", rate="1000", **o).load()
    return r().select(F.lit("all").alias("window"), "start", "xml").unionByName(r(mindate="2000", maxdate="2012").select(F.lit("2000-2012").alias("window"), "start", "xml"))


def cursor_results(spark: SparkSession, d: str) -> DataFrame:
    remote.register(spark)
    return spark.read.format("cursor_search").options(transport=f"{STUB}:search", query="x", rate="1000").load().select("page", F.get_json_object("result", "$.id").alias("id"))


def fetched_ids(spark: SparkSession, d: str) -> DataFrame:
    """Pages and identifiers of a fetch by id list."""
    x = remote.fetch_ids(t(spark, d, "documents"), f"{STUB}:citations", rate=FAST)
    return x.agg(F.sum("n_ids").alias("ids"), F.sum(F.regexp_extract("xml", r"ids='(\d+)'", 1).cast("bigint")).alias("answered"), F.max("n_ids").cast("bigint").alias("page"), F.count("error").alias("errors"))


def enrichment_facts(spark: SparkSession, d: str) -> DataFrame:
    return remote.enrichment_lookup(t(spark, d, "documents"), f"{STUB}:search", rate=FAST)


def _needy(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d, "pmid", "pmcid", "doi").select("pmid", "pmcid", F.when(F.col("doi").isNotNull(), F.concat(F.element_at(F.array(*map(F.lit, ("10.1016", "10.1002", "10.1007", "10.9999"))), (F.col("doc_id") % 4 + 1).cast("int")), F.lit("/"), F.col("doi"))).alias("doi"), (F.col("doc_id") % 3 == 0).alias("has_suppl"))


def fulltext_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Every attempt at a full text, tier after tier, until one succeeds."""
    a = fulltext.fetch_tiers(_needy(spark, d), f"{STUB}:texts", tasks=4, rate=FAST)
    return a.select("pmid", "tier", "ok", "name", "status", "supplement_files")


def fulltext_statistics(spark: SparkSession, d: str) -> DataFrame:
    s = fulltext.statistics(fulltext_attempts(spark, d))
    return s.select("tier", "tried", "ok", F.array_join("statuses", "|").alias("statuses"))


def best_representations(spark: SparkSession, d: str) -> DataFrame:
    """Which stored file stands for each paper, and its tier."""
    n = F.explode(F.filter(F.array(*[F.when(F.pmod(F.col("doc_id"), F.lit(k)) == 0, F.lit(v)) for k, v in ((2, "wiley.pdf"), (3, "unpaywall.html"), (5, "springer.xml"), (7, "epmc.xml"), (11, "unpaywall.pdf"))]), lambda x: x.isNotNull()))
    files = t(spark, d, "documents").where("pmid is not null").select("pmid", n.alias("name")).withColumn("path", F.concat_ws("/", "pmid", "name"))
    return xml.best_representation(files, t(spark, d, "documents").where("pmid is not null"))


def loaded_documents(spark: SparkSession, d: str) -> DataFrame:
    """Parsed articles filled from the catalogue; the others stand as title and abstract."""
    x = _docs(spark, d, "pmid", "title", "abstract", "journal", "license", "fulltext_tier")
    docs = x.select("pmid", "title", "abstract", F.create_map(F.lit("journal"), "journal", F.lit("license"), "license").alias("meta"))
    sec = F.array(F.struct(F.lit("S").alias("title"), F.lit(1).alias("depth"), F.array(F.lit("p")).alias("paragraphs")))
    parsed = x.where("fulltext_tier = 'epmc'").select(
        F.col("pmid").alias("key"), F.when(F.length("pmid") % 2 == 0, "").otherwise(F.lit("Own title")).alias("title"), F.lit("").alias("abstract"), sec.alias("sections"), F.array().cast(xml._TABLES).alias("tables"),
        F.create_map(F.lit("journal"), F.lit(""), F.lit("license"), F.lit("own")).alias("meta"), F.lit("epmc").alias("tier"),
    )
    return xml.load_documents(parsed, docs).select("pmid", F.md5("title").alias("title"), F.md5("abstract").alias("abstract"), F.size("sections").cast("bigint").alias("n_sections"), F.col("meta")["journal"].alias("journal"), F.col("meta")["license"].alias("license"), "tier")


def imported_pmcids(spark: SparkSession, d: str) -> DataFrame:
    """Imported articles find their paper by pmcid; those of unknown papers are left."""
    c = _docs(spark, d, "pmid", "pmcid").where("pmcid is not null")
    new = t(spark, d, "documents").where("pmcid is not null").select("pmcid").distinct().unionByName(spark.createDataFrame([("PMC1",)], "pmcid string"))
    return new.join(c, "pmcid").select("pmcid", "pmid")


# -- grounding cascades ----------------------------------------------------------------------------------------------
def _phenotypes(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "individuals").select(F.explode("record.phenotypes").alias("x")).where("x is not null and x.text is not null").select("x.text", "x.hpo_id", "x.hpo_label")


def _phenotype_names(spark: SparkSession, d: str) -> DataFrame:
    """The phenotypes that records name with an identifier, and a made-up synonym of each, stand for the ontology."""
    p = _phenotypes(spark, d).where("hpo_id is not null and hpo_label is not null").groupBy(F.col("hpo_id").alias("id")).agg(F.min("hpo_label").alias("label"))
    return p.select(F.col("label").alias("name"), "id", "label", F.lit(0).alias("prio")).unionByName(p.select(F.concat(F.lit("sign of "), "label").alias("name"), "id", "label", F.lit(2).alias("prio")))


def _phenotype_texts(spark: SparkSession, d: str) -> DataFrame:
    p = _phenotypes(spark, d)
    none = F.lit(None).cast("string").alias("supplied")
    return p.select("text", F.col("hpo_id").alias("supplied")).unionByName(p.select(F.upper("text").alias("text"), none)).unionByName(p.select(F.concat(F.lit("Sign of "), "text").alias("text"), none)).distinct()


def ground_phenotypes(spark: SparkSession, d: str) -> DataFrame:
    return grounding.ground_phenotypes(_phenotype_texts(spark, d), _phenotype_names(spark, d), fuzzy_tier=False).drop("candidates")


def ground_phenotypes_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """The whole cascade over texts with an extra word or a lost letter."""
    x = _phenotypes(spark, d).select(F.explode(F.array(F.concat("text", F.lit(" today")), F.expr("substring(text, 2)"))).alias("text"), F.lit(None).cast("string").alias("supplied")).distinct()
    return grounding.ground_phenotypes(x, _phenotype_names(spark, d))


def _disease_ontology(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    a = t(spark, d, "disease_aliases").where("alias is not null and omim is not null").withColumn("id", F.regexp_replace("omim", "^OMIM:", "MONDO:0"))
    label = a.groupBy("id").agg(F.min("alias").alias("label"))
    names = a.join(label, "id").select(F.col("alias").alias("name"), "id", "label", F.when(F.col("alias") == F.col("label"), 0).otherwise(1).alias("prio"))
    return names, a.select("id", F.col("omim").alias("xref")).distinct(), a.where("length(alias) % 2 = 0").select("alias", "omim")


def _disease_texts(spark: SparkSession, d: str) -> DataFrame:
    """Typed diseases; the labels themselves come with a supplied number."""
    none = F.lit(None).cast("string")
    typed = t(spark, d, "diagnoses").where("disease_text is not null").select(F.col("disease_text").alias("text"), none.alias("mondo"), none.alias("omim"), none.alias("orphanet"))
    label = t(spark, d, "disease_aliases").groupBy("omim").agg(F.min("alias").alias("text")).select("text", none.alias("mondo"), "omim", none.alias("orphanet"))
    return typed.unionByName(label).distinct()


def ground_disease_names(spark: SparkSession, d: str) -> DataFrame:
    return grounding.ground_disease_names(_disease_texts(spark, d), *_disease_ontology(spark, d), fuzzy_tier=False).select("text", F.col("omim").alias("supplied"), "id", "label", "status", "confidence", "method", "id_omim")


def ground_disease_names_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    return grounding.ground_disease_names(_disease_texts(spark, d), *_disease_ontology(spark, d))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "analytes_builtin").select("label", F.filter(F.split(F.coalesce("synonyms", F.lit("")), r"\|"), lambda x: x != "").alias("synonyms"), "chebi", "vmh")


def ground_analyte_names(spark: SparkSession, d: str) -> DataFrame:
    """All tiers but the fuzzy one, with identifiers."""
    x = t(spark, d, "measurements").where("analyte_text is not null").select(F.col("analyte_text").alias("text"), F.lit(None).cast("string").alias("chebi"))
    return grounding.ground_analyte_names(x, _entries(spark, d), fuzzy_tier=False).select("text", "label", "chebi", "vmh", "status", "confidence")


def _grounded(spark: SparkSession, d: str, *parts: str) -> DataFrame:
    """Every record once, with the answers of the cascades (fuzzy tiers left out) put back into its arrays; `parts` names the arrays
    that are wanted (all by default)."""
    r = _records(spark, d)
    none = F.lit(None).cast("string")
    texts = lambda field, *cols: r.select(F.explode(f"record.{field}").alias("x")).where("x is not null").select(*cols)
    answers: dict = {}
    if not parts or "phenotypes" in parts:
        answers["phenotypes"] = grounding.ground_phenotypes(texts("phenotypes", "x.text", F.col("x.hpo_id").alias("supplied")), _phenotype_names(spark, d), False)
    if not parts or "measurements" in parts:
        answers["analytes"] = grounding.ground_analyte_names(texts("measurements", F.col("x.analyte_text").alias("text"), none.alias("chebi")), _entries(spark, d), False)
    if not parts or "diagnoses" in parts:
        dx = texts("diagnoses", F.col("x.disease_text").alias("text"), *[none.alias(c) for c in ("mondo", "omim", "orphanet")])
        answers["diseases"] = grounding.ground_disease_names(dx, *_disease_ontology(spark, d), False)
    return ingest.ground_records(r, **answers)


def record_grounding(spark: SparkSession, d: str) -> DataFrame:
    """What grounding put into every record: phenotype, analyte and disease identifiers in order, `-` for none."""
    g = _grounded(spark, d)
    ids = lambda c, f: F.coalesce(F.array_join(F.transform(F.filter(F.col(c), lambda x: x.isNotNull()), f), "|", "-"), F.lit(""))
    return g.select("record_id", ids("record.phenotypes", lambda x: x["hpo_id"]).alias("phenotypes"), ids("record.measurements", lambda x: x["analyte"]["label"]).alias("analytes"), ids("record.diagnoses", lambda x: x["disease"]["omim"]).alias("diseases"), ids("record.diagnoses", lambda x: x["grounding"]["status"]).alias("states"))


# -- ingest ----------------------------------------------------------------------------------------------------------
def _manifest_texts(spark: SparkSession, d: str) -> DataFrame:
    """A manifest per paper, made from its individuals: some papers out of scope, some individuals unaffected or left out."""
    p = t(spark, d, "individuals").where("pmid is not null and local_id is not null").select("pmid", "local_id").distinct()
    last = F.substring("pmid", -1, 1)
    n = F.substring("local_id", -1, 1)
    one = F.struct(
        "local_id", F.when(last != "7", F.array(F.lit("sec:2"))).alias("where"), F.concat(F.lit("F"), n).alias("family_id"), F.when(n == "2", False).when(n == "1", F.lit(None)).otherwise(True).alias("is_affected"),
        F.when(last == "5", "unheard_of").otherwise("typical_presentation").alias("case_type"), F.lit("stated").alias("case_type_reason"), (n == "3").alias("is_rereport"),
    )
    g = p.groupBy("pmid").agg(F.array_sort(F.collect_list(F.when(n != "9", one))).alias("individuals"))
    m = F.struct((last != "3").alias("in_scope"), F.when(last == "4", "odd").otherwise("case_report").alias("document_type"), F.when(last != "6", F.lit("made up")).alias("reasons"), "individuals")
    return g.select("pmid", F.to_json(m).alias("payload"))


def triage_rows(spark: SparkSession, d: str) -> DataFrame:
    x = ingest.triage(ingest.manifests(_manifest_texts(spark, d)))
    return x.select("pmid", "in_scope", "n_individuals", F.array_join("individual_ids", "|").alias("individual_ids"), "is_rereport", "document_type", "reasons")


def manifest_issues(spark: SparkSession, d: str) -> DataFrame:
    m = ingest.manifests(_manifest_texts(spark, d)).where("readable")
    return m.select("pmid", F.explode(schema_check.manifest_issues(F.col("m"))).alias("i")).select("pmid", "i.severity", "i.path", "i.msg")


def ingest_provenance(spark: SparkSession, d: str) -> DataFrame:
    """Records of papers in scope with the source and triage blocks they get."""
    sets = t(spark, d, "subject_labels").join(t(spark, d, "documents").select("doc_id", "pmid"), "doc_id").select("pmid", F.col("subject").alias("set_name"))
    x = ingest.provenance(ingest.admitted(_records(spark, d).select("record_id", "pmid", "local_id"), ingest.manifests(_manifest_texts(spark, d))), _docs(spark, d, "pmid", "pmcid", "doi", "title", "journal", "pub_year", "license", "fulltext_tier", "text"), sets)
    return x.select("record_id", "_source.pmcid", "_source.year", "_source.tier", "_source.input_sha256", F.array_join("_source.sets", "|").alias("sets"), "_triage.document_type", "_triage.case_type", "_triage.is_rereport", "_triage.family_id")


def ingest_issues(spark: SparkSession, d: str) -> DataFrame:
    """Quotes that are nowhere in the document, and records without a narrative."""
    from .documents import verification_totals

    r = _records(spark, d)
    u = anchors.units(_docs(spark, d, "pmid", "text").select("pmid", "text"))
    n = anchors.narratives(r.select("record_id", "pmid", F.explode("record.narrative_anchors").alias("anchor")), u)
    return ingest.evidence_issues(r, verification_totals(spark, d), n)


def ingest_statistics(spark: SparkSession, d: str) -> DataFrame:
    m = ingest.manifests(_manifest_texts(spark, d))
    r = ingest.admitted(_records(spark, d).select("record_id", "pmid", "local_id", (F.coalesce("valid", F.lit(0)) == 1).alias("valid")), m)
    return ingest.statistics(ingest.triage(m), r)


def schema_issues(spark: SparkSession, d: str) -> DataFrame:
    x = _records(spark, d).select("record_id", F.explode(schema_check.record_issues(F.col("record"))).alias("i"))
    return x.groupBy(F.regexp_replace("i.path", r"/\d+/", "/*/").alias("path"), F.col("i.msg").alias("msg")).agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("n_records"))


def unknown_phenotypes(spark: SparkSession, d: str) -> DataFrame:
    """Phenotype identifiers that the ontology (here: every second identifier in use) does not hold."""
    r = _records(spark, d).select("record_id", "record.phenotypes")
    used = r.select("record_id", F.explode("phenotypes").alias("x")).where("x.hpo_id is not null").select("record_id", F.col("x.hpo_id").alias("id")).distinct()
    terms = used.select("id").distinct().where("cast(right(id, 1) as int) % 2 = 0")
    known = used.join(terms, "id").groupBy("record_id").agg(F.collect_set("id").alias("known"))
    x = r.join(known, "record_id", "left").select("record_id", F.explode(schema_check.unknown_terms(F.col("phenotypes"), F.coalesce("known", F.array().cast("array<string>")))).alias("i"))
    return x.select("record_id", "i.severity", "i.path", "i.msg")


QUERIES = {f.__name__: f for f in (
    hit_counts, seed_harvest, lag_harvest, recall_candidates, entry_years, term_eligibility, not_enriched, prefixed_sets, first_harvested, terms_in_order, tag_texts, scope_build, history_pages, cursor_results, fetched_ids, enrichment_facts,
    fulltext_attempts, fulltext_statistics, best_representations, loaded_documents, imported_pmcids, ground_phenotypes, ground_phenotypes_fuzzy, ground_disease_names, ground_disease_names_fuzzy, ground_analyte_names, record_grounding,
    triage_rows, manifest_issues, ingest_provenance, ingest_issues, ingest_statistics, schema_issues, unknown_phenotypes,
)}

# -- SQL -------------------------------------------------------------------------------------------------------------
_HITS = r"""terms AS (SELECT DISTINCT lower(trim(alias, ' ')) AS term, omim FROM disease_aliases WHERE length(alias) >= 8 AND NOT regexp_matches(alias, '[()\[\]":*?]')),
    texts AS (SELECT doc_id, pmid, lower(concat_ws(chr(10), nullif(title, ''), nullif(abstract, ''), nullif(array_to_string(keywords, chr(10)), ''))) AS t FROM documents),
    hits AS (SELECT DISTINCT doc_id, pmid, omim FROM texts, terms WHERE contains(t, term) AND regexp_matches(t, '(^|[^a-z0-9])' || regexp_escape(term) || '($|[^a-z0-9])'))"""
_PH = 'p AS (SELECT x."text" AS text, x.hpo_id AS id, x.hpo_label AS label FROM (SELECT unnest(record.phenotypes) AS x FROM individuals) WHERE x IS NOT NULL AND x."text" IS NOT NULL), lab AS (SELECT id, min(label) AS label FROM p WHERE id IS NOT NULL AND label IS NOT NULL GROUP BY id)'
_PKEEP = r"a-z0-9 \-/"
_ONTO = f"""al AS (SELECT alias, omim, replace(omim, 'OMIM:', 'MONDO:0') AS id FROM disease_aliases WHERE alias IS NOT NULL AND omim IS NOT NULL), lb AS (SELECT id, min(alias) AS label, min(omim) AS omim FROM al GROUP BY id),
    ex AS (SELECT key, arg_min(id, (prio, id)) AS id FROM (SELECT al.id, CASE WHEN alias = label THEN 0 ELSE 1 END AS prio, {_key_sql('alias', _DISEASE_KEEP)} AS key FROM al JOIN lb USING (id)) WHERE key <> '' GROUP BY key),
    cu AS (SELECT key, min(omim) AS omim FROM (SELECT omim, {_key_sql('alias', _DISEASE_KEEP)} AS key FROM al WHERE length(alias) % 2 = 0) WHERE key <> '' GROUP BY key)"""
_DKEY = _key_sql("regexp_replace(text, '\\((?:OMIM|MIM|ORPHA)[^)]*\\)', '', 'g')", _DISEASE_KEEP)
_DGROUND = f"""dk AS (SELECT text, supplied, 'OMIM:' || nullif(regexp_extract(text, '(?:OMIM|MIM)\\s*[#*:]?\\s*(\\d{{6}})', 1), '') AS given, {_DKEY} AS key FROM dtexts),
    dg AS (SELECT dk.text, dk.supplied, coalesce(s.id, g.id, ca.id, ex.id) AS id, CASE WHEN s.id IS NOT NULL OR g.id IS NOT NULL THEN 0.9 WHEN ca.id IS NOT NULL OR ex.id IS NOT NULL THEN 0.95 END::DOUBLE AS confidence,
           CASE WHEN s.id IS NOT NULL THEN 'supplied omim' WHEN g.id IS NOT NULL THEN 'omim-in-text' WHEN ca.id IS NOT NULL THEN 'alias' WHEN ex.id IS NOT NULL THEN 'exact' ELSE 'fuzzy' END AS method
           FROM dk LEFT JOIN lb s ON s.omim = dk.supplied LEFT JOIN lb g ON g.omim = dk.given LEFT JOIN cu ON cu.key = dk.key LEFT JOIN lb ca ON ca.omim = cu.omim LEFT JOIN ex ON ex.key = dk.key)"""
_MAN = """ppl AS (SELECT DISTINCT pmid, local_id, right(pmid, 1) AS l, right(local_id, 1) AS n FROM individuals WHERE pmid IS NOT NULL AND local_id IS NOT NULL), man AS (SELECT pmid, l, l <> '3' AS in_scope, CASE WHEN l = '4' THEN 'odd' ELSE 'case_report' END AS document_type FROM ppl GROUP BY pmid, l),
    ent AS (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY local_id) - 1 AS i FROM ppl WHERE n <> '9')"""
_ONER = "(SELECT * FROM individuals WHERE record_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY extracted_at) = 1)"
_NEED = "need AS (SELECT pmid, pmcid, CASE WHEN doi IS NOT NULL THEN ['10.1016', '10.1002', '10.1007', '10.9999'][doc_id % 4 + 1] || '/' || doi END AS doi, doc_id % 3 = 0 AS suppl, doc_id % 4 AS h FROM docs)"
_ATTEMPTS = f"""docs AS {_DOCS}, {_NEED},
    t1 AS (SELECT *, 'epmc' AS tier, coalesce(right(pmcid, 1) IN ('0', '1', '2', '3'), false) AS ok, CASE WHEN pmcid IS NULL THEN 'no pmcid' WHEN right(pmcid, 1) IN ('0', '1', '2', '3') THEN 'ok' ELSE 'http 404' END AS status, CASE WHEN coalesce(right(pmcid, 1) IN ('0', '1', '2', '3'), false) THEN 'epmc.xml' END AS name, CASE WHEN suppl AND coalesce(right(pmcid, 1) IN ('0', '1'), false) THEN 2 ELSE 0 END AS files FROM need),
    t2 AS (SELECT * REPLACE ('pmc' AS tier, coalesce(right(pmcid, 1) IN ('4', '5'), false) AS ok, CASE WHEN pmcid IS NULL THEN 'no pmcid' WHEN right(pmcid, 1) = '9' THEN 'http 500' WHEN right(pmcid, 1) IN ('4', '5') THEN 'ok' ELSE 'no body' END AS status, CASE WHEN coalesce(right(pmcid, 1) IN ('4', '5'), false) THEN 'epmc.xml' END AS name, 0 AS files) FROM t1 WHERE NOT ok),
    t3 AS (SELECT * REPLACE ('unpaywall' AS tier, coalesce(right(doi, 1) IN ('0', '2', '4', '6'), false) AS ok, CASE WHEN doi IS NULL THEN 'no doi' WHEN right(doi, 1) IN ('0', '2', '4', '6') THEN 'ok' ELSE 'no open location' END AS status, CASE WHEN right(doi, 1) IN ('0', '2') THEN 'unpaywall.pdf' WHEN right(doi, 1) IN ('4', '6') THEN 'unpaywall.html' END AS name) FROM t2 WHERE NOT ok),
    t4 AS (SELECT * REPLACE ('publisher' AS tier, coalesce(h < 3 AND right(doi, 1) IN ('1', '2', '3'), false) AS ok, CASE WHEN doi IS NULL OR h = 3 THEN 'no publisher interface' WHEN right(doi, 1) IN ('1', '2', '3') THEN 'ok' ELSE 'http 403' END AS status, CASE WHEN h < 3 AND right(doi, 1) IN ('1', '2', '3') THEN ['elsevier.xml', 'wiley.pdf', 'springer.xml'][h + 1] END AS name) FROM t3 WHERE NOT ok),
    att AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3 UNION ALL SELECT * FROM t4)"""


def _schema_sql() -> str:
    """Written out from the published schema, apart from the operator's tables."""
    need = {"phenotypes": "text excluded evidence", "measurements": "analyte_text specimen interpretation evidence", "genetic_findings": "gene_symbol evidence", "diagnoses": "disease_text status confidence_tier evidence", "treatments": "text type evidence"}
    closed = {
        "measurements": {"specimen": "plasma serum blood dried_blood_spot urine csf fibroblasts leukocytes liver muscle amniotic_fluid other unknown", "comparator": "< <= > >= ~", "interpretation": "HIGH LOW NORMAL ABNORMAL UNKNOWN"},
        "genetic_findings": {"zygosity": "HOMOZYGOUS HETEROZYGOUS COMPOUND_HETEROZYGOUS HEMIZYGOUS MOSAIC HOMOPLASMIC HETEROPLASMIC UNKNOWN", "inheritance_as_stated": "de_novo maternal paternal biparental unknown", "classification_as_reported": "pathogenic likely_pathogenic uncertain_significance likely_benign benign not_stated"},
        "diagnoses": {"status": "FINAL PROVISIONAL DIFFERENTIAL REVISED_FROM EXCLUDED", "confidence_tier": "MOLECULAR ENZYMATIC BIOCHEMICAL CLINICAL PROVISIONAL UNKNOWN", "diagnostic_route": "newborn_screening symptomatic family_screening prenatal postmortem incidental unknown"},
        "treatments": {"type": "diet cofactor_vitamin drug enzyme_replacement substrate_reduction transplant dialysis_or_extracorporeal gene_therapy supportive other", "response": "improved stable worsened no_response not_stated"},
    }
    inlist = lambda v: "(" + ", ".join(f"'{x}'" for x in v.split()) + ")"
    parts = [f"SELECT record_id, '{f}' AS path, 'is required' AS msg FROM one WHERE record.{f} IS NULL" for f in ("local_id", "subject", "phenotypes", "measurements", "genetic_findings", "diagnoses", "narrative_anchors")]
    parts.append("SELECT record_id, 'subject/sex', 'is required' FROM one WHERE record.subject IS NOT NULL AND record.subject.sex IS NULL")
    parts += [f"SELECT record_id, 'subject/{f}', 'not an allowed value: ' || record.subject.{f} FROM one WHERE record.subject.{f} NOT IN {inlist(v)}" for f, v in (("sex", "MALE FEMALE OTHER_SEX UNKNOWN_SEX"), ("vital_status", "ALIVE DECEASED UNKNOWN"))]
    for g, fields in need.items():
        src = f"(SELECT record_id, unnest(record.{g}) AS x FROM one) WHERE x IS NOT NULL"
        parts += [f"SELECT record_id, '{g}/*/{f}', 'is required' FROM {src} AND x.\"{f}\" IS NULL" for f in fields.split()]
        parts += [f"SELECT record_id, '{g}/*/evidence/{f}', 'is required' FROM {src} AND x.evidence IS NOT NULL AND x.evidence.\"{f}\" IS NULL" for f in ("quote", "anchor")]
        parts += [f"SELECT record_id, '{g}/*/{f}', 'not an allowed value: ' || x.\"{f}\" FROM {src} AND x.\"{f}\" NOT IN {inlist(v)}" for f, v in closed.get(g, {}).items()]
    return f"WITH one AS {_ONER}, i AS ({' UNION ALL '.join(parts)}) SELECT path, msg, count(*) AS n, count(DISTINCT record_id) AS n_records FROM i GROUP BY path, msg"


SQL = {
    "hit_counts": f"WITH {_HITS} SELECT omim, count(*) AS n FROM hits GROUP BY omim",
    "seed_harvest": f"WITH {_HITS} SELECT DISTINCT pmid, 'disease:' || omim AS set_name FROM hits WHERE pmid IS NOT NULL UNION SELECT DISTINCT pmid, 'subject:' || subject FROM subject_labels JOIN documents USING (doc_id) WHERE pmid IS NOT NULL",
    "lag_harvest": f"WITH {_HITS}, docs AS {_DOCS} SELECT pmid, edat FROM docs WHERE list_contains(keywords, 'genetics') AND edat >= '2006-01-01' AND substr(edat, 1, 4) <= '2025' AND pmid NOT IN (SELECT pmid FROM hits WHERE pmid IS NOT NULL)",
    "recall_candidates": f"WITH docs AS {_DOCS} SELECT pmid FROM docs WHERE list_contains(keywords, 'metabolism') AND pmid NOT IN (SELECT pmid FROM docs WHERE corpus_layer IN ('A_seed', 'A_lag'))",
    "entry_years": "SELECT substr(edat, 1, 4) AS year, count(*) AS n FROM documents WHERE edat >= '2000-06' AND substr(edat, 1, 4) <= '2015' GROUP BY 1",
    "term_eligibility": r"""SELECT DISTINCT alias, length(alias) >= 8 AND NOT regexp_matches(alias, '[()\[\]":*?]') AS lag, length(alias) >= 10 AND contains(alias, ' ') AS recall, length(alias) >= 3 AS gene FROM disease_aliases""",
    "not_enriched": "SELECT doc_id, pmid FROM documents WHERE is_open_access IS NULL",
    "prefixed_sets": "SELECT 'Subject:' || subject AS set_name, count(DISTINCT doc_id) AS n FROM subject_labels WHERE subject ILIKE 'n%' GROUP BY 1",
    "first_harvested": "SELECT doc_id, added_at FROM documents WHERE added_at IS NOT NULL ORDER BY added_at, doc_id LIMIT 50",
    "terms_in_order": "SELECT alias AS term, row_number() OVER (ORDER BY lower(alias), alias) AS place FROM (SELECT DISTINCT alias FROM disease_aliases)",
    "tag_texts": "SELECT doc_id, md5(concat_ws(chr(10), nullif(title, ''), nullif(abstract, ''), nullif(array_to_string(keywords, chr(10)), ''), nullif(upper(array_to_string(pub_types, chr(10))), ''))) AS digest FROM documents",
    "scope_build": "WITH l AS (SELECT omim AS id, min(alias) AS label FROM disease_aliases WHERE omim IS NOT NULL GROUP BY omim HAVING CAST(right(omim, 1) AS INT) % 2 = 0), g AS (SELECT omim AS id, upper(substr(alias, 1, 3)) AS g FROM disease_aliases UNION SELECT omim, 'SHARED' FROM disease_aliases) SELECT id, label, string_agg(DISTINCT g, '|' ORDER BY g) AS genes FROM l JOIN g USING (id) GROUP BY id, label",
    "history_pages": "SELECT w AS \"window\", CAST(s AS INT) AS start, '<set start=''' || s || ''' size=''500''/>' AS xml FROM (SELECT 'all' AS w, unnest([0, 500, 1000]) AS s UNION ALL SELECT '2000-2012', unnest([0, 500, 1000]))",
    "cursor_results": "SELECT p::INT AS page, p || '-' || i AS id FROM range(3) AS a(p), range(4) AS b(i)",
    "fetched_ids": "SELECT count(DISTINCT pmid) AS ids, count(DISTINCT pmid) AS answered, least(200, count(DISTINCT pmid)) AS page, 0 AS errors FROM documents",
    "enrichment_facts": "SELECT DISTINCT pmid, CASE WHEN right(pmid, 1) IN ('2', '4', '6', '8') THEN 'PMC' || pmid END AS pmcid, CASE WHEN right(pmid, 1) IN ('2', '4', '6', '8') THEN 1 ELSE 0 END AS is_open_access, CASE WHEN right(pmid, 1) IN ('2', '4') THEN 'cc by' END AS license, 1 AS in_epmc, CASE WHEN right(pmid, 1) = '2' THEN 1 ELSE 0 END AS has_suppl FROM documents WHERE pmid IS NOT NULL AND right(pmid, 1) <> '0'",
    "fulltext_attempts": f"WITH {_ATTEMPTS} SELECT pmid, tier, ok, name, status, files AS supplement_files FROM att",
    "fulltext_statistics": f"WITH {_ATTEMPTS} SELECT tier, count(*) AS tried, count(*) FILTER (ok) AS ok, string_agg(DISTINCT status, '|' ORDER BY status) AS statuses FROM att GROUP BY tier",
    "best_representations": "WITH f AS (SELECT pmid, doc_id, n, o, tier FROM (SELECT DISTINCT pmid, doc_id FROM documents WHERE pmid IS NOT NULL), (VALUES ('epmc.xml', 0, 'epmc', 7), ('springer.xml', 2, 'publisher', 5), ('unpaywall.pdf', 4, 'unpaywall', 11), ('wiley.pdf', 5, 'publisher', 2)) AS v(n, o, tier, k) WHERE doc_id % k = 0) SELECT DISTINCT d.pmid, pmid || '/' || b.n AS path, coalesce(b.tier, 'abstract') AS tier FROM documents d LEFT JOIN (SELECT pmid, arg_min(n, o) AS n, arg_min(tier, o) AS tier FROM f GROUP BY pmid) b USING (pmid) WHERE pmid IS NOT NULL",
    "loaded_documents": f"WITH docs AS {_DOCS} SELECT pmid, md5(CASE WHEN e AND length(pmid) % 2 = 1 THEN 'Own title' ELSE coalesce(title, '') END) AS title, md5(coalesce(abstract, '')) AS abstract, CASE WHEN e THEN 1 ELSE 0 END AS n_sections, journal, CASE WHEN e THEN 'own' ELSE license END AS license, CASE WHEN e THEN 'epmc' ELSE 'abstract' END AS tier FROM (SELECT *, coalesce(fulltext_tier = 'epmc', false) AS e FROM docs)",
    "imported_pmcids": f"WITH docs AS {_DOCS} SELECT DISTINCT d.pmcid, c.pmid FROM documents d JOIN docs c ON c.pmcid = d.pmcid",
    "ground_phenotypes": f"""WITH {_PH}, e AS (SELECT key, min(id) AS id FROM (SELECT id, {_key_sql('label', _PKEEP)} AS key FROM lab) WHERE key <> '' GROUP BY key),
        x AS (SELECT DISTINCT text, supplied, {_key_sql('text', _PKEEP)} AS key FROM (SELECT text, id AS supplied FROM p UNION ALL SELECT upper(text), NULL FROM p UNION ALL SELECT 'Sign of ' || text, NULL FROM p)),
        j AS (SELECT x.*, s.label AS said, e.id AS e, CASE WHEN starts_with(x.key, 'sign of ') THEN r.id END AS r FROM x LEFT JOIN lab s ON s.id = x.supplied LEFT JOIN e ON e.key = x.key LEFT JOIN e r ON x.key = 'sign of ' || r.key)
        SELECT text, supplied, i AS id, l.label AS label, CASE WHEN i IS NULL THEN 'unresolved' ELSE 'grounded' END AS status, CASE WHEN said IS NOT NULL OR e IS NOT NULL THEN 0.95 WHEN r IS NOT NULL THEN 0.85 END::DOUBLE AS confidence, CASE WHEN said IS NOT NULL THEN 'supplied+verified' WHEN e IS NOT NULL THEN 'exact' WHEN r IS NOT NULL THEN 'synonym' ELSE 'fuzzy' END AS method
        FROM (SELECT *, CASE WHEN said IS NOT NULL THEN supplied ELSE coalesce(e, r) END AS i FROM j) LEFT JOIN lab l ON l.id = i""",
    "ground_disease_names": f"""WITH {_ONTO}, dtexts AS (SELECT DISTINCT disease_text AS text, NULL::VARCHAR AS supplied FROM diagnoses WHERE disease_text IS NOT NULL UNION SELECT min(alias), omim FROM disease_aliases GROUP BY omim), {_DGROUND}
        SELECT text, supplied, dg.id AS id, coalesce(lb.label, text) AS label, CASE WHEN dg.id IS NULL THEN 'unresolved' ELSE 'grounded' END AS status, confidence, method, CASE WHEN dg.id IS NULL THEN supplied ELSE lb.omim END AS id_omim FROM dg LEFT JOIN lb ON lb.id = dg.id""",
    "ground_analyte_names": f"WITH g AS ({_CAT_SQL['ground_analytes']}) SELECT text, g.label, chebi, vmh, CASE WHEN g.label IS NULL THEN 'unresolved' ELSE 'grounded' END AS status, confidence FROM g LEFT JOIN (SELECT label, min(chebi) AS chebi, min(vmh) AS vmh FROM analytes_builtin GROUP BY label) a ON a.label = g.label",
    "record_grounding": f"""WITH {_ONTO}, one AS {_ONER}, {_PH}, dtexts AS (SELECT DISTINCT x.disease_text AS text, NULL::VARCHAR AS supplied FROM (SELECT unnest(record.diagnoses) AS x FROM one) WHERE x.disease_text IS NOT NULL), {_DGROUND},
        e AS (SELECT key, min(id) AS id FROM (SELECT id, {_key_sql('label', _PKEEP)} AS key FROM lab) WHERE key <> '' GROUP BY key),
        ga AS ({_CAT_SQL['ground_analytes'].replace('analyte_text AS text FROM measurements WHERE analyte_text IS NOT NULL', 'x.analyte_text AS text FROM (SELECT unnest(record.measurements) AS x FROM one) WHERE x.analyte_text IS NOT NULL')}),
        ph AS (SELECT record_id, i, x.hpo_id AS s, {_key_sql('x."text"', _PKEEP)} AS key FROM (SELECT record_id, record.phenotypes[i + 1] AS x, i FROM (SELECT *, unnest(range(len(record.phenotypes))) AS i FROM one)) WHERE x IS NOT NULL),
        a1 AS (SELECT record_id, string_agg(coalesce(CASE WHEN lab.id IS NOT NULL THEN s ELSE e.id END, '-'), '|' ORDER BY i) AS v FROM ph LEFT JOIN lab ON lab.id = s LEFT JOIN e ON e.key = ph.key GROUP BY record_id),
        a2 AS (SELECT record_id, string_agg(coalesce(ga.label, '-'), '|' ORDER BY i) AS v FROM (SELECT record_id, record.measurements[i + 1] AS x, i FROM (SELECT *, unnest(range(len(record.measurements))) AS i FROM one)) LEFT JOIN ga ON ga.text = x.analyte_text WHERE x IS NOT NULL GROUP BY record_id),
        a3 AS (SELECT record_id, string_agg(coalesce(lb.omim, '-'), '|' ORDER BY i) AS v, string_agg(CASE WHEN x.disease_text IS NULL THEN '-' WHEN dg.id IS NULL THEN 'unresolved' ELSE 'grounded' END, '|' ORDER BY i) AS st FROM (SELECT record_id, record.diagnoses[i + 1] AS x, i FROM (SELECT *, unnest(range(len(record.diagnoses))) AS i FROM one)) LEFT JOIN dg ON dg.text = x.disease_text LEFT JOIN lb ON lb.id = dg.id WHERE x IS NOT NULL GROUP BY record_id)
        SELECT record_id, coalesce(a1.v, '') AS phenotypes, coalesce(a2.v, '') AS analytes, coalesce(a3.v, '') AS diseases, coalesce(a3.st, '') AS states FROM one LEFT JOIN a1 USING (record_id) LEFT JOIN a2 USING (record_id) LEFT JOIN a3 USING (record_id)""",
    "triage_rows": f"WITH {_MAN}, a AS (SELECT pmid, count(*) FILTER (n <> '2') AS k, string_agg(local_id, '|' ORDER BY local_id) AS ids, max(CASE WHEN n = '3' THEN 1 ELSE 0 END) AS r FROM ent GROUP BY pmid) SELECT man.pmid, CAST(in_scope AS INT) AS in_scope, coalesce(k, 0) AS n_individuals, coalesce(ids, '') AS individual_ids, coalesce(r, 0) AS is_rereport, document_type, CASE WHEN l <> '6' THEN 'made up' END AS reasons FROM man LEFT JOIN a ON a.pmid = man.pmid",
    "manifest_issues": f"WITH {_MAN} SELECT pmid, 'error' AS severity, 'reasons' AS path, 'is required' AS msg FROM man WHERE l = '6' UNION ALL SELECT pmid, 'error', 'document_type', 'not an allowed value: odd' FROM man WHERE l = '4' UNION ALL SELECT pmid, 'error', 'individuals/' || i || '/where', 'is required' FROM ent WHERE l = '7' UNION ALL SELECT pmid, 'error', 'individuals/' || i || '/case_type', 'not an allowed value: unheard_of' FROM ent WHERE l = '5'",
    "ingest_provenance": f"""WITH {_MAN}, docs AS {_DOCS}, one AS {_ONER}, s AS (SELECT pmid, string_agg(DISTINCT subject, '|' ORDER BY subject) AS sets FROM subject_labels JOIN documents USING (doc_id) GROUP BY pmid)
        SELECT o.record_id, d.pmcid, d.pub_year AS year, d.fulltext_tier AS tier, CASE WHEN coalesce(d.text, '') <> '' THEN sha256(d.text) END AS input_sha256, coalesce(s.sets, '') AS sets, m.document_type, CASE WHEN e.local_id IS NOT NULL THEN CASE WHEN e.l = '5' THEN 'unheard_of' ELSE 'typical_presentation' END END AS case_type, CASE WHEN e.local_id IS NOT NULL THEN e.n = '3' END AS is_rereport, CASE WHEN e.local_id IS NOT NULL THEN 'F' || e.n END AS family_id
        FROM one o JOIN man m ON m.pmid = o.pmid AND m.in_scope LEFT JOIN ent e ON e.pmid = o.pmid AND e.local_id = o.local_id LEFT JOIN docs d ON d.pmid = o.pmid LEFT JOIN s ON s.pmid = o.pmid""",
    "ingest_issues": f"""WITH tot AS ({_DOC_SQL['verification_totals']}), nar AS ({_DOC_SQL['narrative_assembly']}) SELECT record_id, 'warn' AS severity, 'evidence' AS path, missing || ' of ' || total || ' evidence quotes not found verbatim in the document' AS msg FROM tot WHERE missing > 0
        UNION ALL SELECT DISTINCT record_id, 'warn', 'narrative_anchors', 'no narrative could be assembled (anchors missing or unresolvable)' FROM individuals WHERE record_id IS NOT NULL AND record_id NOT IN (SELECT record_id FROM nar)""",
    "ingest_statistics": f"WITH {_MAN}, one AS {_ONER}, r AS (SELECT coalesce(valid, 0) = 1 AS v FROM one JOIN man USING (pmid) WHERE in_scope) SELECT 'manifests' AS name, count(*) AS n FROM man UNION ALL SELECT 'in_scope', count(*) FROM man WHERE in_scope UNION ALL SELECT 'records', count(*) FROM r UNION ALL SELECT 'valid', count(*) FROM r WHERE v UNION ALL SELECT 'invalid', count(*) FROM r WHERE NOT v",
    "schema_issues": _schema_sql(),
    "unknown_phenotypes": f"WITH one AS {_ONER} SELECT record_id, 'error' AS severity, 'phenotypes/' || i || '/hpo_id' AS path, 'unknown or obsolete HPO id: ' || x.hpo_id AS msg FROM (SELECT record_id, i, record.phenotypes[i + 1] AS x FROM (SELECT *, unnest(range(len(record.phenotypes))) AS i FROM one)) WHERE coalesce(x.hpo_id, '') <> '' AND CAST(right(x.hpo_id, 1) AS INT) % 2 = 1",
}
