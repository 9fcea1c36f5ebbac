"""Queries on catalogue state, scopes and grounding, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import numbers, text
from ..operators import catalogue, grounding, scope
from ..session import table as t


def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    """Re-harvests merged into one catalogue row per pmid: last supplied values, first `added_at`."""
    x = t(spark, d, "documents").select("pmid", "doc_id", "pmcid", "doi", "journal", "pub_year", "license", "fulltext_tier", "added_at", "updated_at")
    return catalogue.upsert(x, "pmid", [F.coalesce("added_at", F.lit(0.0)), F.col("doc_id")], first=("added_at",)).drop("doc_id")


def layer_precedence(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").where("pmid is not null").groupBy("pmid").agg(F.min("corpus_layer").alias("corpus_layer"))


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").where("event_type is not null")
    tier = F.element_at(F.array(*map(F.lit, catalogue.FULLTEXT_TIERS)), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(F.col("user_id").cast("string").alias("pmid"), tier.alias("tier"), (F.col("value") > 50).alias("ok"), "ts", "event_id")


def tier_promotion(spark: SparkSession, d: str) -> DataFrame:
    """Latest attempt per (pmid, tier), and whether it may promote a document that stands at none, `abstract` or some tier."""
    last = catalogue.latest(_attempts(spark, d), ["pmid", "tier"], [F.col("ts"), F.col("event_id")])
    current = F.element_at(F.array(F.lit(None).cast("string"), F.lit("abstract"), *map(F.lit, catalogue.FULLTEXT_TIERS)), (F.col("pmid").cast("int") % 6 + 1))
    return last.select("pmid", "tier", "ok", current.alias("before"), catalogue.promoted_tier(current, F.col("tier"), F.coalesce("ok", F.lit(False))).alias("now"))


def tier_cascade(spark: SparkSession, d: str) -> DataFrame:
    a = _attempts(spark, d)
    docs = a.select("pmid", F.lit("abstract").alias("fulltext_tier")).distinct()
    return catalogue.cascade(docs, a.where("ok"))


def not_attempted(spark: SparkSession, d: str) -> DataFrame:
    a = _attempts(spark, d).where("event_id % 7 < 2")
    docs = _attempts(spark, d).select("pmid", F.lit(None).cast("string").alias("fulltext_tier")).distinct()
    return catalogue.open_attempts(docs, a).select("pmid", "tier", F.col("rank").cast("bigint").alias("rank"))


def publisher_router(spark: SparkSession, d: str) -> DataFrame:
    prefixes = F.array(*map(F.lit, ("10.1016", "10.1002", "10.1111", "10.1007", "10.1038", "10.1186", "10.1140", "10.9999")))
    x = t(spark, d, "documents").where("doi is not null").withColumn("doi", F.concat(F.element_at(prefixes, (F.col("doc_id") % 8 + 1).cast("int")), F.lit("/"), F.substring_index("doi", "/", -1)))
    return x.groupBy(F.coalesce(catalogue.publisher(F.col("doi")), F.lit("none")).alias("publisher")).agg(F.count("*").alias("n"))


def set_membership(spark: SparkSession, d: str) -> DataFrame:
    """Documents of a set (rated ones), full rows of the catalogue without texts."""
    x = t(spark, d, "documents").select("doc_id", "pmid", "journal", "pub_year")
    return x.join(t(spark, d, "subject_labels").select("doc_id"), "doc_id", "left_semi")


def set_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sets of documents by subject, first writer kept, with a second batch ignored where it is there already."""
    x = t(spark, d, "subject_labels").select(F.concat(F.lit("subject:"), "subject").alias("set_name"), "doc_id", "rater")
    base = x.where("rater = 1").select("set_name", "doc_id", F.lit("rater 1").alias("source")).distinct()
    new = x.where("rater = 2").select("set_name", "doc_id", F.lit("rater 2").alias("source"))
    both = catalogue.insert_or_ignore(base, new, ["set_name", "doc_id"], [F.col("source")])
    return both.groupBy("set_name", "source").agg(F.count("*").alias("n"))


def replace_links(spark: SparkSession, d: str) -> DataFrame:
    """Insert-or-replace: the later price list of an order-part link replaces the earlier one."""
    x = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_a"), F.col("l_partkey").alias("record_b"), F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_extendedprice").alias("score"))
    return catalogue.latest(x, ["record_a", "record_b"], [F.col("l_shipdate"), F.col("l_linenumber")]).select("record_a", "record_b", "score")


def enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Open-access facts merged into the catalogue, missing ones as 0."""
    docs = t(spark, d, "documents").where("pmid is not null").select("doc_id", "pmid", "pmcid")
    facts = t(spark, d, "documents").where("pmid is not null and is_open_access is not null").groupBy("pmid").agg(F.max("pmcid").alias("pmcid"), F.max("is_open_access").alias("is_open_access"), F.lit(1).alias("in_epmc"))
    return catalogue.enrich(docs, facts).select("doc_id", "pmid", "pmcid", "is_open_access", "in_epmc")


def catalogue_status(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.status(t(spark, d, "documents"))


def work_buckets(spark: SparkSession, d: str) -> DataFrame:
    """How many papers need triage, need extraction or are done, judged by what has been extracted of them."""
    docs = t(spark, d, "documents").where("pmid is not null").groupBy("pmid").agg((F.max("fulltext_tier").isNotNull()).alias("manifested"))
    n = t(spark, d, "individuals").groupBy("pmid").agg(F.countDistinct("record_id").alias("records"))
    x = docs.join(n, "pmid", "left")
    return x.groupBy(catalogue.work_state(F.col("manifested"), F.lit(None).cast("boolean"), F.col("records")).alias("state")).agg(F.count("*").alias("n"))


def chunk_pages(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers in pages of 100 within each layer, as they are sent to a batch interface."""
    x = t(spark, d, "documents").where("pmid is not null").select("corpus_layer", "pmid").distinct()
    return catalogue.pages(x, [F.col("pmid")], 100, ["corpus_layer"]).groupBy("corpus_layer", "page").agg(F.count("*").alias("n"), F.min("pmid").alias("first_pmid"))


def language_filter(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").where(F.coalesce("language", F.lit("eng")).isin("eng", "deu", "ger")).groupBy("journal").agg(F.count("*").alias("n"))


def scope_tag(spark: SparkSession, d: str) -> DataFrame:
    """Documents tagged with the disease terms that are long enough to be searched for."""
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("key"), "text")
    a = t(spark, d, "disease_aliases").select(F.col("alias").alias("name"), F.col("omim").alias("id")).where(r"length(alias) >= 8 and not alias rlike '[()\\[\\]\":*?]'")
    x = scope.tag(docs, scope.terms(a))
    return x.where("size(terms) > 0").select(F.col("key").alias("doc_id"), F.array_join("ids", "|").alias("ids"), F.array_join("terms", "|").alias("terms"))


def scope_terms(spark: SparkSession, d: str) -> DataFrame:
    return scope.terms(t(spark, d, "disease_aliases").select(F.col("alias").alias("name"), F.col("omim").alias("id")))


def descendants(spark: SparkSession, d: str) -> DataFrame:
    """Everything below each region: nations, and customers below them."""
    r = t(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"))
    n = t(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("sub"), F.concat(F.lit("r"), "n_regionkey").alias("obj"))
    c = t(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("sub"), F.concat(F.lit("n"), "c_nationkey").alias("obj"))
    return scope.descendants(n.unionByName(c), r).select("root", "id", F.col("level").cast("bigint").alias("level"))


def _lexicon(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "analytes_builtin")
    names = a.select("label", F.posexplode(F.concat(F.array("label"), F.filter(F.split(F.coalesce("synonyms", F.lit("")), r"\|"), lambda x: x != ""))).alias("i", "name"))
    return grounding.lexicon(names, "analyte", [F.col("label"), F.col("i")]).select("key", "label")


def analyte_lexicon(spark: SparkSession, d: str) -> DataFrame:
    return _lexicon(spark, d)


def ground_analytes(spark: SparkSession, d: str) -> DataFrame:
    return grounding.ground_analytes(t(spark, d, "measurements").select(F.col("analyte_text").alias("text")), _lexicon(spark, d))


def ground_diseases(spark: SparkSession, d: str) -> DataFrame:
    return grounding.ground_diseases(t(spark, d, "diagnoses").select(F.col("disease_text").alias("text")), t(spark, d, "disease_aliases"))


def _genes(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "individuals").select(F.explode("record.genetic_findings").alias("g")).where("g is not null").select("g.gene_symbol", "g.hgnc_id")


def gene_cascade(spark: SparkSession, d: str) -> DataFrame:
    g = _genes(spark, d)
    known = g.where("hgnc_id is not null and gene_symbol rlike '^[A-Z]+[0-9]+$'").groupBy(F.col("gene_symbol").alias("symbol")).agg(F.min("hgnc_id").alias("hgnc_id")).withColumn("aliases", F.array(F.concat(F.lower(F.substring("symbol", 1, 2)), F.substring("symbol", 3, 20))))
    return grounding.ground_genes(g.select(F.col("gene_symbol").alias("symbol")), known)


def ground_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Candidates for the typed analytes that no exact tier knows."""
    rest = ground_analytes(spark, d).where("label is null").select("text")
    return grounding.fuzzy(rest, _lexicon(spark, d), "analyte", "weighted", 80.0, 0.95)


def unit_normalise(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "measurements").select("unit").where("unit is not null").groupBy("unit").agg(F.count("*").alias("n"))
    return x.select("unit", text.unit_normal(F.col("unit")).alias("ucum"), "n")


def record_slugs(spark: SparkSession, d: str) -> DataFrame:
    """Record ids rebuilt from pmid and local id, with the number of local ids that fall together."""
    x = t(spark, d, "individuals").select("pmid", "local_id").distinct()
    return x.groupBy(F.concat(F.lit("PMID_"), "pmid", F.lit("_"), text.slug(F.coalesce("local_id", F.lit("")))).alias("rebuilt")).agg(F.count("*").alias("n_local_ids"))


def disease_queries(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "disease_aliases").groupBy("omim").agg(F.sort_array(F.collect_set("alias")).alias("terms"))
    none = F.array().cast("array<string>")
    return a.select("omim", text.search_query(F.lit(""), F.col("terms"), none).alias("query"))


def publication_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates put together from parts; a bare year stands as a free date."""
    p = F.split("pub_date", "-")
    full = F.size(p) == 3
    x = t(spark, d, "documents").where("pub_date is not null")
    part = lambda i: F.when(full, p[i])
    return x.select("doc_id", numbers.publication_date(part(0), part(1), part(2), F.when(~full, F.col("pub_date"))).alias("pub_date"), numbers.year_band(F.col("pub_year")).alias("band"))


def squashed_abstracts(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "documents").where("abstract is not null")
    s = text.squash(F.col("abstract"))
    return x.select("doc_id", F.length(s).cast("bigint").alias("chars"), F.sha2(s, 256).alias("digest"))


def text_digests(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "documents")
    return x.select("doc_id", F.when(F.coalesce("text", F.lit("")) != "", F.sha2("text", 256)).alias("input_sha256"))


# Fixed values of the SQL, written out apart from the operators' own.
_UNITS = (
    "('umol/l', 'umol/L'), ('µmol/l', 'umol/L'), ('micromol/l', 'umol/L'), ('mmol/l', 'mmol/L'), ('nmol/l', 'nmol/L'), ('pmol/l', 'pmol/L'), ('mol/l', 'mol/L'), ('mg/dl', 'mg/dL'), ('g/dl', 'g/dL'), "
    "('ug/dl', 'ug/dL'), ('µg/dl', 'ug/dL'), ('ng/dl', 'ng/dL'), ('mg/l', 'mg/L'), ('g/l', 'g/L'), ('ug/l', 'ug/L'), ('µg/l', 'ug/L'), ('ng/l', 'ng/L'), ('ng/ml', 'ng/mL'), ('ug/ml', 'ug/mL'), "
    "('µg/ml', 'ug/mL'), ('mg/ml', 'mg/mL'), ('nmol/ml', 'nmol/mL'), ('umol/ml', 'umol/mL'), ('µmol/ml', 'umol/mL'), ('pmol/ml', 'pmol/mL'), ('u/l', 'U/L'), ('iu/l', '[IU]/L'), ('mu/l', 'mU/L'), "
    "('miu/l', 'm[IU]/L'), ('ku/l', 'kU/L'), ('mmol/mol creatinine', 'mmol/mol{creat}'), ('mmol/mol creat', 'mmol/mol{creat}'), ('mmol/mol cr', 'mmol/mol{creat}'), ('mmol/mol', 'mmol/mol{creat}'), "
    "('umol/mmol creatinine', 'umol/mmol{creat}'), ('µmol/mmol creatinine', 'umol/mmol{creat}'), ('umol/mmol', 'umol/mmol{creat}'), ('mg/g creatinine', 'mg/g{creat}'), ('mg/g creat', 'mg/g{creat}'), "
    "('ug/mg creatinine', 'ug/mg{creat}'), ('mmhg', 'mm[Hg]'), ('kpa', 'kPa'), ('%', '%'), ('percent', '%'), ('nmol/h/mg protein', 'nmol/h/mg{protein}'), ('nmol/min/mg protein', 'nmol/min/mg{protein}'), "
    "('nmol/h/mg', 'nmol/h/mg{protein}'), ('umol/h/mg protein', 'umol/h/mg{protein}'), ('pmol/min/mg', 'pmol/min/mg{protein}'), ('nmol/17h/mg protein', 'nmol/(17.h)/mg{protein}'), "
    "('nmol/mg protein/h', 'nmol/h/mg{protein}'), ('meq/l', 'meq/L'), ('g/kg/day', 'g/kg/d'), ('mg/kg/day', 'mg/kg/d'), ('mg/kg', 'mg/kg'), ('iu/kg', '[IU]/kg'), ('cells/ul', '/uL'), ('x10^9/l', '10*9/L'), "
    "('10^9/l', '10*9/L'), ('x109/l', '10*9/L'), ('g/mol', 'g/mol'), ('sec', 's'), ('s', 's'), ('min', 'min')"
)
_FILL = "cerebrospinal fluid|dried blood spot|concentrations|concentration|whole blood|fibroblast|leukocyte|urinary|plasma|levels|serum|blood|urine|level|csf|dbs|of"
_ROMAN = {"viii": "8", "iii": "3", "vii": "7", "ii": "2", "iv": "4", "vi": "6", "ix": "9", "i": "1", "v": "5", "x": "10"}


def _key_sql(col: str, keep: str, fillers: bool = False) -> str:
    s = f"lower(trim({col}, ' '))"
    for a in ("ae", "oe"):
        s = f"regexp_replace(regexp_replace({s}, '([a-z]){a}([a-z])', '\\1e\\2', 'g'), '([a-z]){a}([a-z])', '\\1e\\2', 'g')"
    for r, n in _ROMAN.items():
        s = f"regexp_replace({s}, '\\btype\\s+{r}\\b', 'type {n}', 'g')"
    s = f"regexp_replace({s}, '\\b(aciduria|acidaemia)\\b', 'acidemia', 'g')"
    s = f"regexp_replace({s}, '\\bdeficiency of (.+)$', '\\1 deficiency')"
    s = f"regexp_replace({s}, '[‐-―]', '-', 'g')"
    if fillers:
        s = f"regexp_replace({s}, '\\b({_FILL})\\b', ' ', 'g')"
    s = f"trim(regexp_replace(regexp_replace({s}, '[^{keep}]', ' ', 'g'), '\\s+', ' ', 'g'))"
    return f"regexp_replace({s}, '^[ -]+|[ -]+$', '', 'g')" if fillers else s


_ANALYTE_KEEP, _DISEASE_KEEP = r"a-z0-9 \-/:,\.", r"a-z0-9 \-/,"
_LEX = f"""names AS (SELECT label, 0 AS i, label AS name FROM analytes_builtin UNION ALL SELECT label, i + 1, s[i + 1] FROM (SELECT label, s, unnest(range(len(s))) AS i FROM (SELECT label, list_filter(string_split(coalesce(synonyms, ''), '|'), lambda x: x <> '') AS s FROM analytes_builtin))),
    lex AS (SELECT key, arg_min(label, (label, i)) AS label FROM (SELECT *, {_key_sql('name', _ANALYTE_KEEP, True)} AS key FROM names) WHERE key <> '' GROUP BY key)"""
_STEREO = r"^(?:\(?[RSEZ]\)?-|[LD]-|\(\+\)-|\(-\)-|\(\+/-\)-|\(±\)-|[+-]-|alpha-|beta-|α-|β-|cis-|trans-|all-trans-|n-|iso-)+"
_ATT = "att AS (SELECT CAST(user_id AS VARCHAR) AS pmid, ['epmc', 'pmc', 'unpaywall', 'publisher'][event_id % 4 + 1] AS tier, value > 50 AS ok, ts, event_id FROM events WHERE event_type IS NOT NULL)"

QUERIES = {f.__name__: f for f in (
    upsert_latest, layer_precedence, tier_promotion, tier_cascade, not_attempted, publisher_router, set_membership, set_sizes, replace_links, enrichment, catalogue_status, work_buckets, chunk_pages, language_filter,
    scope_tag, scope_terms, descendants, analyte_lexicon, ground_analytes, ground_diseases, gene_cascade, ground_fuzzy, unit_normalise, record_slugs, disease_queries, publication_dates, squashed_abstracts, text_digests,
)}
_LAST = lambda c: f"arg_max({c}, (coalesce(added_at, 0), doc_id)) FILTER ({c} IS NOT NULL) AS {c}"
SQL = {
    "upsert_latest": f"SELECT pmid, {', '.join(_LAST(c) for c in ('pmcid', 'doi', 'journal', 'pub_year', 'license', 'fulltext_tier', 'updated_at'))}, arg_min(added_at, (coalesce(added_at, 0), doc_id)) FILTER (added_at IS NOT NULL) AS added_at FROM documents WHERE pmid IS NOT NULL GROUP BY pmid",
    "layer_precedence": "SELECT pmid, min(corpus_layer) AS corpus_layer FROM documents WHERE pmid IS NOT NULL GROUP BY pmid",
    "tier_promotion": f"WITH {_ATT}, l AS (SELECT pmid, tier, ok, [NULL, 'abstract', 'epmc', 'pmc', 'unpaywall', 'publisher'][CAST(pmid AS INT) % 6 + 1] AS before FROM att QUALIFY row_number() OVER (PARTITION BY pmid, tier ORDER BY ts DESC, event_id DESC) = 1) SELECT pmid, tier, ok, before, CASE WHEN coalesce(ok, false) AND (before IS NULL OR before = 'abstract' OR before = tier) THEN tier ELSE before END AS now FROM l",
    "tier_cascade": f"WITH {_ATT} SELECT pmid, CASE min(CASE WHEN ok THEN CASE tier WHEN 'epmc' THEN 0 WHEN 'pmc' THEN 1 WHEN 'unpaywall' THEN 2 ELSE 3 END END) WHEN 0 THEN 'epmc' WHEN 1 THEN 'pmc' WHEN 2 THEN 'unpaywall' WHEN 3 THEN 'publisher' ELSE 'abstract' END AS fulltext_tier FROM att GROUP BY pmid",
    "not_attempted": f"WITH {_ATT}, tiers AS (SELECT * FROM (VALUES ('epmc', 0), ('pmc', 1), ('unpaywall', 2), ('publisher', 3)) AS v(tier, rank)) SELECT p.pmid, tiers.tier, CAST(rank AS BIGINT) AS rank FROM (SELECT DISTINCT pmid FROM att) p CROSS JOIN tiers WHERE NOT EXISTS (SELECT 1 FROM att a WHERE a.event_id % 7 < 2 AND a.pmid = p.pmid AND a.tier = tiers.tier)",
    "publisher_router": "WITH documents AS (SELECT ['10.1016', '10.1002', '10.1111', '10.1007', '10.1038', '10.1186', '10.1140', '10.9999'][doc_id % 8 + 1] || '/' || split_part(doi, '/', 2) AS doi FROM documents WHERE doi IS NOT NULL) SELECT CASE WHEN split_part(doi, '/', 1) = '10.1016' THEN 'elsevier' WHEN split_part(doi, '/', 1) IN ('10.1002', '10.1111') THEN 'wiley' WHEN split_part(doi, '/', 1) IN ('10.1007', '10.1038', '10.1186', '10.1140') THEN 'springer' ELSE 'none' END AS publisher, count(*) AS n FROM documents WHERE doi IS NOT NULL GROUP BY 1",
    "set_membership": "SELECT doc_id, pmid, journal, pub_year FROM documents WHERE doc_id IN (SELECT doc_id FROM subject_labels)",
    "set_sizes": "WITH x AS (SELECT DISTINCT 'subject:' || subject AS set_name, doc_id, rater FROM subject_labels), b AS (SELECT set_name, doc_id, 'rater 1' AS source FROM x WHERE rater = 1), n AS (SELECT set_name, doc_id, 'rater 2' AS source FROM x WHERE rater = 2 AND NOT EXISTS (SELECT 1 FROM b WHERE b.set_name = x.set_name AND b.doc_id = x.doc_id)) SELECT set_name, source, count(*) AS n FROM (SELECT * FROM b UNION ALL SELECT * FROM n) GROUP BY set_name, source",
    "replace_links": "SELECT l_orderkey AS record_a, l_partkey AS record_b, l_extendedprice AS score FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate DESC, l_linenumber DESC) = 1",
    "enrichment": "WITH f AS (SELECT pmid, max(pmcid) AS pmcid, max(is_open_access) AS oa FROM documents WHERE pmid IS NOT NULL AND is_open_access IS NOT NULL GROUP BY pmid) SELECT d.doc_id, d.pmid, coalesce(nullif(f.pmcid, ''), d.pmcid) AS pmcid, coalesce(f.oa, 0) AS is_open_access, CASE WHEN f.pmid IS NULL THEN 0 ELSE 1 END AS in_epmc FROM documents d LEFT JOIN f ON d.pmid = f.pmid WHERE d.pmid IS NOT NULL",
    "catalogue_status": "SELECT 'tier' AS dimension, coalesce(fulltext_tier, 'none') AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'layer', coalesce(corpus_layer, 'none'), count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'total', 'all', count(*) FROM documents UNION ALL SELECT 'total', 'with_pmcid', count(pmcid) FROM documents",
    "work_buckets": "WITH x AS (SELECT pmid, max(fulltext_tier) IS NOT NULL AS m FROM documents WHERE pmid IS NOT NULL GROUP BY pmid), n AS (SELECT pmid, count(DISTINCT record_id) AS r FROM individuals GROUP BY pmid) SELECT CASE WHEN NOT m THEN 'need_triage' WHEN coalesce(r, 0) = 0 THEN 'need_extract' ELSE 'done' END AS state, count(*) AS n FROM x LEFT JOIN n USING (pmid) GROUP BY 1",
    "chunk_pages": "SELECT corpus_layer, CAST(page AS BIGINT) AS page, count(*) AS n, min(pmid) AS first_pmid FROM (SELECT corpus_layer, pmid, (row_number() OVER (PARTITION BY corpus_layer ORDER BY pmid) - 1) // 100 AS page FROM (SELECT DISTINCT corpus_layer, pmid FROM documents WHERE pmid IS NOT NULL)) GROUP BY 1, 2",
    "language_filter": "SELECT journal, count(*) AS n FROM documents WHERE coalesce(language, 'eng') IN ('eng', 'deu', 'ger') GROUP BY journal",
    "scope_tag": r"""WITH v AS (SELECT lower(a) AS term, omim FROM (SELECT trim(regexp_replace(trim(alias), '\s*\(.*?\)\s*$', '')) AS a, omim FROM disease_aliases WHERE length(alias) >= 8 AND NOT regexp_matches(alias, '[()\[\]":*?]')))
        SELECT doc_id, string_agg(DISTINCT omim, '|' ORDER BY omim) AS ids, string_agg(DISTINCT term, '|' ORDER BY term) AS terms FROM documents d, v WHERE contains(lower(text), term) AND regexp_matches(lower(text), '(^|[^a-z0-9])' || regexp_escape(term) || '($|[^a-z0-9])') GROUP BY doc_id""",
    "scope_terms": r"SELECT DISTINCT lower(a) AS term, omim AS id FROM (SELECT trim(regexp_replace(trim(alias), '\s*\(.*?\)\s*$', '')) AS a, omim FROM disease_aliases) WHERE NOT regexp_matches(a, '^(?:[A-Z0-9\-]{1,4}|.{0,4})$') AND NOT regexp_matches(a, '[\x22\[\]]')",
    "descendants": "SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS id, 0::BIGINT AS level FROM region UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, 1 FROM nation UNION ALL SELECT 'r' || n_regionkey, 'c' || c_custkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "analyte_lexicon": f"WITH {_LEX} SELECT key, label FROM lex",
    "ground_analytes": f"""WITH {_LEX}, t AS (SELECT DISTINCT analyte_text AS text FROM measurements WHERE analyte_text IS NOT NULL),
        va AS (SELECT text, unnest(l) AS variant, unnest(range(len(l))) AS i FROM (SELECT text, list_concat([text, regexp_replace(text, '\\(.*?\\)', ' ', 'g')], regexp_extract_all(text, '\\(([^)]+)\\)', 1), regexp_extract_all(text, '\\b(C\\d{{1,2}}(?::\\d)?(?:-?(?:OH|DC))?)\\b', 1)) AS l FROM t)),
        ex AS (SELECT text, arg_min(label, i) AS label, arg_min(variant = text, i) AS same FROM (SELECT *, {_key_sql('variant', _ANALYTE_KEEP, True)} AS key FROM va) JOIN lex USING (key) GROUP BY text),
        lo AS (SELECT lk, min(label) AS label FROM (SELECT label, key, {_key_sql(f"regexp_replace(regexp_replace(label, '<[^>]+>', '', 'g'), '{_STEREO}', '', 'i')", _ANALYTE_KEEP, True)} AS lk FROM lex) WHERE lk <> key GROUP BY lk),
        st AS (SELECT text, lo.label AS label FROM (SELECT text, {_key_sql(f"regexp_replace(regexp_replace(regexp_replace(text, '\\(.*?\\)', ' ', 'g'), '<[^>]+>', '', 'g'), '{_STEREO}', '', 'i')", _ANALYTE_KEEP, True)} AS lk FROM t) JOIN lo USING (lk))
        SELECT t.text, coalesce(ex.label, st.label) AS label, CASE WHEN ex.label IS NOT NULL THEN CASE WHEN same THEN 0.95 ELSE 0.9 END WHEN st.label IS NOT NULL THEN 0.85 END::DOUBLE AS confidence, CASE WHEN ex.label IS NOT NULL THEN 'exact' WHEN st.label IS NOT NULL THEN 'stereo-stripped' END AS method
        FROM t LEFT JOIN ex USING (text) LEFT JOIN st USING (text)""",
    "ground_diseases": f"""WITH t AS (SELECT DISTINCT disease_text AS text FROM diagnoses WHERE disease_text IS NOT NULL), k AS (SELECT DISTINCT omim FROM disease_aliases),
        l AS (SELECT key, min(omim) AS omim FROM (SELECT omim, {_key_sql('alias', _DISEASE_KEEP)} AS key FROM disease_aliases) WHERE key <> '' GROUP BY key),
        x AS (SELECT text, 'OMIM:' || nullif(regexp_extract(text, '(?:OMIM|MIM)\\s*[#*:]?\\s*(\\d{{6}})', 1), '') AS given, {_key_sql("regexp_replace(text, '\\((?:OMIM|MIM|ORPHA)[^)]*\\)', '', 'g')", _DISEASE_KEEP)} AS key FROM t)
        SELECT text, coalesce(k.omim, l.omim) AS omim, CASE WHEN k.omim IS NOT NULL THEN 0.9 WHEN l.omim IS NOT NULL THEN 0.95 END::DOUBLE AS confidence, CASE WHEN k.omim IS NOT NULL THEN 'omim-in-text' WHEN l.omim IS NOT NULL THEN 'alias' END AS method
        FROM x LEFT JOIN k ON k.omim = x.given LEFT JOIN l USING (key)""",
    "gene_cascade": r"""WITH g AS (SELECT x.gene_symbol AS s, x.hgnc_id AS h FROM (SELECT unnest(record.genetic_findings) AS x FROM individuals) WHERE x IS NOT NULL),
        k AS (SELECT s AS symbol, min(h) AS h FROM g WHERE h IS NOT NULL AND regexp_matches(s, '^[A-Z]+[0-9]+$') GROUP BY s),
        a AS (SELECT lower(substr(symbol, 1, 2)) || substr(symbol, 3) AS alias, min(symbol) AS of FROM k GROUP BY 1),
        d AS (SELECT DISTINCT s AS text, regexp_replace(trim(s), '[^A-Za-z0-9\-]', '', 'g') AS c FROM g WHERE s IS NOT NULL),
        j AS (SELECT text, k1.symbol AS e, k2.symbol AS u, a.of AS al FROM d LEFT JOIN k k1 ON k1.symbol = c LEFT JOIN k k2 ON k2.symbol = upper(c) LEFT JOIN a ON a.alias = c)
        SELECT text, coalesce(e, u, al) AS gene, k.h AS hgnc_id, CASE WHEN e IS NOT NULL THEN 0.98 WHEN u IS NOT NULL THEN 0.95 WHEN al IS NOT NULL THEN 0.9 END::DOUBLE AS confidence FROM j LEFT JOIN k ON k.symbol = coalesce(e, u, al)""",
    "unit_normalise": f"""WITH m AS (SELECT * FROM (VALUES {_UNITS}) AS v(k, v)), u AS (SELECT unit, count(*) AS n, regexp_replace(replace(replace(replace(lower(trim(unit, ' ')), 'litre', 'l'), 'liter', 'l'), 'μ', 'µ'), '\\s+', ' ', 'g') AS k FROM measurements WHERE unit IS NOT NULL GROUP BY unit)
        SELECT unit, CASE WHEN unit = '' THEN NULL ELSE coalesce(m1.v, m2.v, trim(unit, ' ')) END AS ucum, n FROM u LEFT JOIN m m1 ON m1.k = u.k LEFT JOIN m m2 ON m2.k = replace(u.k, ' ', '')""",
    "record_slugs": "SELECT 'PMID_' || pmid || '_' || coalesce(nullif(substr(regexp_replace(regexp_replace(coalesce(local_id, ''), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40), ''), 'individual') AS rebuilt, count(*) AS n_local_ids FROM (SELECT DISTINCT pmid, local_id FROM individuals) GROUP BY 1",
    "disease_queries": """SELECT omim, '(' || string_agg('"' || alias || '"[tiab]', ' OR ' ORDER BY alias) || ') AND ("Case Reports"[pt])' AS query FROM (SELECT DISTINCT omim, alias FROM disease_aliases) GROUP BY omim""",
    "publication_dates": r"SELECT doc_id, CASE WHEN len(string_split(pub_date, '-')) = 3 THEN pub_date ELSE nullif(regexp_extract(pub_date, '^(\d{4})', 1), '') END AS pub_date, CASE WHEN coalesce(pub_year, 0) = 0 THEN 'unknown' WHEN pub_year <= 1999 THEN 'pre2000' WHEN pub_year <= 2014 THEN '2000-2014' ELSE '2015+' END AS band FROM documents WHERE pub_date IS NOT NULL",
    "squashed_abstracts": "WITH s AS (SELECT doc_id, trim(regexp_replace(abstract, '[\\s\\x0B\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g')) AS s FROM documents WHERE abstract IS NOT NULL) SELECT doc_id, length(s) AS chars, sha256(s) AS digest FROM s",
    "text_digests": "SELECT doc_id, CASE WHEN coalesce(text, '') <> '' THEN sha256(text) END AS input_sha256 FROM documents",
}
