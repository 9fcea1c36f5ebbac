"""Queries on records: linkage, samples, validation, facts, exports, phenopackets, review metrics, overviews; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import numbers, text
from ..operators import facts, linkage, overview, phenopacket, review, sampling, validation
from ..operators.grounding import small
from ..session import table as t
from .documents import _DOCS, _docs, _records

_ONE = "(SELECT * FROM individuals WHERE record_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY extracted_at) = 1)"


def _recs(spark: SparkSession, d: str) -> DataFrame:
    """Every record once (its first extraction)."""
    r = t(spark, d, "individuals").where("record_id is not null")
    first = r.groupBy("record_id").agg(F.min("extracted_at").alias("extracted_at"))
    return r.join(first, ["record_id", "extracted_at"], "left_semi").dropDuplicates(["record_id"])


# -- linkage ---------------------------------------------------------------------------------------------------------
def entity_links(spark: SparkSession, d: str) -> DataFrame:
    return linkage.link(linkage.features(_recs(spark, d), _docs(spark, d, "pmid", "pub_year", "authors")))


def variant_keys(spark: SparkSession, d: str) -> DataFrame:
    f = linkage.features(_recs(spark, d), _docs(spark, d, "pmid", "pub_year", "authors"))
    return f.select("record_id", F.explode("keys").alias("key"))


def birth_years(spark: SparkSession, d: str) -> DataFrame:
    f = linkage.features(_recs(spark, d), _docs(spark, d, "pmid", "pub_year", "authors"))
    return f.select("record_id", F.col("birth_year").cast("bigint").alias("birth_year"))


def age_days(spark: SparkSession, d: str) -> DataFrame:
    x = _recs(spark, d)
    return x.select("record_id", *[numbers.age_days(F.col(f"record.subject.{a}.iso8601")).alias(a) for a in validation.AGES])


# -- sampling --------------------------------------------------------------------------------------------------------
def _pool(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d, "pmid", "title", "abstract", "pub_types", "pub_year", "fulltext_tier", "is_open_access", "pmcid", "lang", "language")
    docs = docs.where(F.coalesce("language", F.lit("eng")) == "eng").withColumn("in_epmc", F.lit(0))
    return docs.withColumn("set_name", F.concat(F.lit("lang:"), F.coalesce("lang", F.lit("none"))))


def doc_kinds(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "documents")
    return x.select("doc_id", sampling.document_kind(F.col("title"), F.col("abstract"), F.col("pub_types")).alias("kind"), sampling.fulltext_expected(F.col("fulltext_tier"), F.lit(0), F.col("is_open_access"), F.col("pmcid")).alias("ft"))


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.draw(_pool(spark, d)).select("set_name", "pmid", "ft", "band", "kind")


def sample_summary(spark: SparkSession, d: str) -> DataFrame:
    s = stratified_sample(spark, d)
    parts = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(c).cast("string").alias("value")) for k, c in (("set", "set_name"), ("fulltext", "ft"), ("band", "band"), ("kind", "kind"))])
    return s.select(F.explode(parts).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def assign_reviewers(spark: SparkSession, d: str) -> DataFrame:
    return sampling.assign(t(spark, d, "individuals").where("record_id is not null"), ["ada", "ben", "cai"], 20, 0.2, seed=1)


# -- validation ------------------------------------------------------------------------------------------------------
def validate_rules(spark: SparkSession, d: str) -> DataFrame:
    x = _recs(spark, d).select("record_id", F.explode(validation.issues()).alias("i"))
    return x.select("record_id", "i.severity", "i.path", "i.msg")


def record_confidence(spark: SparkSession, d: str) -> DataFrame:
    x = _recs(spark, d).withColumn("found", validation.issues())
    return x.select("record_id", validation.valid(F.col("found")).alias("valid"), validation.confidence(F.col("found")).alias("confidence"))


# -- facts and exports -----------------------------------------------------------------------------------------------
def facts_flatten(spark: SparkSession, d: str) -> DataFrame:
    f = facts.facts(_recs(spark, d))
    return f.where("grp in ('phenotype', 'genetic_finding', 'diagnosis', 'treatment', 'outcome', 'family')").drop("i")


def facts_measured(spark: SparkSession, d: str) -> DataFrame:
    """Facts of subject and measurements."""
    return facts.facts(_recs(spark, d)).where("grp in ('subject', 'measurement')").drop("i")


def fact_counts(spark: SparkSession, d: str) -> DataFrame:
    return facts.facts(_recs(spark, d)).groupBy("grp", "verification").agg(F.count("*").alias("n"))


def case_sheets(spark: SparkSession, d: str) -> DataFrame:
    return facts.case_sheets(_recs(spark, d))


def final_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    x = _recs(spark, d).withColumn("f", facts.final_diagnosis(F.col("record.diagnoses")))
    return x.select("record_id", F.col("f.disease_text").alias("disease_text"), F.col("f.confidence_tier").alias("confidence_tier"))


# -- phenopackets ----------------------------------------------------------------------------------------------------
def phenopacket_digest(spark: SparkSession, d: str) -> DataFrame:
    """Scalar digest of every phenopacket that is built from a record."""
    p = phenopacket.with_added(_recs(spark, d)).select("record_id", phenopacket.phenopacket(F.col("record"), F.col("record_id"), F.col("pmid")).alias("p"))
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    i = F.col("p.interpretations")[0]
    quantities = F.filter("p.measurements", lambda m: m["value"]["quantity"].isNotNull())
    return p.select(
        "record_id", F.col("p.subject.sex").alias("sex"), F.col("p.subject.timeAtLastEncounter.age.iso8601duration").alias("last_seen"), F.col("p.subject.vitalStatus.status").alias("vital_status"),
        n(F.col("p.phenotypicFeatures")).alias("n_features"), n(F.col("p.measurements")).alias("n_measurements"), n(quantities).alias("n_quantities"), 
        i["progressStatus"].alias("progress"), n(i["diagnosis"]["genomicInterpretations"]).alias("n_variants"), n(F.col("p.medicalActions")).alias("n_actions"),
    )


def phenopacket_issues(spark: SparkSession, d: str) -> DataFrame:
    """Structural problems of the stored phenopackets."""
    x = t(spark, d, "individuals").where("phenopacket is not null").select(F.explode(phenopacket.structural_issues(F.col("phenopacket"))).alias("issue"))
    return x.groupBy("issue").agg(F.count("*").alias("n"))


def phenopacket_texts(spark: SparkSession, d: str) -> DataFrame:
    return phenopacket.with_added(_recs(spark, d)).select("record_id", phenopacket.phenopacket_json(F.col("record"), F.col("record_id"), F.col("pmid")).alias("phenopacket"))


# -- review metrics --------------------------------------------------------------------------------------------------
def _decisions(spark: SparkSession, d: str) -> DataFrame:
    """Stored diagnoses stand in for reviewed facts: the verdict follows from status and tier of each."""
    x = t(spark, d, "diagnoses").where("fact_id is not null")
    v = F.when(F.col("status").isNull(), "Unsure").when(F.col("disease_text").isNull(), "Not in paper").when(F.col("status") == "FINAL", "Correct").when(F.col("status") == "DIFFERENTIAL", "Partly correct").otherwise("Wrong value")
    rows = x.select("fact_id", F.coalesce("confidence_tier", F.lit("none")).alias("grp"), v.alias("verdict"), "extracted_at")
    return review.primary(rows, [F.col("extracted_at"), F.col("verdict"), F.col("grp")])


def review_metrics(spark: SparkSession, d: str) -> DataFrame:
    missed = t(spark, d, "diagnoses").where("anchor is null").select(F.coalesce("confidence_tier", F.lit("none")).alias("grp"))
    return review.metrics(_decisions(spark, d).select("grp", "verdict"), missed)


def kappa(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of the two raters on whether a document is about a subject (all pairs of rated document and subject)."""
    lab = t(spark, d, "subject_labels")
    both = lab.groupBy("doc_id").agg(F.countDistinct("rater").alias("n")).where("n = 2").select("doc_id")
    grid = both.join(small(t(spark, d, "subjects").select("subject")))
    said = lambda r, c: lab.where(F.col("rater") == r).select("doc_id", "subject", F.lit("yes").alias(c)).distinct()
    x = grid.join(said(1, "a"), ["doc_id", "subject"], "left").join(said(2, "b"), ["doc_id", "subject"], "left").fillna("no", ["a", "b"])
    return review.agreement(x.select("a", "b"))


# -- overviews -------------------------------------------------------------------------------------------------------
def overview_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Words per document and language."""
    x = t(spark, d, "documents").where("text is not null").select(F.coalesce("lang", F.lit("none")).alias("lang"), F.size(F.split(F.trim(F.regexp_replace("text", r"[ \t\r\n]+", " ")), " ")).alias("words"))
    return overview.percentiles(x, "words", ["lang"]).withColumns({"low": F.col("low").cast("bigint"), "high": F.col("high").cast("bigint")})


def dense_year_axis(spark: SparkSession, d: str) -> DataFrame:
    x = t(spark, d, "documents").where("pub_year is not null").groupBy("pub_year").agg(F.count("*").alias("n"))
    return overview.dense_axis(x, "pub_year", "n", 1980, 2030)


def band_crosstab(spark: SparkSession, d: str) -> DataFrame:
    """Documents by year band and licence group, with totals over either and both."""
    x = t(spark, d, "documents").select(numbers.year_band(F.col("pub_year")).alias("band"), overview.licence_group(F.col("license")).alias("licence"))
    return x.cube("band", "licence").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).select(F.when(F.col("g").bitwiseAND(2) > 0, "total").otherwise(F.col("band")).alias("band"), F.when(F.col("g").bitwiseAND(1) > 0, "total").otherwise(F.col("licence")).alias("licence"), "n")


def patients_per_article(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "individuals").groupBy("pmid").agg(F.countDistinct("record_id").alias("patients"))
    return n.groupBy("patients").agg(F.count("*").alias("articles"))


def year_interpolation(spark: SparkSession, d: str) -> DataFrame:
    """Approximate year of every paper from the first numbers of the years' papers."""
    docs = _docs(spark, d, "pmid", "pub_year")
    anchors = docs.where("pub_year is not null and pmid rlike '^[0-9]+$'").groupBy(F.floor(F.col("pmid").cast("bigint") / 500).alias("b")).agg(F.min(F.col("pmid").cast("bigint")).alias("k"), F.round(F.avg("pub_year"), 3).alias("v")).drop("b")
    keys = docs.where("pmid rlike '^[0-9]+$'").select("pmid", F.col("pmid").cast("bigint").alias("k"))
    return overview.interpolate(keys, anchors).select("pmid", F.round("v", 2).alias("approx_year"))


def topk_quality(spark: SparkSession, d: str) -> DataFrame:
    """The five dearest parts of each brand."""
    from pyspark.sql import Window

    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return t(spark, d, "part").withColumn("r", F.row_number().over(w)).where("r <= 5").select("p_brand", "p_partkey", "p_retailprice", F.col("r").cast("bigint").alias("r"))


def json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """JSON properties decoded, missing or invalid text kept as it is."""
    x = t(spark, d, "events")
    v = F.try_parse_json("props")
    return x.select("event_id", F.when(v.isNotNull(), "json").when(F.col("props").isNotNull(), "text").otherwise("none").alias("kind"), F.try_variant_get(v, "$.k", "string").alias("k"))


QUERIES = {f.__name__: f for f in (
    entity_links, variant_keys, birth_years, age_days, doc_kinds, stratified_sample, sample_summary, assign_reviewers, validate_rules, record_confidence, facts_flatten, facts_measured, fact_counts, case_sheets, final_diagnosis,
    phenopacket_digest, phenopacket_issues, phenopacket_texts,
    review_metrics, kappa, overview_percentiles, dense_year_axis, band_crosstab, patients_per_article, year_interpolation, topk_quality, json_roundtrip,
)}


def _days_sql(c: str) -> str:
    part = lambda u, f: f"coalesce(TRY_CAST(nullif(regexp_extract({c}, '^P[^T]*?(\\d+){u}', 1), '') AS DOUBLE), 0) * {f}"
    return f"CASE WHEN regexp_matches({c}, '^P(\\d+Y)?(\\d+M)?(\\d+W)?(\\d+D)?(T(\\d+H)?(\\d+M)?(\\d+S)?)?$') AND {c} <> 'P' THEN {part('Y', 365.25)} + {part('M', 30.44)} + {part('W', '7.0')} + {part('D', '1.0')} END"


_S = "record.subject"
_FIRST_AGE = f"coalesce({', '.join(_days_sql(f'{_S}.{a}.iso8601') for a in ('age_at_last_followup', 'age_at_presentation', 'age_at_onset'))})"
_FEATS = f"""one AS {_ONE}, docs AS {_DOCS},
    feats AS (SELECT record_id, o.pmid, record.subject.sex AS sex, authors, CASE WHEN coalesce(pub_year, 0) <> 0 THEN CAST(trunc(pub_year - {_FIRST_AGE} / 365.25) AS BIGINT) END AS birth_year FROM one o LEFT JOIN docs d ON o.pmid = d.pmid WHERE valid = 1),
    g AS (SELECT record_id, pmid, unnest(record.genetic_findings) AS x FROM one WHERE valid = 1),
    ks AS (SELECT DISTINCT record_id, pmid, upper(coalesce(x.gene_symbol, '')) || ':' || lower(regexp_replace(v, '[^A-Za-z0-9>_]', '', 'g')) AS key FROM (SELECT record_id, pmid, x, unnest([x.variant_hgvs_c, x.variant_hgvs_p, x.variant_text]) AS v FROM g WHERE x IS NOT NULL) WHERE coalesce(v, '') <> '')"""
# Fixed values of the SQL, written out apart from the operators' own.
_KIND_RE = {
    "count": r"\b(?:\d+|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty|thirty|forty|fifty)\s+(?:unrelated\s+|new\s+|additional\s+|further\s+|japanese\s+|chinese\s+|turkish\s+|italian\s+|\w+\s+)?(?:patients|cases|children|infants|siblings|sibs|families|individuals|probands|subjects|brothers|sisters|neonates|newborns|adults|women|men|boys|girls)\b",
    "words": r"\b(case series|series of|cohort|retrospective|prospective|registry|multicenter|multicentre|natural history|long-term follow-up of \d+|clinical spectrum|in \d+ patients)\b",
    "two": r"\b(two|three|2|3) (cases|patients|siblings|sibs|brothers|sisters|families)\b",
    "review": r"\b(review of the literature|literature review|systematic review|review of \d+ (reported )?cases|reported cases)\b",
}


def _kind_sql() -> str:
    tx = "(coalesce(title, '') || chr(10) || substr(coalesce(abstract, ''), 1, 600))"
    has = lambda c, k: f"regexp_matches({c}, '{_KIND_RE[k]}', 'i')"
    pt = lambda *v: f"list_has_any(coalesce(pub_types, []), [{', '.join(repr(x) for x in v)}])"
    ti = "coalesce(title, '')"
    cnt = f"coalesce(nullif(regexp_extract({ti}, '({_KIND_RE['count']})', 1, 'i'), ''), nullif(regexp_extract({tx}, '({_KIND_RE['count']})', 1, 'i'), ''))"
    return f"""CASE WHEN {has(tx, 'words')} OR {has(ti, 'count')} OR {pt("Multicenter Study", "Observational Study", "Clinical Study")} THEN CASE WHEN coalesce(regexp_matches({cnt}, '^{_KIND_RE['two']}', 'i'), false) THEN 'small_series' ELSE 'series' END
        WHEN {has(ti, 'two')} OR regexp_matches(substr(coalesce(abstract, ''), 1, 300), '{_KIND_RE['two']}', 'i') THEN 'small_series'
        WHEN {pt('Case Reports')} THEN CASE WHEN {has(tx, 'review')} OR {pt('Review', 'Systematic Review')} THEN 'case_plus_review' ELSE 'single_case' END
        WHEN {has(tx, 'count')} THEN 'series' ELSE 'other' END"""


_FT = "CASE WHEN fulltext_tier IN ('epmc', 'pmc', 'unpaywall', 'publisher') THEN true WHEN fulltext_tier = 'abstract' THEN false ELSE coalesce(is_open_access, 0) <> 0 OR coalesce(pmcid, '') <> '' END"
_BAND = "CASE WHEN coalesce(pub_year, 0) = 0 THEN 'unknown' WHEN pub_year <= 1999 THEN 'pre2000' WHEN pub_year <= 2014 THEN '2000-2014' ELSE '2015+' END"


def _age_sql(a: str) -> str:
    return f"array_to_string(list_filter([nullif({a}.iso8601, ''), nullif({a}.text, '')], lambda z: z IS NOT NULL), ' / ')"


def _join_sql(*parts: str, sep: str = "; ") -> str:
    return f"array_to_string(list_filter([{', '.join(f'nullif({p}, {chr(39)}{chr(39)})' for p in parts)}], lambda z: z IS NOT NULL), '{sep}')"


def _x(field: str) -> str:
    return f"(SELECT record_id, pmid, i, record.{field}[i + 1] AS x FROM (SELECT *, unnest(range(len(record.{field}))) AS i FROM one) WHERE record.{field}[i + 1] IS NOT NULL)"


_STATUS = lambda e: f"CASE WHEN {e} IS NULL THEN '' WHEN {e}.verification IS NULL THEN 'unverified' WHEN coalesce({e}.verification.in_anchor, false) THEN 'in anchor' WHEN coalesce({e}.verification.in_document, false) THEN 'in document' ELSE 'NOT FOUND' END"


def _fact_sql(grp: str, field: str, item: str, detail: str, grounded: str) -> str:
    return f"SELECT record_id || '#{grp}:' || i AS fact_id, record_id, pmid, '{grp}' AS grp, coalesce({item}, '') AS item, {detail} AS detail, coalesce({grounded}, '') AS grounded, coalesce(x.evidence.quote, '') AS quote, coalesce(x.evidence.anchor, '') AS anchor, {_STATUS('x.evidence')} AS verification FROM {_x(field)}"


_pre = lambda label, c: f"'{label}' || nullif({c}, '')"
_FACTS = f"""
    {_fact_sql('phenotype', 'phenotypes', "CASE WHEN coalesce(x.excluded, false) THEN 'ABSENT: ' ELSE '' END || coalesce(x.text, '')", _join_sql(_pre('onset ', _age_sql('x.onset')), 'x.severity', 'x.modifier'), _join_sql('x.hpo_id', 'x.hpo_label', sep=' '))}
    UNION ALL {_fact_sql('genetic_finding', 'genetic_findings', f"coalesce(nullif({_join_sql('x.gene_symbol', 'x.variant_hgvs_c', 'x.variant_hgvs_p', sep=' ')}, ''), x.variant_text)", _join_sql('x.zygosity', 'x.inheritance_as_stated', 'x.classification_as_reported', 'x.method', _pre('transcript ', 'x.transcript'), "CASE WHEN x.novel THEN 'novel' END"), 'x.hgnc_id')}
    UNION ALL {_fact_sql('diagnosis', 'diagnoses', 'x.disease_text', _join_sql('x.status', 'x.confidence_tier', 'x.diagnostic_route', _pre('age at dx ', _age_sql('x.age_at_diagnosis')), "CASE WHEN len(x.prior_misdiagnoses) > 0 THEN 'prior: ' || array_to_string(list_transform(x.prior_misdiagnoses, lambda z: coalesce(z, '')), '; ') END"), "''")}
    UNION ALL {_fact_sql('treatment', 'treatments', 'x.text', _join_sql('x.type', 'x.agent', _pre('response: ', 'x.response'), 'x.response_text'), "''")}
    UNION ALL SELECT record_id || '#outcome:0', record_id, pmid, 'outcome', 'outcome', record.outcome.text, '', coalesce(record.outcome.evidence.quote, ''), coalesce(record.outcome.evidence.anchor, ''), {_STATUS('record.outcome.evidence')} FROM one WHERE coalesce(record.outcome.text, '') <> ''
    UNION ALL SELECT record_id || '#family:0', record_id, pmid, 'family', 'consanguinity', CASE WHEN record.family.consanguinity THEN 'yes' ELSE 'no' END, '', '', '', '' FROM one WHERE record.family.consanguinity IS NOT NULL
    UNION ALL SELECT record_id || '#family:' || CASE WHEN record.family.consanguinity IS NULL THEN 0 ELSE 1 END, record_id, pmid, 'family', 'family history', record.family.family_history_text, '', '', '', '' FROM one WHERE coalesce(record.family.family_history_text, '') <> ''"""
_SUBJECT_SQL = f"""sub0 AS (SELECT record_id, pmid, unnest([{', '.join(f"CASE WHEN coalesce({v}, '') NOT IN ('', 'UNKNOWN_SEX', 'UNKNOWN') THEN struct_pack(o := {o}, item := '{k}', detail := {v}, quote := '', anchor := '', verification := '') END" for o, (k, v) in enumerate((*((k, f'{_S}.{k}') for k in ('sex', 'vital_status', 'ancestry_as_stated', 'country_of_care')), *((k, f'CAST({_S}.{k} AS VARCHAR)') for k in ('gestational_age_weeks', 'birth_weight_g')))))},
        {', '.join(f"CASE WHEN {_age_sql(f'{_S}.{k}')} <> '' THEN struct_pack(o := {10 + o}, item := '{k}', detail := {_age_sql(f'{_S}.{k}')}, quote := coalesce({_S}.{k}.evidence.quote, ''), anchor := coalesce({_S}.{k}.evidence.anchor, ''), verification := {_STATUS(f'{_S}.{k}.evidence')}) END" for o, k in enumerate(('age_at_onset', 'age_at_presentation', 'age_at_last_followup', 'age_at_death')))}]) AS z FROM one),
    sub AS (SELECT record_id, pmid, row_number() OVER (PARTITION BY record_id ORDER BY z.o) - 1 AS i, z.item AS item, z.detail AS detail, z.quote AS quote, z.anchor AS anchor, z.verification AS verification FROM sub0 WHERE z IS NOT NULL)"""
_MEASURED_SQL = _fact_sql('measurement', 'measurements', 'x.analyte_text', _join_sql("coalesce(nullif(x.value_text, ''), CASE WHEN coalesce(x.comparator, '') <> '' AND x.value IS NOT NULL THEN x.comparator ELSE '' END || coalesce(CAST(x.value AS VARCHAR), '') || coalesce(' ' || nullif(x.unit, ''), ''))", "CASE WHEN x.reference_range IS NOT NULL THEN 'ref ' || coalesce(nullif(x.reference_range.text, ''), concat_ws('–', CAST(x.reference_range.low AS VARCHAR), CAST(x.reference_range.high AS VARCHAR))) END", "CASE WHEN x.interpretation <> 'UNKNOWN' THEN x.interpretation END", "CASE WHEN x.specimen <> 'other' THEN 'specimen ' || nullif(x.specimen, '') END", _pre('timing ', 'x.timing'), _pre('age ', _age_sql('x.age'))), "''")
_QUOTES = "x.evidence.quote AS quote, x.evidence.anchor AS anchor, x.evidence.verification.in_anchor AS quote_in_anchor, x.evidence.verification.in_document AS quote_in_document"
_FINAL = "list_filter(record.diagnoses, lambda z: z.status = 'FINAL')[1]"
_days = {a: _days_sql(f"{_S}.{a}.iso8601") for a in validation.AGES}
_DUR = lambda c: f"(regexp_matches({c}, '^P(\\d+Y)?(\\d+M)?(\\d+W)?(\\d+D)?(T(\\d+H)?(\\d+M)?(\\d+S)?)?$') AND {c} <> 'P')"
_HC = r"^c\.[\d_+\-*]+[ACGTacgt]*(>|del|dup|ins|inv|delins)?[ACGTacgt]*$|^c\.[\d_+\-*]+(del|dup|ins|inv|delins)[ACGTacgt]*\d*$"
_HP = r"^p\.\(?[A-Z][a-z]{2}\d+(?:[A-Z][a-z]{2}|\*|=|Ter|fs.*|del.*|dup.*|ins.*)?\)?$|^p\.\(?[A-Z]\d+[A-Z*=]\)?$"
_ISSUES = " UNION ALL ".join([
    *[f"SELECT record_id, 'error' AS severity, 'subject/{a}/iso8601' AS path, 'not an ISO 8601 duration' AS msg FROM one WHERE coalesce({_S}.{a}.iso8601, '') <> '' AND NOT {_DUR(f'{_S}.{a}.iso8601')}" for a in validation.AGES],
    f"SELECT record_id, 'warn', 'subject/age_at_onset', 'onset after presentation' FROM one WHERE {_days['age_at_onset']} > {_days['age_at_presentation']} + 1",
    f"SELECT record_id, 'warn', 'subject/age_at_death', 'death before last follow-up' FROM one WHERE {_days['age_at_death']} < {_days['age_at_last_followup']} - 1",
    f"SELECT record_id, 'info', 'subject/age_at_death', 'deceased without age at death' FROM one WHERE {_S}.vital_status = 'DECEASED' AND {_S}.age_at_death IS NULL",
    f"SELECT record_id, 'error', 'subject', 'age > 120 years' FROM one WHERE greatest({', '.join(_days.values())}) > {120 * 365.25}",
    f"SELECT record_id, 'error', 'phenotypes/' || i || '/hpo_id', 'malformed HPO id' FROM {_x('phenotypes')} WHERE coalesce(x.hpo_id, '') <> '' AND NOT regexp_matches(x.hpo_id, '^HP:\\d{{7}}$')",
    f"SELECT record_id, 'warn', 'phenotypes/' || i || '/evidence', 'no evidence quote' FROM {_x('phenotypes')} WHERE coalesce(x.evidence.quote, '') = ''",
    f"SELECT record_id, 'warn', 'measurements/' || i || '/unit', 'numeric value without unit' FROM {_x('measurements')} WHERE x.value IS NOT NULL AND coalesce(x.unit, '') = '' AND x.interpretation IS DISTINCT FROM 'UNKNOWN'",
    f"SELECT record_id, 'warn', 'measurements/' || i || '/interpretation', 'interpretation ' || x.interpretation || ' disagrees with reference range (' || e || ')' FROM (SELECT *, CASE WHEN x.value > x.reference_range.high THEN 'HIGH' WHEN x.value < x.reference_range.low THEN 'LOW' ELSE 'NORMAL' END AS e FROM {_x('measurements')}) WHERE x.value IS NOT NULL AND x.reference_range.low IS NOT NULL AND x.reference_range.high IS NOT NULL AND x.interpretation IN ('HIGH', 'LOW', 'NORMAL') AND x.interpretation <> e",
    f"SELECT record_id, 'warn', 'measurements/' || i || '/value', 'negative value' FROM {_x('measurements')} WHERE x.value < 0 AND coalesce(x.unit_ucum, '') <> 'mm[Hg]'",
    f"SELECT record_id, 'warn', 'measurements/' || i || '/evidence', 'no evidence quote' FROM {_x('measurements')} WHERE coalesce(x.evidence.quote, '') = ''",
    f"SELECT record_id, 'warn', 'genetic_findings/' || i || '/variant_hgvs_c', 'HGVS c. not recognised: ' || x.variant_hgvs_c FROM {_x('genetic_findings')} WHERE coalesce(x.variant_hgvs_c, '') <> '' AND NOT regexp_matches(trim(x.variant_hgvs_c), '{_HC}')",
    f"SELECT record_id, 'warn', 'genetic_findings/' || i || '/variant_hgvs_p', 'HGVS p. not recognised: ' || x.variant_hgvs_p FROM {_x('genetic_findings')} WHERE coalesce(x.variant_hgvs_p, '') <> '' AND NOT regexp_matches(trim(x.variant_hgvs_p), '{_HP}')",
    f"SELECT y.record_id, 'warn', 'genetic_findings/' || i || '/zygosity', 'hemizygous in a female' FROM {_x('genetic_findings')} y JOIN one o USING (record_id) WHERE x.zygosity = 'HEMIZYGOUS' AND o.record.subject.sex = 'FEMALE'",
    f"SELECT record_id, 'warn', 'genetic_findings/' || i || '/gene_symbol', 'gene symbol not recognised: ' || coalesce(x.gene_symbol, 'None') FROM {_x('genetic_findings')} WHERE x.\"grounding\".status = 'unresolved'",
    f"SELECT record_id, 'warn', 'diagnoses', 'no FINAL diagnosis' FROM one WHERE {_FINAL} IS NULL",
    f"SELECT y.record_id, 'warn', 'diagnoses/' || i || '/confidence_tier', 'MOLECULAR tier without genetic findings' FROM {_x('diagnoses')} y JOIN one o USING (record_id) WHERE x.confidence_tier = 'MOLECULAR' AND coalesce(len(o.record.genetic_findings), 0) = 0",
    f"SELECT record_id, 'warn', 'diagnoses/' || i || '/confidence_tier', 'ENZYMATIC tier without enzyme activities' FROM {_x('diagnoses')} WHERE x.confidence_tier = 'ENZYMATIC'",
])
_LIVE = lambda f: f"list_filter(coalesce(record.{f}, []), lambda z: z IS NOT NULL)"
_NALL = " + ".join(f"len({_LIVE(f)})" for f in ("phenotypes", "measurements", "genetic_findings", "diagnoses"))
_NGR = " + ".join(f"len(list_filter({_LIVE(f)}, lambda z: z.\"grounding\".status = 'grounded'))" for f in ("phenotypes", "measurements", "genetic_findings", "diagnoses"))
_POOL = f"""docs AS {_DOCS}, pool AS (SELECT 'lang:' || coalesce(lang, 'none') AS set_name, pmid, {_FT} AS ft, {_BAND} AS band, {_kind_sql()} AS kind, sha1('1:' || pmid) AS h FROM docs WHERE coalesce(language, 'eng') = 'eng'),
    sizes AS (SELECT set_name, count(*) FILTER (ft) AS nf, count(*) FILTER (NOT ft) AS na FROM pool GROUP BY set_name),
    takes AS (SELECT set_name, least(25 - least(18, nf), na) AS ta, least(25 - least(25 - least(18, nf), na), nf) AS tf FROM sizes),
    p0 AS (SELECT pool.*, CASE WHEN ft THEN tf ELSE ta END AS n, CASE WHEN ft THEN 4 ELSE 1 END AS ms, count(*) OVER (PARTITION BY set_name, ft) AS tot, count(*) OVER (PARTITION BY set_name, ft, band) AS inb, kind IN ('series', 'small_series') AS ser FROM pool JOIN takes USING (set_name)),
    p1 AS (SELECT *, ser AND row_number() OVER (PARTITION BY set_name, ft, ser ORDER BY h) <= least(ms, n) AS s1 FROM p0),
    p2a AS (SELECT *, greatest(0, 2 - count(*) FILTER (s1) OVER (PARTITION BY set_name, ft, band)) AS need, count(*) FILTER (s1) OVER (PARTITION BY set_name, ft) AS c1, row_number() OVER (PARTITION BY set_name, ft, band, s1 ORDER BY h) AS r FROM p1),
    p2b AS (SELECT *, NOT s1 AND r <= need AS w FROM p2a),
    p2 AS (SELECT *, w AND row_number() OVER (PARTITION BY set_name, ft, w ORDER BY band, h) <= n - c1 AS s2 FROM p2b),
    p3a AS (SELECT *, n - count(*) FILTER (s1 OR s2) OVER (PARTITION BY set_name, ft) AS rest, row_number() OVER (PARTITION BY set_name, ft, band, (s1 OR s2) ORDER BY h) AS r3 FROM p2),
    p3b AS (SELECT *, NOT (s1 OR s2) AND rest > 0 AND r3 <= greatest(0, round_even(rest * inb / tot, 0)) AS w3 FROM p3a),
    p3 AS (SELECT *, w3 AND row_number() OVER (PARTITION BY set_name, ft, w3 ORDER BY band, h) <= rest AS s3 FROM p3b),
    p4 AS (SELECT *, s1 OR s2 OR s3 AS done, count(*) FILTER (s1 OR s2 OR s3) OVER (PARTITION BY set_name, ft) AS c3 FROM p3),
    sample AS (SELECT set_name, pmid, ft, band, kind FROM (SELECT *, row_number() OVER (PARTITION BY set_name, ft, done ORDER BY h) AS r4 FROM p4) WHERE done OR r4 <= n - c3)"""
_DEC = "dec AS (SELECT fact_id, coalesce(confidence_tier, 'none') AS grp, CASE WHEN status IS NULL THEN 'Unsure' WHEN disease_text IS NULL THEN 'Not in paper' WHEN status = 'FINAL' THEN 'Correct' WHEN status = 'DIFFERENTIAL' THEN 'Partly correct' ELSE 'Wrong value' END AS verdict, extracted_at FROM diagnoses WHERE fact_id IS NOT NULL), prim AS (SELECT * FROM dec QUALIFY row_number() OVER (PARTITION BY fact_id ORDER BY extracted_at NULLS FIRST, verdict, grp) = 1)"
_r = lambda a, b: f"CASE WHEN ({b}) <> 0 THEN CAST(printf('%.3f', CAST({a} AS DOUBLE) / ({b})) AS DOUBLE) END"
SQL = {
    "entity_links": f"""WITH {_FEATS}, pr AS (SELECT a.record_id AS record_a, b.record_id AS record_b, min(a.key) AS shared_key FROM ks a JOIN ks b ON a.key = b.key AND a.record_id < b.record_id AND a.pmid IS DISTINCT FROM b.pmid GROUP BY 1, 2),
        x AS (SELECT pr.*, fa.sex AS sa, fb.sex AS sb, nullif(fa.birth_year, 0) AS ya, nullif(fb.birth_year, 0) AS yb, len(list_intersect(coalesce(fa.authors, []), coalesce(fb.authors, []))) AS n FROM pr JOIN feats fa ON fa.record_id = record_a JOIN feats fb ON fb.record_id = record_b),
        s AS (SELECT *, coalesce(sa NOT IN ('', 'UNKNOWN_SEX') AND sb NOT IN ('', 'UNKNOWN_SEX'), false) AS ks_ FROM x),
        z AS (SELECT *, CAST(printf('%.2f', 0.5::DOUBLE + CASE WHEN ks_ THEN CASE WHEN sa = sb THEN 0.1 ELSE -0.5 END ELSE 0 END::DOUBLE + CASE WHEN abs(ya - yb) <= 2 THEN 0.2 WHEN abs(ya - yb) > 2 THEN -0.3 ELSE 0 END::DOUBLE + CASE WHEN n > 0 THEN 0.15 ELSE 0 END::DOUBLE) AS DOUBLE) AS score FROM s)
        SELECT record_a, record_b, shared_key, n AS n_authors, score, concat_ws('; ', 'shared variant ' || shared_key, CASE WHEN ks_ THEN CASE WHEN sa = sb THEN 'same sex' ELSE 'different sex' END END, CASE WHEN abs(ya - yb) <= 2 THEN 'birth year ~' || ya WHEN abs(ya - yb) > 2 THEN 'birth years ' || ya || ' vs ' || yb END, CASE WHEN n > 0 THEN n || ' shared authors' END) AS evidence FROM z WHERE score >= 0.6""",
    "variant_keys": f"WITH {_FEATS} SELECT record_id, key FROM ks",
    "birth_years": f"WITH {_FEATS} SELECT record_id, birth_year FROM feats",
    "age_days": f"WITH one AS {_ONE} SELECT record_id, {', '.join(f'{v} AS {k}' for k, v in _days.items())} FROM one",
    "doc_kinds": f"SELECT doc_id, {_kind_sql()} AS kind, {_FT} AS ft FROM documents",
    "stratified_sample": f"WITH {_POOL} SELECT * FROM sample",
    "sample_summary": f"WITH {_POOL} SELECT 'set' AS dimension, set_name AS value, count(*) AS n FROM sample GROUP BY 2 UNION ALL SELECT 'fulltext', CAST(ft AS VARCHAR), count(*) FROM sample GROUP BY 2 UNION ALL SELECT 'band', band, count(*) FROM sample GROUP BY 2 UNION ALL SELECT 'kind', kind, count(*) FROM sample GROUP BY 2",
    "assign_reviewers": """WITH r AS (SELECT record_id, row_number() OVER (ORDER BY sha1('1:' || record_id)) - 1 AS k FROM (SELECT DISTINCT record_id FROM individuals WHERE record_id IS NOT NULL)),
        a AS (SELECT *, k % 3 AS who, (k // 3) // 20 + 1 AS batch FROM r), b AS (SELECT *, row_number() OVER (PARTITION BY who, batch ORDER BY k) - 1 AS j, count(*) OVER (PARTITION BY who, batch) AS n FROM a)
        SELECT record_id, ['ada', 'ben', 'cai'][who + 1] AS reviewer, batch, 'primary' AS role FROM b UNION ALL SELECT record_id, ['ada', 'ben', 'cai'][(who + 1) % 3 + 1], batch, 'second' FROM b WHERE j < round_even(n * 0.2, 0)""",
    "validate_rules": f"WITH one AS {_ONE} {_ISSUES}",
    "record_confidence": f"WITH one AS {_ONE}, iss AS ({_ISSUES}), c AS (SELECT record_id, count(*) FILTER (severity = 'warn') AS w, count(*) FILTER (severity = 'error') AS e FROM iss GROUP BY record_id) SELECT record_id, coalesce(e, 0) = 0 AS valid, CASE WHEN ({_NALL}) > 0 THEN CAST(printf('%.3f', greatest(0::DOUBLE, CAST({_NGR} AS DOUBLE) / ({_NALL}) - 0.03::DOUBLE * coalesce(w, 0))) AS DOUBLE) ELSE 0 END::DOUBLE AS confidence FROM one LEFT JOIN c USING (record_id)".replace("CAST(len", "CAST((len").replace(" AS DOUBLE) / (", ") AS DOUBLE) / ("),
    "facts_flatten": f"WITH one AS {_ONE} SELECT * FROM ({_FACTS})",
    "facts_measured": f"""WITH one AS {_ONE}, {_SUBJECT_SQL}
        SELECT record_id || '#subject:' || i AS fact_id, record_id, pmid, 'subject' AS grp, item, detail, '' AS grounded, quote, anchor, verification FROM sub
        UNION ALL {_MEASURED_SQL}""",
    "case_sheets": f"""WITH one AS {_ONE}, {_SUBJECT_SQL}, f AS (SELECT record_id, 'subject' AS grp, i, item, detail, anchor, verification FROM sub UNION ALL SELECT record_id, grp, CAST(regexp_extract(fact_id, ':(\\d+)$', 1) AS BIGINT), item, detail, anchor, verification FROM ({_FACTS} UNION ALL {_MEASURED_SQL})),
        l AS (SELECT record_id, grp, i, '- ' || CASE verification WHEN 'in anchor' THEN '✓' WHEN 'in document' THEN '~' WHEN 'NOT FOUND' THEN '✗' ELSE '·' END || ' ' || coalesce(item, '') || CASE WHEN coalesce(detail, '') <> '' THEN ' — ' || detail ELSE '' END || CASE WHEN coalesce(anchor, '') <> '' THEN ' [' || anchor || ']' ELSE '' END AS line FROM f),
        g AS (SELECT record_id, grp, list_position(['subject', 'family', 'phenotype', 'measurement', 'genetic_finding', 'diagnosis', 'treatment', 'outcome'], grp) AS o, string_agg(line, chr(10) ORDER BY i) AS body FROM l GROUP BY record_id, grp)
        SELECT record_id, '# ' || record_id || chr(10) || chr(10) || string_agg('## ' || grp || chr(10) || body, chr(10) || chr(10) ORDER BY o) AS sheet FROM g GROUP BY record_id""",
    "fact_counts": f"""WITH one AS {_ONE}, f AS (SELECT grp, verification FROM ({_FACTS}) UNION ALL SELECT 'measurement', {_STATUS('x.evidence')} FROM {_x('measurements')}
        UNION ALL SELECT 'subject', '' FROM (SELECT unnest([CASE WHEN {_S}.sex NOT IN ('UNKNOWN_SEX', 'UNKNOWN') THEN {_S}.sex END, CASE WHEN {_S}.vital_status NOT IN ('UNKNOWN_SEX', 'UNKNOWN') THEN {_S}.vital_status END, {_S}.ancestry_as_stated, {_S}.country_of_care, CAST({_S}.gestational_age_weeks AS VARCHAR), CAST({_S}.birth_weight_g AS VARCHAR)]) AS v FROM one) WHERE coalesce(v, '') <> ''
        UNION ALL SELECT 'subject', {_STATUS('a.evidence')} FROM (SELECT unnest([{_S}.age_at_onset, {_S}.age_at_presentation, {_S}.age_at_last_followup, {_S}.age_at_death]) AS a FROM one) WHERE coalesce(a.iso8601, '') <> '' OR coalesce(a.text, '') <> '')
        SELECT grp, verification, count(*) AS n FROM f GROUP BY grp, verification""",
    "final_diagnosis": f"WITH one AS {_ONE} SELECT record_id, {_FINAL}.disease_text AS disease_text, {_FINAL}.confidence_tier AS confidence_tier FROM one",
    "phenopacket_digest": f"""WITH one AS {_ONE} SELECT record_id, coalesce({_S}.sex, 'UNKNOWN_SEX') AS sex, coalesce(nullif({_S}.age_at_last_followup.iso8601, ''), nullif({_S}.age_at_presentation.iso8601, '')) AS last_seen, CASE WHEN {_S}.vital_status IN ('ALIVE', 'DECEASED') THEN {_S}.vital_status END AS vital_status,
        len(list_filter({_LIVE('phenotypes')}, lambda z: coalesce(z.hpo_id, '') <> '')) AS n_features, len({_LIVE('measurements')}) AS n_measurements, len(list_filter({_LIVE('measurements')}, lambda z: z.value IS NOT NULL)) AS n_quantities,
        CASE WHEN {_FINAL} IS NOT NULL OR len({_LIVE('genetic_findings')}) > 0 THEN CASE WHEN {_FINAL}.confidence_tier = 'MOLECULAR' THEN 'SOLVED' ELSE 'IN_PROGRESS' END END AS progress,
        len({_LIVE('genetic_findings')}) AS n_variants, len({_LIVE('treatments')}) AS n_actions FROM one""",
    "phenopacket_issues": """WITH p AS (SELECT phenopacket AS t, json_valid(phenopacket) AS ok FROM individuals WHERE phenopacket IS NOT NULL), v AS (SELECT ok, CASE WHEN ok THEN json_extract_string(t, '$.id') END AS a, CASE WHEN ok THEN json_extract_string(t, '$.subject') END AS b, CASE WHEN ok THEN json_extract_string(t, '$.metaData') END AS c FROM p),
        i AS (SELECT 'no JSON' AS issue FROM v WHERE NOT ok UNION ALL SELECT 'no id' FROM v WHERE ok AND a IS NULL UNION ALL SELECT 'no subject' FROM v WHERE ok AND b IS NULL UNION ALL SELECT 'no metaData' FROM v WHERE ok AND c IS NULL) SELECT issue, count(*) AS n FROM i GROUP BY issue""",
    "year_interpolation": f"""WITH docs AS {_DOCS}, n AS (SELECT pmid, CAST(pmid AS BIGINT) AS k, pub_year FROM docs WHERE regexp_matches(pmid, '^[0-9]+$')), a AS (SELECT CAST(min(k) AS DOUBLE) AS k, round(avg(pub_year), 3) AS v FROM n WHERE pub_year IS NOT NULL GROUP BY k // 500),
        j AS (SELECT n.pmid, n.k, (SELECT max(struct_pack(k := a.k, v := a.v)) FROM a WHERE a.k <= n.k) AS l, (SELECT min(struct_pack(k := a.k, v := a.v)) FROM a WHERE a.k >= n.k) AS h FROM n)
        SELECT pmid, round(coalesce(l.v + (h.v - l.v) * (k - l.k) / nullif(h.k - l.k, 0), l.v, h.v), 2) AS approx_year FROM j""",
    "review_metrics": f"""WITH {_DEC}, m AS (SELECT coalesce(confidence_tier, 'none') AS grp FROM diagnoses WHERE anchor IS NULL),
        d AS (SELECT CASE WHEN grouping(grp) = 1 THEN 'all' ELSE grp END AS grp, count(*) AS n, count(*) FILTER (verdict = 'Correct') AS correct, count(*) FILTER (verdict = 'Partly correct') AS partly, count(*) FILTER (verdict = 'Unsure') AS unsure, count(*) FILTER (verdict IN ('Wrong value', 'Wrong grounding', 'Wrong patient', 'Not in paper')) AS wrong FROM prim GROUP BY ROLLUP (grp)),
        k AS (SELECT CASE WHEN grouping(grp) = 1 THEN 'all' ELSE grp END AS grp, count(*) AS missed FROM m GROUP BY ROLLUP (grp)),
        x AS (SELECT grp, coalesce(n, 0) AS n, coalesce(correct, 0) AS correct, coalesce(partly, 0) AS partly, coalesce(unsure, 0) AS unsure, coalesce(wrong, 0) AS wrong, coalesce(missed, 0) AS missed FROM d FULL OUTER JOIN k USING (grp))
        SELECT *, {_r('correct', 'n - unsure')} AS precision_strict, {_r('(correct + partly)', 'n - unsure')} AS precision_lenient, {_r('correct', 'correct + partly + missed')} AS recall_strict, {_r('(correct + partly)', 'correct + partly + missed')} AS recall_lenient, {_r('wrong', 'n - unsure')} AS error_rate FROM x""",
    "kappa": """WITH b AS (SELECT doc_id FROM subject_labels GROUP BY doc_id HAVING count(DISTINCT rater) = 2), g AS (SELECT doc_id, subject FROM b, subjects),
        x AS (SELECT CASE WHEN EXISTS (SELECT 1 FROM subject_labels l WHERE l.doc_id = g.doc_id AND l.subject = g.subject AND l.rater = 1) THEN 'yes' ELSE 'no' END AS a, CASE WHEN EXISTS (SELECT 1 FROM subject_labels l WHERE l.doc_id = g.doc_id AND l.subject = g.subject AND l.rater = 2) THEN 'yes' ELSE 'no' END AS b FROM g),
        t AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS same, sum(CASE WHEN a = 'yes' THEN 1 ELSE 0 END) AS ay, sum(CASE WHEN b = 'yes' THEN 1 ELSE 0 END) AS bym FROM x),
        p AS (SELECT n, CAST(same AS DOUBLE) / n AS po, CAST(ay * bym + (n - ay) * (n - bym) AS DOUBLE) / (n * n) AS pe FROM t) SELECT n, CAST(printf('%.3f', po) AS DOUBLE) AS exact, CAST(printf('%.3f', (po - pe) / (1 - pe)) AS DOUBLE) AS kappa FROM p""",
    "overview_percentiles": "WITH w AS (SELECT coalesce(lang, 'none') AS lang, len(string_split(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g')), ' ')) AS words FROM documents WHERE text IS NOT NULL) SELECT lang, count(*) AS n, min(words) AS low, max(words) AS high, round(avg(words), 4) AS mean, quantile_cont(words, 0.05) AS p5, quantile_cont(words, 0.25) AS p25, quantile_cont(words, 0.5) AS p50, quantile_cont(words, 0.75) AS p75, quantile_cont(words, 0.95) AS p95 FROM w GROUP BY lang",
    "dense_year_axis": "SELECT CAST(y AS INT) AS pub_year, count(d.doc_id) AS n FROM generate_series(1980, 2030) AS g(y) LEFT JOIN documents d ON d.pub_year = y GROUP BY y",
    "band_crosstab": f"WITH x AS (SELECT {_BAND} AS band, CASE WHEN coalesce(license, '') = '' THEN 'none' WHEN contains(lower(license), 'nc') THEN 'non-commercial' WHEN contains(lower(license), 'cc0') OR contains(lower(license), 'cc by') THEN 'open' ELSE 'other' END AS licence FROM documents) SELECT CASE WHEN grouping(band) = 1 THEN 'total' ELSE band END AS band, CASE WHEN grouping(licence) = 1 THEN 'total' ELSE licence END AS licence, count(*) AS n FROM x GROUP BY CUBE (band, licence)",
    "patients_per_article": "SELECT patients, count(*) AS articles FROM (SELECT pmid, count(DISTINCT record_id) AS patients FROM individuals GROUP BY pmid) GROUP BY patients",
    "topk_quality": "SELECT p_brand, p_partkey, p_retailprice, r FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r <= 5",
    "json_roundtrip": "SELECT event_id, CASE WHEN json_valid(props) THEN 'json' WHEN props IS NOT NULL THEN 'text' ELSE 'none' END AS kind, CASE WHEN json_valid(props) THEN json_extract_string(props, '$.k') END AS k FROM events",
}
