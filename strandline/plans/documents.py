"""Queries over anchored documents and evidence quotes, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import anchors
from ..session import table as t

GROUPS = ("phenotypes", "measurements", "genetic_findings", "diagnoses", "treatments")


def _docs(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """One row per pmid: the latest harvest (its smallest doc_id on ties)."""
    docs = t(spark, d, "documents").where("pmid is not null")
    latest = docs.groupBy("pmid").agg(F.max_by("doc_id", F.struct("added_at", -F.col("doc_id"))).alias("doc_id"))
    return docs.select("doc_id", *[c for c in cols if c != "pmid"]).join(latest, "doc_id")


_DOCS = "(SELECT * FROM documents WHERE pmid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY added_at DESC NULLS LAST, doc_id) = 1)"
_ONE = "(SELECT record_id, any_value(pmid) AS pmid, any_value(record) AS record FROM individuals WHERE record_id IS NOT NULL GROUP BY record_id)"


def _records(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "individuals").where("record_id is not null").dropDuplicates(["record_id"])


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """(record_id, pmid, grp, idx, anchor, quote) of every evidence of a record's facts; repeats of a record count once.

    One scan and one explode; only the narrow rows are deduplicated.
    """

    def group(g: str):  # noqa: ANN202
        items = F.transform(f"record.{g}", lambda x, i: F.struct(F.lit(g).alias("grp"), i.cast("bigint").alias("idx"), x["evidence"]["anchor"].alias("anchor"), x["evidence"]["quote"].alias("quote"), x["evidence"].isNotNull().alias("there")))
        return F.coalesce(F.filter(items, lambda e: e["there"]), F.array())

    x = t(spark, d, "individuals").where("record_id is not null").select("record_id", "pmid", F.explode(F.concat(*map(group, GROUPS))).alias("e"))
    return x.select("record_id", "pmid", "e.grp", "e.idx", "e.anchor", "e.quote").dropDuplicates(["record_id", "grp", "idx"])


_EVIDENCE = " UNION ALL ".join(
    f"SELECT record_id, pmid, '{g}' AS grp, i AS idx, record.{g}[i + 1].evidence.anchor AS anchor, record.{g}[i + 1].evidence.quote AS quote FROM (SELECT *, unnest(range(len(record.{g}))) AS i FROM one) WHERE record.{g}[i + 1].evidence IS NOT NULL"
    for g in GROUPS
)
_LINES = rf"""
    lines AS (SELECT k, unnest(l) AS line, unnest(range(len(l))) AS p FROM (SELECT doc_id AS k, string_split(text, chr(10)) AS l FROM docs WHERE text IS NOT NULL)),
    marked AS (SELECT *,
        CASE WHEN starts_with(line, '## Abstract [abstract]') THEN 'a'
             WHEN regexp_matches(line, '^### Table (.*?) \[tab:(\d+)\]\s*$') THEN 't' || regexp_extract(line, '\[tab:(\d+)\]\s*$', 1)
             WHEN regexp_matches(line, '^#{{2,4}} (.+?) \[sec:(\d+)\]\s*$') THEN 's'
             WHEN regexp_matches(line, '^Figure (\S+): (.*)$') THEN 'f' END AS mark FROM lines),
    state AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY k ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mode,
        regexp_matches(line, '^\[sec:(\d+) ¶(\d+)\] (.*)$') AS is_par FROM marked),
    titles AS (SELECT k, arg_min(trim(substr(line, 3)), p) AS unit FROM state WHERE starts_with(line, '# ') GROUP BY k),
    abs AS (SELECT *, sum(CASE WHEN mark = 'a' THEN 0 WHEN trim(line) = '' AND had > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY p) AS ended
            FROM (SELECT *, sum(CASE WHEN trim(line) <> '' AND mark IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY p) AS had FROM state WHERE mode = 'a' AND NOT is_par)),
    pars AS (SELECT k, CAST(regexp_extract(line, '^\[sec:(\d+) ¶(\d+)\] (.*)$', 1) AS INT) AS n, CAST(regexp_extract(line, '^\[sec:(\d+) ¶(\d+)\] (.*)$', 2) AS INT) AS m, regexp_extract(line, '^\[sec:(\d+) ¶(\d+)\] (.*)$', 3) AS unit FROM state WHERE is_par),
    rows_ AS (SELECT k, CAST(substr(mode, 2) AS INT) AS n, CAST(regexp_extract(line, '^\| r(\d+) \| (.*) \|\s*$', 1) AS INT) AS m,
              list_transform(string_split(regexp_extract(line, '^\| r(\d+) \| (.*) \|\s*$', 2), ' | '), lambda x: trim(x)) AS cells
              FROM state WHERE starts_with(mode, 't') AND regexp_matches(line, '^\| r(\d+) \| (.*) \|\s*$')),
    units AS (SELECT k, 'title' AS kind, NULL::INT AS n, NULL::INT AS m, 'title' AS anchor, unit FROM titles WHERE unit <> ''
        UNION ALL SELECT k, 'abstract', NULL, NULL, 'abstract', string_agg(trim(line), chr(10) ORDER BY p) FROM abs WHERE mark IS NULL AND ended = 0 AND trim(line) <> '' GROUP BY k
        UNION ALL SELECT k, 'paragraph', n, m, 'sec:' || n || ' ¶' || m, unit FROM pars
        UNION ALL SELECT k, 'row', n, m, 'tab:' || n || ' r' || m, array_to_string(cells, ' | ') FROM rows_
        UNION ALL SELECT k, 'figure', NULL, NULL, 'fig:' || regexp_extract(line, '^Figure (\S+): (.*)$', 1), regexp_extract(line, '^Figure (\S+): (.*)$', 2) FROM state WHERE mark = 'f')"""


def units_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return anchors.units(t(spark, d, "documents").select("doc_id", "text")).select("doc_id", "kind", "n", "m", "anchor", "unit")


def table_cells(spark: SparkSession, d: str) -> DataFrame:
    """Table columns and cells, resolved."""
    return anchors.resolved(t(spark, d, "documents").select("doc_id", "text"), "doc_id").where(F.col("anchor").rlike(r"^tab:\d+.*c\d+$"))


def section_texts(spark: SparkSession, d: str) -> DataFrame:
    return anchors.resolved(t(spark, d, "documents").select("doc_id", "text"), "doc_id").where(F.col("anchor").rlike(r"^sec:\d+$"))


def _verified(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d, "pmid", "text")
    e = evidence(spark, d)
    v = anchors.verify_quotes(e, docs.select("pmid", "text"))
    k = lambda df, s: df.withColumnsRenamed({"anchor": f"_a{s}", "quote": f"_q{s}", "pmid": f"_p{s}"})
    j = e.join(k(v, "v"), (F.col("pmid").eqNullSafe(F.col("_pv"))) & F.col("anchor").eqNullSafe(F.col("_av")) & F.col("quote").eqNullSafe(F.col("_qv")), "left")
    return j.drop("_pv", "_av", "_qv")


def quote_verify(spark: SparkSession, d: str) -> DataFrame:
    return _verified(spark, d).select("record_id", "grp", "idx", "anchor_exists", "in_anchor", "in_document", F.col("start").cast("bigint").alias("start"), F.col("stop").cast("bigint").alias("stop"))


def verification_totals(spark: SparkSession, d: str) -> DataFrame:
    v = _verified(spark, d)
    return v.groupBy("record_id").agg(F.count("*").alias("total"), F.count_if("in_anchor").alias("in_anchor"), F.count_if("in_document").alias("in_document"), F.count_if(~F.col("in_document")).alias("missing"))


_RESOLVED = """
    resolved AS (SELECT k, anchor, unit AS text FROM units WHERE unit <> ''
        UNION ALL SELECT k, 'sec:' || n, string_agg(unit, chr(10) || chr(10) ORDER BY m) FROM pars GROUP BY k, n
        UNION ALL SELECT k, 'tab:' || n || ' r' || m || 'c' || (j + 1), cells[j + 1] FROM (SELECT *, unnest(range(len(cells))) AS j FROM rows_)
        UNION ALL SELECT k, 'tab:' || n || 'c' || (j + 1), string_agg(CASE WHEN j > 0 THEN cells[1] || ': ' || cells[j + 1] ELSE cells[1] END, chr(10) ORDER BY m) FROM (SELECT *, unnest(range(len(cells))) AS j FROM rows_) GROUP BY k, n, j)"""
_SQUASH = "trim(regexp_replace(replace({}, chr(160), ' '), '\\s+', ' ', 'g'))"
_VERIFY = f"""
    WITH one AS {_ONE}, docs AS {_DOCS}, {_LINES}, {_RESOLVED},
    ev AS ({_EVIDENCE}),
    n AS (SELECT e.*, {_SQUASH.format("coalesce(quote, '')")} AS q, CASE WHEN regexp_matches(e.anchor, '^tab:\\d+ r\\d+c\\d+$|^tab:\\d+ r\\d+$|^sec:\\d+( ¶\\d+)?$|^abstract$|^title$|^fig:.+$') THEN e.anchor END AS a FROM ev e),
    v AS (SELECT n.*, d.text AS full_text, r.text IS NOT NULL AS anchor_exists,
          CASE WHEN q = '' THEN 0 WHEN strpos({_SQUASH.format("r.text")}, q) > 0 THEN strpos({_SQUASH.format("r.text")}, q) WHEN length(q) > 80 THEN strpos({_SQUASH.format("r.text")}, substr(q, 1, 80)) ELSE 0 END AS p
          FROM n LEFT JOIN docs d ON n.pmid = d.pmid LEFT JOIN resolved r ON r.k = d.doc_id AND r.anchor = n.a),
    w AS (SELECT record_id, grp, idx, anchor_exists, coalesce(p, 0) > 0 AS in_anchor,
          coalesce(p > 0 OR (q <> '' AND (contains({_SQUASH.format("full_text")}, q) OR (length(q) > 80 AND contains({_SQUASH.format("full_text")}, substr(q, 1, 80))))), false) AS in_document,
          CASE WHEN p > 0 THEN p - 1 END AS start, CASE WHEN p > 0 THEN p - 1 + length(q) END AS stop FROM v)"""


def narrative_assembly(spark: SparkSession, d: str) -> DataFrame:
    u = anchors.units(_docs(spark, d, "pmid", "text").select("pmid", "text"))
    a = _records(spark, d).select("record_id", "pmid", F.explode("record.narrative_anchors").alias("anchor"))
    n = anchors.narratives(a, u)
    return n.select("record_id", F.array_join("passages.anchor", "; ").alias("anchors"), F.size("passages").cast("bigint").alias("n_units"), F.aggregate("passages", F.lit(0).cast("bigint"), lambda s, x: s + x["chars"]).alias("chars"), F.md5(F.array_join("passages.text", "\n")).alias("digest"))


def narrative_backfill(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d, "pmid", "text").select("pmid", "text")
    u = anchors.units(docs)
    r = _records(spark, d)
    titles = anchors.section_titles(docs)
    # There is no triage table: every section of the record's paper stands for what triage points at.
    where = r.select("record_id", "pmid", "local_id").join(titles.select("pmid", F.concat(F.lit("sec:"), "n").alias("anchor")).distinct(), "pmid")
    return anchors.backfill(where, evidence(spark, d), u, titles).select("record_id", "anchor")


def table_captions(spark: SparkSession, d: str) -> DataFrame:
    return anchors.table_heads(t(spark, d, "documents").select("doc_id", "text"))


QUERIES = {
    "quote_verify": quote_verify,
    "verification_totals": verification_totals,
    "units_paragraphs": units_paragraphs,
    "section_texts": section_texts,
    "table_cells": table_cells,
    "table_captions": table_captions,
    "narrative_assembly": narrative_assembly,
    "narrative_backfill": narrative_backfill,
}
# Fixed values of the SQL, written out apart from the operators' own.
_GENERIC = r"^(introduction|background|discussion|conclusion|conclusions|literature review|review of the literature|methods|materials and methods)\b"
_SELF = r"\b(our patient|the patient|this patient|the proband|our proband|this case|our case|the present case|the index case|the child|the boy|the girl|the infant|the neonate|the fetus|the family|the siblings)\b"
SQL = {
    "quote_verify": f"{_VERIFY} SELECT * FROM w",
    "verification_totals": f"{_VERIFY} SELECT record_id, count(*) AS total, count(*) FILTER (in_anchor) AS in_anchor, count(*) FILTER (in_document) AS in_document, count(*) FILTER (NOT in_document) AS missing FROM w GROUP BY record_id",
    "units_paragraphs": f"WITH docs AS (SELECT doc_id, text FROM documents), {_LINES} SELECT k AS doc_id, kind, n, m, anchor, unit FROM units",
    "section_texts": f"WITH docs AS (SELECT doc_id, text FROM documents), {_LINES}, {_RESOLVED} SELECT k AS doc_id, anchor, text FROM resolved WHERE regexp_matches(anchor, '^sec:\\d+$')",
    "table_cells": f"WITH docs AS (SELECT doc_id, text FROM documents), {_LINES}, {_RESOLVED} SELECT k AS doc_id, anchor, text FROM resolved WHERE regexp_matches(anchor, 'c\\d+$')",
    "table_captions": rf"""WITH docs AS (SELECT doc_id, text FROM documents), {_LINES},
        h AS (SELECT k, CAST(substr(mark, 2) AS INT) AS tab, regexp_extract(line, '^### Table (.*?) \[tab:(\d+)\]\s*$', 1) AS label FROM state WHERE starts_with(mark, 't')),
        q AS (SELECT k, CAST(substr(mode, 2) AS INT) AS tab, line, row_number() OVER (PARTITION BY k, mode ORDER BY p) AS r FROM state WHERE starts_with(mode, 't') AND mark IS NULL AND trim(line) <> '' AND NOT starts_with(line, '|'))
        SELECT h.k AS doc_id, h.tab, h.label, coalesce((SELECT trim(line) FROM q WHERE q.k = h.k AND q.tab = h.tab AND r = 1), '') AS caption,
               (SELECT trim(substr(arg_max(line, r), 11)) FROM q WHERE q.k = h.k AND q.tab = h.tab AND r > 1 AND starts_with(line, 'Footnotes:')) AS footnotes FROM h""",
    "narrative_assembly": rf"""WITH one AS {_ONE}, docs AS {_DOCS}, {_LINES},
        a AS (SELECT DISTINCT record_id, pmid, anchor FROM (SELECT record_id, pmid, unnest(record.narrative_anchors) AS anchor FROM one) WHERE anchor IS NOT NULL),
        e AS (SELECT DISTINCT a.record_id, u.kind, u.n, u.m, u.anchor, u.unit FROM a JOIN docs d USING (pmid) JOIN units u ON u.k = d.doc_id AND (u.anchor = a.anchor OR (regexp_matches(a.anchor, '^(sec|tab):\d+$') AND starts_with(u.anchor, a.anchor || ' '))) WHERE u.unit <> ''),
        o AS (SELECT *, CASE kind WHEN 'title' THEN -1 WHEN 'abstract' THEN 0 WHEN 'paragraph' THEN 1 WHEN 'row' THEN 2 ELSE 3 END AS rk FROM e)
        SELECT record_id, string_agg(anchor, '; ' ORDER BY rk, coalesce(n, 0), coalesce(m, 0), anchor) AS anchors, count(*) AS n_units, CAST(sum(length(unit)) AS BIGINT) AS chars,
               md5(string_agg(unit, chr(10) ORDER BY rk, coalesce(n, 0), coalesce(m, 0), anchor)) AS digest FROM o GROUP BY record_id""",
    "narrative_backfill": rf"""WITH one AS (SELECT record_id, any_value(pmid) AS pmid, any_value(local_id) AS local_id, any_value(record) AS record FROM individuals WHERE record_id IS NOT NULL GROUP BY record_id), docs AS {_DOCS}, {_LINES},
        heads AS (SELECT DISTINCT k, CAST(regexp_extract(line, '\[sec:(\d+)\]\s*$', 1) AS INT) AS n, regexp_matches(line, '^#{{2,4}} {_GENERIC[1:]}', 'i') AS generic FROM state WHERE mark = 's'),
        w AS (SELECT DISTINCT o.record_id, o.pmid, o.local_id, d.doc_id AS k, s.n FROM one o JOIN docs d USING (pmid) JOIN heads s ON s.k = d.doc_id),
        ev AS ({_EVIDENCE})
        SELECT DISTINCT record_id, 'abstract' AS anchor FROM w JOIN units u ON u.k = w.k AND u.kind = 'abstract'
        UNION SELECT w.record_id, 'sec:' || w.n FROM w JOIN heads h ON h.k = w.k AND h.n = w.n WHERE NOT h.generic
        UNION SELECT w.record_id, u.anchor FROM w JOIN heads h ON h.k = w.k AND h.n = w.n AND h.generic JOIN units u ON u.k = w.k AND u.kind = 'paragraph' AND u.n = w.n
            WHERE regexp_matches(u.unit, '{_SELF}', 'i') OR (coalesce(w.local_id, '') <> '' AND contains(lower(u.unit), lower(w.local_id)))
        UNION SELECT record_id, regexp_extract(trim(anchor), '^(sec:\d+ ¶\d+|tab:\d+ r\d+)', 1) FROM ev WHERE regexp_matches(trim(anchor), '^(sec:\d+ ¶\d+|tab:\d+ r\d+)')""",
}
