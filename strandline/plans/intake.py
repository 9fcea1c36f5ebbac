"""Queries on article XML, streams and claims, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import anchors, extraction
from ..session import scratch, table as t
from ..sources import xml
from ..streaming import incremental
from .documents import _LINES


def _esc(c):  # noqa: ANN001
    c = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " ")


def _many(tag: str, a, inner=lambda x: x):  # noqa: ANN001
    return F.coalesce(F.array_join(F.transform(a, lambda x: F.concat(F.lit(f"<{tag}>"), inner(_esc(x)), F.lit(f"</{tag}>"))), ""), F.lit(""))


def _citation_xml(x: DataFrame) -> DataFrame:
    """(source, xml): catalogue rows in the citation format; the first author has the affiliations, keywords stand as headings too."""
    w = lambda tag, c: F.concat(F.lit(f"<{tag}>"), _esc(c), F.lit(f"</{tag}>"))
    opt = lambda there, c: F.when(there, c).otherwise(F.lit(""))
    ymd = F.split("pub_date", "-")
    dated = F.col("pub_date").rlike(r"^\d{4}-\d{2}-\d{2}$")
    places = F.transform(F.coalesce("affiliations", F.array().cast("array<string>")), lambda a: F.concat(F.lit("<AffiliationInfo><Affiliation>"), _esc(a), F.lit("</Affiliation></AffiliationInfo>")))
    heads = F.transform(F.coalesce("keywords", F.array().cast("array<string>")), lambda k, i: F.concat(F.lit('<MeshHeading><DescriptorName UI="D'), i.cast("string"), F.lit('" MajorTopicYN="'), F.when(i == 0, "Y").otherwise("N"), F.lit('">'), _esc(k), F.lit("</DescriptorName><QualifierName>q</QualifierName></MeshHeading>")))
    e = F.split("edat", "-")
    art = F.concat(
        F.lit("<PubmedArticle><MedlineCitation>"), w("PMID", F.col("pmid")), F.lit("<Article><Journal>"), w("Title", F.col("journal")), opt(F.col("issn").isNotNull(), w("ISSN", F.col("issn"))), F.lit("<JournalIssue><PubDate>"), w("Year", F.col("pub_year").cast("string")), F.lit("</PubDate></JournalIssue></Journal>"), w("ArticleTitle", F.col("title")),
        opt(F.col("abstract").isNotNull(), F.concat(F.lit('<Abstract><AbstractText Label="AIM">'), _esc(F.col("abstract")), F.lit("</AbstractText></Abstract>"))),
        opt(dated, F.concat(F.lit("<ArticleDate>"), w("Year", ymd[0]), w("Month", ymd[1]), w("Day", ymd[2]), F.lit("</ArticleDate>"))), w("Language", F.col("language")),
        F.lit("<AuthorList><Author><LastName>First</LastName><Initials>A</Initials>"), F.array_join(places, ""), F.lit("</Author>"), _many("Author", F.col("authors"), lambda v: F.concat(F.lit("<LastName>"), v, F.lit("</LastName>"))), F.lit("</AuthorList>"), F.lit("<PublicationTypeList>"), _many("PublicationType", F.col("pub_types")), F.lit("</PublicationTypeList></Article>"),
        F.lit("<MeshHeadingList>"), F.array_join(heads, ""), F.lit("</MeshHeadingList>"),
        F.lit("<KeywordList>"), _many("Keyword", F.col("keywords")), F.lit("</KeywordList></MedlineCitation><PubmedData><History>"), opt(F.size(e) == 3, F.concat(F.lit('<PubMedPubDate PubStatus="entrez">'), w("Year", e[0]), w("Month", e[1]), w("Day", e[2]), F.lit("</PubMedPubDate>"))),
        F.lit("</History><ArticleIdList>"), opt(F.col("doi").isNotNull(), F.concat(F.lit('<ArticleId IdType="doi">'), _esc(F.col("doi")), F.lit("</ArticleId>"))), opt(F.col("pmcid").isNotNull(), F.concat(F.lit('<ArticleId IdType="pmc">'), F.regexp_replace(_esc(F.col("pmcid")), "^PMC", ""), F.lit("</ArticleId>"))), F.lit("</ArticleIdList></PubmedData></PubmedArticle>"),
    )
    return x.select(F.col("doc_id").cast("string").alias("source"), art.alias("xml"))


def citation_scan(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows written as citation XML and read again."""
    c = xml.citations(_citation_xml(t(spark, d, "documents").where("pmid is not null")))
    return c.select(F.col("source").cast("bigint").alias("doc_id"), "pmid", "doi", "journal", "pub_year", (F.size("authors") - 1).cast("bigint").alias("n_authors"), F.array_join("pub_types", "|").alias("pub_types"), F.array_join("keywords", "|").alias("keywords"), "error")


def citation_details(spark: SparkSession, d: str) -> DataFrame:
    """What else a citation holds: identifiers, dates, abstract, affiliations (five distinct ones), headings."""
    c = xml.citations(_citation_xml(t(spark, d, "documents").where("pmid is not null")))
    heads = F.transform("mesh", lambda m: F.concat_ws("/", m["descriptor"], m["ui"], m["major"].cast("string"), F.array_join(m["qualifiers"], "+")))
    return c.select(F.col("source").cast("bigint").alias("doc_id"), "pmcid", "issn", "pub_date", "language", "edat", F.md5("abstract").alias("abstract"), F.md5(F.array_join("affiliations", "|")).alias("affiliations"), F.array_join(heads, "|").alias("mesh"))


def article_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents' units written as full-text XML, read again and rendered with anchors: sections, tables, paragraphs."""
    u = anchors.units(t(spark, d, "documents").select("doc_id", "text"))
    ps = u.where("kind = 'paragraph'").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("m", "unit"))).alias("ps"))
    secs = ps.select("doc_id", "n", F.concat(F.lit("<sec><title>Section "), "n", F.lit("</title>"), F.array_join(F.transform("ps", lambda p: F.concat(F.lit("<p>"), _esc(p["unit"]), F.lit("</p>"))), ""), F.lit("</sec>")).alias("x"))
    body = secs.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "x"))), lambda s: s["x"]), "").alias("body"))
    rows = u.where("kind = 'row'").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("m", "cells"))).alias("rs"))
    tabs = rows.select("doc_id", "n", F.concat(F.lit("<table-wrap><label>T</label><table>"), F.array_join(F.transform("rs", lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r["cells"], lambda c: F.concat(F.lit("<td>"), _esc(c), F.lit("</td>"))), ""), F.lit("</tr>"))), ""), F.lit("</table></table-wrap>")).alias("x"))
    floats = tabs.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "x"))), lambda s: s["x"]), "").alias("floats"))
    doc = body.join(floats, "doc_id", "left").select(F.col("doc_id").cast("string").alias("key"), F.concat(F.lit('<article xmlns="urn:x"><front><article-title>T</article-title></front><body>'), "body", F.lit("</body>"), F.coalesce("floats", F.lit("")), F.lit("</article>")).alias("xml"))
    a = xml.articles(doc)
    return a.select(F.col("key").cast("bigint").alias("doc_id"), F.size("sections").cast("bigint").alias("n_sections"), F.aggregate("sections", F.lit(0), lambda s, x: s + F.size(x["paragraphs"])).cast("bigint").alias("n_paragraphs"), F.size("tables").cast("bigint").alias("n_tables"), F.aggregate("tables", F.lit(0), lambda s, x: s + F.size(x["rows"])).cast("bigint").alias("n_rows"))


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Events merged incrementally into the last known state of every user."""
    src = t(spark, d, "events")
    path = scratch(spark, "stream")
    state = incremental.ingest(spark, f"{d}/event[s].parquet", src.schema, f"{path}/state", f"{path}/checkpoint", "user_id", [F.col("ts"), F.col("event_id")])
    return state.select("user_id", "event_id", "event_type", "value")


def window_counts(spark: SparkSession, d: str) -> DataFrame:
    return incremental.windowed_counts(t(spark, d, "events"), width="1 day")


def stub_extraction(spark: SparkSession, d: str) -> DataFrame:
    """A rule in the place of a model: the first table row of each document as a claim, with its error column."""
    u = anchors.units(t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("pmid"), "text"))
    items = u.where("kind = 'row' and m > 1").groupBy("pmid").agg(F.min_by("unit", F.struct("n", "m")).alias("text"), F.min_by("anchor", F.struct("n", "m")).alias("local_id"))
    c = extraction.claims(extraction.extract(items, _first_cell))
    return c.select(F.col("pmid").cast("bigint").alias("doc_id"), "claim_type", "quote", "anchor")


def _first_cell(text: str, anchor: str) -> str:
    import json

    return json.dumps({"claims": [{"claim_type": "measured", "as_stated": text, "evidence": {"quote": text.split(" | ")[0], "anchor": anchor}, "quantities": []}]})


QUERIES = {f.__name__: f for f in (citation_scan, citation_details, article_scan, stream_upsert, window_counts, stub_extraction)}
_W = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_CLEAN = "trim(regexp_replace(regexp_replace({}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', ' ', 'g'), '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g'))"
_ALL = f"WITH docs AS (SELECT doc_id, text FROM documents), {_LINES}"
SQL = {
    "citation_details": f"""WITH a AS (SELECT doc_id, unnest(list_transform(affiliations, lambda v: {_CLEAN.format('v')})) AS v, unnest(range(len(affiliations))) AS i FROM documents WHERE pmid IS NOT NULL),
        f AS (SELECT doc_id, v, min(i) AS i FROM a WHERE coalesce(v, '') <> '' GROUP BY doc_id, v QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) <= 5),
        g AS (SELECT doc_id, string_agg(v, '|' ORDER BY i) AS places FROM f GROUP BY doc_id)
        SELECT d.doc_id, pmcid, issn, CASE WHEN regexp_matches(pub_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN pub_date WHEN pub_year IS NOT NULL THEN pub_year || '-01-01' END AS pub_date, language,
               edat, md5('AIM: ' || {_CLEAN.format('abstract')}) AS abstract, md5(coalesce(places, '')) AS affiliations,
               coalesce(array_to_string(list_transform(keywords, lambda k, i: coalesce({_CLEAN.format('k')}, '') || '/D' || (i - 1) || CASE WHEN i = 1 THEN '/true/q' ELSE '/false/q' END), '|'), '') AS mesh
        FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id WHERE pmid IS NOT NULL""",
    "article_scan": f"{_ALL}, r AS (SELECT k, count(DISTINCT n) AS nt, count(*) AS nr FROM rows_ GROUP BY k) SELECT p.k AS doc_id, count(DISTINCT n) AS n_sections, count(*) FILTER (trim(unit) <> '') AS n_paragraphs, coalesce(any_value(nt), 0) AS n_tables, coalesce(any_value(nr), 0) AS n_rows FROM pars p LEFT JOIN r ON r.k = p.k GROUP BY p.k",
    "stub_extraction": f"{_ALL} SELECT k AS doc_id, 'measured' AS claim_type, arg_min(cells[1], (n, m)) AS quote, 'tab:' || arg_min(n, (n, m)) || ' r' || arg_min(m, (n, m)) AS anchor FROM rows_ WHERE m > 1 GROUP BY k",
    "citation_scan": f"SELECT doc_id, pmid, lower(doi) AS doi, {_W.format('journal')} AS journal, pub_year, coalesce(len(authors), 0) AS n_authors, coalesce(array_to_string(pub_types, '|'), '') AS pub_types, coalesce(array_to_string(keywords, '|'), '') AS keywords, NULL::VARCHAR AS error FROM documents WHERE pmid IS NOT NULL",
    "stream_upsert": "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) FILTER (event_type IS NOT NULL) AS event_type, arg_max(value, (ts, event_id)) FILTER (value IS NOT NULL) AS value FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
    "window_counts": "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2",
}
