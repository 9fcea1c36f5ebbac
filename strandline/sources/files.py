"""Readers of the flat and JSON files that feed the engine: lexicons, ontologies, work folders, lists, exchange files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import curie, truthy


def _tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("mode", "PERMISSIVE")
    return (r.schema(schema) if schema else r).csv(path)


def _bars(c: Column) -> Column:
    """A `|` list without its empty entries."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def analyte_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(label, synonyms array, chebi, vmh, kind) of a tab-separated lexicon with `|` lists."""
    t = _tsv(spark, path, "label string, synonyms string, chebi string, vmh string, kind string")
    return t.where("label is not null").withColumn("synonyms", _bars(F.col("synonyms")))


def disease_aliases(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, "alias string, omim string").where("alias is not null and omim is not null")


def disease_sets(spark: SparkSession, path: str) -> DataFrame:
    t = _tsv(spark, path, "key string, label string, mondo string, genes string, mesh string, tiab string, gene_tiab string, why string").where("trim(key) <> ''")
    return t.select(F.trim("key").alias("key"), F.trim("label").alias("label"), "mondo", _bars(F.col("genes")).alias("genes"), F.trim("mesh").alias("mesh"), _bars(F.col("tiab")).alias("tiab"), _bars(F.col("gene_tiab")).alias("gene_tiab"), "why")


def genes_to_disease(spark: SparkSession, path: str) -> DataFrame:
    """(disease_id, genes) for OMIM and ORPHA identifiers; the file has further columns."""
    t = _tsv(spark, path).where("gene_symbol is not null and (disease_id like 'OMIM:%' or disease_id like 'ORPHA:%')")
    return t.groupBy("disease_id").agg(F.array_sort(F.collect_set("gene_symbol")).alias("genes"))


def gene_nomenclature(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, hgnc_id, aliases) with aliases and previous symbols together."""
    t = _tsv(spark, path).where("symbol is not null")
    return t.select("symbol", "hgnc_id", F.array_distinct(F.concat(_bars(F.col("alias_symbol")), _bars(F.col("prev_symbol")))).alias("aliases"))


def _either(t: DataFrame, *names: str) -> Column:
    have = {c.lower(): c for c in t.columns}
    cols = [F.col(have[n]) for n in names if n in have]
    return F.coalesce(*cols) if cols else F.lit(None).cast("string")


def chebi_names(spark: SparkSession, compounds: str, names: str | None = None) -> DataFrame:
    """(name, chebi, prio) from either layout of the compound and name files; compounds before names."""
    c = _tsv(spark, compounds)
    status = _either(c, "status_id", "status")
    c = c.where(status.isNull() | status.isin("", "1", "3", "C", "E"))
    cid = F.concat(F.lit("CHEBI:"), _either(c, "id"))
    out = c.select(F.explode(F.array(_either(c, "name"), _either(c, "ascii_name"))).alias("name"), cid.alias("chebi"), F.lit(0).alias("prio"))
    if names:
        n = _tsv(spark, names)
        status, lang = _either(n, "status_id"), _either(n, "language_code", "language")
        n = n.where((status.isNull() | status.isin("", "1", "3")) & (lang.isNull() | lang.isin("", "en", "la")))
        cid = F.concat(F.lit("CHEBI:"), _either(n, "compound_id"))
        out = out.unionByName(n.select(F.explode(F.array(_either(n, "name"), _either(n, "ascii_name"))).alias("name"), cid.alias("chebi"), F.lit(1).alias("prio")))
    return out.withColumn("name", F.regexp_replace("name", "<[^>]+>", "")).where("length(name) >= 3 and chebi is not null").distinct()


_NODE = "array<struct<id:string,lbl:string,type:string,meta:struct<deprecated:boolean,definition:struct<val:string>,synonyms:array<struct<pred:string,val:string>>,xrefs:array<struct<val:string>>>>>"
_GRAPHS = f"graphs array<struct<meta:struct<version:string>,nodes:{_NODE},edges:array<struct<sub:string,pred:string,obj:string>>>>"


def obograph(spark: SparkSession, path: str, iri_prefix: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of an ontology in obographs JSON: classes of the prefix that are neither deprecated nor obsolete."""
    g = spark.read.schema(_GRAPHS).option("multiLine", True).json(path).select(F.explode("graphs").alias("g"))
    n = g.select(F.explode("g.nodes").alias("n")).withColumn("id", curie(F.col("n.id"), iri_prefix, prefix))
    n = n.where("n.type = 'CLASS' and id is not null and not coalesce(n.meta.deprecated, false) and not lower(coalesce(n.lbl, '')) like 'obsolete%'")
    syn = lambda p: F.array_sort(F.array_distinct(F.transform(F.filter("n.meta.synonyms", p), lambda s: s["val"])))
    xref = lambda p: F.array_sort(F.array_distinct(F.transform(F.filter("n.meta.xrefs", lambda x: F.startswith(x["val"], F.lit(p))), lambda x: x["val"])))
    nodes = n.select(
        "id", F.col("n.lbl").alias("label"), syn(lambda s: s["pred"] == "hasExactSynonym").alias("exact"), syn(lambda s: s["pred"] != "hasExactSynonym").alias("related"),
        F.coalesce(xref("OMIM:"), F.array().cast("array<string>")).alias("omim"), F.coalesce(xref("Orphanet:"), F.array().cast("array<string>")).alias("orphanet"), F.col("n.meta.definition.val").alias("definition"),
    )
    e = g.select(F.explode("g.edges").alias("e")).where("e.pred = 'is_a'").select(curie(F.col("e.sub"), iri_prefix, prefix).alias("sub"), curie(F.col("e.obj"), iri_prefix, prefix).alias("obj"))
    known = nodes.select("id")
    edges = e.join(known.withColumnRenamed("id", "sub"), "sub", "left_semi").join(known.withColumnRenamed("id", "obj"), "obj", "left_semi")
    return nodes, edges.select("sub", "obj")


def ontology_names(nodes: DataFrame) -> DataFrame:
    """(name, id, label, prio): labels before exact synonyms before the other ones."""
    named = F.concat(F.array(F.struct(F.col("label").alias("name"), F.lit(0).alias("prio"))), F.transform(F.coalesce("exact", F.array().cast("array<string>")), lambda s: F.struct(s.alias("name"), F.lit(1).alias("prio"))), F.transform(F.coalesce("related", F.array().cast("array<string>")), lambda s: F.struct(s.alias("name"), F.lit(2).alias("prio"))))
    return nodes.select("id", "label", F.explode(named).alias("x")).select("x.name", "id", "label", "x.prio")


def pmid_list(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.text(path).select(F.trim(F.regexp_replace("value", "(?i)^\\s*PMID:", "")).alias("pmid"))
    return t.where("pmid <> ''").distinct()


def terms(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("term")).where("term <> ''")


def searchable(c: Column) -> Column:
    """Terms fit for a remote search field: 8 characters and more, none of the query syntax."""
    return (F.length(c) >= 8) & ~c.rlike(r'[()\[\]":*?]')


def work_items(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, name, content) of the files in a work folder `<path>/<pmid>/<name>`."""
    t = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("content"))
    return t.select(F.element_at(F.split("p", "/"), -2).alias("pmid"), F.element_at(F.split("p", "/"), -1).alias("name"), "content")


def work_state(items: DataFrame) -> DataFrame:
    """(pmid, state): need_triage, need_extract or done, from which files are there."""
    w = items.groupBy("pmid").agg(F.max((F.col("name") == "manifest.json").cast("int")).alias("m"), F.sum(F.rlike("name", F.lit(r"^record_.*\.json$")).cast("int")).alias("r"), F.max(F.when(F.col("name") == "manifest.json", F.try_variant_get(F.try_parse_json("content"), "$.in_scope", "boolean"))).alias("in_scope"))
    return w.select("pmid", F.when(F.col("m") == 0, "need_triage").when(F.coalesce("in_scope", F.lit(True)) & (F.col("r") == 0), "need_extract").otherwise("done").alias("state"))


def fetched_xml(spark: SparkSession, path: str) -> DataFrame:
    """(pmcid, xml) of a fetch result `{pmcid: {status, xml}}`: status 200 with a body only."""
    t = spark.read.option("wholetext", True).text(path)
    m = t.select(F.explode(F.from_json("value", "map<string,struct<status:int,xml:string>>")).alias("pmcid", "v"))
    return m.where("v.status = 200 and contains(v.xml, '<body')").select("pmcid", F.col("v.xml").alias("xml"))


def page_text(c: Column) -> Column:
    """The article within a captured page: behind the first `---`, before the tab listing."""
    body = F.regexp_replace(c, r"(?s)^.*?---\s*", "")
    return F.trim(F.regexp_replace(body, r"(?s)Tab Context.*$", ""))


def reviewed(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Filled review sheets saved as CSV, blank rows dropped."""
    t = spark.read.option("header", True).schema(columns).csv(path)
    return t.where(" or ".join(f"coalesce(trim(`{c}`), '') <> ''" for c, k in t.dtypes if k == "string")).withColumn("file", F.col("_metadata.file_name")) if t.columns else t


def overview_patients(spark: SparkSession, path: str) -> DataFrame:
    """Per-patient summaries (JSON or CSV by extension) with age in years from value-unit pairs and word counts."""
    t = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.option("multiLine", True).json(path)
    words = F.size(F.split(F.trim(F.coalesce("patient", F.lit(""))), r"\s+"))
    return t.withColumns({"n_words": words, "gender": truthy(F.col("gender")) if "gender" in t.columns else F.lit(None).cast("string")})
