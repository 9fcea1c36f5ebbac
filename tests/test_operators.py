"""Operators on hand-written rows: quirks, nulls, empty tables, ties, repeated rows, clashing names."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import anchors, catalogue, extraction, grounding, harmonise, nested, overview, phenopacket, review, sampling, scope
from strandline.sources import files, remote, xml
from strandline.streaming import incremental

MD = """# Title

## Abstract [abstract]
First line.
second line

## Case [sec:2]

[sec:2 ¶1] The patient was  seen twice.

[sec:2 ¶2] Another one.

### Table Table 1 [tab:1]
Footnotes: none.
| r1 | head | P1 |
|---|---|---|
| r2 | ammonia | 480 |
Footnotes: late.

Figure F1: A picture."""


def docs(spark, rows):
    return spark.createDataFrame(rows, "pmid string, text string, anchor string")


def test_units_and_anchors(spark):
    u = anchors.units(docs(spark, [("1", MD, "clash"), ("2", None, None), ("3", "", None)]).drop("anchor"))
    got = {r.anchor: r.unit for r in u.collect()}
    assert got == {"title": "Title", "abstract": "First line.\nsecond line", "sec:2 ¶1": "The patient was  seen twice.", "sec:2 ¶2": "Another one.", "tab:1 r1": "head | P1", "tab:1 r2": "ammonia | 480", "fig:F1": "A picture."}
    whole = {r.anchor: r.text for r in anchors.resolved(docs(spark, [("1", MD, None), ("2", None, None)]), "pmid").collect()}
    assert whole["sec:2"] == "The patient was  seen twice.\n\nAnother one."
    assert whole["tab:1c2"] == "head: P1\nammonia: 480" and whole["tab:1 r2c2"] == "480"
    heads = anchors.table_heads(docs(spark, [("1", MD, None)]).drop("anchor")).first()
    assert (heads.caption, heads.footnotes) == ("Footnotes: none.", "late.")  # an empty caption is taken by the next line


def test_quotes(spark):
    d = docs(spark, [("1", MD, None)]).drop("anchor")
    long_ = "x" * 90
    d = d.unionByName(spark.createDataFrame([("2", f"[sec:1 ¶1] {long_} end")], "pmid string, text string"))
    q = spark.createDataFrame([("1", "sec:2¶1", "The patient was seen"), ("1", "tab:9", "Another one."), ("1", None, "no such"), ("1", "abstract", ""), ("2", "sec:1 ¶1", "x" * 85 + "y"), ("9", "abstract", "First")], "pmid string, anchor string, quote string")
    got = {(r.pmid, r.quote): (r.anchor_exists, r.in_anchor, r.in_document, r.start, r.stop) for r in anchors.verify_quotes(q, d).collect()}
    assert got["1", "The patient was seen"] == (True, True, True, 0, 20)
    assert got["1", "Another one."] == (False, False, True, None, None)
    assert got["1", "no such"] == (False, False, False, None, None)
    assert got["1", ""] == (True, False, False, None, None)
    assert got["2", "x" * 85 + "y"] == (True, True, True, 0, 86)
    assert got["9", "First"][2] is False


def test_rendering_round_trip(spark):
    s = spark.createDataFrame([("T", "A.", [("References", 1, ["r"]), ("Case", 5, ["p", "q"])])], "t string, a string, s array<struct<title:string,depth:int,paragraphs:array<string>>>")
    md = s.select(anchors.render(F.col("t"), F.col("a"), F.col("s")).alias("text"), F.lit("1").alias("pmid"))
    assert md.first().text == "# T\n\n## Abstract [abstract]\nA.\n\n#### Case [sec:2]\n\n[sec:2 ¶1] p\n\n[sec:2 ¶2] q"
    assert anchors.units(md).count() == 4
    t = spark.createDataFrame([("", "Cap", [["a|b"], ["c", "d"]], "n")], "l string, c string, r array<array<string>>, f string")
    assert t.select(anchors.table_markdown(F.col("l"), F.col("c"), F.col("r"), F.col("f"), F.lit(3))).first()[0] == "### Table 3 [tab:3]\nCap\n| r1 | a/b |  |\n|---|---|---|\n| r2 | c | d |\nFootnotes: n"


def test_catalogue_state(spark):
    x = spark.createDataFrame([("1", "a", None, 1.0), ("1", None, "z", 2.0), ("1", "b", None, 3.0), (None, "q", "q", 1.0)], "pmid string, x string, y string, at double")
    assert [tuple(r) for r in catalogue.upsert(x, "pmid", [F.col("at")], first=("at",)).collect()] == [("1", "b", "z", 1.0)]
    base = spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], "pmid string, x string, n int")
    new = spark.createDataFrame([("2", None, "w"), ("3", "c", None)], "pmid string, x string, extra string")
    got = {r.pmid: (r.x, r.n, r.extra) for r in catalogue.merge(base, new, "pmid").collect()}
    assert got == {"1": ("a", 1, None), "2": ("b", 2, "w"), "3": ("c", None, None)}
    t = spark.createDataFrame([(None, "pmc", True), ("abstract", "pmc", True), ("epmc", "pmc", True), ("abstract", "pmc", False)], "c string, t string, ok boolean")
    assert [r[0] for r in t.select(catalogue.promoted_tier(F.col("c"), F.col("t"), F.col("ok"))).collect()] == ["pmc", "pmc", "epmc", "abstract"]
    assert spark.range(1).select(catalogue.layer(F.lit("A_seed"), F.lit("A_lag"))).first()[0] == "A_lag"


def test_closure_ends_on_diamonds_and_cycles(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("a", "d"), (None, "a")], "sub string, obj string")
    got = {(r.id, r.level) for r in scope.descendants(e, spark.createDataFrame([("a",)], "id string")).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 1), ("d", 2)}


def test_tagging_is_longest_first_and_bounded(spark):
    v = spark.createDataFrame([("acid disease", "1"), ("acid", "2"), ("acid disease", "3")], "term string, id string")
    t = spark.createDataFrame([(1, "Acid disease, acidic; ACID."), (2, None), (3, "")], "key int, text string")
    g = spark.createDataFrame([("PAH", "9")], "symbol string, id string")
    got = {r.key: (r.ids, r.genes, r.terms) for r in scope.tag(t.unionByName(spark.createDataFrame([(4, "pah PAH PAHX")], "key int, text string")), v, g).collect()}
    assert got[1] == (["1", "2", "3"], [], ["acid", "acid disease"])
    assert got[2] == ([], [], []) == got[3] and got[4] == (["9"], ["PAH"], [])


def test_gene_cascade(spark):
    genes = spark.createDataFrame([("ABC1", "H:1", ["OLD1", "XYZ2"]), ("XYZ2", "H:2", [])], "symbol string, hgnc_id string, aliases array<string>")
    got = {r.text: (r.gene, r.confidence) for r in grounding.ground_genes(spark.createDataFrame([("ABC1",), ("abc1 ",), ("OLD1",), ("none",), ("XYZ2",), (None,)], "symbol string"), genes).collect()}
    assert got == {"ABC1": ("ABC1", 0.98), "abc1 ": ("ABC1", 0.95), "OLD1": ("ABC1", 0.9), "none": (None, None), "XYZ2": ("XYZ2", 0.98)}


def test_fuzzy_accepts_only_clear_winners(spark):
    lex = spark.createDataFrame([("abnormal gait", "A"), ("abnormal gait pattern", "B"), ("seizure", "C")], "key string, label string")
    got = grounding.fuzzy(spark.createDataFrame([("siezure",), ("abnormal gait",), ("",), (None,)], "text string"), lex, "phenotype").collect()
    assert {(r.text, r.label, r.accepted) for r in got if r["rank"] == 1} == {("siezure", "C", False), ("abnormal gait", "A", False)}


def test_kinds_and_quotas(spark):
    d = spark.createDataFrame([("Two siblings with X", "", ["Case Reports"]), ("X in 12 patients", None, []), ("A case", "a literature review", ["Case Reports"]), ("A case", None, ["Case Reports"]), (None, None, None)], "t string, a string, p array<string>")
    assert [r[0] for r in d.select(sampling.document_kind(F.col("t"), F.col("a"), F.col("p"))).collect()] == ["small_series", "series", "case_plus_review", "single_case", "other"]
    rows = [("s", str(i), "x", None, ["Case Reports"], 1990 + i % 40, "epmc" if i % 2 else "abstract", 0, 0, None) for i in range(200)]
    docs_ = spark.createDataFrame(rows, "set_name string, pmid string, title string, abstract string, pub_types array<string>, pub_year int, fulltext_tier string, in_epmc int, is_open_access int, pmcid string")
    got = sampling.draw(docs_).collect()
    assert len(got) == 25 == len({r.pmid for r in got}) and sum(r.ft for r in got) == 18
    assert sampling.draw(docs_.where("false")).count() == 0
    twice = sampling.draw_in_turn(docs_.unionByName(docs_.withColumn("set_name", F.lit("t"))), ["s", "t"]).collect()
    assert len(twice) == 50 == len({r.pmid for r in twice})


def test_assignment_is_even(spark):
    a = sampling.assign(spark.range(90).select(F.col("id").cast("string").alias("record_id")), ["a", "b", "c"], 10, 0.2).collect()
    first = [r for r in a if r.role == "primary"]
    assert len(first) == 90 and {n: sum(r.reviewer == n for r in first) for n in "abc"} == {"a": 30, "b": 30, "c": 30}
    assert sum(r.role == "second" for r in a) == 18


def test_metrics_over_nothing_are_null(spark):
    d = spark.createDataFrame([("g", "Unsure")], "grp string, verdict string")
    r = {x.grp: x for x in review.metrics(d, spark.createDataFrame([], "grp string")).collect()}
    assert r["g"].precision_strict is None and r["all"].n == 1
    k = review.agreement(spark.createDataFrame([("y", "y"), ("n", "n"), ("y", "n")], "a string, b string")).first()
    assert (k.n, k.exact) == (3, 0.667)


def test_nested_emission_against_a_plain_walk(spark):
    packets = ['{"a": [{"x": 1, "b": {"c": 2}}, null, 3, {"b": [{"c": 1}, {"c": 2}]}]}', '{"a": {"b": {"c": [1]}}}', '"{\\"a\\": [{\\"x\\": 1}]}"', '{"a": [{"x"', None, "", "[[{}], {}]"]
    rows = [(f"r{i}", {"phenotypes": [{"text": "t"}, None]} if i == 0 else None, p) for i, p in enumerate(packets)] + [("r0", {"phenotypes": [{"text": "t"}, None]}, packets[0])]
    df = spark.createDataFrame(rows, "record_id string, record struct<phenotypes:array<struct<text:string>>>, phenopacket string")
    got = {tuple(r) for r in nested.found(df.withColumn("path", F.lit(1))).collect()}
    assert got == {
        ("r0", "record.phenotypes", "0"), ("r0", "phenopacket.a", "0"), ("r0", "phenopacket.a", "3"), ("r0", "phenopacket.a.b", "0.0"), ("r0", "phenopacket.a.b", "3.0"), ("r0", "phenopacket.a.b", "3.1"),
        ("r1", "phenopacket.a", "0"), ("r1", "phenopacket.a.b", "0.0"), ("r2", "phenopacket.a", "0"), ("r6", "phenopacket", "0.0"), ("r6", "phenopacket", "1"),
    }
    assert nested.found(df.where("false")).count() == 0
    assert nested.links(df).where("n_orphans > 0").count() == 0


def leaves(root, value):
    """(dotted path, text) of every scalar, by a plain recursive walk; elements of arrays as the field `value`."""
    if root.startswith("phenopacket") and isinstance(value, str) and value[:1] in ("{", "["):
        value = valid(value) or value
    if isinstance(value, dict):
        for k, x in value.items():
            yield from leaves(f"{root}.{k}", x)
    elif isinstance(value, list):
        for x in value:
            if x is not None:
                yield from leaves(root if isinstance(x, (dict, list)) else f"{root}.value", x)
    else:
        yield root, value if value is None or isinstance(value, str) else json.dumps(value)


def valid(text):
    try:
        x = json.loads(text)
        return valid(x) if isinstance(x, str) else x
    except (TypeError, ValueError):
        return []


def test_flat_tables_hold_every_scalar(spark, sf):
    df = spark.read.parquet(f"{sf}/individuals.parquet").where("record_id is not null")
    want = Counter()
    for rid, record, packet in set(map(tuple, df.select("record_id", F.to_json("record"), "phenopacket").collect())):
        want.update((rid, *x) for root, text in (("record", record), ("phenopacket", packet)) for x in leaves(root, valid(text)))
    folder = nested.write_tables(df)
    rows = spark.read.schema(nested.ROW).parquet(folder).collect()
    got = Counter((r.record_id, f"{r.tag}.{k}", v) for r in rows for k, v in json.loads(r.payload).items())
    assert sum(want.values()) > 5000 and got == want
    assert {r.tag for r in rows} <= set(nested.TABLES)
    keys = {(r.record_id, r.version, r.tag, r.pos) for r in rows}
    assert len(keys) == len(rows) and all((r.record_id, r.version, r.parent_path, r.parent_pos) in keys for r in rows if r.parent_path)


def test_single_objects_become_columns_of_the_nearest_row(spark):
    packets = ['{"id": "p", "subject": {"id": "s", "a.b": {"c": 1}}, "measurements": [{"value": {"quantity": {"value": "7.5", "unit": {"id": "u"}}}}, {"value": {"quantity": {"value": "high"}}}]}', '{"measurements": {"assay": {"id": "q"}}, "note": "{\\"x\\": 1}"}', '{"measurements": null, "new": [1, "two", null]}', '[{"id": "l"}]']
    rows = [("r0", ([(("said", "sec:1"), "t")], ["n", None, "m"], ("died",)), packets[0])] + [(f"r{i}", None, p) for i, p in enumerate(packets) if i] + [("r0", ([(("said", "sec:1"), "t")], ["n", None, "m"], ("died",)), packets[0]), ("r0", ([], None, ("alive",)), None)]
    df = spark.createDataFrame(rows, "record_id string, record struct<phenotypes:array<struct<evidence:struct<quote:string,anchor:string>,text:string>>,extractor_notes:array<string>,outcome:struct<text:string>>, phenopacket string")
    table = lambda tag: nested.flat_table(df, tag).orderBy("record_id", "pos").collect()
    assert [(r.pos, r.parent_path, r.parent_pos, r.text, r.evidence_quote, r.evidence_anchor) for r in table("record.phenotypes")] == [("0", "record", "", "t", "said", "sec:1")]
    assert sorted(r.outcome_text for r in table("record")) == ["alive", "died"]
    assert [(r.pos, r.value) for r in table("record.extractor_notes")] == [("0", "n"), ("2", "m")]
    got = [(r.record_id, r.pos, r.assay_id, r.value_quantity_value, r.value_quantity_unit_id, r.other) for r in table("phenopacket.measurements")]
    assert got == [("r0", "0", None, 7.5, "u", None), ("r0", "1", None, None, None, '{"value.quantity.value":"high"}'), ("r1", "0", "q", None, None, None)]
    assert [(r.record_id, r.pos, r.id, r.subject_id, r.other) for r in table("phenopacket")] == [("r0", "", "p", "s", '{"subject.a.b.c":"1"}'), ("r1", "", None, None, '{"note.x":"1"}'), ("r2", "", None, None, '{"measurements":null}'), ("r3", "0", "l", None, None)]
    assert [(r.pos, r.other) for r in table("phenopacket.new")] == [("0", '{"value":"1"}'), ("1", '{"value":"two"}')]
    assert nested.read_table(spark, nested.write_tables(df.where("false")), "record").count() == 0
    links = {(r.path, r.parent_path): (r.n_rows, r.n_orphans) for r in nested.links(df).collect()}
    assert links["record", None] == (2, 0) and links["phenopacket", None] == (4, 0) and links["record.extractor_notes", "record"] == (2, 0)


M = "fact_id string, pmid string, analyte_text string, specimen string, value double, unit string, unit_ucum string, ref_low double, ref_high double, interpretation string, panel string, method string"
LEX = "label string, synonyms string, kind string, molar_mass double, unit_common string"


def test_harmonised_units(spark):
    lex = spark.createDataFrame([("creatinine", "creat.", "metabolite", 113.12, "umol/L"), ("testonic acid", "testonate|TTA", "metabolite", 200.0, "umol/L"), ("K5", None, "metabolite", None, "umol/L")], LEX)
    rows = [("a", "testonic acid", 1.0, "mg/dl", None), ("b", "testonic acid [mmol/L]", 2.0, "n/a", None), ("c", "TTA", 3.0, None, "mmol/mol{creat}"), ("d", "testonnic acid", 4.0, "?", "umol/L"), ("e", "testonic acid/creatinine ratio", 5.0, "umol/L", None), ("f", None, 5.0, "umol/L", None), ("g", "TTA", None, "umol/L", None), ("h", "K5", 1.0, "mg/L", None), ("i", "TTA", 7.0, None, None), ("a", "testonic acid", 1.0, "mg/dl", None)]
    m = spark.createDataFrame([(f, "p", t, None, v, u, c, None, None, None, None, None) for f, t, v, u, c in rows], M)
    got = {r.fact_id: r.common_milli for r in harmonise.found(m.withColumn("label", F.lit("clash")), lex).collect()}
    assert got == {"a": 50_000, "b": 2_000_000, "c": 3_000, "d": 4_000}
    source = {r.fact_id: r.unit_source for r in harmonise.harmonise(m, lex).collect()}
    assert source["h"] == source["i"] == "review" and source["b"] == "analyte_text" and source["d"] == "unit_ucum"
    assert harmonise.found(m.where("false"), lex).count() == 0


def test_the_forest_fills_clear_units_and_asks_for_the_others(spark):
    lex = spark.createDataFrame([("alphonic acid", None, "metabolite", 100.0, "umol/L"), ("gammase", None, "enzyme", None, "U/L"), ("creatinine", None, "metabolite", 113.12, "umol/L")], LEX)
    rows = [(f"u{i}", "p", "alphonic acid", "plasma", 80.0 + i % 40, "umol/L", None, None, None, None, None, None) for i in range(400)]
    rows += [(f"e{i}", "p", "gammase", "serum", 10.0 + i % 9, "U/L", None, None, None, None, None, None) for i in range(400)]
    rows += [("x", "p", "alphonic acid", "plasma", 95.0, None, None, None, None, None, None, None)]
    got = {r.fact_id: r for r in harmonise.harmonise(spark.createDataFrame(rows, M), lex).collect()}
    assert (got["x"].unit_source, got["x"].unit, got["x"].common) == ("model", "umol/L", 95.0)
    assert len(got) == 801


def test_the_forest_settles_unreadable_units(spark):
    lex = spark.createDataFrame([("alphonic acid", None, "metabolite", 100.0, "umol/L"), ("gammase", None, "enzyme", None, "U/L"), ("creatinine", None, "metabolite", 113.12, "umol/L")], LEX)
    row = lambda fact, text, value, unit, ucum=None: (fact, "p", text, "plasma" if text[0] == "a" else "serum", value, unit, ucum, None, None, None, None, None)
    clear = [row(f"u{i}", "alphonic acid", 80.0 + i % 40, "umol/L") for i in range(400)] + [row(f"e{i}", "gammase", 10.0 + i % 9, "U/L") for i in range(400)]
    odd = [row("typo", "alphonic acid", 95.0, "umo1/L"), row("ucum", "alphonic acid", 96.0, "n/a", "umolL"), row("both", "alphonic acid", 97.0, "umo1/L", "mmol/L"), row("other", "alphonic acid", 98.0, "percentile"), row("far", "alphonic acid", 99.0, "mgd/L"), row("none", "alphonic acid", 95.0, "?")]
    m = spark.createDataFrame(clear + odd, M)
    got = {r.fact_id: r.common_milli for r in harmonise.found(m, lex).collect()}
    assert got == {f[0]: round(f[4] * 1000) for f in clear} | {"typo": 95_000, "ucum": 96_000, "both": 97_000_000}
    source = {r.fact_id: r.unit_source for r in harmonise.harmonise(m, lex).collect()}
    assert source["typo"] == source["ucum"] == source["none"] == "model" and source["other"] == source["far"] == "review" and source["both"] == "unit_ucum"


def test_citations_and_articles(spark):
    c = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>1998 Winter</MedlineDate></PubDate></JournalIssue></Journal><ArticleTitle>A <i>b</i> c</ArticleTitle>
    <Abstract><AbstractText Label="AIM">x</AbstractText><AbstractText>y</AbstractText></Abstract><AuthorList><Author><LastName>Doe</LastName><Initials>JA</Initials><AffiliationInfo><Affiliation>P</Affiliation></AffiliationInfo></Author><Author><CollectiveName>Group</CollectiveName></Author></AuthorList></Article></MedlineCitation>
    <PubmedData><ArticleIdList><ArticleId IdType="pmc">12</ArticleId><ArticleId IdType="doi">10.1/X</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"""
    r = xml.citations(spark.createDataFrame([("s", c), ("bad", "<a>"), ("none", None)], "source string, xml string")).collect()
    ok = next(x for x in r if x.source == "s")
    assert (ok.title, ok.abstract, ok.pmcid, ok.doi, ok.pub_year, ok.pub_date, ok.authors) == ("A b c", "AIM: x\ny", "PMC12", "10.1/x", 1998, "1998", ["Doe JA", "Group"])
    assert all(x.error for x in r if x.source != "s")
    a = '<article xmlns="u"><front><article-title>T</article-title><abstract><p>q</p></abstract></front><body><p>loose</p><sec><title>S</title><p>one <b>two</b></p><sec><p>deep</p></sec></sec></body><floats-group><table-wrap><label>L</label><table><tr><th colspan="2">h</th></tr><tr><td>a</td><td>b</td></tr></table></table-wrap></floats-group></article>'
    x = xml.articles(spark.createDataFrame([("1", a), ("2", "no")], "key string, xml string")).where("key = '1'").first()
    assert [(s.title, s.depth, s.paragraphs) for s in x.sections] == [("Body", 1, ["loose"]), ("S", 1, ["one two"]), ("(untitled)", 2, ["deep"])]
    assert x.tables[0].rows == [["h", ""], ["a", "b"]] and x.abstract == "q"


def test_files(spark, tmp_path):
    (tmp_path / "lex.tsv").write_text("label\tsynonyms\tchebi\tvmh\tkind\nA\tb|c|\t\t\tmetabolite\n")
    assert files.analyte_lexicon(spark, str(tmp_path / "lex.tsv")).first().synonyms == ["b", "c"]
    g = {"graphs": [{"nodes": [{"id": "http://x/HP_1", "lbl": "One", "type": "CLASS", "meta": {"synonyms": [{"pred": "hasExactSynonym", "val": "uno"}]}}, {"id": "http://x/HP_2", "lbl": "obsolete two", "type": "CLASS"}, {"id": "http://x/HP_3", "lbl": "Three", "type": "CLASS"}], "edges": [{"sub": "http://x/HP_3", "pred": "is_a", "obj": "http://x/HP_1"}, {"sub": "http://x/HP_2", "pred": "is_a", "obj": "http://x/HP_1"}]}]}
    (tmp_path / "hp.json").write_text(json.dumps(g))
    nodes, edges = files.obograph(spark, str(tmp_path / "hp.json"), "http://x/HP_", "HP:")
    assert {r.id for r in nodes.collect()} == {"HP:1", "HP:3"} and [tuple(r) for r in edges.collect()] == [("HP:3", "HP:1")]
    assert {r.name for r in files.ontology_names(nodes).collect()} == {"One", "uno", "Three"}
    (tmp_path / "work" / "5").mkdir(parents=True)
    (tmp_path / "work" / "5" / "manifest.json").write_text('{"in_scope": true}')
    assert [tuple(r) for r in files.work_state(files.work_items(spark, str(tmp_path / "work"))).collect()] == [("5", "need_extract")]


def test_remote_waits_and_tries_again():
    now, slept, calls = [0.0], [], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    def transport(url, params):
        calls.append(url)
        return (503, "") if len(calls) < 3 else (200, "ok")

    limiter = remote.RateLimiter(2.0, clock=lambda: now[0], sleep=sleep)
    assert remote.fetch(transport, "u", {}, limiter, sleep=sleep) == "ok" and len(calls) == 3 and 1.0 in slept and 2.0 in slept
    with pytest.raises(RuntimeError):
        remote.fetch(lambda u, p: (404, ""), "u", {}, limiter, sleep=sleep)
    pages = [json.dumps({"nextCursorMark": c}) for c in ("a", "b", "b")]
    assert len(list(remote.cursor_pages(lambda u, p: (200, pages.pop(0)), "u", "q", limiter))) == 3


def test_incremental_ingest_resumes(spark, tmp_path):
    src, state, cp = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")
    schema = "k string, v string, ts long"
    spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], schema).coalesce(1).write.parquet(src)
    args = (spark, src, spark.createDataFrame([], schema).schema, state, cp, "k", [F.col("ts")])
    assert incremental.ingest(*args).count() == 2
    spark.createDataFrame([("a", "0", 0), ("b", "2", 2), ("c", "1", 1)], schema).coalesce(1).write.mode("append").parquet(src)
    assert {(r.k, r.v) for r in incremental.ingest(*args).collect()} == {("a", "1"), ("b", "2"), ("c", "1")}
    assert incremental.ingest(*args).count() == 3


def test_extraction_errors_stay_in_a_column(spark):
    def rule(text, local_id):
        if not text:
            raise ValueError("empty")
        return text.upper()

    r = extraction.extract(spark.createDataFrame([("1", "a", "x"), ("2", "b", None)], "pmid string, local_id string, text string"), rule)
    assert {(x.pmid, x.payload, x.error) for x in r.collect()} == {("1", "X", None), ("2", None, "ValueError: empty")}


def test_interpolation_and_dense_axis(spark):
    a = spark.createDataFrame([(10, 2000.0), (20, 2010.0)], "k int, v double")
    got = {r.k: r.v for r in overview.interpolate(spark.createDataFrame([(5,), (10,), (15,), (25,)], "k int"), a).collect()}
    assert got == {5: 2000.0, 10: 2000.0, 15: 2005.0, 25: 2010.0}
    assert overview.dense_axis(spark.createDataFrame([(2, 5)], "y int, n long"), "y", "n", 1, 3).orderBy("y").collect()[0].n == 0


def test_phenopacket_leaves_empty_keys_out(spark, sf):
    r = spark.read.parquet(f"{sf}/individuals.parquet")
    for row in phenopacket.with_added(r).select(phenopacket.phenopacket_json(F.col("record"), F.col("record_id"), F.col("pmid")).alias("p")).collect():
        assert all(v not in ([], None) for v in json.loads(row.p).values())


def test_case_sheets_samples_and_tables(spark, sf, tmp_path):
    from strandline.operators import facts

    r = spark.read.parquet(f"{sf}/individuals.parquet").dropDuplicates(["record_id"])
    sheet = facts.case_sheets(r).first().sheet
    assert sheet.startswith("# PMID_") and "\n## " in sheet
    s = spark.createDataFrame([("s", "1")], "set_name string, pmid string")
    sampling.write_sample(s, spark.createDataFrame([("s", "1"), ("t", "1"), ("u", "1")], "set_name string, pmid string"), str(tmp_path / "sample"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "sample")).first().other_sets == "t|u"
    text = review.metrics_markdown(review.metrics(spark.createDataFrame([("g", "Correct")], "grp string, verdict string"), spark.createDataFrame([], "grp string")).collect())
    assert text.count("\n") == 3 and "| g | 1 | 1 |" in text
    assert facts.export_all(r, spark.read.parquet(f"{sf}/documents.parquet"), str(tmp_path / "export")) and spark.read.parquet(str(tmp_path / "export/treatments.parquet")).columns[0] == "record_id"


def test_intermediate_tables_live_in_the_shared_folder(spark, tmp_path):
    from strandline import session

    df = spark.range(5).toDF("x")
    out = session.materialise(df, "t")
    path = session._MADE[-1]
    assert path.startswith(session.shared_dir(spark)) and out.count() == 5
    session._MADE[:] = [path]
    assert session.drop_scratch(spark) == 1 and session._MADE == []


def test_json_of_any_depth_is_read():
    deep = '{"a":[' * 30_000 + '"x"' + "]}" * 30_000
    value, depth = nested._loads(deep), 0
    while isinstance(value, dict):
        value, depth = value["a"][0], depth + 1
    assert (value, depth) == ("x", 30_000)
    for text in ('{"a": [1, -2.5e3, true, null, "q\\u00e9", {}, []], "b": {"c": ""}}', "[]", "3", '"s"', " {} "):
        assert nested._deep(text) == json.loads(text)
    for text in ("{", '{"a"}', "[1,]", '{"a":1,}', "[1] 2", "", "[1 2]", '{"a":1]', "tru"):
        with pytest.raises(ValueError):
            nested._deep(text)


def test_terms_are_tagged_alike_by_one_dictionary_and_by_shards(spark):
    v = spark.createDataFrame([("acid", "1"), ("fatty acid", "2"), ("fatty acid oxidation", "3"), ("oxidation defect", "4"), ("acid", "5"), (None, "6"), ("x", None)], "term string, id string")
    g = spark.createDataFrame([("ABC1", "g1"), ("BC1", "g2")], "symbol string, id string")
    texts = [(1, "A Fatty Acid oxidation defect; acid."), (2, "fattyacid acids ABC1 abc1 XABC1"), (3, None), (4, ""), (5, "acid-base fatty acid")]
    d = spark.createDataFrame(texts, "key int, text string")
    want = {1: (["1", "3", "5"], [], ["acid", "fatty acid oxidation"]), 2: (["g1"], ["ABC1"], []), 3: ([], [], []), 4: ([], [], []), 5: (["1", "2", "5"], [], ["acid", "fatty acid"])}
    for n in (100, 2):
        assert {r.key: (r.ids, r.genes, r.terms) for r in scope.tag(d, v, g, shard_terms=n).collect()} == want


def test_interpolation_equals_numpy(spark):
    r = random.Random(3)
    points = sorted((float(k), r.random()) for k in r.sample(range(5000), 400))
    keys = [r.randint(-100, 5100) for _ in range(500)]
    x = overview.interpolate(spark.createDataFrame([(k,) for k in keys], "k int"), spark.createDataFrame([*points, (None, 1.0)], "k double, v double"))
    want = sorted((k, round(float(np.interp(k, *zip(*points, strict=True))), 9)) for k in keys)
    assert sorted((a, round(b, 9)) for a, b in x.collect()) == want
    assert overview.interpolate(spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([], "k double, v double")).first().v is None


def test_of_repeated_anchors_the_last_counts(spark):
    docs = spark.createDataFrame([("1", "# T\n\n## S [sec:1]\n\n[sec:1 ¶1] first text\n\n[sec:1 ¶1] second text"), ("2", None)], "pmid string, text string")
    q = spark.createDataFrame([("1", "sec:1 ¶1", "second text"), ("1", "sec:1 ¶1", "first text"), ("1", None, "nowhere"), ("2", "title", "x"), ("3", "title", ""), (None, "title", "x")], "pmid string, anchor string, quote string")
    got = {(r.pmid, r.quote): (r.anchor_exists, r.in_anchor, r.in_document) for r in anchors.verify_quotes(q, docs).collect()}
    assert got == {("1", "second text"): (True, True, True), ("1", "first text"): (True, False, True), ("1", "nowhere"): (False, False, False), ("2", "x"): (False, False, False), ("3", ""): (False, False, False), (None, "x"): (False, False, False)}


def test_damaged_and_faulty_xml_costs_its_own_rows_only(spark):
    one = "<PubmedArticle><MedlineCitation><PMID>{}</PMID><Article><ArticleTitle>t</ArticleTitle>{}</Article></MedlineCitation></PubmedArticle>"
    bad = one.format(2, "<ArticleDate><Year>19x</Year></ArticleDate>")
    texts = [("set", f"<S>{one.format(1, '')}{bad}{one.format(3, '')}</S>"), ("cut", f"<S>{one.format(4, '')}{one.format(5, '')[:60]}")]
    got = sorted((r.source, r.pmid, r.error is None) for r in xml.citations(spark.createDataFrame(texts, "source string, xml string")).collect() if r.pmid)
    assert got == [("cut", "4", True), ("set", "1", True), ("set", "2", False), ("set", "3", True)]
    a = '<article><front><license xmlns:x="l" x:href="http://cc"><license-p> </license-p></license><article-title>T</article-title></front><body><sec><title>S</title><p>one</p></sec><sec><p>tw'
    r = xml.articles(spark.createDataFrame([("k", a), ("n", None)], "key string, xml string")).where("key = 'k'").first()
    assert r.error and r.title == "T" and r.meta["license"] == "http://cc" and [s.title for s in r.sections] == ["S", "(untitled)"]


def test_model_of_missing_units_is_right_where_it_is_sure(spark):
    d = "/root/testdata/sf0.01"
    rows = {r.confident: r for r in harmonise.held_out(spark.read.parquet(f"{d}/measurements.parquet"), spark.read.parquet(f"{d}/analytes_builtin.parquet")).collect()}
    assert rows[True].share >= 0.9 and rows[True].n >= 50


def test_grounding_cascades_with_their_fuzzy_tiers(spark):
    names = spark.createDataFrame([("short stature", "HP:1", "short stature", 0), ("small body size", "HP:1", "short stature", 2), ("long fingers", "HP:2", "long fingers", 0)], "name string, id string, label string, prio int")
    texts = spark.createDataFrame([("Short stature", "HP:1"), ("short stature", None), ("small body size", None), ("short statur", None), ("blue eyes", "HP:2"), ("nothing", "HP:9"), (None, "HP:1")], "text string, supplied string")
    got = {r.text: (r.id, r.status, r.confidence, r.method) for r in grounding.ground_phenotypes(texts, names).collect()}
    assert got["Short stature"] == ("HP:1", "grounded", 0.95, "supplied+verified") and got["short stature"] == ("HP:1", "grounded", 0.95, "exact")
    assert got["small body size"] == ("HP:1", "grounded", 0.85, "synonym") and got["short statur"][::3] == ("HP:1", "fuzzy") and got["short statur"][1] == "grounded"
    assert got["blue eyes"] == ("HP:2", "candidate", 0.5, "supplied-unverified") and got["nothing"] == (None, "unresolved", None, "fuzzy") and None not in got
    lex = spark.createDataFrame([("abc def", "A"), ("abd def", "B"), ("zzz", "C")], "key string, label string")
    t = spark.createDataFrame([("abc deg",)], "text string")
    whole, cut = ([tuple(r) for r in grounding.fuzzy(t, lex, "phenotype", shard_rows=n).orderBy("rank").collect()] for n in (100, 1))
    assert whole == cut and len(whole) == 2
