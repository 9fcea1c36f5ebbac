"""Anchored documents as rows: units of the rendered text, anchor resolution, quote verification, narratives.

Everything is derived inside a document's own row with array functions (no shuffle of texts): lines carry their anchors, and
table rows are read from the piece of text that begins at the table's heading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import squash, truthy

# The anchor grammar of rendered documents, and wordings that mark sections and sentences.
SECTION = r"^#{2,4} (.+?) \[sec:(\d+)\]\s*$"
PARAGRAPH = r"^\[sec:(\d+) ¶(\d+)\] (.*)$"
TABLE = r"^### Table (.*?) \[tab:(\d+)\]\s*$"
ROW = r"^\| r(\d+) \| (.*) \|\s*$"
FIGURE = r"^Figure (\S+): (.*)$"
ANCHOR = r"(?i)^(abstract|title|sec:(\d+)(?:\s*¶\s*(\d+))?|tab:(\d+)(?:\s*r(\d+))?(?:\s*c(\d+))?|fig:(.+))$"
TOLERANT_LENGTH = 80
QUOTES_PER_ROW = 512
REFERENCE_LIKE = r"(?i)^(references|bibliography|acknowledg|competing interests|funding|author contributions)"
GENERIC_SECTION = r"(?i)^(introduction|background|discussion|conclusion|conclusions|literature review|review of the literature|methods|materials and methods)\b"
SELF_REFERENCE = r"(?i)\b(our patient|the patient|this patient|the proband|our proband|this case|our case|the present case|the index case|the child|the boy|the girl|the infant|the neonate|the fetus|the family|the siblings)\b"


def _unit(kind: str, n: Column, m: Column, anchor: Column, text: Column, cells: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), n.cast("int").alias("n"), m.cast("int").alias("m"), anchor.alias("anchor"), text.alias("text"), (cells if cells is not None else F.lit(None).cast("array<string>")).alias("cells"))


def is_paragraph(x: Column) -> Column:
    """A cheap prefix test before the pattern: most lines fail it."""
    return F.startswith(x, F.lit("[sec:")) & x.rlike(PARAGRAPH)


def is_figure(x: Column) -> Column:
    return F.startswith(x, F.lit("Figure ")) & x.rlike(FIGURE)


def is_row(x: Column) -> Column:
    return F.startswith(x, F.lit("| r")) & x.rlike(ROW)


def _first_line(lines: Column, prefix: str, pattern: str, group: int) -> Column:
    hit = F.try_element_at(F.filter(lines, lambda x: F.startswith(x, F.lit(prefix)) & x.rlike(pattern)), F.lit(1))
    return F.regexp_extract(hit, pattern, group)


_ABSTRACT = (
    r"(?m)^## Abstract \[abstract\].*\n(?:[ \t]*\n)*"
    r"((?:(?![ \t]*$|#{2,4} .*\[(?:sec|tab):\d+\][ \t]*$|\[sec:\d+ ¶\d+\] |Figure \S+: ).*(?:\n|\z))*)"
)


def _abstract(text: Column) -> Column:
    """The lines below the abstract's heading up to the next blank line or heading, joined by line breaks."""
    block = F.rtrim(F.regexp_extract(text, _ABSTRACT, 1), F.lit("\n"))
    return truthy(F.array_join(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), "\n"))


def _tables(md: Column) -> Column:
    """Pieces of text that begin at a table's heading and end before the next section heading or figure."""
    pieces = F.split(md, r"(?m)^(?=### Table .*? \[tab:\d+\]\s*$)")
    own = F.filter(pieces, lambda p: F.element_at(F.split(p, "\n"), 1).rlike(TABLE))
    return F.transform(own, lambda p: F.element_at(F.split(p, r"(?m)^(?=#{2,4} .+? \[sec:\d+\]\s*$|Figure \S+: )(?!### Table )"), 1))


def unit_array(text: Column) -> Column:
    """All finest units of one text as an array of structs `(kind, n, m, anchor, text, cells)`, in document order."""
    lines = F.split(text, "\n")
    title = truthy(F.trim(_first_line(lines, "# ", r"^# (.*)$", 1)))

    def paragraph(x: Column) -> Column:
        anchor = F.substring_index(F.substring(x, 2, 60), "]", 1)  # "sec:N ¶M"
        n, m = F.substring_index(F.substring_index(anchor, ":", -1), " ", 1), F.substring_index(anchor, "¶", -1)
        return _unit("paragraph", n, m, F.concat(F.lit("sec:"), n.cast("int"), F.lit(" ¶"), m.cast("int")), x.substr(F.length(anchor) + 4, F.length(x)))

    paragraphs = F.transform(F.filter(lines, is_paragraph), paragraph)

    def rows(piece: Column) -> Column:
        tab = F.regexp_extract(F.element_at(F.split(piece, "\n"), 1), TABLE, 2)

        def row(x: Column) -> Column:
            cells = F.transform(F.split(F.regexp_extract(x, ROW, 2), r" \| "), lambda c: F.trim(c))
            r = F.regexp_extract(x, ROW, 1)
            return _unit("row", tab, r, F.concat(F.lit("tab:"), tab, F.lit(" r"), r), F.array_join(cells, " | "), cells)

        return F.transform(F.filter(F.split(piece, "\n"), is_row), row)

    figures = F.transform(F.filter(lines, is_figure), lambda x: _unit("figure", F.lit(None), F.lit(None), F.concat(F.lit("fig:"), F.regexp_extract(x, FIGURE, 1)), F.regexp_extract(x, FIGURE, 2)))
    head = F.array(_unit("title", F.lit(None), F.lit(None), F.lit("title"), title), _unit("abstract", F.lit(None), F.lit(None), F.lit("abstract"), _abstract(text)))
    return F.concat(F.filter(head, lambda u: u["text"].isNotNull()), paragraphs, F.flatten(F.transform(_tables(text), rows)), figures)


def units(documents: DataFrame, text: str = "text") -> DataFrame:
    """Every finest unit of every document: title, abstract, paragraphs, table rows, figures, in document order.

    Adds `(ord, kind, n, m, anchor, unit, cells)` to the other columns.
    """
    others = [c for c in documents.columns if c != text]
    u = documents.where(F.col(text).isNotNull()).select(*others, F.posexplode(unit_array(F.col(text))).alias("ord", "u"))
    return u.select(*others, "ord", "u.kind", "u.n", "u.m", "u.anchor", F.col("u.text").alias("unit"), "u.cells")


def table_heads(documents: DataFrame, text: str = "text") -> DataFrame:
    """(…, tab, label, caption, footnotes); where the caption is missing its place is taken by the first plain line."""
    others = [c for c in documents.columns if c != text]
    p = documents.where(F.col(text).isNotNull()).select(*others, F.explode(_tables(F.col(text))).alias("p"))
    lines = F.split("p", "\n")
    plain = F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda x: (F.trim(x) != "") & ~F.startswith(x, F.lit("|")))
    caption = F.coalesce(F.trim(F.try_element_at(plain, F.lit(1))), F.lit(""))
    notes = F.filter(F.slice(plain, F.lit(2), F.size(plain)), lambda x: F.startswith(x, F.lit("Footnotes:")))
    head = F.element_at(lines, 1)
    return p.select(*others, F.regexp_extract(head, TABLE, 2).cast("int").alias("tab"), F.regexp_extract(head, TABLE, 1).alias("label"), caption.alias("caption"), F.trim(F.try_element_at(notes, F.lit(-1)).substr(F.lit(11), F.length(F.try_element_at(notes, F.lit(-1))))).alias("footnotes"))


def section_titles(documents: DataFrame, text: str = "text") -> DataFrame:
    """(…, n, title) of every section heading; the first heading of a number counts."""
    others = [c for c in documents.columns if c != text]
    s = documents.where(F.col(text).isNotNull()).select(*others, F.explode(F.filter(F.split(text, "\n"), lambda x: F.startswith(x, F.lit("##")) & x.rlike(SECTION))).alias("h"))
    return s.select(*others, F.regexp_extract("h", SECTION, 2).cast("int").alias("n"), F.regexp_extract("h", SECTION, 1).alias("title"), F.rlike("h", F.lit(REFERENCE_LIKE)).alias("reference_like"))


def normal_anchor(a: Column) -> Column:
    """The canonical spelling of an anchor (single blank before ¶ and r), NULL for what the grammar doesn't know."""
    t = F.trim(a)
    g = [F.regexp_extract(t, ANCHOR, i) for i in range(8)]
    return (
        F.when(~t.rlike(ANCHOR), F.lit(None).cast("string"))
        .when(F.lower(t).isin("abstract", "title"), F.lower(t))
        .when(g[2] != "", F.concat(F.lit("sec:"), g[2].cast("int"), F.when(g[3] != "", F.concat(F.lit(" ¶"), g[3].cast("int"))).otherwise(F.lit(""))))
        .when(g[4] != "", F.concat(F.lit("tab:"), g[4].cast("int"), F.when(g[5] != "", F.concat(F.lit(" r"), g[5].cast("int"))).otherwise(F.lit("")), F.when(g[6] != "", F.concat(F.lit("c"), g[6].cast("int"))).otherwise(F.lit(""))))
        .otherwise(F.concat(F.lit("fig:"), F.trim(g[7])))
    )


def _form(anchor: Column, text: Column) -> Column:
    return F.struct(anchor.cast("string").alias("anchor"), text.alias("text"))


def anchor_forms(us: Column) -> Column:
    """All anchor forms of one document's units: units, whole sections, table rows, cells and columns, as (anchor, text)."""
    fine = F.transform(F.filter(us, lambda u: u["text"] != ""), lambda u: _form(u["anchor"], u["text"]))
    of = lambda kind: F.filter(us, lambda u: u["kind"] == kind)
    numbers = lambda kind: F.array_distinct(F.transform(of(kind), lambda u: u["n"]))
    mine = lambda kind, n: F.array_sort(F.filter(of(kind), lambda u: u["n"] == n), lambda a, b: a["m"] - b["m"])
    sections = F.transform(numbers("paragraph"), lambda n: _form(F.concat(F.lit("sec:"), n), F.array_join(F.transform(mine("paragraph", n), lambda u: u["text"]), "\n\n")))
    cells = F.flatten(F.transform(of("row"), lambda u: F.transform(u["cells"], lambda c, j: _form(F.concat(u["anchor"], F.lit("c"), j + 1), c))))

    def columns(n: Column) -> Column:
        rows = mine("row", n)
        width = F.array_max(F.transform(rows, lambda u: F.size(u["cells"])))

        def column(j: Column) -> Column:
            there = F.filter(rows, lambda u: F.size(u["cells"]) >= j)
            line = lambda u: F.when(j > 1, F.concat(u["cells"][0], F.lit(": "), u["cells"][j - 1])).otherwise(u["cells"][0])
            return _form(F.concat(F.lit("tab:"), n, F.lit("c"), j), F.array_join(F.transform(there, line), "\n"))

        return F.transform(F.sequence(F.lit(1), F.greatest(width, F.lit(1))), column)

    return F.concat(fine, sections, cells, F.flatten(F.transform(numbers("row"), columns)))


def resolved(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All anchor forms as (key, anchor, text). Built within each row."""
    d = documents.where(F.col(text).isNotNull()).select(key, unit_array(F.col(text)).alias("us"))
    return d.select(key, F.explode(anchor_forms(F.col("us"))).alias("f")).select(key, "f.anchor", "f.text")


def verify_quotes(quotes: DataFrame, documents: DataFrame, key: str = "pmid", text: str = "text") -> DataFrame:
    """Where quotes occur: `quotes(key, anchor, quote)` → plus `(anchor_exists, in_anchor, in_document, start, stop)`.

    White space is squashed on both sides. A quote longer than 80 characters may match by its first 80; its end is still
    counted with the full length. Distinct quotes are gathered by document (narrow rows; at most some `QUOTES_PER_ROW` together, so
    a document with very many is split), meet its row once, and anchors and text are searched within that row. Where an anchor
    occurs more than once the last one counts.
    """
    q = quotes.select(key, "anchor", "quote").distinct()
    many = q.groupBy(key).agg(F.ceil(F.count("*") / QUOTES_PER_ROW).alias("_parts"))
    q = q.join(many, q[key].eqNullSafe(many[key])).drop(many[key]).withColumn("_part", F.pmod(F.xxhash64("anchor", "quote"), F.col("_parts")))
    one = F.struct("anchor", "quote", squash(F.coalesce("quote", F.lit(""))).alias("q"), normal_anchor(F.col("anchor")).alias("a"))
    q = q.groupBy(key, "_part").agg(F.collect_list(one).alias("_qs"))
    docs = documents.select(key, text)
    j = q.join(docs, key, "left")
    # Generators of one row each keep the units and the forms from being computed per quote.
    j = j.select(key, "_qs", F.inline(F.array(F.struct(F.when(F.col(text).isNotNull(), unit_array(F.col(text))).alias("_us"), squash(F.col(text)).alias("_d")))))
    j = j.select(key, "_qs", "_d", F.inline(F.array(F.struct(F.coalesce(anchor_forms(F.col("_us")), F.array().cast("array<struct<anchor:string,text:string>>")).alias("_forms")))))
    last_first = lambda part: F.reverse(F.transform("_forms", lambda f: f[part]))
    j = j.select(key, "_qs", "_d", F.inline(F.array(F.struct(last_first("anchor").alias("_names"), last_first("text").alias("_texts")))))

    def looked_up(x: Column) -> Column:
        at = F.array_position("_names", x["a"])
        return F.struct(x["anchor"].alias("anchor"), x["quote"].alias("quote"), x["q"].alias("q"), squash(F.try_element_at("_texts", F.nullif(at, F.lit(0)).cast("int"))).alias("t"))

    def placed(x: Column) -> Column:
        long_, head = F.length(x["q"]) > TOLERANT_LENGTH, F.substring(x["q"], 1, TOLERANT_LENGTH)
        pos = F.when(x["q"] == "", 0).otherwise(F.coalesce(F.nullif(F.instr(x["t"], x["q"]), F.lit(0)), F.when(long_, F.instr(x["t"], head)), F.lit(0)))
        inside = F.when(x["q"] == "", False).otherwise(F.contains("_d", x["q"]) | (long_ & F.contains("_d", head)))
        return F.struct(x["anchor"].alias("anchor"), x["quote"].alias("quote"), F.length(x["q"]).alias("n"), x["t"].isNotNull().alias("anchor_exists"), pos.alias("pos"), F.when(pos > 0, True).otherwise(F.coalesce(inside, F.lit(False))).alias("in_document"))

    out = j.select(key, F.explode(F.transform(F.transform("_qs", looked_up), placed)).alias("x")).select(key, "x.*")
    at = F.when(F.col("pos") > 0, F.col("pos") - 1)
    return out.select(key, "anchor", "quote", "anchor_exists", (F.col("pos") > 0).alias("in_anchor"), "in_document", at.alias("start"), (at + F.col("n")).alias("stop"))


def expand(anchors: DataFrame, u: DataFrame, key: str, owner: str) -> DataFrame:
    """`anchors(owner, key, anchor)` → distinct finest units `(owner, key, ord, anchor, unit)`: sections become their
    paragraphs, tables their rows, finer anchors themselves."""
    a = anchors.select(owner, key, normal_anchor(F.col("anchor")).alias("_a")).where("_a is not null").distinct()
    coarse = F.col("_a").rlike(r"^(sec|tab):\d+$")
    fine = a.where(~coarse).join(u.withColumnRenamed("anchor", "_a"), [key, "_a"])
    wide = a.where(coarse).withColumn("_c", F.col("_a")).drop("_a").join(u.withColumn("_c", F.regexp_extract("anchor", r"^((?:sec|tab):\d+) ", 1)).withColumnRenamed("anchor", "_a"), [key, "_c"]).drop("_c")
    cols = [owner, key, "ord", F.col("_a").alias("anchor"), "kind", "n", "m", "unit"]
    return fine.select(*cols).unionByName(wide.select(*cols)).where("unit <> ''").dropDuplicates([owner, key, "anchor"])


def narratives(anchors: DataFrame, u: DataFrame, key: str = "pmid", owner: str = "record_id") -> DataFrame:
    """The verbatim passages of each owner in document order: `(owner, key, passages array<struct<anchor,text,chars>>)`."""
    rank = F.when(F.col("kind") == "title", -1).when(F.col("kind") == "abstract", 0).when(F.col("kind") == "paragraph", 1).when(F.col("kind") == "row", 2).otherwise(3)
    e = expand(anchors, u, key, owner).withColumn("_o", F.struct(rank.alias("r"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("m", F.lit(0)).alias("m"), "anchor"))
    items = F.array_sort(F.collect_list(F.struct("_o", F.col("anchor"), F.col("unit").alias("text"), F.length("unit").alias("chars"))))
    return e.groupBy(owner, key).agg(F.transform(items, lambda x: F.struct(x["anchor"].alias("anchor"), x["text"].alias("text"), x["chars"].alias("chars"))).alias("passages"))


def backfill(where: DataFrame, evidence: DataFrame, u: DataFrame, titles: DataFrame, key: str = "pmid", owner: str = "record_id") -> DataFrame:
    """Anchors for owners without a narrative: `where(owner, key, local_id, anchor)` from triage plus evidence anchors.

    The abstract comes first; of generic sections only paragraphs that speak of the patient (or name the local id) are kept;
    evidence paragraphs and rows are added where not covered yet. `(owner, key, anchor)`, distinct.
    """
    abstract = where.select(owner, key).distinct().join(u.where("kind = 'abstract'").select(key, "anchor"), key)
    w = where.withColumn("_a", normal_anchor(F.col("anchor"))).where("_a is not null")
    w = w.withColumn("_n", F.when(F.col("_a").rlike(r"^sec:\d+$"), F.regexp_extract("_a", r"(\d+)$", 1).cast("int")))
    t = titles.select(key, F.col("n").alias("_n"), F.col("title").rlike(GENERIC_SECTION).alias("_generic")).dropDuplicates([key, "_n"])
    w = w.join(t, [key, "_n"], "left")
    plain = w.where(~F.coalesce("_generic", F.lit(False))).select(owner, key, F.col("_a").alias("anchor"))
    p = u.where("kind = 'paragraph'").select(key, F.col("n").alias("_n"), F.col("anchor").alias("_p"), "unit")
    said = F.col("unit").rlike(SELF_REFERENCE) | ((F.coalesce("local_id", F.lit("")) != "") & F.contains(F.lower("unit"), F.lower("local_id")))
    generic = w.where("_generic").join(p, [key, "_n"]).where(said).select(owner, key, F.col("_p").alias("anchor"))
    seen = evidence.select(owner, key, truthy(F.regexp_extract(F.trim("anchor"), r"^(sec:\d+ ¶\d+|tab:\d+ r\d+)", 1)).alias("anchor")).where("anchor is not null")
    return abstract.select(owner, key, "anchor").unionByName(plain).unionByName(generic).unionByName(seen).distinct()


def render(title: Column, abstract: Column, sections: Column, max_chars: int = 180_000) -> Column:
    """Anchored markdown of a document: `sections array<struct<title,depth,paragraphs>>`; reference-like sections are left
    out but counted in the numbering; longer texts are cut with a marker."""

    def section(s: Column, i: Column) -> Column:
        n = (i + 1).cast("string")
        head = F.concat(F.repeat(F.lit("#"), F.least(s["depth"] + 1, F.lit(4))), F.lit(" "), s["title"], F.lit(" [sec:"), n, F.lit("]"))
        body = F.transform(s["paragraphs"], lambda p, j: F.concat(F.lit("[sec:"), n, F.lit(" ¶"), (j + 1).cast("string"), F.lit("] "), p))
        return F.when(~s["title"].rlike(REFERENCE_LIKE), F.array_join(F.concat(F.array(head), body), "\n\n"))

    parts = F.concat(F.array(F.concat(F.lit("# "), F.coalesce(title, F.lit("")))), F.when(truthy(abstract).isNotNull(), F.array(F.concat(F.lit("## Abstract [abstract]\n"), abstract))).otherwise(F.array().cast("array<string>")), F.filter(F.transform(sections, section), lambda x: x.isNotNull()))
    text = F.array_join(parts, "\n\n")
    return F.when(F.length(text) > max_chars, F.concat(F.substring(text, 1, max_chars), F.lit("\n\n[TRUNCATED]"))).otherwise(text)


def table_markdown(label: Column, caption: Column, rows: Column, footnotes: Column, number: Column) -> Column:
    """A table with anchored rows: bars inside cells become slashes, short rows are padded, a rule follows the first row."""
    width = F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))

    def line(r: Column, i: Column) -> Column:
        cells = F.concat(F.transform(r, lambda c: F.replace(c, F.lit("|"), F.lit("/"))), F.array_repeat(F.lit(""), width - F.size(r)))
        text = F.concat(F.lit("| r"), (i + 1).cast("string"), F.lit(" | "), F.array_join(cells, " | "), F.lit(" |"))
        return F.when(i == 0, F.concat(text, F.lit("\n|"), F.repeat(F.lit("---|"), width + 1))).otherwise(text)

    n = number.cast("string")
    head = F.concat(F.lit("### Table "), F.coalesce(truthy(label), n), F.lit(" [tab:"), n, F.lit("]"))
    notes = F.when(truthy(footnotes).isNotNull(), F.array(F.concat(F.lit("Footnotes: "), footnotes))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(F.array(head, F.coalesce(caption, F.lit(""))), F.transform(rows, line), notes), "\n")
