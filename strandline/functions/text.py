"""Scalar text functions as Column expressions (JVM side, no Python workers)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Roman numerals of disease and gene types.
ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}
# Months of publication dates.
MONTHS = {"Jan": "01", "Feb": "02", "Mar": "03", "Apr": "04", "May": "05", "Jun": "06", "Jul": "07", "Aug": "08", "Sep": "09", "Oct": "10", "Nov": "11", "Dec": "12"}
# Spellings of units and their UCUM form (lower case, litre as l, micro as U+00B5).
UNIT_SPELLINGS = {
    "umol/l": "umol/L", "µmol/l": "umol/L", "micromol/l": "umol/L", "mmol/l": "mmol/L", "nmol/l": "nmol/L", "pmol/l": "pmol/L", "mol/l": "mol/L",
    "mg/dl": "mg/dL", "g/dl": "g/dL", "ug/dl": "ug/dL", "µg/dl": "ug/dL", "ng/dl": "ng/dL", "mg/l": "mg/L", "g/l": "g/L", "ug/l": "ug/L", "µg/l": "ug/L", "ng/l": "ng/L",
    "ng/ml": "ng/mL", "ug/ml": "ug/mL", "µg/ml": "ug/mL", "mg/ml": "mg/mL", "nmol/ml": "nmol/mL", "umol/ml": "umol/mL", "µmol/ml": "umol/mL", "pmol/ml": "pmol/mL",
    "u/l": "U/L", "iu/l": "[IU]/L", "mu/l": "mU/L", "miu/l": "m[IU]/L", "ku/l": "kU/L",
    "mmol/mol creatinine": "mmol/mol{creat}", "mmol/mol creat": "mmol/mol{creat}", "mmol/mol cr": "mmol/mol{creat}", "mmol/mol": "mmol/mol{creat}",
    "umol/mmol creatinine": "umol/mmol{creat}", "µmol/mmol creatinine": "umol/mmol{creat}", "umol/mmol": "umol/mmol{creat}",
    "mg/g creatinine": "mg/g{creat}", "mg/g creat": "mg/g{creat}", "ug/mg creatinine": "ug/mg{creat}",
    "mmhg": "mm[Hg]", "kpa": "kPa", "%": "%", "percent": "%",
    "nmol/h/mg protein": "nmol/h/mg{protein}", "nmol/min/mg protein": "nmol/min/mg{protein}", "nmol/h/mg": "nmol/h/mg{protein}", "umol/h/mg protein": "umol/h/mg{protein}", "pmol/min/mg": "pmol/min/mg{protein}",
    "nmol/17h/mg protein": "nmol/(17.h)/mg{protein}", "nmol/mg protein/h": "nmol/h/mg{protein}",
    "meq/l": "meq/L", "g/kg/day": "g/kg/d", "mg/kg/day": "mg/kg/d", "mg/kg": "mg/kg", "iu/kg": "[IU]/kg",
    "cells/ul": "/uL", "x10^9/l": "10*9/L", "10^9/l": "10*9/L", "x109/l": "10*9/L", "g/mol": "g/mol", "sec": "s", "s": "s", "min": "min",
}
# Specimen and filler words left out of analyte keys.
ANALYTE_FILLERS = ("plasma", "serum", "blood", "urinary", "urine", "csf", "cerebrospinal fluid", "dried blood spot", "dbs", "whole blood", "fibroblast", "leukocyte", "level", "levels", "concentration", "concentrations", "of")


def lookup(values: dict[str, str], key: Column) -> Column:
    """A literal map as an expression; NULL for other keys."""
    return F.create_map(*[F.lit(x) for x in chain(*values.items())])[key]


def truthy(c: Column) -> Column:
    """NULL for the empty string: the two are equally missing."""
    return F.nullif(c, F.lit(""))


def squash(c: Column) -> Column:
    """Runs of white space (no-break spaces too) as one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x{A0}]+", " "))


def slug(c: Column, default: str = "individual") -> Column:
    """Letters and digits joined by `_`, at most 40 characters; the default where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(truthy(F.substring(s, 1, 40)), F.lit(default))


def spell(c: Column) -> Column:
    """Lower case, ae/oe inside words as e, Roman type numbers as digits, acidurias as acidemias, deficiency last."""
    s = F.lower(c)
    s = F.regexp_replace(s, "(?<=[a-z])ae(?=[a-z])", "e")
    s = F.regexp_replace(s, "(?<=[a-z])oe(?=[a-z])", "e")
    for r, n in sorted(ROMAN.items(), key=lambda x: -len(x[0])):
        s = F.regexp_replace(s, rf"(?<![a-z0-9_])type\s+{r}(?![a-z0-9_])", f"type {n}")
    s = F.regexp_replace(s, "(?<![a-z0-9_])(aciduria|acidaemia)(?![a-z0-9_])", "acidemia")
    return F.regexp_replace(s, "(?<![a-z0-9_])deficiency of (.+)$", "$1 deficiency")


def key(c: Column, vocabulary: str = "phenotype") -> Column:
    """The comparison key of a vocabulary: `phenotype`, `disease` (keeps commas) or `analyte` (no specimen words)."""
    keep = {"phenotype": r"a-z0-9 \-/", "disease": r"a-z0-9 \-/,", "analyte": r"a-z0-9 \-/:,\."}[vocabulary]
    s = F.regexp_replace(spell(F.trim(c)), "[‐-―]", "-")
    if vocabulary == "analyte":
        words = "|".join(sorted(ANALYTE_FILLERS, key=len, reverse=True))
        s = F.regexp_replace(s, rf"(?<![a-z0-9_])({words})(?![a-z0-9_])", " ")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, f"[^{keep}]", " "), r"\s+", " "))
    return F.regexp_replace(s, "^[ -]+|[ -]+$", "") if vocabulary == "analyte" else s


def strip_stereo(c: Column) -> Column:
    """Without mark-up tags and without stereo prefixes at the start."""
    prefixes = r"(?iu)^(?:\(?[RSEZ]\)?-|[LD]-|\(\+\)-|\(-\)-|\(\+/-\)-|\(±\)-|[+-]-|alpha-|beta-|α-|β-|cis-|trans-|all-trans-|n-|iso-)+"
    return F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), prefixes, "")


def clean_term(c: Column) -> Column:
    """A vocabulary term fit for searching, or NULL: no trailing parenthesis, not too short, no quotes or brackets."""
    s = F.regexp_replace(F.trim(c), r"\s*\(.*?\)\s*$", "")
    bad = s.rlike(r"^(?:[A-Z0-9\-]{1,4}|.{0,4})$") | s.rlike(r"[\"\[\]]")
    return F.when(~bad, s)


def curie(c: Column, iri_prefix: str, prefix: str) -> Column:
    return F.when(F.startswith(c, F.lit(iri_prefix)), F.concat(F.lit(prefix), F.substring(c, len(iri_prefix) + 1, 1000)))


def omim_in_text(c: Column) -> Column:
    return truthy(F.regexp_extract(c, r"(?:OMIM|MIM)\s*[#*:]?\s*(\d{6})", 1))


def text_variants(c: Column) -> Column:
    """Whole text, text without parentheses, each parenthesis, each acylcarnitine code; in this order."""
    return F.concat(
        F.array(c, F.regexp_replace(c, r"\(.*?\)", " ")),
        F.regexp_extract_all(c, F.lit(r"\(([^)]+)\)"), F.lit(1)),
        F.regexp_extract_all(c, F.lit(r"(?<![A-Za-z0-9_])(C\d{1,2}(?::\d)?(?:-?(?:OH|DC))?)(?![A-Za-z0-9_])"), F.lit(1)),
    )


def gene_clean(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"[^A-Za-z0-9\-]", "")


def unit_normal(c: Column) -> Column:
    """UCUM form of a unit's common spelling; other units as written, NULL for none."""
    u = truthy(c)
    k = F.replace(F.replace(F.replace(F.lower(F.trim(u)), F.lit("litre"), F.lit("l")), F.lit("liter"), F.lit("l")), F.lit("μ"), F.lit("µ"))
    k = F.regexp_replace(k, r"\s+", " ")
    return F.coalesce(lookup(UNIT_SPELLINGS, k), lookup(UNIT_SPELLINGS, F.replace(k, F.lit(" "), F.lit(""))), F.trim(u))


def variant_key(symbol: Column, notation: Column) -> Column:
    """`SYMBOL:notation` with everything but letters, digits, > and _ left out (so + - * . do not distinguish)."""
    return F.when(truthy(notation).isNotNull(), F.concat(F.upper(F.coalesce(symbol, F.lit(""))), F.lit(":"), F.lower(F.regexp_replace(notation, "[^A-Za-z0-9>_]", ""))))


def search_query(mesh: Column, terms: Column, genes: Column, case_reports: bool = True) -> Column:
    """The boolean literature query of one disease: heading OR title/abstract terms OR gene symbols."""
    head = F.when(truthy(mesh).isNotNull(), F.array(F.when(F.endswith(mesh, F.lit("]")), mesh).otherwise(F.concat(F.lit('"'), mesh, F.lit('"[MeSH Terms]')))))
    tiab = lambda a: F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.concat(F.lit('"'), x, F.lit('"[tiab]')))
    q = F.concat(F.lit("("), F.array_join(F.concat(F.coalesce(head, F.array().cast("array<string>")), tiab(terms), tiab(genes)), " OR "), F.lit(")"))
    return F.concat(q, F.lit(' AND ("Case Reports"[pt])')) if case_reports else q


def age_label(age: Column) -> Column:
    """`P2Y / 2 years`, whichever parts are given; empty without any."""
    return F.concat_ws(" / ", truthy(age["iso8601"]), truthy(age["text"]))


def mark(status: Column) -> Column:
    """How a sheet marks where a quote was found: at its anchor, elsewhere in the document, nowhere; nothing if unchecked."""
    return F.when(status == "in anchor", "✓").when(status == "in document", "~").when(status == "NOT FOUND", "✗").otherwise("")


def quantity(comparator: Column, number: Column, unit: Column) -> Column:
    """`<5 mmol/L`, whichever parts are given; empty without a number."""
    return F.coalesce(F.concat(F.coalesce(comparator, F.lit("")), number, F.coalesce(F.concat(F.lit(" "), truthy(unit)), F.lit(""))), F.lit(""))


def decoded(c: Column) -> Column:
    """JSON text as `(value variant, raw)`: what does not parse is kept as `raw`."""
    v = F.try_parse_json(c)
    return F.struct(v.alias("value"), F.when(v.isNull(), c).alias("raw"))
