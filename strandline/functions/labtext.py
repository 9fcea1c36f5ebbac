"""Free-typed analyte and disease texts: taking off unit, specimen, timing and certainty words, and comparison keys.

Shared by the reference-list mapping and by unit harmonisation; holds no matching by distance.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from .lookalike import fold, strip_accents
from .units import parse_unit

# Words that do not change what an analyte text means.
SPECIMENS = (
    "whole blood", "dried blood spots", "dried blood spot", "dried bloodspot", "cerebrospinal fluid", "blood spot", "plasma", "serum", "blood", "csf", "urine",
    "urinary", "dbs", "leukocytes", "leukocyte", "leucocytes", "leucocyte", "fibroblasts", "fibroblast", "erythrocytes", "erythrocyte", "muscle", "liver",
    "saliva", "venous", "arterial", "capillary", "amniotic fluid", "lymphocytes", "lymphocyte", "faeces", "feces", "stool", "tissue",
)
QUALIFIERS = (
    "at admission", "on admission", "at presentation", "at diagnosis", "at follow-up", "at birth", "fasting", "fasted", "postprandial", "peak", "trough", "baseline", "initial", "maximum", "max", "minimum",
    "min", "mean", "random", "first", "last", "repeat", "levels", "level", "concentrations", "concentration", "conc.", "conc", "activity", "content", "excretion", "value", "values", "result", "during crisis", "day 1",
)
DISEASE_WORDS = (
    "suspected", "probable", "possible", "presumed", "likely", "confirmed", "known", "severe", "mild", "moderate", "classic", "classical", "atypical", "typical", "late-onset", "late onset", "early-onset", "early onset", "neonatal-onset", "adult-onset", "familial", "sporadic", "hereditary", "attenuated",
    "neonatal form", "infantile form", "juvenile form", "adult form", "late-onset form", "severe form", "mild form", "vitamin-responsive", "vitamin responsive", "with cardiomyopathy", "with epilepsy", "with seizures", "confirmed by sequencing", "confirmed genetically", "confirmed enzymatically", "clinically", "genetically confirmed", "biochemically confirmed", "query", "variant form",
)

_EDGE = " \t\n,;:.-–—*†‡§#?!"
_BRACKET_END = re.compile(r"[\s,;]*[(\[{]([^()\[\]{}]*)[)\]}][\s,;.*†‡]*$")
_BRACKET_START = re.compile(r"^[\s]*[(\[{]([^()\[\]{}]*)[)\]}]\s*")
_MARKS = re.compile(r"[*†‡§]+")
_SPEC = "|".join(sorted((re.escape(s) for s in SPECIMENS), key=len, reverse=True))
_QUAL = "|".join(sorted((re.escape(s) for s in QUALIFIERS), key=len, reverse=True))
_SPEC_TAIL = re.compile(rf"(?:[\s,;]+|^)(?:(?:in|of|from)\s+)?(?:the\s+)?(?:{_SPEC})$", re.I)
_SPEC_HEAD = re.compile(rf"^(?:{_SPEC})(?:[\s,:;-]+)(?:of\s+)?", re.I)
_QUAL_TAIL = re.compile(rf"[\s,;]+(?:{_QUAL})$", re.I)
_QUAL_HEAD = re.compile(rf"^(?:{_QUAL})(?:\s+of)?[\s,:;]+", re.I)
_KNOWN = re.compile(rf"^(?:(?:in|of|from)\s+)?(?:{_SPEC}|{_QUAL})$", re.I)
_IN_TAIL = re.compile(r"[\s,;]+in$", re.I)
_RATIO = re.compile(r"\bratio\b|\bquotient\b|\(\s*sum\s*\)|\bsum of\b|\s\+\s|(?<=\w)\s*/\s*(?=[A-Za-z0-9]{2})|\btotal of\b", re.I)


_UNITISH = re.compile(r"/|\bper\b|-1\W*$|⁻¹|%|\b(?:[mun]m|[µμ]m|kpa|torr|mm ?hg|mm ?\[hg\]|kilopascals?)\W*$", re.I)


def _unit_tail(t: str) -> tuple[str, str] | None:
    """The longest tail of `t` that is a unit, and what stands before it."""
    if not _UNITISH.search(t):
        return None
    for m in re.finditer(r"[\s,;(\[]+", t):
        tail = t[m.end() :].strip(_EDGE.replace(".", "").replace("-", "") + ")]")
        low = tail.lower()
        if low.startswith("in "):
            tail = tail[3:]
        if tail and parse_unit(tail) is not None and m.start() > 0:
            return t[: m.start()], tail
    return None


@dataclass(frozen=True)
class Parsed:
    """`core` is what is left of the text; `unit` the unit spelled in it; `composite` marks ratios and sums."""

    core: str
    unit: str | None = None
    composite: bool = False
    inner: tuple[str, ...] = field(default=())


def parse_analyte(raw: str) -> Parsed:
    """Peel unit, specimen, timing and marks off both ends of a typed analyte until nothing more comes off."""
    t = re.sub(r"\s+", " ", _MARKS.sub(" ", fold(raw))).strip(_EDGE)
    unit, inner = None, []
    while True:
        before = t
        if m := _BRACKET_END.search(t):
            body = m[1].strip()
            if body.lower() == "sum":
                return Parsed(t, unit, True)
            if parse_unit(body) is not None:
                unit = unit or body
                t = t[: m.start()]
            elif _KNOWN.match(body) or not body:
                t = t[: m.start()]
            elif m.start() > 0:
                inner.append(body)
                t = t[: m.start()]
        if hit := _unit_tail(t):
            unit, t = unit or hit[1], hit[0]
            t = _IN_TAIL.sub("", t)
        t = t.strip(_EDGE)
        for rx in (_QUAL_TAIL, _SPEC_TAIL, _SPEC_HEAD, _QUAL_HEAD):
            if (s := rx.sub("", t).strip(_EDGE)) and s != t:
                t = s
        if t == before:
            break
    composite = bool(_RATIO.search(t)) or bool(re.search(r"\w\s*/\s*\w", t))
    if m := re.match(r"^(acid|kinase|dehydrogenase|aminotransferase)s?\s*,\s*(.+)$", t, re.I):
        t = f"{m[2]} {m[1]}"
    elif m := re.match(r"^(.+?)\s*,\s*(free|total|partial pressure of)$", t, re.I):
        t = f"{m[2]} {m[1]}"
    return Parsed(t, unit, composite, tuple(inner))


_DW = "|".join(sorted((re.escape(s) for s in DISEASE_WORDS), key=len, reverse=True))
_DIS_HEAD = re.compile(rf"^(?:{_DW})(?:[\s,:;]+(?:case of\s+)?|$)", re.I)
_DIS_TAIL = re.compile(rf"[\s,;:–—-]+(?:{_DW})$", re.I)
_OMIM = re.compile(r"(?:OMIM|MIM)\s*[#*:]?\s*(\d{6})", re.I)
_ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
_TYPE = re.compile(r"\b(?:types?|typ|subtype)[\s.-]*(\d+|[ivx]+)\b", re.I)
_TAIL_NUMBER = re.compile(r"\b(?:type[\s.-]*)?(\d+|[ivx]+)$", re.I)
# Names of discoverers, in any order: "A-B syndrome", "A B disease", "syndrome of A and B".
_NAME = r"[A-ZÀ-Þ][\w'’]+"
_EPONYM = re.compile(rf"^((?i:{_NAME}(?:(?:\s*[-/]\s*|\s+and\s+|\s+){_NAME})+))\s+(?i:syndrome|disease)$")
_OF_EPONYM = re.compile(rf"^(?i:syndrome|disease) of ((?i:{_NAME}(?:(?:\s*[-/,]\s*|\s+and\s+|\s+){_NAME})*))$")


def parse_disease(raw: str) -> tuple[str, str | None]:
    """`(core, omim number or None)`; type numbers become Arabic and stand as `type N`."""
    t = re.sub(r"\s+", " ", _MARKS.sub(" ", fold(raw))).strip(_EDGE)
    omim = None
    if m := _OMIM.search(t):
        omim = m[1]
        t = re.sub(r"[\s,;]*[(\[]?\s*(?:OMIM|MIM)\s*[#*:]?\s*\d{6}\s*[)\]]?", " ", t, flags=re.I).strip(_EDGE)
    while True:
        before = t
        if (m := _BRACKET_END.search(t)) and m.start() > 0:
            t = t[: m.start()]
        t = _DIS_TAIL.sub("", t.strip(_EDGE))
        t = _DIS_HEAD.sub("", t).strip(_EDGE) or t
        if t == before:
            break
    if (m := re.match(r"^deficiency of (?:the )?(.+)$", t, re.I)) or (m := re.match(r"^(.+?)\s*,\s*deficiency$", t, re.I)):
        t = m[1] + " deficiency"
    t = re.sub(r"\b(?:deficit|def\.?|defic\.?|deficiencies|deficient)(?=\s|$)", "deficiency", t, flags=re.I)
    t = re.sub(r"\b(?:synd\.|syndr\.)(?=\s|$)", "syndrome", t, flags=re.I)
    t = re.sub(r"\b(?:dis\.)(?=\s|$)", "disease", t, flags=re.I)
    t = re.sub(r"\b(acidaemia|aciduria|acid(?=uria))\b", "acidemia", t, flags=re.I)
    t = re.sub(r"aemia\b", "emia", t, flags=re.I)
    t = _TYPE.sub(lambda m: f"type {_ROMAN.get(m[1].lower(), m[1])}", t)
    if (m := _EPONYM.match(t)) or (m := _OF_EPONYM.match(t)):
        names = sorted(x for x in re.split(r"[\s-]+|\band\b|\bet\b|\bund\b|&", m[1]) if x)
        t = "-".join(names).lower() + " syndrome"
    if (m := re.search(r"(?<!type )\b(\d+|[ivx]+)$", t, re.I)) and m.start() > 3:
        t = f"{t[: m.start()].rstrip(' -')} type {_ROMAN.get(m[1].lower(), m[1])}"
    return t, omim


_OH = re.compile(r"(?<![a-z0-9])(\d+)[\s-]?oh[\s-](?=[a-z]{3})")


def key(text: str) -> str:
    """What two spellings share when only case, accents, spaces and punctuation differ."""
    t = strip_accents(fold(text)).lower()
    t = _OH.sub(r"\1-hydroxy", t)
    return re.sub(r"[^a-z0-9:]+", "", t)


def guard(text: str) -> tuple:
    """What no typo may change: the numbers in order, and a one-letter prefix such as `L-`."""
    t = strip_accents(fold(text)).lower()
    t = _OH.sub(r"\1-hydroxy", t)
    prefix = m[1] if (m := re.match(r"^([a-z])[\s-](?=[a-z])", t)) else ""
    return tuple(re.findall(r"\d+", t)), prefix


# Initials used for the class words of analyte names.
INITIALS = {"dh": "dehydrogenase", "bp": "binding protein", "at": "aminotransferase", "pp": "partial pressure"}
_PRESSURE = re.compile(r"^(.+?)\s+(?:partial press(?:ure)?|p\.? ?p\.?)$", re.I)


def expand(text: str, words: dict[str, str]) -> str:
    """A cut-off or initialled last word, spelled out (`words`: beginnings to class words of the reference list)."""
    head, gap, last = text.rpartition(" ")
    if not gap:
        head, gap, last = text.rpartition("-")
    if gap and head:
        low = last.lower().rstrip(".")
        full = INITIALS.get(low) or words.get(low)
        if full:
            text = f"{head}{gap}{full}"
        elif low.endswith("s") and low[:-1] in words.values():
            text = f"{head}{gap}{low[:-1]}"
    if m := _PRESSURE.match(text):
        text = f"partial pressure of {m[1]}"
    return text


def end_word(entry: str) -> str:
    """The word that ends an entry."""
    w = (re.findall(r"[a-z]+", entry.lower()) or [""])[-1]
    return "carnitine" if w.endswith("carnitine") else w


def class_words(entries: list[str]) -> dict[str, str]:
    """Beginnings (2 letters and more) of words that end several entries of the list, where they are unambiguous."""
    ends: dict[str, int] = {}
    for w in map(end_word, entries):
        if len(w) >= 4:
            ends[w] = ends.get(w, 0) + 1
    begun: dict[str, set[str]] = {}
    for w, n in ends.items():
        if n >= 2:
            for i in range(2, len(w)):
                begun.setdefault(w[:i], set()).add(w)
    return {k: next(iter(v)) for k, v in begun.items() if len(v) == 1 and k not in ends}


def is_code(k: str) -> bool:
    """Short abbreviations take no typos."""
    return len(k) <= 5
