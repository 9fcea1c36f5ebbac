"""Measurement units: one parser for the many spellings, and conversion factors to an analyte's common unit."""

from __future__ import annotations

import re
from functools import lru_cache

from .lookalike import fold

# Powers of ten of the prefixes, spelled out or short.
PREFIX = {"": 0, "k": 3, "kilo": 3, "m": -3, "milli": -3, "u": -6, "mc": -6, "micro": -6, "n": -9, "nano": -9, "p": -12, "pico": -12, "d": -1, "deci": -1, "c": -2}
# 1 ukat = 60 U; 1 mm[Hg] = 0.133322 kPa.
U_PER_KAT = 60e6
KPA_PER_MMHG = 0.133322

PLACEHOLDERS = frozenset({"", "-", "--", "?", "n/a", "na", "nd", "none", "unknown", "unit", "units", "see text", "not stated", "not reported", "nan", "null", "."})

_SUP = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")
_P = "(kilo|milli|micro|nano|pico|mc|k|m|u|n|p)?"
_NUM = re.compile(rf"^{_P}\s?(moles?|mols?|mol|grams?|gm?s?|kat(?:al)?s?|i\.?u\.?|\[iu\]|units?|u|m)$")
_DEN = re.compile(r"^(100\s?|10)?(d|deci|m|milli|u|micro|c)?(l|litres?|liters?)$")
_CREAT = re.compile(r"^(m|milli|u|micro|mc)?(mol|moles?|g|gm|grams?)\s?\{?(?:of )?(?:creatinine|creat|crea|cr|cre)\}?\.?$")
_CELLS = re.compile(r"^(?:x|×)?\s?10\s?(?:\^|\*|e|\*\*)?\s?(\d{1,2})\s?(?:cells)?\s?/\s?(l|litres?|liters?|ul|mm3|ml)$")
_PLAIN_CELLS = re.compile(r"^(cells?|k|thou|thousand|g|t)?\s?/\s?(ul|mm3|l|ml)$")
_SCALED_U = re.compile(r"^(?:x|×)?\s?(?:10\s?[\^*e]?\s?(3)|(1000))\s?(i?u|units?)\s?/\s?(l|ml)$")


@lru_cache(maxsize=65536)
def parse_unit(raw: str | None) -> tuple[str, float] | None:
    """`(dimension, factor)` with value·factor in the dimension's base unit, or None.

    Dimensions and bases: molar (mol/L), mass (g/L), creat_molar (mol/mol creatinine), creat_mass (g/g creatinine),
    activity (U/L), pressure (kPa), cells (1/L).
    """
    if raw is None:
        return None
    t = fold(raw).strip().translate(_SUP).replace("µ", "u").replace("μ", "u").lower()
    if t in PLACEHOLDERS:
        return None
    t = re.sub(r"\s+", " ", t)
    t = re.sub(r"(?<=[a-z])[ ·*]?([dmu]?l|litre|liter) ?-1$", r"/\1", t)  # g L-1, nmol·l-1
    t = re.sub(r"\bper\b", "/", t)
    t = re.sub(r"\s*/\s*", "/", t).strip()
    if t in ("mmhg", "mm hg", "mm[hg]", "torr"):
        return "pressure", KPA_PER_MMHG
    if t in ("kpa", "kilopascal", "kilopascals"):
        return "pressure", 1.0
    if t in ("mm", "um", "nm"):
        return "molar", {"mm": 1e-3, "um": 1e-6, "nm": 1e-9}[t]
    if m := re.match(r"^(m|u|mc|micro)?gm?s? ?%$", t):
        return "mass", 10.0 ** (PREFIX[m[1] or ""] + 1)
    if m := _SCALED_U.match(t):
        return "activity", 1e3 * (1e3 if m[4] == "ml" else 1.0)
    t = t.replace("mm³", "mm3")
    if m := _CELLS.match(t):
        per = {"ul": 6, "mm3": 6, "ml": 3}.get(m[2], 0)
        return "cells", 10.0 ** (int(m[1]) + per)
    if m := _PLAIN_CELLS.match(t):
        per = {"ul": 6, "mm3": 6, "ml": 3}.get(m[2], 0)
        if m[1] in ("k", "thou", "thousand"):
            return "cells", 10.0 ** (3 + per)
        if m[1] in (None, "cell", "cells"):
            return "cells", 10.0**per
        if m[2] != "l" and m[1] == "t":
            return None
    top, slash, den = t.partition("/")
    if not slash:
        return None
    m = _NUM.match(top.strip())
    if not m:
        return None
    p, base = 10.0 ** PREFIX[m[1] or ""], m[2]
    if base == "m" or (base == "u" and m[1] is None and top not in ("u",)):
        return None
    if c := _CREAT.match(den):
        q = 10.0 ** PREFIX[c[1][0] if c[1] in ("milli",) else ("u" if c[1] in ("micro", "mc") else c[1]) or ""] if c[1] else 1.0
        substance = base.startswith("mol")
        if substance and c[2].startswith("mol"):
            return "creat_molar", p / q
        if not substance and base.startswith("g") and c[2].startswith("g"):
            return "creat_mass", p / q
        if substance and c[2].startswith("g"):
            return "creat_molar_g", p / q
        return None
    d = _DEN.match(den)
    if not d:
        return None
    v = {None: 1.0, "d": 0.1, "deci": 0.1, "m": 1e-3, "milli": 1e-3, "u": 1e-6, "micro": 1e-6, "c": 1e-2}[d[2]]
    v *= {None: 1.0, "100": 100.0, "10": 10.0}[(d[1] or "").strip() or None]
    if base.startswith("mol"):
        return "molar", p / v
    if base.startswith("g"):
        return "mass", p / v
    if base.startswith("kat"):
        return "activity", p * U_PER_KAT / v
    return "activity", p / v


def to_common(value: float, unit: tuple[str, float], unit_common: str, molar_mass: float | None, creatinine_mass: float) -> float | None:
    """`value` in the analyte's common unit (`mmol/mol{creat}` if the unit is per creatinine); None where the dimensions
    don't fit."""
    dim, f = unit
    ok_mass = molar_mass is not None and molar_mass == molar_mass and molar_mass > 0
    if dim == "creat_molar":
        return value * f * 1e3
    if dim == "creat_mass":
        return value * f / molar_mass * creatinine_mass * 1e3 if ok_mass else None
    if dim == "creat_molar_g":
        return value * f * creatinine_mass * 1e3
    target = parse_unit(unit_common)
    if target is None:
        return None
    tdim, tf = target
    if dim == tdim:
        return value * f / tf
    if dim == "mass" and tdim == "molar" and ok_mass:
        return value * f / molar_mass / tf
    if dim == "molar" and tdim == "mass" and ok_mass:
        return value * f * molar_mass / tf
    return None
