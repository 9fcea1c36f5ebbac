"""Characters that look like ordinary ones: one plain-Python mapping used by Arrow-batched operators.

`fold` changes only what shows as (nearly) the same or not at all: compatibility forms of letters and digits, letters
followed by a combining mark, invisible characters, spaces other than U+0020, hyphens drawn like `-`, and letters of
another script inside a word. It leaves superscripts, subscripts, dashes of other length, curly quotes, words wholly in
another script, single Greek letters and the micro sign alone.
"""

from __future__ import annotations

import re
import unicodedata

# Letters drawn alike in Latin, Cyrillic and Greek.
CYRILLIC_LIKE_LATIN = "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ"
LATIN_OF_CYRILLIC = "ABESIJKMHOPCTYXaesijopcyxhdqw"
GREEK_LIKE_LATIN = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρικυ"
LATIN_OF_GREEK = "ABEZHIKMNOPTYXovpiku"

# Characters that do not show.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
# Hyphens drawn like U+002D.
HYPHENS = "‐‑﹣－"

TO_LATIN = dict(zip(CYRILLIC_LIKE_LATIN + GREEK_LIKE_LATIN, LATIN_OF_CYRILLIC + LATIN_OF_GREEK, strict=True))
TO_CYRILLIC = {b: a for a, b in zip(CYRILLIC_LIKE_LATIN, LATIN_OF_CYRILLIC, strict=True)}
TO_GREEK = {b: a for a, b in zip(GREEK_LIKE_LATIN, LATIN_OF_GREEK, strict=True)}

_FOLD_TAGS = ("<wide>", "<narrow>", "<font>", "<compat>", "<circle>", "<initial>", "<medial>", "<final>", "<isolated>")
_KEEP = "µ…ſ"
_WORD = re.compile(r"[^\W_]+")
_FOREIGN = re.compile(r"[Ͱ-Ͽἀ-῿Ѐ-ԯ]")
# Anything but these may be a look-alike by itself; they may be one only inside a word of another script.
_SUSPECT = re.compile(r"[^\x00-\x7e¡-¬®-ÿĀ-ɏ‒-”•…†‡−×⁰-₎Ͱ-ϿЀ-ԯ]")
_PLAIN = frozenset(c for c in map(chr, range(0x2500)) if not _SUSPECT.match(c) and not _FOREIGN.match(c))
_MIXED = re.compile(
    r"[0-9A-Za-zÀ-ɏ][Ͱ-ϿЀ-ԯ]|[Ͱ-ϿЀ-ԯ][0-9A-Za-zÀ-ɏ]|[Ͱ-Ͽ][Ѐ-ԯ]|[Ѐ-ԯ][Ͱ-Ͽ]"
)


class _CharMap(dict):
    """A lazy table for `str.translate`, filled as characters turn up."""

    def __missing__(self, code: int):
        ch = chr(code)
        out: str | int = code
        if code > 0x7E:
            cat = unicodedata.category(ch)
            if ch in INVISIBLE or 0xFE00 <= code <= 0xFE0F or 0xE0000 <= code <= 0xE007F:
                out = ""
            elif ch in HYPHENS:
                out = "-"
            elif cat == "Zs":
                out = " "
            elif ch not in _KEEP:
                d = unicodedata.decomposition(ch)
                if d.startswith(_FOLD_TAGS) and (cat[0] in "LN" or d.startswith("<wide>")):
                    out = unicodedata.normalize("NFKC", ch)
        self[code] = out
        return out


_CHARS = _CharMap()


def _script(ch: str) -> str:
    c = ord(ch)
    if c < 0x250:
        return "L" if ch.isalpha() else ""
    if 0x370 <= c <= 0x3FF or 0x1F00 <= c <= 0x1FFF:
        return "G"
    if 0x400 <= c <= 0x52F:
        return "C"
    return "L" if 0x1E00 <= c <= 0x1EFF else ""


def _word(m: re.Match) -> str:
    w = m.group()
    if w.isascii() or not _FOREIGN.search(w):
        return w
    scripts = [_script(c) for c in w]
    kinds = set(scripts) - {""}
    if kinds == {"C"} or kinds == {"G"}:
        # A lone look-alike letter with digits ("К15") belongs to a code, not to a word of its own script.
        letters = [c for c, s in zip(w, scripts, strict=True) if s]
        if len(letters) == 1 and len(w) > 1 and letters[0] in TO_LATIN and letters[0].isupper():
            return w.replace(letters[0], TO_LATIN[letters[0]])
        return w
    foreign = [c for c, s in zip(w, scripts, strict=True) if s in ("C", "G")]
    latin = [c for c, s in zip(w, scripts, strict=True) if s == "L"]
    strange = [c for c in foreign if c not in TO_LATIN]
    if strange and "C" in kinds and "L" in kinds and all(c in TO_CYRILLIC for c in latin):
        return "".join(TO_CYRILLIC.get(c, c) if s == "L" else c for c, s in zip(w, scripts, strict=True))
    if "L" not in kinds:  # Greek letters in a Cyrillic word
        return "".join(TO_CYRILLIC.get(TO_LATIN.get(c, c), c) if s == "G" else c for c, s in zip(w, scripts, strict=True))
    return "".join(TO_LATIN.get(c, c) if s in ("C", "G") else c for c, s in zip(w, scripts, strict=True))


def fold(text: str) -> str:
    """The look-alike-mapped form of a text; equal to the text where it has no such character. Case, runs of spaces and
    line breaks are kept."""
    if text.isascii():
        return text
    odd = set(text) - _PLAIN
    if not odd:
        return text
    t = text
    if any(map(_SUSPECT.match, odd)):
        t = unicodedata.normalize("NFC", t).translate(_CHARS)
        t = unicodedata.normalize("NFC", t)  # a mark may have stood behind an invisible character
    return _WORD.sub(_word, t) if _MIXED.search(t) else t


def unify(text: str) -> str:
    """`fold` plus what is equal on screen by convention only: the micro sign becomes Greek mu."""
    t = fold(text)
    return t if t.isascii() else t.replace("µ", "μ")


def strip_accents(text: str) -> str:
    """Letters without their marks (a lossy key, for matching only)."""
    if text.isascii():
        return text
    t = unicodedata.normalize("NFKD", text)
    t = "".join(c for c in t if not unicodedata.combining(c))
    return t.replace("ø", "o").replace("Ø", "O").replace("ß", "ss").replace("ł", "l").replace("đ", "d")
