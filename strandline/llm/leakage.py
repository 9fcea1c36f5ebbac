"""Problem 8: evaluation texts leaking into documents.

The evaluation items become a broadcast hash set of normalised word n-grams (blocks of at most `BLOCK_BYTES` of item text, one
pass over the documents each, so any number of items is handled the same way). Every document's token windows are scanned
against it in Arrow batches: words are mapped to ids of the items' vocabulary, windows of known words are hashed in one numpy
pass, and only windows in the set are looked at again. Hits are verified exactly: a run of at least `MIN_RUN` equal words (all of
a shorter item), or the whole item within the document at a word edit distance of at most `MAX_CHANGED` of its length
(bit-parallel, semi-global). `MAX_CHANGED` is 0.16, a little more than the one word in eight of the contract ("about").

The seeds miss neither kind. An item of n words may have k = floor(0.16 n) changed; cut into k + 1 stretches, one of them is
unchanged, so its grams have n // (k + 1) words, five at most (a run of 15 words holds eleven of those). A changed whole still
holds at least n - q + 1 - k q of its q-grams, and only documents with so many hits are measured (q-gram lemma).

Words: look-alike characters folded, lower case, inner punctuation and line-break hyphens removed; other punctuation ends a
word.

Cases: null and empty texts give no row; items of up to six words allow no change and are looked for as a whole run; null items
are skipped; texts of any length are read whole; repeated rows give one row; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.lookalike import fold

N = 5
MIN_RUN = 15
MAX_CHANGED = 0.16
BLOCK_BYTES = 32 << 20
_BREAK = re.compile(r"-[ \t]*\r?\n[ \t>]*")
_DROPPED = ".,:;'’ʼ-"
_SPACED = "!\"#$%&()*+/<=>?@[\\]^_`{|}~–—‒―−“”„‘‚«»…·•¶§†‡"
_ASCII = {ord(c): None for c in _DROPPED} | {ord(c): " " for c in _SPACED}


def words(text: str) -> list[str]:
    t = fold(text).lower()
    if "-" in t:
        t = _BREAK.sub("", t)
    if t.isascii():
        return t.translate(_ASCII).split()
    for c in _DROPPED:
        t = t.replace(c, "")
    for c in _SPACED:
        t = t.replace(c, " ")
    return t.split()


def changes(n: int) -> int:
    """How many words of an item of `n` words may be changed."""
    return int(MAX_CHANGED * n)


def seed(n: int) -> int:
    """The length of the grams of an item of `n` words."""
    return min(N, n // (changes(n) + 1))


class Matcher:
    """The items' vocabulary and sets of grams; `match` gives the items a text contains."""

    def __init__(self, items: list[tuple[int, str]]):
        listed = {i: words(t) for i, t in items if t}
        listed = {i: w for i, w in listed.items() if w}
        self.ids = {w: n for n, w in enumerate(sorted({w for ws in listed.values() for w in ws}), 1)}
        self.mult = [pow(0x9E3779B97F4A7C15, n, 2**64) for n in range(1, N + 1)]
        self.coded = {i: np.array([self.ids[w] for w in ws], dtype=np.int64) for i, ws in listed.items()}
        self.grams: dict[int, dict[int, list[tuple[int, int]]]] = {}  # length -> hash -> (item, place)
        for i, code in self.coded.items():
            q = seed(len(code))
            for at, h in enumerate(self._hashes(code, q).tolist()):
                self.grams.setdefault(q, {}).setdefault(h, []).append((i, at))
        self.known = {q: np.array(sorted(g), dtype=np.uint64) for q, g in self.grams.items()}
        self.masks = {}
        for i, code in self.coded.items():
            m: dict[int, int] = {}
            for n, c in enumerate(code.tolist()):
                m[c] = m.get(c, 0) | (1 << n)
            self.masks[i] = m

    def _hashes(self, code: np.ndarray, q: int) -> np.ndarray:
        c = code.astype(np.uint64)
        n = len(c) - q + 1
        h = np.zeros(n, dtype=np.uint64)
        for k in range(q):
            h += (c[k : k + n] + np.uint64(k)) * np.uint64(self.mult[k])
            h ^= h >> np.uint64(29)
        return h

    def codes(self, text: str) -> np.ndarray:
        get = self.ids.get
        return np.array([get(w, 0) for w in words(text)], dtype=np.int64)

    def hits(self, code: np.ndarray, q: int) -> list[tuple[int, int]]:
        """(start, hash) of the windows of `q` words that are in the set."""
        known = self.known[q]
        if len(code) < q:
            return []
        zero = np.concatenate(([0], np.cumsum(code == 0)))
        at = np.flatnonzero(zero[q:] == zero[:-q])
        if not len(at):
            return []
        h = self._hashes(code, q)[at]
        pos = np.minimum(np.searchsorted(known, h), len(known) - 1)
        good = known[pos] == h
        return list(zip(at[good].tolist(), h[good].tolist(), strict=True))

    def match(self, text: str) -> list[tuple[int, str]]:
        """(item, kind) with kind `run` or `whole`."""
        code = self.codes(text)
        found: dict[int, str] = {}
        for q, grams in self.grams.items():
            last: dict[tuple[int, int], tuple[int, int]] = {}
            seen: dict[int, list[int]] = {}
            for p, h in self.hits(code, q):
                for i, at in grams[h]:
                    seen.setdefault(i, []).append(p)
                    before, run = last.get((i, p - at), (-9, 0))
                    run = run + 1 if before == p - 1 else 1
                    last[(i, p - at)] = (p, run)
                    if run + q - 1 >= min(MIN_RUN, len(self.coded[i])):
                        found[i] = "run"
            for i, ps in seen.items():
                n = len(self.coded[i])
                k = changes(n)
                if i not in found and k and len(set(ps)) >= n - q + 1 - k * q and self.whole(i, code, ps) <= k:
                    found[i] = "whole"
        return sorted(found.items())

    def whole(self, i: int, code: np.ndarray, ps: list[int]) -> int:
        """The least word edit distance of the whole item to any stretch around the hits."""
        n = len(self.coded[i])
        best, ps = n, sorted(set(ps))
        at = 0
        while at < len(ps):  # one stretch per cluster of hits
            end = at
            while end + 1 < len(ps) and ps[end + 1] - ps[end] <= n:
                end += 1
            window = code[max(0, ps[at] - n - N) : ps[end] + n + 2 * N]
            best = min(best, self._semi(i, window.tolist()))
            at = end + 1
        return best

    def _semi(self, i: int, text: list[int]) -> int:
        masks, n = self.masks[i], len(self.coded[i])
        full, top = (1 << n) - 1, 1 << (n - 1)
        pv, mv, score, best = full, 0, n, n
        for c in text:
            eq = masks.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv)
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph <<= 1  # a stretch may begin anywhere
            mh <<= 1
            pv = (mh | ~(xv | ph)) & full
            mv = ph & xv & full
            best = min(best, score)
        return best


def _batches(items: list[tuple[int, str]]):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(items)
        for pdf in it:
            out = [(d, i, kind) for d, text in zip(pdf["doc_id"], pdf["text"], strict=True) if text for i, kind in matcher.match(text)]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "kind"]).astype({"doc_id": "int64", "item_id": "int64", "kind": "object"})

    return run


def leaks(documents: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`(doc_id, item_id, kind)` of every document that contains an item, in part (`run`) or as a changed whole (`whole`)."""
    items = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    texts = documents.where("text is not null and doc_id is not null").select("doc_id", "text")
    parts = []
    for b in range(blocks):
        rows = sorted((r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect())
        parts.append(texts.mapInPandas(_batches(rows), "doc_id bigint, item_id bigint, kind string"))
    return reduce(DataFrame.unionByName, parts).distinct()


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(documents, items).select("doc_id", "item_id").distinct()


def report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Which items leaked: (suite, item_id, n_documents), items without a leak included."""
    n = leaks(documents, items).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n"))
    return items.select("suite", "item_id").distinct().join(n, "item_id", "left").select("suite", "item_id", F.coalesce("n", F.lit(0)).alias("n_documents"))


def clean(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without those that leak (anti-join on the document id)."""
    return documents.join(leaks(documents, items).select("doc_id").distinct(), "doc_id", "left_anti")
