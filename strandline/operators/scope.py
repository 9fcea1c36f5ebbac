"""Ontology scopes: closure over is-a edges, term cleaning, dictionary tagging of texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_term
from ..session import checkpoint

MAX_TERMS = 200_000


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, id, level): everything below each root of `edges(sub, obj)`, the root included, at its smallest level.

    One join per level against what is new only, to any depth; a visited node is not expanded again, so diamonds and cycles end.
    """
    e = edges.select(F.col("obj").alias("id"), F.col("sub").alias("child")).where("id is not null and child is not null").distinct()
    seen = roots.select(F.col("id").alias("root"), "id").distinct().withColumn("level", F.lit(0))
    front = seen
    for level in count(1):
        nxt = front.join(e, "id").select("root", F.col("child").alias("id")).distinct().join(seen.select("root", "id"), ["root", "id"], "left_anti").withColumn("level", F.lit(level))
        nxt = checkpoint(nxt)
        if nxt.isEmpty():
            break
        seen, front = seen.unionByName(nxt), nxt
    return seen


def scope(edges: DataFrame, root: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Ids of a root's subtree without the subtrees of the excluded roots."""
    spark = edges.sparkSession
    inside = descendants(edges, spark.createDataFrame([(root,)], "id string")).select("id")
    if not excluded:
        return inside
    out = descendants(edges, spark.createDataFrame([(x,) for x in excluded], "id string")).select("id")
    return inside.join(out, "id", "left_anti")


def terms(names: DataFrame) -> DataFrame:
    """`names(id, name)` → distinct cleaned lower-case terms `(term, id)`."""
    return names.select(F.lower(clean_term(F.col("name"))).alias("term"), "id").where("term is not null").distinct()


class Dictionary:
    """Terms in any case, found between non-alphanumerics by an automaton over all of them at once."""

    def __init__(self, words: list[str], fold: bool):
        self.fold, self.words = fold, words
        try:
            import ahocorasick
        except ImportError:  # the pattern below finds the same, term by term
            self.automaton, self.rx = None, [(w, re.compile(f"(?={re.escape(w)})")) for w in words]
        else:
            self.automaton = ahocorasick.Automaton() if words else None
            self.rx = []
            for w in words:
                self.automaton.add_word(w, w)
            if words:
                self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, str]]:
        """(start, -length, term) of every bounded occurrence."""
        t = text.lower() if self.fold else text
        if self.automaton is not None:
            spans = ((end + 1 - len(w), end + 1, w) for end, w in self.automaton.iter(t))
        else:
            spans = ((m.start(), m.start() + len(w), w) for w, rx in self.rx for m in rx.finditer(t))
        return [(a, a - b, w) for a, b, w in spans if not (a and _edge(t[a - 1])) and not (b < len(t) and _edge(t[b]))]


def _edge(c: str) -> bool:
    return c.isascii() and c.isalnum()


def kept(hits: list[tuple[int, int, str]]) -> list[str]:
    """From left to right, the longest at each place, not overlapping; distinct and sorted."""
    out, end = set(), 0
    for start, length, w in sorted(hits):
        if start >= end:
            out.add(w)
            end = start - length
    return sorted(out)


_HITS = "array<struct<start:int,length:int,term:string>>"


def _finder(words: list[str], symbols: list[str]):  # noqa: ANN202
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms_, genes = Dictionary(words, True), Dictionary(symbols, False)
        row = lambda hits: [{"start": a, "length": n, "term": w} for a, n, w in hits]
        for pdf in it:
            yield pd.DataFrame({"key": pdf["key"], "t": [row(terms_.find(x)) if x else [] for x in pdf["text"]], "g": [row(genes.find(x)) if x else [] for x in pdf["text"]]})

    return run


def _resolver(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pick = lambda hits: kept([(h["start"], h["length"], h["term"]) for h in hits])
    for pdf in it:
        yield pd.DataFrame({"key": pdf["key"], "genes": [pick(h) for h in pdf["g"]], "terms": [pick(h) for h in pdf["t"]]})


def _tagger(words: dict[str, list[str]], symbols: dict[str, list[str]]):  # noqa: ANN202
    """Finder and resolver in one, for a dictionary that is one shard."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms_, genes = Dictionary(list(words), True), Dictionary(list(symbols), False)
        for pdf in it:
            t = [kept(terms_.find(x)) if x else [] for x in pdf["text"]]
            g = [kept(genes.find(x)) if x else [] for x in pdf["text"]]
            ids = [sorted({i for w in a for i in words[w]} | {i for w in b for i in symbols[w]}) for a, b in zip(t, g, strict=True)]
            yield pd.DataFrame({"key": pdf["key"], "ids": ids, "genes": g, "terms": t})

    return run


def tag(texts: DataFrame, vocabulary: DataFrame, genes: DataFrame | None = None, shard_terms: int = MAX_TERMS) -> DataFrame:
    """`texts(key, text)` tagged with `vocabulary(term, id)` (any case) and `genes(symbol, id)` (exact case).

    Longest terms first, bounded by non-alphanumerics, not overlapping: `(key, ids, genes, terms)`, sorted lists. Dictionaries of
    more than `shard_terms` terms are searched shard by shard; what overlaps is then resolved over the hits of all shards (rows of
    one key count as one text there).
    """
    words = vocabulary.select(F.lower("term").alias("term"), "id").where("term <> '' and id is not null").distinct()
    symbols = genes.select(F.col("symbol").alias("term"), "id").where("term <> '' and id is not null").distinct() if genes is not None else words.where("false")
    shards = max(1, -(-max(x.count() for x in (words, symbols)) // shard_terms))
    kind, texts = texts.schema["key"].dataType.simpleString(), texts.select("key", "text")

    def part(x: DataFrame, i: int) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for r in x.where(F.pmod(F.xxhash64("term"), F.lit(shards)) == i).collect():
            out.setdefault(r[0], []).append(r[1])
        return out

    if shards == 1:
        return texts.mapInPandas(_tagger(part(words, 0), part(symbols, 0)), f"key {kind}, ids array<string>, genes array<string>, terms array<string>")
    found = (texts.mapInPandas(_finder(list(part(words, i)), list(part(symbols, i))), f"key {kind}, t {_HITS}, g {_HITS}") for i in range(shards))
    hits = reduce(DataFrame.unionByName, found).groupBy("key").agg(F.flatten(F.collect_list("t")).alias("t"), F.flatten(F.collect_list("g")).alias("g"))
    tagged = hits.mapInPandas(_resolver, f"key {kind}, genes array<string>, terms array<string>")
    ids = tagged.select("key", F.explode("terms").alias("term")).join(words, "term").unionByName(tagged.select("key", F.explode("genes").alias("term")).join(symbols, "term"))
    return tagged.join(ids.groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("ids")), "key", "left").select("key", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"), "genes", "terms")
