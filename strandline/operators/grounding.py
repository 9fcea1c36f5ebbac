"""Free text to vocabulary identifiers: lexicons with first-writer priority, exact cascades, fuzzy residual."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.fuzzy import token_set_ratio, token_sort_ratio, weighted_ratio
from ..functions.text import gene_clean, key, omim_in_text, strip_stereo, text_variants

#: Tables estimated at most so large are sent to every executor; larger ones are joined.
BROADCAST_BYTES = 32 << 20
#: A fuzzy search holds its lexicon in every worker; larger ones are searched in shards of so many rows.
SHARD_ROWS = 200_000
SCORERS = {"token_set": token_set_ratio, "weighted": weighted_ratio}


def lexicon(entries: DataFrame, vocabulary: str, order: list[Column]) -> DataFrame:
    """`entries(name, id, label, …)` → one row per key; the first in `order` wins."""
    cols = [c for c in entries.columns if c != "name"]
    e = entries.withColumn("key", key(F.col("name"), vocabulary)).where("key <> ''")
    return e.groupBy("key").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("v")).select("key", "v.*")


def small(df: DataFrame, size: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint where the optimiser's estimate of its size (no job is run) allows it; the other joins are left to
    adaptive execution, which knows the real size."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if estimate <= size else df


def ground_analytes(texts: DataFrame, lex: DataFrame, col: str = "text") -> DataFrame:
    """Exact tiers over distinct texts: whole text .95, its variants .9, stereo-stripped form .85.

    `(text, label, confidence, method)`; rows without a match are kept with nulls.
    """
    loose = lex.withColumn("loose", key(strip_stereo(F.col("label")), "analyte")).where("loose <> key").groupBy("loose").agg(F.min("label").alias("loose_label"))
    d = texts.select(F.col(col).alias("text")).where(F.col(col).isNotNull()).distinct()
    v = d.select("text", F.posexplode(text_variants(F.col("text"))).alias("i", "variant")).withColumn("key", key(F.col("variant"), "analyte")).where("key <> ''")
    exact = v.join(small(lex.select("key", "label")), "key").groupBy("text").agg(F.min(F.struct("i", (F.col("variant") == F.col("text")).alias("same"), "label")).alias("b"))
    exact = exact.select("text", F.col("b.label").alias("exact_label"), F.when(F.col("b.same"), 0.95).otherwise(0.9).alias("exact_conf"))
    stripped = d.withColumn("loose", key(strip_stereo(F.regexp_replace("text", r"\(.*?\)", " ")), "analyte")).join(small(loose), "loose").select("text", "loose_label")
    out = d.join(exact, "text", "left").join(stripped, "text", "left")
    return out.select("text", F.coalesce("exact_label", "loose_label").alias("label"), F.when(F.col("exact_label").isNotNull(), F.col("exact_conf")).when(F.col("loose_label").isNotNull(), 0.85).alias("confidence"), F.when(F.col("exact_label").isNotNull(), "exact").when(F.col("loose_label").isNotNull(), "stereo-stripped").alias("method"))


def ground_diseases(texts: DataFrame, aliases: DataFrame, col: str = "text") -> DataFrame:
    """Number in the text .9, then alias .95. `aliases(alias, omim)`; `(text, omim, confidence, method)`."""
    d = texts.select(F.col(col).alias("text")).where(F.col(col).isNotNull()).distinct()
    known = aliases.select(F.col("omim").alias("known")).distinct()
    lex = lexicon(aliases.select(F.col("alias").alias("name"), "omim"), "disease", [F.col("omim")])
    x = d.withColumns({"given": F.concat(F.lit("OMIM:"), omim_in_text(F.col("text"))), "key": key(F.regexp_replace("text", r"\((?:OMIM|MIM|ORPHA)[^)]*\)", ""), "disease")})
    x = x.join(small(known), F.col("given") == F.col("known"), "left").join(small(lex), "key", "left")
    return x.select("text", F.coalesce("known", "omim").alias("omim"), F.when(F.col("known").isNotNull(), 0.9).when(F.col("omim").isNotNull(), 0.95).alias("confidence"), F.when(F.col("known").isNotNull(), "omim-in-text").when(F.col("omim").isNotNull(), "alias").alias("method"))


def ground_genes(symbols: DataFrame, genes: DataFrame, col: str = "symbol") -> DataFrame:
    """Exact .98, upper case .95, alias .9. `genes(symbol, hgnc_id, aliases array)`; one row per distinct symbol."""
    d = symbols.select(F.col(col).alias("text")).where(F.col(col).isNotNull()).distinct().withColumn("clean", gene_clean(F.col("text")))
    g = genes.groupBy(F.col("symbol").alias("gene")).agg(F.min("hgnc_id").alias("hgnc_id"))
    alias = genes.select("symbol", F.explode_outer("aliases").alias("alias")).where("alias is not null").join(g.select(F.col("gene").alias("alias")), "alias", "left_anti").groupBy("alias").agg(F.min("symbol").alias("of"))
    x = d.join(small(g.select(F.col("gene").alias("exact"))), F.col("clean") == F.col("exact"), "left").join(small(g.select(F.col("gene").alias("upper"))), F.upper("clean") == F.col("upper"), "left").join(small(alias), F.col("clean") == F.col("alias"), "left")
    x = x.withColumn("gene", F.coalesce("exact", "upper", "of"))
    x = x.join(small(g), "gene", "left")
    conf = F.when(F.col("exact").isNotNull(), 0.98).when(F.col("upper").isNotNull(), 0.95).when(F.col("of").isNotNull(), 0.9)
    return x.select("text", "gene", "hgnc_id", conf.alias("confidence"))


class _Bound:
    """Which names may reach a score at all: those with a word in common, and those whose letters in common allow it (a proven
    upper bound of both scorers), for all names at once."""

    def __init__(self, names: list[str], scorer: str):
        letters = sorted({c for n in names for c in n})
        self.column = {c: i for i, c in enumerate(letters)}
        self.counts = np.zeros((len(names), len(letters)), dtype=np.int16)
        self.words: dict[str, list[int]] = {}
        for i, n in enumerate(names):
            for c in n:
                self.counts[i, self.column[c]] += 1
            for w in set(n.split()):
                self.words.setdefault(w, []).append(i)
        self.length = np.array([len(n) for n in names])
        self.partial = scorer == "weighted"

    def possible(self, k: str, cutoff: float) -> list[int]:
        mine = np.zeros(len(self.column), dtype=np.int16)
        for c in k:
            if c in self.column:
                mine[self.column[c]] += 1
        used = np.flatnonzero(mine)
        common = np.minimum(self.counts[:, used], mine[used]).sum(axis=1)
        most = 200.0 * common / (self.length + len(k))
        if self.partial:
            most = np.maximum(most, 100.0 * common / np.maximum(np.minimum(self.length, len(k)), 1))
        good = most >= cutoff - 1e-9
        for w in set(k.split()):
            good[self.words.get(w, [])] = True
        return np.flatnonzero(good).tolist()


def _candidates(names: list[tuple[str, str]], scorer: str, cutoff: float, top: int):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score, bound = SCORERS[scorer], _Bound([n for n, _ in names], scorer)

        @lru_cache(maxsize=100_000)
        def best(k: str) -> list[tuple]:
            hits = []
            for n in bound.possible(k, cutoff):
                name, label = names[n]
                s = score(k, name, cutoff) if score is weighted_ratio else score(k, name)
                if s >= cutoff:
                    hits.append((-s, n, name, label))
            return [(rank, name, label, round(-s / 100, 3), round(token_sort_ratio(k, name) / 100, 3)) for rank, (s, _, name, label) in enumerate(sorted(hits)[:top], 1)]

        for pdf in it:
            out = [(text, *hit) for text, k in zip(pdf["text"], pdf["key"], strict=True) for hit in best(k)]
            yield pd.DataFrame(out, columns=["text", "rank", "name", "label", "score", "strict"]).astype({"rank": "int32"})

    return run


def fuzzy(texts: DataFrame, lex: DataFrame, vocabulary: str, scorer: str = "token_set", cutoff: float = 70.0, accept: float = 0.93, margin: float = 0.05, top: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Candidates for texts that no exact tier knows, against a small lexicon `(key, label)`: `(text, rank, name, label,
    score, strict, accepted)`. The first is accepted if its order-sensitive ratio is high and it leads by the margin or the
    second has the same label."""
    d = texts.select("text").where("text is not null").distinct().withColumn("key", key(F.col("text"), vocabulary)).where("key <> ''").repartition(texts.sparkSession.sparkContext.defaultParallelism, "key")
    rows = lex.select("key", "label").where("key is not null").distinct()
    shards = -(-rows.count() // shard_rows) or 1
    part = lambda i: sorted((r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("key"), F.lit(shards)) == i).collect())
    schema = "text string, rank int, name string, label string, score double, strict double"
    c = reduce(DataFrame.unionByName, (d.mapInPandas(_candidates(part(i), scorer, cutoff, top), schema) for i in range(shards)))
    if shards > 1:  # the best of all shards, in the order one list would give
        best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "name", "label", "score", "strict"))), 1, top)
        c = c.groupBy("text").agg(best.alias("b")).select("text", F.posexplode("b").alias("rank", "b")).select("text", (F.col("rank") + 1).alias("rank"), "b.name", "b.label", "b.score", "b.strict")
    second = c.where("rank = 2").select("text", F.col("score").alias("score2"), F.col("label").alias("label2"))
    measure = F.col("strict") if scorer == "token_set" else F.col("score")
    ok = (F.col("rank") == 1) & (measure >= accept) & (F.col("score2").isNull() | (F.col("score") - F.col("score2") >= margin) | (F.col("label2") == F.col("label")))
    return c.join(second, "text", "left").withColumn("accepted", ok).drop("score2", "label2")


# -- whole cascades: one row per distinct text with its status, confidence, method and candidates ---------------------
CANDIDATES = "array<struct<id:string,label:string,score:double>>"


@F.pandas_udf(T.DoubleType())
def _set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs: dict[tuple, float] = {}
    for p in zip(a, b, strict=True):
        if p not in pairs:
            pairs[p] = token_set_ratio(p[0] or "", p[1] or "")
    return pd.Series([pairs[p] for p in zip(a, b, strict=True)], dtype="float64")


def _hits(rest: DataFrame, names: DataFrame, vocabulary: str, scorer: str, cutoff: float, accept: float, margin: float) -> DataFrame:
    """Fuzzy candidates of `rest(text)` among `names(key, id, label)`: (text, candidates, hit): `hit` is the accepted one."""
    c = fuzzy(rest.select("text"), names.select("key", F.col("id").alias("label")), vocabulary, scorer, cutoff, accept, margin)
    c = c.join(small(names.groupBy("id").agg(F.min("label").alias("named"))), F.col("label") == F.col("id"))
    conf = F.round((F.col("strict") if scorer == "token_set" else F.col("score")) * 0.9, 3)
    row = F.struct("rank", F.struct("id", F.col("named").alias("label"), "score").alias("c"))
    return c.groupBy("text").agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["c"]).alias("candidates"), F.max(F.when(F.col("accepted"), F.struct("id", F.col("named").alias("label"), conf.alias("confidence")))).alias("hit"))


def _result(x: DataFrame, keys: list[str], tiers: list[tuple[Column, Column, Column, Column, str]]) -> DataFrame:
    """The first tier that applies: (condition, id, label, confidence, method)."""
    pick = [F.when(cond, F.struct(i.alias("id"), lb.alias("label"), c.cast("double").alias("confidence"), F.lit(m).alias("method"))) for cond, i, lb, c, m in tiers]
    return x.withColumn("t", F.coalesce(*pick))


def _cascade(settled: DataFrame, keys: list[str], fuzzy_names: DataFrame | None, vocabulary: str, scorer: str, cutoff: float, accept: float, margin: float, last: Column | None) -> DataFrame:
    """Rows with a tier as they are; the rest through the fuzzy tier (if `fuzzy_names` is given), then `last`."""
    none = F.array().cast(CANDIDATES)
    done = settled.where("t is not null").select(*keys, "t.id", "t.label", F.lit("grounded").alias("status"), "t.confidence", "t.method", none.alias("candidates"))
    rest = settled.where("t is null")
    if fuzzy_names is not None:
        rest = rest.join(_hits(rest, fuzzy_names, vocabulary, scorer, cutoff, accept, margin), "text", "left")
    else:
        rest = rest.withColumns({"candidates": none, "hit": F.lit(None).cast("struct<id:string,label:string,confidence:double>")})
    cands = F.coalesce("candidates", none)
    last = last if last is not None else F.lit(None).cast("struct<id:string,label:string,confidence:double,method:string>")
    got = F.coalesce(F.when(F.col("hit").isNotNull(), F.struct("hit.id", "hit.label", "hit.confidence", F.lit("fuzzy").alias("method"))), last)
    rest = rest.withColumn("got", got)
    status = F.when(F.col("hit").isNotNull(), "grounded").when(F.col("got").isNotNull() | (F.size(cands) > 0), "candidate").otherwise("unresolved")
    rest = rest.select(*keys, "got.id", "got.label", status.alias("status"), "got.confidence", F.coalesce("got.method", F.lit("fuzzy")).alias("method"), cands.alias("candidates"))
    return done.unionByName(rest)


def ground_phenotypes(texts: DataFrame, names: DataFrame, fuzzy_tier: bool = True) -> DataFrame:
    """`texts(text, supplied)` against `names(name, id, label, prio)` (0 label, 1 exact synonym, 2 other): a supplied id whose
    label agrees (.95 or .85), the exact name .95, a synonym .85, an accepted fuzzy one, the supplied id as a candidate .5.
    """
    lex = lambda cond: lexicon(names.where(cond).select("name", "id", "label", "prio"), "phenotype", [F.col("prio"), F.col("id")])
    exact, related = lex("prio < 2"), lex("prio = 2")
    labels = names.where("prio = 0").groupBy(F.col("id").alias("supplied")).agg(F.min("label").alias("said"))
    d = texts.select("text", "supplied").where("text is not null").distinct().withColumn("key", key(F.col("text"), "phenotype"))
    x = d.join(small(exact.select("key", F.col("id").alias("id1"), F.col("label").alias("label1"))), "key", "left").join(small(related.select("key", F.col("id").alias("id2"), F.col("label").alias("label2"))), "key", "left")
    x = x.join(small(labels), "supplied", "left").withColumn("said_key", key(F.col("said"), "phenotype"))
    same, other = x.where("said is null or said_key = key"), x.where("said is not null and said_key <> key")
    x = same.withColumn("sim", F.when(F.col("said").isNotNull(), 100.0)).unionByName(other.withColumn("sim", _set_ratio("key", "said_key")))
    agrees = F.col("said").isNotNull() & (F.coalesce(F.col("id1") == F.col("supplied"), F.lit(False)) | (F.col("sim") >= 80))
    x = _result(x, ["text"], [
        (agrees, F.col("supplied"), F.col("said"), F.when(F.col("sim") >= 90, 0.95).otherwise(0.85), "supplied+verified"),
        (F.col("id1").isNotNull(), F.col("id1"), F.col("label1"), F.lit(0.95), "exact"), (F.col("id2").isNotNull(), F.col("id2"), F.col("label2"), F.lit(0.85), "synonym"),
    ])
    last = F.when(F.col("said").isNotNull(), F.struct(F.col("supplied").alias("id"), F.col("said").alias("label"), F.lit(0.5).alias("confidence"), F.lit("supplied-unverified").alias("method")))
    fz = exact.select("key", "id", "label").unionByName(related.join(exact, "key", "left_anti").select("key", "id", "label")) if fuzzy_tier else None
    return _cascade(x, ["text", "supplied"], fz, "phenotype", "token_set", 70.0, 0.93, 0.05, last)


def ground_disease_names(texts: DataFrame, names: DataFrame, xrefs: DataFrame, aliases: DataFrame, fuzzy_tier: bool = True) -> DataFrame:
    """`texts(text, mondo, omim, orphanet)` (the last three as supplied, may be null) against an ontology: `names(name, id, label,
    prio)`, `xrefs(id, xref)` and curated `aliases(alias, omim)`.

    Supplied identifiers that resolve and whose label agrees .9; a number in the text .9; alias → number → id .95; exact .95;
    an accepted fuzzy name; else the text itself stays as label with what was supplied. `(text, mondo, omim, orphanet, id,
    label, status, confidence, method, candidates, id_omim, id_orphanet)`.
    """
    exact = lexicon(names.where("prio < 2").select("name", "id", "label", "prio"), "disease", [F.col("prio"), F.col("id")])
    by_xref = xrefs.groupBy("xref").agg(F.min("id").alias("id"))
    labels = names.where("prio = 0").groupBy("id").agg(F.min("label").alias("label"))
    alias = lexicon(aliases.select(F.col("alias").alias("name"), "omim"), "disease", [F.col("omim")]).join(by_xref, F.col("omim") == F.col("xref")).select("key", F.col("id").alias("alias_id"))
    keys = ["text", "mondo", "omim", "orphanet"]
    d = texts.select(*keys).where("text is not null").distinct()
    d = d.withColumns({"key": key(F.regexp_replace("text", r"\((?:OMIM|MIM|ORPHA)[^)]*\)", ""), "disease"), "given": F.concat(F.lit("OMIM:"), omim_in_text(F.col("text"))), "own": key(F.col("text"), "disease")})

    def resolve(x: DataFrame, col: str, out: str) -> DataFrame:
        return x.join(small(by_xref.select(F.col("xref").alias(col), F.col("id").alias(out))), col, "left")

    x = resolve(resolve(resolve(d, "omim", "by_omim"), "orphanet", "by_orphanet"), "given", "by_text").withColumn("by_mondo", F.col("mondo"))
    x = x.join(small(alias), "key", "left").join(small(exact.select("key", F.col("id").alias("exact_id"))), "key", "left")
    tiers = []
    for name in ("mondo", "omim", "orphanet"):
        x = x.join(small(labels.select(F.col("id").alias(f"by_{name}"), F.col("label").alias(f"said_{name}"))), f"by_{name}", "left")
        agree = F.when(F.col(f"said_{name}").isNotNull(), _set_ratio("own", key(F.col(f"said_{name}"), "disease")))
        x = x.withColumn(f"sim_{name}", agree)
        tiers.append((F.coalesce(F.col(f"sim_{name}") >= 60, F.lit(False)), F.col(f"by_{name}"), F.lit(None).cast("string"), F.lit(0.9), f"supplied {name}"))
    tiers += [(F.col(c).isNotNull(), F.col(c), F.lit(None).cast("string"), F.lit(conf), m) for c, conf, m in (("by_text", 0.9, "omim-in-text"), ("alias_id", 0.95, "alias"), ("exact_id", 0.95, "exact"))]
    g = _cascade(_result(x, keys, tiers), keys, exact.select("key", "id", "label") if fuzzy_tier else None, "disease", "token_set", 75.0, 0.97, 0.03, None).drop("label")
    first = lambda p: F.min(F.when(F.startswith("xref", F.lit(p)), F.col("xref")))
    facts = labels.join(xrefs.groupBy("id").agg(first("OMIM:").alias("id_omim"), first("Orphanet:").alias("id_orphanet")), "id", "left")
    g = g.join(small(facts), "id", "left")
    return g.select(*keys, "id", F.coalesce("label", "text").alias("label"), "status", "confidence", "method", "candidates", F.when(F.col("id").isNotNull(), F.col("id_omim")).otherwise(F.col("omim")).alias("id_omim"), F.when(F.col("id").isNotNull(), F.col("id_orphanet")).otherwise(F.col("orphanet")).alias("id_orphanet"))


def ground_analyte_names(texts: DataFrame, entries: DataFrame, fuzzy_tier: bool = True) -> DataFrame:
    """Analytes through all tiers: `texts(text, chebi)` against `entries(label, synonyms array, chebi, vmh)` → `(text, supplied,
    label, chebi, vmh, status, confidence, method, candidates)`; a supplied identifier stays where the entry has none."""
    names = entries.select("label", F.posexplode(F.concat(F.array("label"), F.coalesce("synonyms", F.array().cast("array<string>")))).alias("i", "name"))
    lex = lexicon(names, "analyte", [F.col("label"), F.col("i")]).select("key", "label")
    d = texts.select("text", F.col("chebi").alias("supplied")).where("text is not null").distinct()
    x = d.join(ground_analytes(d, lex), "text")
    x = x.withColumn("t", F.when(F.col("label").isNotNull(), F.struct(F.col("label").alias("id"), "label", "confidence", "method"))).drop("label", "confidence", "method")
    fz = lex.select("key", F.col("label").alias("id"), "label") if fuzzy_tier else None
    g = _cascade(x, ["text", "supplied"], fz, "analyte", "weighted", 80.0, 0.95, 0.05, None)
    ids = entries.groupBy("label").agg(F.min("chebi").alias("chebi"), F.min("vmh").alias("vmh"))
    return g.drop("id").join(small(ids), "label", "left").select("text", "supplied", "label", F.coalesce("chebi", "supplied").alias("chebi"), "vmh", "status", "confidence", "method", "candidates")
