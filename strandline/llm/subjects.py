"""Problem 9: subject areas of documents (term weighting, truncated SVD, seed centroids refined iteratively).

1. Document frequencies of words over all documents, per language and overall (partial counts per Arrow batch, summed in the
   JVM). A word's weight is minus the log of its largest share of documents in any language, so the set phrases of a small
   language weigh as little as those of a large one. The model keeps at most `MAX_TERMS` words.
2. Every document becomes the ids of its known words, sentence by sentence, written once to the shared folder; all later passes
   read these.
3. Truncated SVD by randomised subspace iteration over all documents: each pass multiplies AᵀA by a thin matrix that is held
   by every task; partial products are summed `FAN` at a time in two rounds, so no worker ever holds more than `FAN` of them,
   and the driver adds what is left one by one.
4. Seed centroids per subject and language from the rated documents (two raters, shared among a document's subjects) and the
   subjects' descriptions; then, some times over, every document that is clearly nearest to one centroid moves it.
5. Sentences are embedded likewise; a sentence bears the subject whose nearest centroid's cosine is high and clear enough. A
   document gets every subject that makes up about a fifth or more of its subject-bearing sentences, and at least two of them:
   a single sentence is a passing one, also in a document without another.

Cases: null and empty texts give no row; documents without subject-bearing sentence give none; documents of any length are
read whole; repeated doc ids give distinct (doc_id, subject) rows; labels of unknown documents or subjects are ignored; without
labels the descriptions alone seed the centroids; empty tables give an empty result; null languages form no group of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

MAX_TERMS, MAX_SUBJECTS = 8192, 1000
MIN_DOCS, MIN_SHARE, MAX_SHARE = 5, 5e-4, 0.3
MIN_LANGUAGE = 20
RANK, EXTRA, PASSES, ROUNDS = 64, 10, 3, 4
CLEAR = 0.2
COSINE, MARGIN, LEAST = 0.3, 0.1, 0.15
SHARE, SENTENCES = 0.18, 2
FAN = 32

_PUNCTUATION = ".,;:()[]\"“”„«»!?*#|–—…"
_END = "\x00"


# Rows, headings and footnotes of tables are no sentences.
_TABLE = re.compile(r"^(?:\||#{2,4} Table |Footnotes:).*$", re.M)


def tokens(text: str) -> list[str]:
    """Lower-case words with `_END` between sentences; tables are left out."""
    if "\n|" in text:
        text = _TABLE.sub("", text)
    t = text.lower().replace("\n", f" {_END} ")
    for c in ".!?":
        t = t.replace(f"{c} ", f" {_END} ")
    for c in _PUNCTUATION:
        t = t.replace(c, " ")
    return t.split()


def _word(w: str) -> bool:
    return 2 < len(w) <= 40 and not any(c.isdigit() for c in w) and any(map(str.isalpha, w))


def _counts(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        by: dict[str, Counter] = {}
        for text, lang in zip(pdf["text"], pdf["lang"], strict=True):
            by.setdefault(lang or "", Counter()).update({*tokens(text), ""})  # "" counts the documents
        out = [(lang, w, n) for lang, c in by.items() for w, n in c.items() if w == "" or _word(w)]
        yield pd.DataFrame(out, columns=["lang", "word", "n"])


def weights(docs: DataFrame, max_terms: int = MAX_TERMS) -> tuple[list[str], np.ndarray, list[str]]:
    """(words, weights, languages of their own) from counts over all documents."""
    counts = materialise(docs.mapInPandas(_counts, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    sizes = {r[0]: r[1] for r in counts.where("word = ''").select("lang", "n").collect()}  # one row per language
    total = sum(sizes.values())
    if not total:
        return [], np.zeros(0, dtype=np.float32), []
    langs = sorted(x for x, n in sizes.items() if x and n >= MIN_LANGUAGE)
    size = F.create_map(*[F.lit(v) for x in langs for v in (x, float(sizes[x]))]) if langs else None
    share = F.when(F.col("lang").isin(langs), F.col("n") / size[F.col("lang")]).otherwise(0.0) if langs else F.lit(0.0)
    per = counts.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"), F.max(share).alias("most"))
    per = per.select("word", "n", F.greatest("most", F.col("n") / total).alias("share")).where((F.col("n") >= max(MIN_DOCS, MIN_SHARE * total)) & (F.col("share") <= MAX_SHARE))
    rows = per.orderBy(F.desc("n"), "word").limit(max_terms).collect()
    return [r[0] for r in rows], np.array([-np.log(r[2]) for r in rows], dtype=np.float32), langs


STOP = -2  # ends a sentence among the ids


def _known(words: list[str]):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = ({w: i for i, w in enumerate(words)} | {_END: STOP}).get
        for pdf in it:
            out = []
            for text in pdf["text"]:
                a = np.fromiter((get(w, -1) for w in tokens(text)), dtype=np.int32)
                a = a[a != -1]
                out.append(a[(a != STOP) | np.append(a[1:] != STOP, False)])  # one end per sentence with known words
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang": pdf["lang"], "ids": out})

    return run


def _dense(ids: pd.Series, weight: np.ndarray) -> np.ndarray:
    a = np.zeros((len(ids), len(weight)), dtype=np.float32)
    for n, i in enumerate(ids):
        i = np.asarray(i, dtype=np.int64)
        i = i[i >= 0]
        a[n, i] = weight[i]
    return a / (np.linalg.norm(a, axis=1, keepdims=True) + 1e-9)


def _blocks(it: Iterator[pd.DataFrame], size: int = 512) -> Iterator[pd.DataFrame]:
    for pdf in it:
        for at in range(0, len(pdf), size):
            yield pdf.iloc[at : at + size]


def _summed(rows: DataFrame, part, shape: tuple[int, int], fan: int = FAN) -> np.ndarray:
    """The sum over all tasks of a fixed-size matrix: `part` folds a task's blocks into one. Two rounds add `fan` matrices at a
    time, whatever the number of tasks; the driver reads one partition of the rest after the other."""

    def task(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros(shape, dtype=np.float32)
        for block in _blocks(it):
            total += part(block)
        if total.any():
            yield pd.DataFrame({"g": [TaskContext.get().partitionId() // fan], "m": [total.tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(shape, dtype=np.float64)
        for b in pdf["m"]:
            total += np.frombuffer(b, dtype=np.float32).reshape(shape)
        return pd.DataFrame({"g": [pdf["g"].iloc[0] // fan], "m": [total.astype(np.float32).tobytes()]})

    sums = rows.mapInPandas(task, "g int, m binary")
    for _ in range(2):
        sums = sums.groupBy("g").applyInPandas(add, "g int, m binary")
    out = np.zeros(shape, dtype=np.float64)
    for r in sums.toLocalIterator():
        out += np.frombuffer(r["m"], dtype=np.float32).reshape(shape)
    return out


def decompose(rows: DataFrame, weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors (words x rank) of the weighted, row-normalised document-word matrix."""
    v = len(weight)
    width = min(v, rank + EXTRA)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((v, width)))[0].astype(np.float32)
    y = q
    for _ in range(PASSES):

        def part(block: pd.DataFrame, q: np.ndarray = q) -> np.ndarray:
            a = _dense(block["ids"], weight)
            return a.T @ (a @ q)

        y = _summed(rows, part, (v, width))
        last, q = q, np.linalg.qr(y)[0].astype(np.float32)
    # Rayleigh-Ritz on the last subspace: qᵀ(AᵀA)q, with AᵀA·last already at hand.
    small = last.T.astype(np.float64) @ y
    value, vector = np.linalg.eigh((small + small.T) / 2)
    return (last @ vector[:, np.argsort(-value)[: min(rank, width)]]).astype(np.float32)


def centroids(rows: DataFrame, labels: DataFrame, subjects: list[tuple[str, str]], words: list[str], weight: np.ndarray, langs: list[str], basis: np.ndarray) -> np.ndarray:
    """(languages x subjects, rank) unit vectors, seeded by ratings and descriptions and refined over all documents."""
    names = [s for s, _ in subjects]
    langs = langs or [""]
    k, place = len(names) * len(langs), {x: i for i, x in enumerate(langs)}
    votes = labels.where(F.col("subject").isin(names)).groupBy("doc_id", "subject").agg(F.countDistinct("rater").alias("n"))
    votes = votes.groupBy("doc_id").agg(F.collect_list(F.struct("subject", "n")).alias("votes"))
    rated = rows.join(votes, "doc_id")
    index = {s: i for i, s in enumerate(names)}

    def unit(block: pd.DataFrame) -> np.ndarray:
        e = _dense(block["ids"], weight) @ basis
        return e / (np.linalg.norm(e, axis=1, keepdims=True) + 1e-9)

    def seed(block: pd.DataFrame) -> np.ndarray:
        e, w = unit(block), np.zeros((len(block), k), dtype=np.float32)
        for n, (lang, vs) in enumerate(zip(block["lang"], block["votes"], strict=True)):
            at = place.get(lang or "")
            if at is not None:
                total = sum(x["n"] for x in vs)
                for x in vs:
                    w[n, at * len(names) + index[x["subject"]]] += x["n"] / total
        return w.T @ e

    seeds = _summed(rated, seed, (k, basis.shape[1]))
    ids = {w: i for i, w in enumerate(words)}
    for n, (_, text) in enumerate(subjects):  # the descriptions, one vote each, in the language whose words they use (or the first)
        known = [ids[w] for w in set(tokens(text or "")) if w in ids]
        if known:
            e = weight[known] @ basis[known]
            at = place.get("en", 0)
            seeds[at * len(names) + n] += 0.5 * e / (np.linalg.norm(e) + 1e-9)
    c = _unit_rows(seeds)
    for _ in range(ROUNDS):

        def move(block: pd.DataFrame, c: np.ndarray = c.astype(np.float32)) -> np.ndarray:
            e = unit(block)
            cos = e @ c.T
            for n, lang in enumerate(block["lang"]):  # a document moves centroids of its own language only
                at = place.get(lang or "")
                if at is not None:
                    own = cos[n, at * len(names) : (at + 1) * len(names)].copy()
                    cos[n] = -1
                    cos[n, at * len(names) : (at + 1) * len(names)] = own
            top = np.argmax(cos, axis=1)
            r = np.arange(len(block))
            first = cos[r, top].copy()
            cos[r, top] = -1
            clear = first - cos.max(axis=1, initial=-1.0)
            w = np.zeros((len(block), k), dtype=np.float32)
            w[r, top] = np.where((clear > CLEAR) & (first > COSINE), clear, 0)
            return w.T @ e

        c = _unit_rows(_summed(rows, move, (k, basis.shape[1])) + 0.5 * seeds)
    return c.astype(np.float32)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.where(n > 1e-9, m / np.maximum(n, 1e-9), 0)


def _assign(names: list[str], weight: np.ndarray, basis: np.ndarray, c: np.ndarray):
    terms = (weight[:, None] * basis).astype(np.float32)
    s = len(names)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _blocks(it, 256):
            parts, doc = [], []
            for n, ids in enumerate(pdf["ids"]):
                parts += [np.asarray(ids, dtype=np.int64), np.array([STOP])]
                doc.append(np.full(len(ids) + 1, n))
            a, d = np.concatenate(parts), np.concatenate(doc)
            sentence = np.cumsum(a == STOP)
            keep = a >= 0
            a, d, sentence = a[keep], d[keep], sentence[keep]
            if not len(a):
                continue
            starts = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
            e, owner = np.add.reduceat(terms[a], starts, axis=0), d[starts]
            norm = np.linalg.norm(e, axis=1)
            z = (e @ c.T).reshape(len(e), -1, s).max(axis=1) / np.maximum(norm, 1e-9)[:, None]
            r, top = np.arange(len(z)), np.argmax(z, axis=1)
            first = z[r, top].copy()
            z[r, top] = -1
            good = (norm >= LEAST) & (first >= COSINE) & (first - z.max(axis=1, initial=-1.0) >= MARGIN)
            table = np.zeros((len(pdf), s))
            np.add.at(table, (owner[good], top[good]), 1)
            share = table / np.maximum(table.sum(axis=1, keepdims=True), 1)
            i, j = np.nonzero((share >= SHARE) & (table >= SENTENCES))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[i], "subject": [names[x] for x in j], "share": share[i, j]})

    return run


def assign(documents: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    """`(doc_id, subject, share)` of every document that is about at least one subject."""
    docs = documents.where("text is not null and doc_id is not null").select("doc_id", "text", "lang")
    listed = [(r[0], r[1]) for r in subjects.where("subject is not null").select("subject", "description").distinct().orderBy("subject").limit(MAX_SUBJECTS + 1).collect()]
    if len(listed) > MAX_SUBJECTS:
        raise ValueError(f"more than {MAX_SUBJECTS} subjects; a centroid of each is held by every task")
    words, weight, langs = weights(docs)
    if not words or not listed:
        return docs.select("doc_id", F.lit("").alias("subject"), F.lit(0.0).alias("share")).where("false")
    rows = materialise(docs.mapInPandas(_known(words), "doc_id bigint, lang string, ids array<int>"), "known-words")
    basis = decompose(rows, weight)
    c = centroids(rows, labels, listed, words, weight, langs, basis)
    return rows.select("doc_id", "ids").mapInPandas(_assign([s for s, _ in listed], weight, basis, c), "doc_id bigint, subject string, share double")


def found(documents: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    return assign(documents, subjects, labels).select("doc_id", "subject").distinct()


def composition(documents: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    """The make-up of the corpus: (subject, n_documents, weight), each document's weight shared among its subjects."""
    a = assign(documents, subjects, labels)
    return a.groupBy("subject").agg(F.countDistinct("doc_id").alias("n_documents"), F.round(F.sum("share"), 3).alias("weight"))
