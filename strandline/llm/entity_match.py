"""Problem 5: the same person described in different papers, matched without a key.

Per reported variant a record gets one fixed 160-bit vector: q-grams of the variant's normal form (gene and codon, whatever
the notation; four bits each, so another gene or codon is far away), two overlapping birth-year tokens and the sex (one bit
each). What papers on one person disagree about costs little: neighbouring birth years two bits, an unstated birth year two, an
unstated sex one. All pairs of vectors within Hamming distance `RADIUS` are found exactly by multi-index hashing: cut into five
32-bit words, two vectors within distance 4 agree in at least one word, so an equi-join on (word number, word, birth-year cell)
meets every such pair; a pair is kept only at its first common word. Cells of three years, entered with their neighbours on one
side, keep the buckets of common variants small: records whose stated birth years lie two cells or more apart (over three years)
are not met, they are different people by definition; unknown years meet everything.

Variants, sex, birth year, country of care, authors, diagnoses and phenotypes are compared as Dice coefficients of their bit
vectors. A first score weighs them by field (`WEIGHTS`); expectation maximisation over the counts of all candidate pairs per
pattern of Dice levels turns it into confidences: per field and level it estimates how often pairs of one person and of
different people show it (latent classes, no labels), and a pair's confidence is the posterior of the first. An unstated field
says nothing. Two descriptions are counted once however often they are repeated word for word, and a description against its own
repeat not at all: repeats would otherwise become the class of one person, and people described anew the other. The patterns are at most (`LEVELS` + 1) to the number of fields, whatever the number of pairs.

`found` keeps pairs by their confidence; an exact check follows: no different stated sex, birth years (publication year less
age at last follow-up) at most two apart. A different country only lowers the confidence. Author lists are read whole.

Cases: repeats of a record count once; records without readable variant have no partner; null parts (sex, age, year, country,
authors) neither support nor contradict; null elements of arrays are skipped; records of one pmid are never paired; several
catalogue rows of one pmid count as the latest; with fewer than `LEAST_PAIRS` candidate pairs of different descriptions the first score itself is
the confidence; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.lookalike import fold, strip_accents
from ..session import materialise

RADIUS, WORDS = 4, 5
BITS = 32 * WORDS
CELL_YEARS = 3
MAX_YEARS = 2.0
LEAST_PAIRS, LEVELS, ROUNDS = 50, 4, 60
CONFIDENT = 0.5
# Where the estimation starts: what two descriptions of one person must share weighs most, free-typed lists weigh little.
WEIGHTS = {"variants": 0.2, "sexes": 0.3, "born": 0.3, "country": 0.1, "authors": 0.05, "diagnoses": 0.03, "phenotypes": 0.02}
LONGS = {"variants": 3, "sexes": 1, "born": 2, "country": 1, "authors": 8, "diagnoses": 4, "phenotypes": 4}

# Three-letter to one-letter amino acids.
AMINO = {"ala": "A", "arg": "R", "asn": "N", "asp": "D", "cys": "C", "gln": "Q", "glu": "E", "gly": "G", "his": "H", "ile": "I", "leu": "L", "lys": "K", "met": "M", "phe": "F", "pro": "P", "ser": "S", "thr": "T", "trp": "W", "tyr": "Y", "val": "V", "ter": "*", "stop": "*"}
_CODING = re.compile(r"(\d+)\s*([ACGT])\s*(?:>|-|→)\s*([ACGT])(?![A-Za-z])")
_PROTEIN = re.compile(r"(?<![A-Za-z0-9])([A-Z][a-z]{2}|[A-Z])(\d+)([A-Z][a-z]{2}|[A-Z*]|fs|del|dup)(?![a-z0-9])")
_GENE = re.compile(r"^\s*([A-Z][A-Z0-9-]{1,9})(?=\s)")


def normal_variants(gene: str | None, c: str | None, p: str | None, text: str | None) -> list[str]:
    """`GENE:codon` forms of one finding; substitutions of coding bases and of amino acids meet at the codon."""
    g = fold(gene or "").strip().upper()
    if not g and text and (m := _GENE.match(fold(text))):
        g = m[1]
    if not g:
        return []
    out = set()
    for t in (c, p, text):
        if not t:
            continue
        t = fold(t)
        out |= {f"{g}:{(int(n) + 2) // 3}" for n, _, _ in _CODING.findall(t)}
        for a, n, b in _PROTEIN.findall(t):
            if (len(a) == 1 or a.lower() in AMINO) and (len(b) < 3 or b.lower() in AMINO or b in ("del", "dup")) and f"{a}{n}{b}".upper() != g:
                out.add(f"{g}:{int(n)}")
        if not out and t is not p:  # other notations (deletions, splice sites): the position string itself
            if m := re.search(r"[cg]\.\s*([\d_+*-]+\s*(?:del|dup|ins)[A-Z]*|\d+[+-]\d+\s*[ACGT]\s*>\s*[ACGT])", t):
                out.add(f"{g}:{re.sub(r'\s+', '', m[1]).lower()}")
    return sorted(out)


def _bits(grams: set[str], size: int, hashes: int) -> int:
    v = 0
    for gram in grams:
        h = int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=16).digest(), "little")
        for _ in range(hashes):
            v |= 1 << (h % size)
            h //= size
    return v


def _grams(text: str, q: int = 2) -> set[str]:
    t = f"^{text}$"
    return {t[i : i + q] for i in range(len(t) - q + 1)}


def _longs(v: int, size: int) -> list[int]:
    out = []
    for i in range(size // 64):
        x = (v >> (64 * i)) & (2**64 - 1)
        out.append(x - 2**64 if x >= 2**63 else x)
    return out


def variant_bits(v: str) -> int:
    return _bits(_grams(v, 2) | _grams(v, 3), BITS, 4)


def identity_vector(variant: str, sex: str | None, birth: float | None) -> int:
    """The vector that is searched: one variant with the person's sex and birth year."""
    tokens = {f"sex {sex}"} if sex else set()
    if birth is not None:
        cell = math.floor((birth + 1e-6) / MAX_YEARS)
        tokens |= {f"born {cell}", f"born {cell + 1}"}
    return variant_bits(variant) | _bits(tokens, BITS, 1)


def birth_bits(birth: float) -> int:
    """The five half-years around a birth; years 64 apart share a bit."""
    return sum(1 << ((math.floor(2 * birth) + i) % 128) for i in range(-2, 3))


def field_vector(texts: list[str], size: int, hashes: int = 2) -> list[int] | None:
    grams: set[str] = set()
    for t in texts:
        if k := re.sub(r"[^a-z0-9]+", " ", strip_accents(fold(t)).lower()).strip():
            grams |= _grams(k, 3)
    return _longs(_bits(grams, size, hashes), size) if grams else None


_AGE = re.compile(r"^P(?:(\d+(?:\.\d+)?)Y)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)W)?(?:(\d+(?:\.\d+)?)D)?(?:T.*)?$")


def age_years(iso: str | None) -> float | None:
    if not iso or not (m := _AGE.match(iso.strip())) or not any(m.groups()):
        return None
    y, mo, w, d = (float(x or 0) for x in m.groups())
    return y + mo / 12 + w * 7 / 365.25 + d / 365.25


_ENCODED = "record_id string, pmid string, sex string, birth double, words array<array<int>>, variants array<bigint>, sexes array<bigint>, born array<bigint>, country array<bigint>, authors array<bigint>, diagnoses array<bigint>, phenotypes array<bigint>"


def _words(v: int) -> list[int]:
    return [x - 2**32 if x >= 2**31 else x for x in ((v >> (32 * i)) & (2**32 - 1) for i in range(WORDS))]


def _encode(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        out = []
        for r in pdf.itertuples(index=False):
            forms = sorted({v for g in (r.findings if r.findings is not None else []) if g is not None for v in normal_variants(g["g"], g["c"], g["p"], g["t"])})
            if not forms:
                continue
            sex = (r.sex or "").strip().upper()
            sex = sex if sex in ("MALE", "FEMALE") else None
            age, year = age_years(r.age), r.pub_year
            birth = float(year) - age if age is not None and year is not None and year == year else None
            every = 0
            for v in forms:
                every |= variant_bits(v)
            texts = lambda x: [t for t in x if t] if x is not None else []
            out.append((
                r.record_id, r.pmid, sex, birth, [_words(identity_vector(v, sex, birth)) for v in forms], _longs(every, 192), _longs(1 if sex == "MALE" else 2, 64) if sex else None, None if birth is None else _longs(birth_bits(birth), 128),
                field_vector([r.country] if r.country else [], 64), field_vector(texts(r.authors), 512, 1), field_vector(texts(r.diagnoses), 256, 1), field_vector(texts(r.phenotypes), 256, 1),
            ))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _ENCODED.split(", ")])


def encode(individuals: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per record with variants: bit vectors of its fields."""
    papers = documents.where("pmid is not null").groupBy("pmid").agg(F.max_by("pub_year", "added_at").alias("pub_year"), F.max_by("authors", "added_at").alias("authors"))
    text = lambda path, name: F.transform(F.filter(path, lambda x: x.isNotNull()), lambda x: x[name])
    one = individuals.where("record_id is not null").select(
        "record_id", "pmid", F.col("record.subject.sex").alias("sex"), F.col("record.subject.age_at_last_followup.iso8601").alias("age"), F.col("record.subject.country_of_care").alias("country"),
        F.transform(F.filter("record.genetic_findings", lambda x: x.isNotNull()), lambda x: F.struct(x["gene_symbol"].alias("g"), x["variant_hgvs_c"].alias("c"), x["variant_hgvs_p"].alias("p"), x["variant_text"].alias("t"))).alias("findings"),
        text("record.diagnoses", "disease_text").alias("diagnoses"), text("record.phenotypes", "text").alias("phenotypes"),
    ).where("size(findings) > 0").dropDuplicates(["record_id"])
    return one.join(papers, "pmid", "left").mapInPandas(_encode, _ENCODED)


def _cells(left: bool):
    cell = F.floor(F.col("birth") / CELL_YEARS).cast("string")
    near = lambda k: F.floor(F.col("birth") / CELL_YEARS + k).cast("string")
    if left:
        return F.when(F.col("birth").isNotNull(), F.array(near(-1), cell, near(1), F.lit("?"))).otherwise(F.array(F.lit("*")))
    return F.when(F.col("birth").isNotNull(), F.array(cell, F.lit("*"))).otherwise(F.array(F.lit("?"), F.lit("*")))


def close_pairs(encoded: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(record_a, record_b, distance): records of different pmids with two variant vectors within the radius, exactly."""
    if radius >= WORDS:
        raise ValueError(f"multi-index hashing over {WORDS} words is exact up to distance {WORDS - 1}")
    rows = encoded.select("record_id", "pmid", "birth", F.explode("words").alias("w"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(WORDS - 1)))).withColumn("word", F.col("w")[F.col("k")])
    a = rows.withColumn("cell", F.explode(_cells(True))).select("k", "word", "cell", F.col("record_id").alias("record_a"), F.col("pmid").alias("pmid_a"), F.col("w").alias("wa"))
    b = rows.withColumn("cell", F.explode(_cells(False))).select("k", "word", "cell", F.col("record_id").alias("record_b"), F.col("pmid").alias("pmid_b"), F.col("w").alias("wb"))
    earlier = " or ".join(f"(k > {i} and wa[{i}] = wb[{i}])" for i in range(WORDS - 1))
    met = a.join(b, ["k", "word", "cell"]).where("record_a < record_b and not (pmid_a <=> pmid_b)").where(f"not ({earlier})")
    met = met.withColumn("distance", sum(F.bit_count(F.col("wa")[i].bitwiseXOR(F.col("wb")[i])) for i in range(WORDS)))
    # bit_count of a negative int counts its 64-bit form: the high half of an xor of ints is all equal bits, taken off here.
    high = sum(F.when(F.col("wa")[i].bitwiseXOR(F.col("wb")[i]) < 0, F.lit(32)).otherwise(F.lit(0)) for i in range(WORDS))
    return met.withColumn("distance", F.col("distance") - high).where(F.col("distance") <= radius).groupBy("record_a", "record_b").agg(F.min("distance").alias("distance"))


def _dice(field: str):
    a, b, longs = F.col(f"{field}_a"), F.col(f"{field}_b"), range(LONGS[field])
    both = sum(F.bit_count(a[i].bitwiseAND(b[i])) for i in longs)
    size = sum(F.bit_count(a[i]) + F.bit_count(b[i]) for i in longs)
    return F.when(a.isNotNull() & b.isNotNull(), 2.0 * both / size)


def score(pairs: DataFrame, encoded: DataFrame) -> DataFrame:
    """Every pair with the Dice coefficient of each field (`d_…`, null if a side is unstated), their weighted mean, what the
    exact check needs: whether the stated sexes agree and the years between the births, and a hash of either description."""
    fields = ["sex", "birth", *WEIGHTS]
    side = lambda s: encoded.select(F.col("record_id").alias(f"record_{s}"), *[F.col(f).alias(f"{f}_{s}") for f in fields], F.xxhash64(*fields).alias(f"described_{s}"))
    x = pairs.join(side("a"), "record_a").join(side("b"), "record_b")
    x = x.withColumns({f"d_{k}": _dice(k) for k in WEIGHTS})
    total = sum(F.when(F.col(f"d_{k}").isNotNull(), F.lit(w)).otherwise(0.0) for k, w in WEIGHTS.items())
    weighted = sum(F.coalesce(F.col(f"d_{k}"), F.lit(0.0)) * w for k, w in WEIGHTS.items())
    return x.select("record_a", "record_b", "distance", *[f"d_{k}" for k in WEIGHTS], (weighted / total).alias("score"), (F.col("sex_a") == F.col("sex_b")).alias("same_sex"), F.abs(F.col("birth_a") - F.col("birth_b")).alias("gap"), "described_a", "described_b")


def estimate(levels: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Expectation maximisation of two latent classes over patterns: `levels` (patterns x fields, -1 for unstated), `n` pairs
    per pattern, `start` the first guess of the share of one person. Returns the prior log-odds and the log-ratio of every
    field and level (0 in the first column, which stands for unstated)."""
    fields = levels.shape[1]
    share, ratio, odds = np.clip(start, 0.01, 0.99), np.zeros((fields, LEVELS + 1)), 0.0
    for _ in range(rounds):
        for f in range(fields):
            same, other = (np.array([(n * w)[levels[:, f] == v].sum() for v in range(LEVELS)]) + 0.5 for w in (share, 1 - share))
            ratio[f, 1:] = np.log(same / same.sum()) - np.log(other / other.sum())
        p = np.clip((n * share).sum() / n.sum(), 1e-6, 1 - 1e-6)
        odds = float(np.log(p / (1 - p)))
        share = 1 / (1 + np.exp(-np.clip(odds + ratio[np.arange(fields), levels + 1].sum(axis=1), -50, 50)))
    return odds, ratio


def match(individuals: DataFrame, documents: DataFrame) -> DataFrame:
    """`(record_a, record_b, distance, d_…, score, same_sex, gap, confidence)` of every close pair."""
    encoded = materialise(encode(individuals, documents), "encoded")
    known = materialise(score(close_pairs(encoded), encoded), "scored-pairs")
    scored = known.drop("described_a", "described_b")
    level = {k: F.coalesce(F.least(F.floor(F.col(f"d_{k}") * LEVELS), F.lit(LEVELS - 1)), F.lit(-1)).cast("int") for k in WEIGHTS}
    # The same two descriptions show the same levels and score wherever they meet.
    both = F.xxhash64(F.least("described_a", "described_b"), F.greatest("described_a", "described_b"))
    once = known.where("described_a <> described_b").groupBy(both.alias("both"), *[v.alias(k) for k, v in level.items()]).agg(F.min("score").alias("score"))
    rows = once.groupBy(*WEIGHTS).agg(F.count("*").alias("n"), F.avg("score").alias("score")).collect()
    if sum(r.n for r in rows) < LEAST_PAIRS:
        return scored.withColumn("confidence", F.col("score"))
    odds, ratio = estimate(np.array([[r[k] for k in WEIGHTS] for r in rows]), np.array([r.n for r in rows], dtype=float), np.array([r.score for r in rows]) ** 4)
    total = sum((F.element_at(F.array(*map(F.lit, ratio[i].tolist())), level[k] + 2) for i, k in enumerate(WEIGHTS)), F.lit(odds))
    return scored.withColumn("confidence", 1 / (1 + F.exp(-total)))


def found(individuals: DataFrame, documents: DataFrame) -> DataFrame:
    """(record_a, record_b) of confident pairs that pass the exact check."""
    m = match(individuals, documents).where(F.col("confidence") >= CONFIDENT)
    return m.where(F.coalesce("same_sex", F.lit(True)) & F.coalesce(F.col("gap") <= MAX_YEARS + 1e-6, F.lit(True))).select("record_a", "record_b")


def confidences(individuals: DataFrame, documents: DataFrame) -> DataFrame:
    """Per twentieth of confidence: candidate pairs, mean vector distance, and how many pairs differ in sex or by over two years."""
    contradicted = F.coalesce(~F.col("same_sex"), F.lit(False)) | F.coalesce(F.col("gap") > MAX_YEARS + 1e-6, F.lit(False))
    m = match(individuals, documents).groupBy((F.round(F.col("confidence") * 20) / 20).alias("confidence"))
    return m.agg(F.count("*").alias("n_pairs"), F.round(F.avg("distance"), 2).alias("mean_distance"), F.count_if(contradicted).alias("n_contradicted"))
