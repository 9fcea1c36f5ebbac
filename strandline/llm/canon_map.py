"""Problem 1: free-entered values mapped to a reference list (BK-tree under a true edit metric).

Every distinct text is read once into comparison keys (in order of preference), and every distinct key is looked up once. The
reference list becomes BK-trees under Levenshtein distance, one per guard (numbers and one-letter prefix, which must agree for a
hit). An equal key wins outright, otherwise the tree returns *every* entry within twice the threshold (a swap of neighbours costs
2 there), the triangle inequality cuts branches, and the hits are ranked by unrestricted Damerau-Levenshtein distance. The list
is sent to the workers in shards of at most `SHARD_BYTES` of spellings, cut by comparison key, one after the other (a short list
is one shard); shard winners merge by distance, then texts take their first reading that hits. Class words are always those of
the whole list. Keys of up to five letters are abbreviations: they match only as they stand (`labtext.is_code`).

Cases: null texts give no row; empty texts, texts of specimen or unit words only, ratios and sums, and values whose nearest
entries tie between different targets map to `(none)`; repeated rows give one row; texts of any length are read whole
(keys longer than the longest entry plus the threshold can't match and are not searched); an empty reference list maps
everything to `(none)`; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import labtext
from ..functions.fuzzy import damerau, levenshtein
from ..session import materialise

NONE = "(none)"
THRESHOLD = 1
SHARD_BYTES = 8 << 20


class BKTree:
    """Entries by their distance to a parent; `search` visits only children whose distance the triangle inequality allows."""

    def __init__(self, keys: list[str] | tuple[str, ...] = ()):
        self.keys: list[str] = []
        self.children: list[dict[int, int]] = []
        for k in keys:
            self.add(k)

    def add(self, k: str) -> None:
        if not self.keys:
            self.keys.append(k)
            self.children.append({})
            return
        at = 0
        while d := levenshtein(k, self.keys[at]):
            nxt = self.children[at].get(d)
            if nxt is None:
                self.children[at][d] = len(self.keys)
                self.keys.append(k)
                self.children.append({})
                return
            at = nxt

    def search(self, k: str, radius: int) -> list[tuple[int, str]]:
        if not self.keys:
            return []
        found, stack = [], [0]
        while stack:
            at = stack.pop()
            d = levenshtein(k, self.keys[at])
            if d <= radius:
                found.append((d, self.keys[at]))
            stack.extend(c for e, c in self.children[at].items() if d - radius <= e <= d + radius)
        return sorted(found)


def entry_core(spelling: str, kind: str) -> str:
    return labtext.parse_disease(spelling)[0] if kind == "disease" else spelling


def guard(core: str) -> str:
    numbers, prefix = labtext.guard(core)
    return "|".join(numbers) + "#" + prefix


class Reader:
    """Typed texts to comparison keys. `words`: the class words of the whole list."""

    def __init__(self, kind: str, words: dict[str, str]):
        self.kind, self.words = kind, words

    def keys(self, text: str) -> list[tuple[str, str]]:
        """(key, guard) of the readings of a text in order of preference; an identifier given in it comes last, as `=id`."""
        if self.kind == "disease":
            core, omim = labtext.parse_disease(text)
            return [(labtext.key(core), guard(core)), *([(f"=OMIM:{omim}", "")] if omim else [])]
        p = labtext.parse_analyte(text)
        if p.composite:
            return []
        cores = [labtext.expand(x, self.words) for x in (p.core, *p.inner)]
        return [(labtext.key(c), guard(c)) for c in cores]


class Mapper:
    """One shard of a reference list, ready to answer. `entries`: (spelling, target) pairs."""

    def __init__(self, entries: list[tuple[str, str]], kind: str, threshold: int = THRESHOLD, words: dict[str, str] | None = None):
        self.threshold = threshold
        if words is None:  # else those of the whole list
            words = labtext.class_words([s for s, _ in entries]) if kind == "analyte" else {}
        self.reader = Reader(kind, words)
        self.targets: dict[str, set[str]] = {}
        guards: dict[str, set[str]] = {}
        for spelling, target in entries:
            core = entry_core(spelling, kind)
            self.targets.setdefault(f"={target}", set()).add(target)
            if k := labtext.key(core):
                self.targets.setdefault(k, set()).add(target)
                guards.setdefault(guard(core), set()).add(k)
        self.trees = {g: BKTree(sorted(ks)) for g, ks in guards.items()}
        self.longest = max((len(k) for k in self.targets if not k.startswith("=")), default=0)

    def near(self, k: str, g: str) -> list[tuple[int, str]]:
        """All targets at the smallest distance within the threshold, as (distance, target)."""
        if k in self.targets:
            return [(0, t) for t in sorted(self.targets[k])]
        if not k or k.startswith("=") or labtext.is_code(k) or len(k) > self.longest + self.threshold or g not in self.trees:
            return []
        hits = [(d, t) for _, e in self.trees[g].search(k, 2 * self.threshold) if not labtext.is_code(e) and (d := damerau(k, e)) <= self.threshold for t in self.targets[e]]
        least = min(hits, default=(0,))[0]
        return sorted({h for h in hits if h[0] == least})

    def best(self, text: str) -> list[tuple[int, str]]:
        """The hits of the first reading that has any."""
        return next((hits for k, g in self.reader.keys(text) if (hits := self.near(k, g))), [])


def _read(kind: str, words: dict[str, str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(kind, words)
        for pdf in it:
            yield pd.DataFrame([(t, rank, *k) for t in pdf["text"] for rank, k in enumerate(reader.keys(t)) if k[0]], columns=["text", "reading", "key", "guard"]).astype({"reading": "int32"})

    return run


def _look_up(entries: list[tuple[str, str]], kind: str, threshold: int, words: dict[str, str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mapper = Mapper(entries, kind, threshold, words)
        for pdf in it:
            yield pd.DataFrame([(k, g, d, t) for k, g in zip(pdf["key"], pdf["guard"], strict=True) for d, t in mapper.near(k, g)], columns=["key", "guard", "distance", "entry"]).astype({"distance": "int32"})

    return run


def _entry_keys(kind: str):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            keys = [labtext.key(entry_core(s, kind)) for s in pdf["spelling"]]
            yield pdf.assign(key=keys, end_word=[labtext.end_word(s) for s in pdf["spelling"]])

    return run


def _class_words(keyed: DataFrame) -> dict[str, str]:
    """`labtext.class_words` of a list that is too long for one task; only the answer reaches the driver."""
    ends = keyed.where("length(end_word) >= 4").groupBy("end_word").agg(F.count("*").alias("n"))
    begun = ends.where("n >= 2").select(F.col("end_word").alias("word"), F.explode(F.expr("transform(sequence(2, length(end_word) - 1), i -> left(end_word, i))")).alias("begin"))
    begun = begun.groupBy("begin").agg(F.count("*").alias("n"), F.first("word").alias("word")).where("n = 1")
    return {r.begin: r.word for r in begun.join(ends, F.col("begin") == F.col("end_word"), "left_anti").select("begin", "word").collect()}


def _shards(entries: DataFrame, kind: str, shard_bytes: int) -> tuple[int, Callable[[int], list[tuple[str, str]]], dict[str, str]]:
    """(number of shards, the pairs of one, class words of the whole list)."""
    size = entries.agg(F.sum(F.octet_length("spelling") + F.octet_length("target"))).first()[0] or 0
    if size <= shard_bytes:
        pairs = sorted((r[0], r[1]) for r in entries.collect())
        return 1, lambda _: pairs, labtext.class_words([s for s, _ in pairs]) if kind == "analyte" else {}
    n = -(-size // shard_bytes)
    keyed = materialise(entries.mapInPandas(_entry_keys(kind), "spelling string, target string, key string, end_word string"), "entries")
    # By key: spellings of one key share their targets and guards.
    pairs = lambda i: sorted((r[0], r[1]) for r in keyed.where(F.pmod(F.xxhash64("key"), F.lit(n)) == i).select("spelling", "target").collect())
    return n, pairs, _class_words(keyed) if kind == "analyte" else {}


def map_to_list(values: DataFrame, entries: DataFrame, kind: str = "analyte", threshold: int = THRESHOLD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """`values(row_key, text)` against `entries(spelling, target)` → `(row_key, text, entry, distance)`.

    `distance` is -1 where nothing matched.
    """
    values = values.select(F.col("row_key").cast("string").alias("row_key"), "text").where(F.col("text").isNotNull())
    shards, pairs, words = _shards(entries.select("spelling", "target").where("spelling is not null and target is not null").distinct(), kind, shard_bytes)
    readings = materialise(values.select("text").distinct().mapInPandas(_read(kind, words), "text string, reading int, key string, guard string"), "readings")
    keys = readings.select("key", "guard").distinct()
    hits = reduce(DataFrame.unionByName, (keys.mapInPandas(_look_up(pairs(i), kind, threshold, words), "key string, guard string, distance int, entry string") for i in range(shards)))
    near = hits.groupBy("key", "guard").agg(F.min("distance").alias("distance"), F.collect_set(F.struct("distance", "entry")).alias("hits"))
    near = near.select("key", "guard", "distance", F.expr("array_distinct(transform(filter(hits, h -> h.distance = distance), h -> h.entry))").alias("entries"))
    first = readings.join(near, ["key", "guard"]).groupBy("text").agg(F.min_by(F.struct("distance", "entries"), "reading").alias("b"))
    best = first.where("size(b.entries) = 1").select("text", F.col("b.entries")[0].alias("entry"), F.col("b.distance").alias("distance"))
    return values.join(best, "text", "left").select("row_key", "text", F.coalesce("entry", F.lit(NONE)).alias("entry"), F.coalesce("distance", F.lit(-1)).alias("distance"))


def analyte_entries(lexicon: DataFrame) -> DataFrame:
    """Labels and `|`-joined synonyms of `analytes_builtin` as (spelling, target)."""
    synonyms = F.filter(F.split(F.coalesce("synonyms", F.lit("")), r"\|"), lambda x: F.trim(x) != "")
    return lexicon.where("label is not null").select(F.explode(F.concat(F.array("label"), synonyms)).alias("spelling"), F.col("label").alias("target"))


def disease_entries(aliases: DataFrame) -> DataFrame:
    return aliases.select(F.col("alias").alias("spelling"), F.col("omim").alias("target"))


def found(measurements: DataFrame, diagnoses: DataFrame, lexicon: DataFrame, aliases: DataFrame) -> DataFrame:
    """(fact_id, entry) for every typed analyte and disease."""
    a = map_to_list(measurements.select(F.col("fact_id").alias("row_key"), F.col("analyte_text").alias("text")), analyte_entries(lexicon), "analyte")
    d = map_to_list(diagnoses.select(F.col("fact_id").alias("row_key"), F.col("disease_text").alias("text")), disease_entries(aliases), "disease")
    return a.unionByName(d).select(F.col("row_key").alias("fact_id"), "entry").distinct()


def unmatched(measurements: DataFrame, diagnoses: DataFrame, lexicon: DataFrame, aliases: DataFrame) -> DataFrame:
    """The report of values that mean no listed entry: (field, text, n_facts)."""
    a = map_to_list(measurements.select(F.col("fact_id").alias("row_key"), F.col("analyte_text").alias("text")), analyte_entries(lexicon), "analyte")
    d = map_to_list(diagnoses.select(F.col("fact_id").alias("row_key"), F.col("disease_text").alias("text")), disease_entries(aliases), "disease")
    both = a.withColumn("field", F.lit("analyte_text")).unionByName(d.withColumn("field", F.lit("disease_text")))
    return both.where(F.col("entry") == NONE).select("field", "row_key", "text").distinct().groupBy("field", "text").agg(F.count("*").alias("n_facts"))
