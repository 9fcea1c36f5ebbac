"""Deterministic stratified samples and reviewer assignments, as hash ranks and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import half_even, hash_rank, year_band
from ..functions.text import truthy

# Wording that marks series, small series and reviews.
NUMBER_WORDS = r"(?:\d+|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty|thirty|forty|fifty)"
SERIES_COUNT = rf"\b{NUMBER_WORDS}\s+(?:unrelated\s+|new\s+|additional\s+|further\s+|japanese\s+|chinese\s+|turkish\s+|italian\s+|\w+\s+)?(?:patients|cases|children|infants|siblings|sibs|families|individuals|probands|subjects|brothers|sisters|neonates|newborns|adults|women|men|boys|girls)\b"
SERIES_WORDS = r"\b(case series|series of|cohort|retrospective|prospective|registry|multicenter|multicentre|natural history|long-term follow-up of \d+|clinical spectrum|in \d+ patients)\b"
TWO_CASES = r"\b(two|three|2|3) (cases|patients|siblings|sibs|brothers|sisters|families)\b"
REVIEW_WORDS = r"\b(review of the literature|literature review|systematic review|review of \d+ (reported )?cases|reported cases)\b"
SERIES_TYPES = ("Multicenter Study", "Observational Study", "Clinical Study")


def document_kind(title: Column, abstract: Column, pub_types: Column) -> Column:
    """single_case, case_plus_review, small_series (2-3), series or other, from publication types and wording."""
    i = lambda p: "(?i)" + p
    t, a = F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit(""))
    text = F.concat(t, F.lit("\n"), F.substring(a, 1, 600))
    types = F.coalesce(pub_types, F.array().cast("array<string>"))
    count = F.coalesce(truthy(F.regexp_extract(t, i(f"({SERIES_COUNT})"), 1)), truthy(F.regexp_extract(text, i(f"({SERIES_COUNT})"), 1)))
    series = text.rlike(i(SERIES_WORDS)) | t.rlike(i(SERIES_COUNT)) | F.arrays_overlap(types, F.array(*map(F.lit, SERIES_TYPES)))
    few = F.coalesce(count.rlike(i("^" + TWO_CASES)), F.lit(False))
    review = text.rlike(i(REVIEW_WORDS)) | F.arrays_overlap(types, F.array(F.lit("Review"), F.lit("Systematic Review")))
    return (
        F.when(series, F.when(few, "small_series").otherwise("series"))
        .when(t.rlike(i(TWO_CASES)) | F.substring(a, 1, 300).rlike(i(TWO_CASES)), "small_series")
        .when(F.array_contains(types, "Case Reports"), F.when(review, "case_plus_review").otherwise("single_case"))
        .otherwise(F.when(text.rlike(i(SERIES_COUNT)), "series").otherwise("other"))
    )


def fulltext_expected(tier: Column, in_epmc: Column, open_access: Column, pmcid: Column) -> Column:
    known = tier.isin("epmc", "pmc", "unpaywall", "publisher")
    likely = (F.coalesce(in_epmc, F.lit(0)) != 0) | (F.coalesce(open_access, F.lit(0)) != 0) | truthy(pmcid).isNotNull()
    return F.when(F.coalesce(known, F.lit(False)), True).when(F.coalesce(tier == "abstract", F.lit(False)), False).otherwise(likely)


def strata(documents: DataFrame, seed: int) -> DataFrame:
    """Documents with the columns that a draw needs: ft, band, kind, rank_hash."""
    return documents.select(
        "set_name", "pmid", fulltext_expected(F.col("fulltext_tier"), F.col("in_epmc"), F.col("is_open_access"), F.col("pmcid")).alias("ft"), year_band(F.col("pub_year")).alias("band"),
        document_kind(F.col("title"), F.col("abstract"), F.col("pub_types")).alias("kind"), hash_rank(seed, F.col("pmid")).alias("rank_hash"),
    )


def pick(pool: DataFrame, n: Column, min_series: Column, min_per_band: int, by: list[str]) -> DataFrame:
    """Quota pick within each group: series first, then bands up to a minimum, then bands in proportion, then by rank.

    Stages are ranks in windows over what is left; each stage stops at the group's total `n`. Adds `stage` (1-4).
    """
    g = Window.partitionBy(*by)
    band = Window.partitionBy(*by, "band")
    by_rank = g.orderBy("rank_hash")
    x = pool.withColumns({"_n": n, "_min_series": min_series})
    if "_total" not in pool.columns:
        x = x.withColumns({"_total": F.count("*").over(g), "_in_band": F.count("*").over(band)})
    x = x.withColumn("_is", F.col("kind").isin("series", "small_series"))
    x = x.withColumn("_r1", F.when(F.col("_is"), F.row_number().over(Window.partitionBy(*by, "_is").orderBy("rank_hash"))))
    x = x.withColumn("_s1", F.coalesce((F.col("_r1") <= F.col("_min_series")) & (F.col("_r1") <= F.col("_n")), F.lit(False)))

    def stage(x: DataFrame, before: Column, limit: Column, name: str) -> DataFrame:
        left = Window.partitionBy(*by, "band", "_left").orderBy("rank_hash")
        x = x.withColumn("_left", ~before).withColumn("_r", F.when(F.col("_left"), F.row_number().over(left)))
        want = F.coalesce(F.col("_left") & (F.col("_r") <= limit), F.lit(False))
        x = x.withColumn("_want", want).withColumn("_chosen", F.sum(before.cast("int")).over(g))
        order = Window.partitionBy(*by, "_want").orderBy("band", "rank_hash")
        x = x.withColumn("_k", F.when(F.col("_want"), F.row_number().over(order)))
        return x.withColumn(name, F.coalesce(F.col("_k") <= F.col("_n") - F.col("_chosen"), F.lit(False)))

    have = F.sum(F.col("_s1").cast("int")).over(band)
    x = x.withColumn("_have", have)
    x = stage(x, F.col("_s1"), F.greatest(F.lit(0), F.lit(min_per_band) - F.col("_have")), "_s2")
    x = x.withColumn("_rest", F.col("_n") - F.sum((F.col("_s1") | F.col("_s2")).cast("int")).over(g))
    quota = F.greatest(F.lit(0), half_even(F.col("_rest") * F.col("_in_band") / F.col("_total")))
    x = stage(x, F.col("_s1") | F.col("_s2"), F.when(F.col("_rest") > 0, quota).otherwise(0), "_s3")
    done = F.col("_s1") | F.col("_s2") | F.col("_s3")
    x = x.withColumn("_done", done).withColumn("_count", F.sum(done.cast("int")).over(g))
    x = x.withColumn("_r4", F.when(~F.col("_done"), F.row_number().over(Window.partitionBy(*by, "_done").orderBy("rank_hash"))))
    x = x.withColumn("_s4", F.coalesce(F.col("_r4") <= F.col("_n") - F.col("_count"), F.lit(False)))
    s = F.when(F.col("_s1"), 1).when(F.col("_s2"), 2).when(F.col("_s3"), 3).when(F.col("_s4"), 4)
    return x.withColumn("stage", s).where("stage is not null").select(*pool.columns, "stage")


def draw(documents: DataFrame, per_set: int = 25, seed: int = 1, fulltext_share: float = 0.72, min_series: int = 4, min_per_band: int = 2) -> DataFrame:
    """One independent draw per set (sets that share documents are drawn one after the other by `draw_in_turn`)."""
    x = strata(documents, seed)
    # Sizes are partial counts. A pick never takes a row beyond the first `per_set` of its stratum, so only those go on: the row
    # limit is applied before the shuffle (window group limit), and no task sorts a whole set.
    sizes = x.groupBy("set_name", "ft", "band").agg(F.count("*").alias("_in_band"))
    g, half = Window.partitionBy("set_name"), Window.partitionBy("set_name", "ft")
    part = lambda yes: F.sum(F.when(F.col("ft") if yes else ~F.col("ft"), F.col("_in_band")).otherwise(0)).over(g)
    sizes = sizes.withColumns({"_total": F.sum("_in_band").over(half), "_nf": part(True), "_na": part(False)})
    first = Window.partitionBy("set_name", "ft", "band", F.col("kind").isin("series", "small_series")).orderBy("rank_hash")
    x = x.withColumn("_first", F.row_number().over(first)).where(F.col("_first") <= per_set).drop("_first").join(sizes, ["set_name", "ft", "band"])
    want = int(round(per_set * fulltext_share))
    a = F.least(F.lit(per_set) - F.least(F.lit(want), F.col("_nf")), F.col("_na"))
    x = x.withColumn("_take_ab", a).withColumn("_take_ft", F.least(F.lit(per_set) - F.col("_take_ab"), F.col("_nf")))
    # Where the abstract half falls short the full-text half fills up; never beyond what there is.
    take = F.when(F.col("ft"), F.col("_take_ft")).otherwise(F.col("_take_ab"))
    series = F.when(F.col("ft"), min_series).otherwise(max(1, min_series // 3))
    out = pick(x, take, series, min_per_band, ["set_name", "ft"])
    return out.select("set_name", "pmid", "ft", "band", "kind", "stage")


def draw_in_turn(documents: DataFrame, set_names: list[str], exclude: DataFrame | None = None, **kw) -> DataFrame:
    """Draws set after set; a document goes to the first set that takes it (sets are few, a join each)."""
    taken = exclude.select("pmid") if exclude is not None else documents.select("pmid").where("false")
    out = None
    for name in set_names:
        d = draw(documents.where(F.col("set_name") == name).join(taken, "pmid", "left_anti"), **kw)
        out = d if out is None else out.unionByName(d)
        taken = taken.unionByName(d.select("pmid"))
    return out


def write_sample(sample: DataFrame, documents: DataFrame, path: str) -> None:
    """The drawn documents as tab-separated text with their other sets joined by `|`."""
    sets = documents.groupBy("pmid").agg(F.array_sort(F.collect_set("set_name")).alias("_sets"))
    x = sample.join(sets, "pmid", "left").withColumn("other_sets", F.array_join(F.array_remove("_sets", F.col("set_name")), "|")).drop("_sets")
    x.select(*[F.col(c).cast("string").alias(c) for c in x.columns]).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def assign(records: DataFrame, reviewers: list[str], batch_size: int, double_fraction: float, seed: int = 1) -> DataFrame:
    """(record_id, reviewer, batch, role): records in hash order are dealt round robin; a share of every batch goes to the
    next reviewer as well."""
    n = len(reviewers)
    names = F.array(*map(F.lit, reviewers))
    # The hash order of all records: ranks within hash prefixes plus the counts before them, so no single task sorts all.
    x = records.select("record_id").distinct().withColumn("h", hash_rank(seed, F.col("record_id"))).withColumn("p", F.substring("h", 1, 3))
    before = x.groupBy("p").agg(F.count("*").alias("c")).withColumn("before", F.sum("c").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)))
    x = x.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy("h"))).join(F.broadcast(before), "p")
    k = F.col("r") - 1 + F.coalesce("before", F.lit(0))
    x = x.withColumn("k", k).withColumns({"who": (F.col("k") % n).cast("int"), "turn": F.floor(F.col("k") / n)})
    x = x.withColumn("batch", F.floor(F.col("turn") / batch_size) + 1)
    w = Window.partitionBy("who", "batch")
    x = x.withColumns({"j": F.row_number().over(w.orderBy("k")) - 1, "size": F.count("*").over(w)})
    first = x.select("record_id", names[F.col("who")].alias("reviewer"), "batch", F.lit("primary").alias("role"))
    if n < 2 or double_fraction <= 0:
        return first
    second = x.where(F.col("j") < half_even(F.col("size") * double_fraction)).select("record_id", names[(F.col("who") + 1) % n].alias("reviewer"), "batch", F.lit("second").alias("role"))
    return first.unionByName(second)


SHEET = ("set", "pmid", "pub_year", "year_band", "fulltext_expected", "fulltext_tier", "kind", "pmcid", "doi", "journal", "title", "other_sets")


def sheet(sample: DataFrame, sets: DataFrame, documents: DataFrame) -> DataFrame:
    """The sample table: `sample(set_name, pmid, ft, band, kind)`, all `sets(pmid, set_name)`, catalogue rows of the papers."""
    other = sets.groupBy("pmid").agg(F.array_sort(F.collect_set("set_name")).alias("_sets"))
    x = sample.join(other, "pmid", "left").join(documents.select("pmid", "pub_year", "fulltext_tier", "pmcid", "doi", "journal", "title"), "pmid", "left")
    x = x.withColumns({"set": F.col("set_name"), "year_band": F.col("band"), "fulltext_expected": F.when(F.col("ft"), "yes").otherwise("no"), "other_sets": F.coalesce(F.array_join(F.array_remove("_sets", F.col("set_name")), "|"), F.lit(""))})
    return x.select(*SHEET)


def register(sets: DataFrame, sample: DataFrame, name: str) -> DataFrame:
    """The sets with the sample as set `name` in place of its former rows; its source says where each document came from."""
    new = sample.select("pmid", F.lit(name).alias("set_name"), F.to_json(F.struct(F.col("set_name").alias("from"), "kind", "band")).alias("source")).dropDuplicates(["pmid"])
    return sets.where(F.col("set_name") != name).unionByName(new, allowMissingColumns=True)
