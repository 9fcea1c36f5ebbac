"""Catalogue state as tables: upserts, retrieval tiers, sets, links, status. Functions return the new version of a table; a
caller writes it beside the old one and swaps (never over the path that is being read)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import truthy

FULLTEXT_TIERS = ("epmc", "pmc", "unpaywall", "publisher")
# Publishers by DOI prefix.
PUBLISHERS = {"10.1016": "elsevier", "10.1002": "wiley", "10.1111": "wiley", "10.1007": "springer", "10.1038": "springer", "10.1186": "springer", "10.1140": "springer"}


def upsert(changes: DataFrame, key: str, order: list[Column], first: tuple[str, ...] = ()) -> DataFrame:
    """The state of every key after its changes in `order`: for each column the last supplied (non-null) value; columns in
    `first` keep their first one. One partial aggregation, no window."""
    o = F.struct(*order)
    cols = [c for c in changes.columns if c != key]
    return changes.where(F.col(key).isNotNull()).groupBy(key).agg(*[(F.min_by if c in first else F.max_by)(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in cols])


def merge(base: DataFrame, updates: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Column-partial upsert of `updates` into `base`: supplied values win, missing columns stay, `keep` never change."""
    new = [c for c in updates.columns if c != key]
    u = updates.withColumnsRenamed({c: f"_u_{c}" for c in new})
    joined = base.join(u, key, "full_outer")
    pick = lambda c: F.coalesce(F.col(c), F.col(f"_u_{c}")) if c in keep else F.coalesce(F.col(f"_u_{c}"), F.col(c))
    out = [pick(c).alias(c) if c in new else F.col(c) for c in base.columns if c != key]
    return joined.select(key, *out, *[F.col(f"_u_{c}").alias(c) for c in new if c not in base.columns])


def insert_or_ignore(base: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of `new` whose key is free are added, the first of each key; rows already there stay."""
    cols = [c for c in new.columns if c not in keys]
    fresh = new.join(base.select(*keys), keys, "left_anti").groupBy(*keys).agg(F.min(F.struct(*order, F.struct(*cols).alias("v")))["v"].alias("v")).select(*keys, "v.*")
    return base.unionByName(fresh, allowMissingColumns=True)


def insert_or_replace(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def clear_set(sets: DataFrame, name: str) -> DataFrame:
    return sets.where(F.col("set_name") != name)


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of every key."""
    cols = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("v")).select(*keys, "v.*")


def promoted_tier(current: Column, tier: Column, ok: Column) -> Column:
    """A successful retrieval sets the tier only over none, `abstract` or itself."""
    return F.when(ok & (current.isNull() | (current == "abstract") | (current == tier)), tier).otherwise(current)


def open_attempts(documents: DataFrame, attempts: DataFrame, tiers: tuple[str, ...] = FULLTEXT_TIERS) -> DataFrame:
    """(key, tier, rank) still to be tried: documents without full text, tiers in order, earlier attempts left out."""
    needed = documents.where("fulltext_tier is null or fulltext_tier = 'abstract'").select("pmid")
    order = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(x).alias("tier")) for i, x in enumerate(tiers)])
    return needed.select("pmid", F.explode(order).alias("o")).select("pmid", "o.tier", "o.rank").join(attempts.select("pmid", "tier"), ["pmid", "tier"], "left_anti")


def cascade(documents: DataFrame, successes: DataFrame, tiers: tuple[str, ...] = FULLTEXT_TIERS) -> DataFrame:
    """The tier every needy document ends with: its first successful one in order, else `abstract`."""
    rank = F.coalesce(*[F.when(F.col("tier") == x, F.lit(i)) for i, x in enumerate(tiers)])
    best = successes.withColumn("rank", rank).where("rank is not null").groupBy("pmid").agg(F.min_by("tier", "rank").alias("got"))
    needed = documents.where("fulltext_tier is null or fulltext_tier = 'abstract'").select("pmid").distinct()
    return needed.join(best, "pmid", "left").select("pmid", F.coalesce("got", F.lit("abstract")).alias("fulltext_tier"))


def publisher(doi: Column) -> Column:
    return F.coalesce(*[F.when(F.split(doi, "/")[0] == p, F.lit(n)) for p, n in PUBLISHERS.items()])


def enrich(documents: DataFrame, facts: DataFrame) -> DataFrame:
    """Enrichment merged by pmid: flags default to 0 where nothing is known, a pmcid is never overwritten by nothing."""
    f = facts.select("pmid", F.col("pmcid").alias("_pmcid"), F.col("is_open_access").alias("_oa"), F.col("in_epmc").alias("_epmc"))
    j = documents.join(f, "pmid", "left")
    return j.withColumns({"pmcid": F.coalesce(truthy(F.col("_pmcid")), F.col("pmcid")), "is_open_access": F.coalesce("_oa", F.lit(0)), "in_epmc": F.coalesce("_epmc", F.lit(0))}).drop("_pmcid", "_oa", "_epmc")


def layer(existing: Column, new: Column) -> Column:
    """Layer precedence: the smaller name by code point stays."""
    return F.least(existing, new)


def status(documents: DataFrame) -> DataFrame:
    """(dimension, value, n): counts by tier, layer and overall in one pass; missing values count as `none`."""
    g = documents.groupBy(F.coalesce("fulltext_tier", F.lit("none")).alias("tier"), F.coalesce("corpus_layer", F.lit("none")).alias("layer")).agg(F.count("*").alias("n"), F.count("pmcid").alias("n_pmcid"))
    parts = F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("value"), n.alias("n")) for k, v, n in (("tier", F.col("tier"), F.col("n")), ("layer", F.col("layer"), F.col("n")), ("total", F.lit("all"), F.col("n")), ("total", F.lit("with_pmcid"), F.col("n_pmcid")))])
    return g.select(F.explode(parts).alias("p")).groupBy("p.dimension", "p.value").agg(F.sum("p.n").alias("n"))


def work_state(manifested: Column, in_scope: Column, records: Column) -> Column:
    """Where an item stands: need_triage, need_extract or done (out-of-scope items are done)."""
    return F.when(~manifested, "need_triage").when(F.coalesce(in_scope, F.lit(True)) & (F.coalesce(records, F.lit(0)) == 0), "need_extract").otherwise("done")


def pages(rows: DataFrame, order: list[Column], size: int, by: list[str]) -> DataFrame:
    """Rows with a page number of `size` rows each within groups."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("page", F.floor((F.row_number().over(w) - 1) / size))


# -- runs and schemas ------------------------------------------------------------------------------------------------
RUNS = "run_id string, command string, args string, version string, started_at double, finished_at double, summary string"
#: The catalogue's tables: columns and keys. There are no secondary indexes: tables are pruned by partition and statistics.
SCHEMAS = {
    "documents": ("pmid string, pmcid string, doi string, title string, abstract string, journal string, journal_iso string, issn string, pub_year int, pub_date string, language string, pub_types array<string>, keywords array<string>, authors array<string>, affiliations array<string>, corpus_layer string, is_open_access int, license string, in_epmc int, has_suppl int, fulltext_tier string, fulltext_path string, edat string, added_at double, updated_at double", ("pmid",)),
    "retrieval": ("pmid string, tier string, ok int, path string, status string, attempted_at double", ("pmid", "tier")),
    "triage": ("pmid string, in_scope int, n_individuals int, individual_ids array<string>, is_rereport int, document_type string, reasons string, model string, prompt_version string, decided_at double", ("pmid",)),
    "links": ("record_a string, record_b string, relation string, evidence string, score double", ("record_a", "record_b", "relation")),
    "document_sets": ("pmid string, set_name string, source string, added_at double", ("pmid", "set_name")),
    "runs": (RUNS, ("run_id",)),
}


def migrated(table: DataFrame, name: str) -> DataFrame:
    """A stored table in today's schema: columns it lacks come as nulls, in declared order; its further columns stay behind."""
    declared = table.sparkSession.createDataFrame([], SCHEMAS[name][0]).schema
    own = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in table.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in declared]
    return table.select(*own, *[c for c in table.columns if c not in declared.names])


def start_runs(runs: DataFrame) -> DataFrame:
    """New run rows: no end yet."""
    return runs.select("run_id", "command", "args", "version", "started_at", F.lit(None).cast("double").alias("finished_at"), F.lit(None).cast("string").alias("summary"))


def finish_runs(runs: DataFrame, ended: DataFrame) -> DataFrame:
    """Ends and summaries put in; a run that failed is not among `ended` and keeps no end."""
    return merge(runs, ended, "run_id").select(*runs.columns)
