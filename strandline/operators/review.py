"""Human verification: verdict tables to precision, recall and agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import round_binary

VERDICTS = ("Correct", "Partly correct", "Wrong value", "Wrong grounding", "Wrong patient", "Not in paper", "Unsure")


def primary(decisions: DataFrame, order: list[Column]) -> DataFrame:
    """The first decision of every fact."""
    cols = [c for c in decisions.columns if c != "fact_id"]
    return decisions.groupBy("fact_id").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("v")).select("fact_id", "v.*")


def metrics(decisions: DataFrame, missed: DataFrame) -> DataFrame:
    """Per group and for all: counts per verdict, missed facts, strict and lenient precision and recall, error rate.

    `decisions(grp, verdict)` are primary; `missed(grp)`. Rates have 3 digits and are NULL over nothing. Both recalls are over
    correct, partly correct and missed facts; wrong values and facts that are not in the paper do not enter them.
    """
    count = lambda *v: F.count_if(F.col("verdict").isin(*v))
    d = decisions.rollup("grp").agg(
        F.count("*").alias("n"), count("Correct").alias("correct"), count("Partly correct").alias("partly"), count("Unsure").alias("unsure"),
        count("Wrong value", "Wrong grounding", "Wrong patient", "Not in paper").alias("wrong"), F.grouping_id().alias("_g"),
    )
    m = missed.rollup("grp").agg(F.count("*").alias("missed"), F.grouping_id().alias("_g"))
    name = F.when(F.col("_g") == 1, "all").otherwise(F.col("grp"))
    x = d.select(name.alias("grp"), "n", "correct", "partly", "unsure", "wrong").join(m.select(name.alias("grp"), "missed"), "grp", "full_outer").fillna(0)
    judged = F.col("n") - F.col("unsure")
    rate = lambda a, b: round_binary(F.try_divide(a, b), 3)
    c, p, miss = F.col("correct"), F.col("partly"), F.col("missed")
    return x.select(
        "grp", "n", "correct", "partly", "unsure", "wrong", "missed", rate(c, judged).alias("precision_strict"), rate(c + p, judged).alias("precision_lenient"),
        rate(c, c + p + miss).alias("recall_strict"), rate(c + p, c + p + miss).alias("recall_lenient"), rate(F.col("wrong"), judged).alias("error_rate"),
    )


def agreement(pairs: DataFrame) -> DataFrame:
    """`pairs(a, b)` of two raters' verdicts on the same item → (n, exact, kappa), in one pass over the counts."""
    cells = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    rows = cells.groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("ra"))
    cols = cells.groupBy(F.col("b").alias("v")).agg(F.sum("n").alias("rb"))
    chance = rows.join(cols, "v").agg(F.sum(F.col("ra") * F.col("rb")).alias("chance"))
    total = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    po = F.col("same") / F.col("n")
    pe = F.coalesce("chance", F.lit(0)) / (F.col("n") * F.col("n"))
    return total.join(chance).select("n", round_binary(po, 3).alias("exact"), round_binary(F.try_divide(po - pe, 1 - pe), 3).alias("kappa"))


def metrics_markdown(rows: list) -> str:
    """The collected metrics (a row per group) as a table."""
    if not rows:
        return ""
    names = list(rows[0].asDict())
    lines = ["| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in sorted(rows, key=lambda r: str(r[0]))])


def missed_in_reviewed(missed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Missed facts of reviewed records; all of them while nothing is reviewed."""
    reviewed_ = decisions.select("record_id").where("record_id is not null").distinct()
    none = reviewed_.agg((F.count("*") == 0).alias("none"))
    m = missed.join(reviewed_.withColumn("seen", F.lit(True)), "record_id", "left").join(F.broadcast(none))
    return m.where("none or seen").drop("none", "seen")


def counts(decisions: DataFrame, missed: DataFrame) -> DataFrame:
    """(n_decisions, n_facts, n_records, n_missed)."""
    d = decisions.agg(F.count("*").alias("n_decisions"), F.countDistinct("fact_id").alias("n_facts"), F.countDistinct("record_id").alias("n_records"))
    return d.join(missed.agg(F.count("*").alias("n_missed")))


def double_reviews(decisions: DataFrame, order: list[Column]) -> DataFrame:
    """(fact_id, a, b): the first two verdicts of a fact, where they come from different reviewers."""
    o = F.struct(*order, F.struct("reviewer", "verdict").alias("v"))
    two = decisions.groupBy("fact_id").agg(F.slice(F.array_sort(F.collect_list(o)), 1, 2).alias("d")).where("size(d) = 2")
    return two.select("fact_id", F.col("d")[0]["v"].alias("x"), F.col("d")[1]["v"].alias("y")).where("x.reviewer <> y.reviewer").select("fact_id", F.col("x.verdict").alias("a"), F.col("y.verdict").alias("b"))


def agreement_of_pairs(pairs: DataFrame) -> DataFrame:
    """(n, exact, binary, kappa) of `double_reviews`: same verdict, same side of Correct, and chance-corrected (one pass)."""
    x, y = F.col("a") == "Correct", F.col("b") == "Correct"
    t = pairs.agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same"), F.count_if(x == y).alias("side"), F.count_if(x).alias("ca"), F.count_if(y).alias("cb")).where("n > 0")
    po, pa, pb = F.col("side") / F.col("n"), F.col("ca") / F.col("n"), F.col("cb") / F.col("n")
    pe = pa * pb + (1 - pa) * (1 - pb)
    return t.select("n", round_binary(F.col("same") / F.col("n"), 3).alias("exact"), round_binary(po, 3).alias("binary"), F.when(pe < 1, round_binary((po - pe) / (1 - pe), 3)).alias("kappa"))


ANSWERS = ("diagnosis_correct", "tier_correct", "narrative_complete", "narrative_has_others")


def record_answers(rows: DataFrame) -> DataFrame:
    """(question, answer, n, mean_quality): counts per answer (empty ones left out), and the mean quality over all rows."""
    parts = F.array(*[F.struct(F.lit(q).alias("question"), F.col(q).alias("answer")) for q in ANSWERS])
    per = rows.select(F.explode(parts).alias("p")).where("coalesce(p.answer, '') <> ''").groupBy("p.question", "p.answer").agg(F.count("*").alias("n"))
    return per.join(rows.agg(round_binary(F.avg("quality"), 2).alias("mean_quality")))


def kept_rows(decisions: DataFrame, missed: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of filled review sheets that say something: a verdict; a record and a text; any answer."""
    said = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != ""
    any_answer = said("quality")
    for q in ANSWERS:
        any_answer = any_answer | said(q)
    return decisions.where(said("verdict")), missed.where(said("record_id") & said("text")), records.where(any_answer)


def batches(assigned: DataFrame, facts: DataFrame) -> DataFrame:
    """The facts every reviewer gets: `assigned(record_id, reviewer, batch, role)` joined with facts by record."""
    return assigned.join(facts, "record_id")


def units_of_records(units: DataFrame, narratives: DataFrame) -> DataFrame:
    """Every unit of a paper with the records whose narrative holds it: `units(pmid, anchor, …)`, `narratives(record_id, pmid, anchor)`
    → plus `records`, sorted, joined by a comma; empty where none does."""
    who = narratives.groupBy("pmid", "anchor").agg(F.array_join(F.array_sort(F.collect_set("record_id")), ", ").alias("records"))
    return units.join(who, ["pmid", "anchor"], "left").withColumn("records", F.coalesce("records", F.lit("")))


def write_gold(decisions: DataFrame, missed: DataFrame, records: DataFrame, path: str) -> None:
    """Verdicts, missed facts and record answers as JSON lines."""
    for name, df in (("decisions", decisions), ("missed", missed), ("records", records)):
        df.write.mode("overwrite").json(f"{path}/{name}.jsonl")
