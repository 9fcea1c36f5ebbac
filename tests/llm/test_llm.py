"""Operators of the llm subpackage on small fixtures: brute force, exact round trips, edge cases."""

import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandline.functions.fuzzy import damerau, levenshtein
from strandline.llm import canon_map, entity_match, leakage, names, packing, subjects, unify

TOKENIZER = packing.TOKENIZER


# -- problem 1 -------------------------------------------------------------------------------------------------------
def test_bk_tree_returns_every_entry_within_the_radius():
    r = random.Random(1)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(300)})
    tree = canon_map.BKTree(words)
    for _ in range(100):
        q = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        for radius in (0, 1, 2):
            assert tree.search(q, radius) == sorted((d, w) for w in words if (d := levenshtein(q, w)) <= radius)
    assert canon_map.BKTree().search("a", 3) == []


ENTRIES = [("2-hydroxytestonic acid", "A"), ("L-fooline", "B"), ("fooline", "B"), ("TSA", "C"), ("X-binding protein", "D")]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 40])
def test_mapping_broadcast_and_sharded(spark, shard_bytes):
    texts = ["2-hydroxytestonic acid", "2-hydroxytestnoic acid", "3-hydroxytestonic acid", "plasma Fooline (mg/dL)", "D-fooline", "TSA", "TSB", "L-fooline/TSA ratio", "", "  ", None, "X-BP", "x" * 5000, "TSA"]
    v = spark.createDataFrame(list(enumerate(texts)), "row_key int, text string").withColumn("entry", F.lit("clash"))
    e = spark.createDataFrame([*ENTRIES, (None, "Z"), ENTRIES[0]], "spelling string, target string")
    got = {int(r.row_key): r.entry for r in canon_map.map_to_list(v, e, shard_bytes=shard_bytes).collect()}
    none = canon_map.NONE
    assert got == {0: "A", 1: "A", 2: none, 3: "B", 4: none, 5: "C", 6: none, 7: none, 8: none, 9: none, 11: "D", 12: none, 13: "C"}
    assert canon_map.map_to_list(v.where("false"), e).count() == 0
    assert {r.entry for r in canon_map.map_to_list(v, e.where("false")).collect()} == {none}


def test_shards_give_the_answers_of_the_whole_list(spark):
    kinds = ["dehydrogenase", "transferase", "reductase", "acylcarnitine"]
    entries = [*ENTRIES, *((f"{a}{b}{c} {k}", f"{a}{b}{c}-{k}") for i, k in enumerate(kinds) for a in ("gro", "fel") for b in ("mu", "ta") for c in ("nol", "rik")[: 2 - i % 2])]
    entries += [("Lbaronine", "E"), ("L-baronine", "F"), ("quorzine", "G"), ("trellate", "H")]
    texts = ["X-BP", "gromunol dehydrog.", "feltanol trans", "gromunol reduct", "gromunnol red", "L-baronin", "quorzin (trellate)", "quorzine [TSA]", "quorzzine (fooline)", "fooline (quorzine)", "TSA (quorzine)", "nothing at all"]
    v, e = spark.createDataFrame(list(enumerate(texts)), "row_key int, text string"), spark.createDataFrame(entries, "spelling string, target string")
    whole, *cut = ({texts[int(r.row_key)]: (r.entry, r.distance) for r in canon_map.map_to_list(v, e, shard_bytes=n).collect()} for n in (1 << 20, 300, 60))
    assert cut == [whole, whole]
    assert whole["X-BP"] == ("D", 0) and whole["quorzin (trellate)"] == ("G", 1) and whole["feltanol trans"] == ("feltanol-transferase", 0)


def test_diseases_by_type_number_and_omim():
    m = canon_map.Mapper([("fooosis type II", "OMIM:1"), ("Foo-Bar syndrome", "OMIM:2"), ("baric acidemia", "OMIM:912345")], "disease")
    best = lambda t: [x for _, x in m.best(t)]
    assert best("suspected fooosis type 2") == best("fooosis 2") == best("Foosis type II, neonatal form") == ["OMIM:1"]
    assert best("fooosis type 3") == []
    assert best("Bar-Foo disease") == best("syndrome of Foo and Bar") == ["OMIM:2"]
    assert best("something else (OMIM 912345)") == ["OMIM:912345"]


def test_ties_between_targets_are_left_open():
    m = canon_map.Mapper([("abcdefgh", "A"), ("abcdefgk", "B")], "analyte")
    assert len(m.best("abcdefgx")) == 2 and damerau("abcdefgx", "abcdefgh") == 1


# -- problem 2 -------------------------------------------------------------------------------------------------------
def test_equal_looking_texts_get_one_form(spark):
    rows = [("f", 1, "caf\u00e9"), ("f", 2, "cafe\u0301"), ("f", 3, "c\u0430f\u00e9"), ("f", 4, "cafe"), ("f", 5, "Café"), ("f", 6, None), ("f", 7, ""), ("g", 8, "ca\u200bf\u00e9"), ("f", 2, "cafe\u0301"), ("f", 9, "µg"), ("f", 10, "μg"), ("f", 11, "x\xa0" * 4000)]
    x = unify.unify_texts(spark.createDataFrame(rows, "field string, row_key int, text string").withColumn("canonical", F.lit(0)))
    got = {r.row_key: (r.canonical, r.lookalike) for r in x.collect()}
    assert got[1][0] == got[2][0] == got[3][0] == got[8][0] == "café"
    assert (got[1][1], got[2][1], got[3][1], got[8][1]) == (False, True, True, True)
    assert got[4] == ("cafe", False) and got[5] == ("Café", False) and got[7] == ("", False) and 6 not in got
    assert got[9][0] == got[10][0] and not got[9][1] and not got[10][1]
    assert got[11] == ("x " * 4000, True) and x.count() == 11
    assert unify.unify_texts(spark.createDataFrame([], "field string, row_key int, text string")).count() == 0


# -- problem 4 -------------------------------------------------------------------------------------------------------
def test_spellings_of_people_and_institutions(spark):
    many = [["Müllerova KG"]] * 20 + [["Hansenson B"]] * 9 + [["Hansenson QB"]] * 9
    rows = many + [["Mullerova, K. G.", "MÜLLEROVA KG", "Katherine Müllerova, PhD", "Kate Mülerova", "et al.", "The Test Study Group", None, "", "Smith"], None, []]
    inst = ["Department of X, Testburg Children's Hospital, Testburg, Land", "Kinderspital Testburg", "Children's Hospital of Tesbturg", "Testburg University Hospital", None, "", "Nowhere"]
    d = spark.createDataFrame([(a, inst if i == 0 else None) for i, a in enumerate(rows)], "authors array<string>, affiliations array<string>").withColumn("name", F.lit("clash"))
    pairs = {tuple(r) for r in names.found(d).collect()}
    group = {"Müllerova KG", "Mullerova, K. G.", "MÜLLEROVA KG", "Katherine Müllerova, PhD", "Kate Mülerova"}
    assert {p[1:] for p in pairs if p[0] == "author"} == {(a, b) for a in group for b in group if a < b}
    hospital = set(inst[:3])
    assert {p[1:] for p in pairs if p[0] == "affiliation"} == {(a, b) for a in hospital for b in hospital if a < b}
    assert names.found(d.where("false")).count() == 0


def test_every_name_has_an_entity(spark):
    inst = ["Max Planck Society, Munich", "MAX PLANCK SOCIETY, Munich", "Imperial College London", "Boston Medical Center, Boston", "Testburg University Hospital", "Acme Corp.", "株式会社", "!!"]
    authors = ["Madonna", "MADONNA", "Hansenson B", "The Test Study Group", "et al."]
    d = spark.createDataFrame([(authors, inst)], "authors array<string>, affiliations array<string>")
    got = {(r.kind, r.name): r.entity_key for r in names.attribute(names.spellings(d)).collect()}
    assert set(got) == {("affiliation", x) for x in inst} | {("author", x) for x in authors[:3]}
    assert {tuple(r) for r in names.found(d).collect()} == {("affiliation", inst[1], inst[0]), ("author", "MADONNA", "Madonna")}


def test_chains_of_variants_end_in_one_entity(spark):
    base = "Mandroviteks"
    chain = [base[:1] + "q" * i + base[1 + i :] + " KG" for i in range(8)]
    rows = [[name] for name, n in zip(chain, (1, 2, 3, 5, 8, 12, 17, 24), strict=True) for _ in range(n)]
    d = spark.createDataFrame([(a, None) for a in rows], "authors array<string>, affiliations array<string>")
    assert {tuple(r) for r in names.found(d).collect()} == {("author", a, b) for a in chain for b in chain if a < b}
    assert [(r.n_spellings, r.n_mentions) for r in names.entities(d).collect()] == [(8, 72)]


def test_typos_in_short_names(spark):
    rows = [["Smith JK"]] * 80 + [["Smtih JK"], ["Smit JK"]] + [["Li W"]] * 9 + [["Lu W"]] * 3
    d = spark.createDataFrame([(a, None) for a in rows], "authors array<string>, affiliations array<string>")
    group = {"Smith JK", "Smtih JK", "Smit JK"}
    assert {tuple(r) for r in names.found(d).collect()} == {("author", a, b) for a in group for b in group if a < b}


# -- problem 5 -------------------------------------------------------------------------------------------------------
RECORD = "struct<subject:struct<sex:string,country_of_care:string,age_at_last_followup:struct<iso8601:string>>,genetic_findings:array<struct<gene_symbol:string,variant_hgvs_c:string,variant_hgvs_p:string,variant_text:string>>,diagnoses:array<struct<disease_text:string>>,phenotypes:array<struct<text:string>>>"


def person(i, pmid, sex, age, gene="ABC1", c=None, p=None, text=None, country="X"):
    g = [None, (gene, c, p, text)] if c or p or text else None
    return (f"r{i}", pmid, ((sex, country, (age,) if age else None), g, None, [None]))


def test_persons_are_paired_across_notations(spark):
    rows = [
        person(1, "1", "MALE", "P10Y", c="c.301A>T"), person(2, "2", "MALE", "P15Y", p="p.(Lys101Glu)"), person(3, "3", "FEMALE", "P15Y", text="K101E"), person(4, "3", "MALE", "P25Y", text="nt 301 A>T"),
        person(5, "2", "MALE", "P15Y", c="c.301A>T"), person(6, "4", None, None, c="c. 301A > T ", country=None), person(7, "4", "MALE", "P15Y"), person(8, "5", "MALE", "P15Y", gene="ABD1", c="c.301A>T"), person(1, "1", "MALE", "P10Y", c="c.301A>T"),
    ]
    ind = spark.createDataFrame(rows, f"record_id string, pmid string, record {RECORD}").withColumn("sex", F.lit("clash"))
    docs = spark.createDataFrame([("1", 2000, ["A"], 1.0), ("2", 2005, None, 1.0), ("3", 2005, ["A"], 1.0), ("4", None, None, 1.0), ("5", 2005, [], 1.0), ("1", 2000, ["A"], 2.0)], "pmid string, pub_year int, authors array<string>, added_at double")
    got = {tuple(r) for r in entity_match.found(ind, docs).collect()}
    assert {("r1", "r2"), ("r1", "r5")} <= got and not any("r3" in p and "r6" not in p or "r7" in p or "r8" in p for p in got)
    assert ("r2", "r5") not in got and ("r1", "r4") not in got
    assert entity_match.found(ind.where("false"), docs).count() == 0


def test_author_lists_are_read_whole_and_a_country_is_no_contradiction(spark):
    row = {"record_id": "r", "pmid": "1", "sex": "MALE", "age": "P1Y", "pub_year": 2000, "country": "X", "findings": [{"g": "ABC1", "c": "c.301A>T", "p": None, "t": None}], "diagnoses": None, "phenotypes": None}
    vector = lambda authors: next(entity_match._encode(iter([pd.DataFrame([row | {"authors": authors}])])))["authors"][0]
    assert vector(["Hansenson B"] * 300 + ["Zyxquiv KG"]) == vector(["Hansenson B", "Zyxquiv KG"]) != vector(["Hansenson B"])
    ind = spark.createDataFrame([person(1, "1", "MALE", "P10Y", c="c.301A>T"), person(2, "2", "MALE", "P15Y", c="c.301A>T", country="Elsewhere")], f"record_id string, pmid string, record {RECORD}")
    docs = spark.createDataFrame([("1", 2000, ["Hansenson B"], 1.0), ("2", 2005, ["Hansenson B"], 1.0)], "pmid string, pub_year int, authors array<string>, added_at double")
    assert {tuple(r) for r in entity_match.found(ind, docs).collect()} == {("r1", "r2")}


def test_multi_index_hashing_is_exact(spark):
    r = random.Random(5)
    base = [r.getrandbits(entity_match.BITS) for _ in range(12)]
    vectors = [v ^ sum(1 << b for b in r.sample(range(entity_match.BITS), r.randint(0, 6))) for v in base for _ in range(6)]
    rows = [(f"{i:03}", str(i), 2000.0 + i % 2 if i % 5 else None, [entity_match._words(v)]) for i, v in enumerate(vectors)]
    got = {(x.record_a, x.record_b): x.distance for x in entity_match.close_pairs(spark.createDataFrame(rows, "record_id string, pmid string, birth double, words array<array<int>>")).collect()}
    want = {(f"{i:03}", f"{j:03}"): d for i in range(len(vectors)) for j in range(i + 1, len(vectors)) if (d := (vectors[i] ^ vectors[j]).bit_count()) <= entity_match.RADIUS}
    assert got == want and set(got.values()) > {0, entity_match.RADIUS}


def test_sex_and_birth_year_cost_little_and_another_variant_much():
    v = entity_match.identity_vector
    far = lambda a, b: (a ^ b).bit_count()
    one = v("ABC1:101", "MALE", 1990.5)
    assert far(one, v("ABC1:101", None, 1990.5)) == 1 and far(one, v("ABC1:101", "MALE", 1992.5)) <= 2 and far(one, v("ABC1:101", None, None)) <= 3
    assert min(far(one, v(x, "MALE", 1990.5)) for x in ("ABD1:101", "ABC1:102", "ABC2:101", "AB1:101")) > entity_match.RADIUS


def test_confidences_are_learnt_without_labels(spark):
    """Persons described twice among carriers of the same variants: confidence alone tells them apart."""
    r = random.Random(13)
    rows, papers, same, other = [], [], set(), set()
    for i in range(150):
        sex, year, place = r.choice(["MALE", "FEMALE"]), r.randint(1960, 2000), f"Land{r.randint(0, 9)}"
        for k in range(3):  # two descriptions of one person, and another carrier
            mine = k < 2
            who = (sex, year, place) if mine else (r.choice(["MALE", "FEMALE"]), year + r.choice([-4, -3, 3, 4]), f"Land{r.randint(10, 19)}")
            pmid = f"{i}-{k}"
            papers.append((pmid, 2010 + k, [f"Author{i} A"], 1.0))
            rows.append((f"{i:03}-{k}", pmid, (who[0] if r.random() > 0.1 else None, who[2], (f"P{2010 + k - who[1]}Y",) if r.random() > 0.1 else None), [("GEN1", f"c.{3 * i + 1}A>T", None, None)], None, None))
        same.add((f"{i:03}-0", f"{i:03}-1"))
        other |= {(f"{i:03}-0", f"{i:03}-2"), (f"{i:03}-1", f"{i:03}-2")}
    ind = spark.createDataFrame([(a, b, (s, g, d, p)) for a, b, s, g, d, p in rows], f"record_id string, pmid string, record {RECORD}")
    docs = spark.createDataFrame(papers, "pmid string, pub_year int, authors array<string>, added_at double")
    got = {(x.record_a, x.record_b): x.confidence for x in entity_match.match(ind, docs).collect()}
    assert sum(got.get(p, 0) >= entity_match.CONFIDENT for p in same) >= 0.97 * len(same)
    assert sum(got.get(p, 0) >= entity_match.CONFIDENT for p in other) <= 0.03 * len(other)
    assert len({round(c, 3) for c in got.values()}) > 5


def test_repeated_descriptions_do_not_shift_the_confidences(spark):
    """The same records under other keys, eight times: persons described anew are still found, with the confidence they had."""
    r = random.Random(17)
    rows, papers, same = [], [], set()
    for i in range(80):
        sex, year, place = r.choice(["MALE", "FEMALE"]), r.randint(1960, 2000), f"Land{r.randint(0, 9)}"
        for k in range(3):  # two descriptions of one person, and another carrier
            who = (sex, year + k, place) if k < 2 else (r.choice(["MALE", "FEMALE"]), year + r.choice([-4, -3, 3, 4]), f"Land{r.randint(10, 19)}")
            texts = lambda: [("".join(r.choice("abcdefghij") for _ in range(12)),) for _ in range(3)]
            papers.append((f"{i}-{k}", 2010 + k, [f"Author{i} A", f"Other{i * 3 + k} B", f"Third{i * 3 + k} C"]))
            rows.append((f"{i:03}-{k}", f"{i}-{k}", (who[0], who[2], (f"P{2010 + k - who[1]}Y",)), [("GEN1", f"c.{3 * i + 1}A>T", None, None)], texts(), texts()))
        same.add((f"{i:03}-0", f"{i:03}-1"))

    def tables(copies):
        ind = spark.createDataFrame([(f"{a}/{n}", f"{b}/{n}", (s, g, d, p)) for n in range(copies) for a, b, s, g, d, p in rows], f"record_id string, pmid string, record {RECORD}")
        return ind, spark.createDataFrame([(f"{a}/{n}", y, x, 1.0) for n in range(copies) for a, y, x in papers], "pmid string, pub_year int, authors array<string>, added_at double")

    within = lambda df: {(x.record_a[:-2], x.record_b[:-2]): x for x in df.collect() if x.record_a[-2:] == x.record_b[-2:] == "/0"}
    one, many = (within(entity_match.match(*tables(n))) for n in (1, 8))
    assert one.keys() == many.keys() >= same and all(many[k].confidence == pytest.approx(one[k].confidence) for k in one)
    assert within(entity_match.found(*tables(8))).keys() == same


# -- problem 7 -------------------------------------------------------------------------------------------------------
def test_packer_fills_and_never_overflows():
    r = random.Random(7)
    sizes = [r.randint(0, 700) for _ in range(3000)]
    p, bins, pieces = packing.Packer(512, "b"), {}, {}
    for i, s in enumerate(sizes):
        for bin_, piece, n in p.assign(s):
            bins[bin_] = bins.get(bin_, 0) + n
            pieces.setdefault(i, []).append(n)
    assert max(bins.values()) <= 512 and all(sum(pieces[i]) == s for i, s in enumerate(sizes))
    assert all(len(v) == 1 for i, v in pieces.items() if sizes[i] <= 512)
    assert sum(bins.values()) / (512 * len(bins)) > 0.95


def test_packer_takes_the_least_sum_of_squares():
    """Against a plain search over all open bins and a new one."""
    r = random.Random(14)
    p, gaps = packing.Packer(40, "b"), {}
    squares = lambda g: sum(list(g.values()).count(x) ** 2 for x in set(g.values()) - {0})
    for _ in range(400):
        size = r.randint(1, 40)
        options = {n: squares({**gaps, n: gap - size}) for n, gap in gaps.items() if gap >= size}
        fresh = squares({**gaps, "new": 40 - size})
        n = p.place(size)
        after = squares({**gaps, n: gaps.get(n, 40) - size})
        assert after == min([fresh, *options.values()])
        gaps[n] = gaps.get(n, 40) - size
        assert gaps[n] >= 0


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files here")
def test_bins_left_by_tasks_are_packed_together(spark):
    d = spark.range(0, 64, 1, 16).select(F.col("id").alias("doc_id"), F.lit("word word word word").alias("text"))
    b = spark.createDataFrame([(1, 64)], "budget_id int, capacity_tokens int")
    x = packing.fill(packing.pack(d, b), b).first()
    assert (x.n_pieces, x.n_tokens, x.n_bins, x.fill) == (64, 256, 4, 1.0)


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files here")
def test_chunked_counts_equal_whole_ones(spark):
    c = packing.TokenCounter()
    r = random.Random(8)
    alphabet = ["a", "the", " ", "  ", "\n", "\n\n", "1", "99", "é", "мир", ".", ",", "'s", "　", "\t", " x"]
    for _ in range(500):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
        assert c.count(t) == len(c.encoding.encode_ordinary(t)), repr(t)
    d = spark.createDataFrame([(1, "word " * 3000), (2, None), (3, ""), (4, "short"), (4, "short"), (None, "x")], "doc_id bigint, text string").withColumn("tokens", F.lit(1))
    b = spark.createDataFrame([(1, 100), (2, 10_000), (3, 0), (None, 5)], "budget_id int, capacity_tokens int")
    got = packing.pack(d, b).collect()
    by = {}
    for x in got:
        by.setdefault((x.budget_id, x.doc_id), []).append(x.tokens)
    assert sum(by[1, 1]) == sum(by[2, 1]) == c.count("word " * 3000) and len(by[2, 1]) == 1 and by[1, 3] == [0] and len(by[1, 4]) == 2
    assert packing.pack(d, b.where("false")).count() == 0


# -- problem 8 -------------------------------------------------------------------------------------------------------
def test_leaks_against_brute_force(spark):
    r = random.Random(9)
    vocab = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(60))) for i in range(6)]
    docs, want = [], set()
    for n in range(60):
        i, ws = n % 6, items[n % 6][1].split()
        filler = lambda: [r.choice(vocab) + "z" for _ in range(r.randint(0, 50))]
        kind = n % 5
        if kind == 0:
            part, hit = ws[10:25], True
        elif kind == 1:
            part, hit = ws[10:24], False
        elif kind == 2:
            part, hit = [w if k % 9 else "changed" for k, w in enumerate(ws)], True
        elif kind == 3:
            part, hit = [w if k % 3 else "changed" for k, w in enumerate(ws)], False
        else:
            part, hit = [w.upper() + "," for w in ws], True
        docs.append((n, " ".join(filler() + part + filler())))
        if hit:
            want.add((n, i))
    d = spark.createDataFrame([*docs, (99, None), (100, ""), docs[0]], "doc_id bigint, text string").withColumn("item_id", F.lit(1))
    it = spark.createDataFrame([*items, (50, None), (51, "")], "item_id bigint, text string")
    assert {tuple(x) for x in leakage.found(d, it).collect()} == want
    assert leakage.found(d, it.where("false")).count() == 0 == leakage.found(d.where("false"), it).count()
    assert {x.doc_id for x in leakage.clean(d, it).collect()}.isdisjoint({n for n, _ in want})


def word_distance(item, text):
    """The least edit distance of the item to any stretch of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_items_of_every_length_against_brute_force():
    r = random.Random(10)
    vocab = [f"w{i}" for i in range(120)]
    for n in range(1, 61):
        item = [r.choice(vocab) for _ in range(n)]
        m = leakage.Matcher([(1, " ".join(item))])
        for changed in range(leakage.changes(n) + 3):
            for _ in range(6):
                ws = list(item)
                for at in r.sample(range(n), min(changed, n)):
                    ws[at] = r.choice(["", "other", "other more", ws[at] + "x"])
                text = " ".join([*(r.choice(vocab) for _ in range(r.randint(0, 9))), *ws, *(r.choice(vocab) for _ in range(r.randint(0, 9)))]).split()
                run = any(item[a : a + min(n, 15)] == text[b : b + min(n, 15)] for a in range(n - min(n, 15) + 1) for b in range(len(text)))
                want = run or word_distance(item, text) <= leakage.changes(n)
                assert bool(m.match(" ".join(text))) == want, (n, item, text)


def test_blocks_of_items_give_the_same_leaks(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(3 + i))) for i in range(30)]
    docs = [(i, f"before {items[i][1]} after") for i in range(30)]
    d, it = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {(i, i, "run") for i in range(30)}
    assert {tuple(x) for x in leakage.leaks(d, it).collect()} == want == {tuple(x) for x in leakage.leaks(d, it, block_bytes=1500).collect()}


def test_words_ignore_case_hyphenation_and_lookalikes():
    assert leakage.words("Un-\n  steady, O'Cl\u043eck 53.9 (x)") == leakage.words("unsteady O’clock 539 x")


# -- problem 9 -------------------------------------------------------------------------------------------------------
def test_subjects_of_generated_documents(spark):
    r = random.Random(11)
    topics = {s: [f"{s}{x}" for x in ("alpha", "beta", "gamma", "delta", "epsilon", "zeta")] for s in ("law", "sport", "food", "art", "sea", "war", "tax", "zoo")}
    rows, truth = [], {}
    for n in range(400):
        own = r.sample(sorted(topics), 1 if n % 3 else 2)
        text = " ".join(f"Notes on {r.choice(topics[s])} and {r.choice(topics[s])} were given." for _ in range(10) for s in own)
        rows.append((n, text + " She came back after a week.", "en" if n % 7 else None))
        truth[n] = set(own)
    labels = [(n, 1, s) for n in range(0, 400, 5) for s in truth[n]] + [(9999, 1, "law"), (1, 1, "unknown")]
    d = spark.createDataFrame([*rows, (500, None, "en"), (501, "", "en"), (502, "Nothing said here.", "en")], "doc_id bigint, text string, lang string").withColumn("subject", F.lit("clash"))
    s = spark.createDataFrame([(x, None if x == "food" else f"about {x}") for x in topics], "subject string, description string")
    lab = spark.createDataFrame(labels, "doc_id bigint, rater int, subject string")
    got = {}
    for x in subjects.found(d, s, lab).collect():
        got.setdefault(x.doc_id, set()).add(x.subject)
    assert sum(got.get(n) == t for n, t in truth.items()) / len(truth) > 0.97 and not {500, 501, 502} & set(got)
    assert subjects.found(d.where("false"), s, lab).count() == 0


def test_sums_hold_few_matrices_at_a_time(spark):
    """2,000 tasks: no group has more than `fan` matrices, and the total is right."""
    rows = spark.range(0, 4000, 1, 2000).select(F.array(F.lit(1)).alias("ids"), "id")
    part = lambda block: np.array([[len(block), block["id"].sum()]], dtype=np.float32)
    assert subjects._summed(rows, part, (1, 2)).tolist() == [[4000.0, 4000 * 3999 / 2]]
    assert subjects._summed(rows.where("false"), part, (1, 2)).tolist() == [[0.0, 0.0]]


def test_shards_of_the_given_lists_agree_row_by_row(spark):
    d = "/root/testdata/sf0.01"
    for table, field, entries, kind in (("measurements", "analyte_text", canon_map.analyte_entries(spark.read.parquet(f"{d}/analytes_builtin.parquet")), "analyte"), ("diagnoses", "disease_text", canon_map.disease_entries(spark.read.parquet(f"{d}/disease_aliases.parquet")), "disease")):
        v = spark.read.parquet(f"{d}/{table}.parquet").select(F.col("fact_id").alias("row_key"), F.col(field).alias("text")).distinct()
        whole, cut = ({tuple(r) for r in canon_map.map_to_list(v, entries, kind, shard_bytes=n).collect()} for n in (1 << 20, 1500))
        assert whole == cut and len(whole) == v.where("text is not null").count()
