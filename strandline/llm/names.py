"""Problem 4: variant spellings of names of people and institutions (noisy-channel attribution).

Distinct strings are counted over all documents and read into (family name or city, first initial or kind of institution,
further initials). Every reading that occurs is a candidate canonical form with the frequency of its spellings as prior;
plain indexing style ("Surname AB") counts in full, other styles less. A variant meets candidates through single-deletion
keys of the family name (or city) joined with the first initial (or kind), so one typo of any sort is found exactly, without
comparing all pairs; in short names a typo counts as less likely. log prior + log likelihood of the typo, of dropped initials and of the reading gives the posterior;
each variant goes to its maximum, and candidates that themselves are variants pass their members on, along chains of any length.

Cases: null arrays, null and empty names give nothing; groups of people ("et al.", study groups) are no persons; names without
a readable family name are their own reading (letters only), so they meet what differs in case, accents and punctuation or by one
typo, and no name is left out; institutions of no listed kind are read by all their words; ties go to the smaller candidate; repeated
names count as frequency; extra columns are ignored; names of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.lookalike import fold, strip_accents
from ..session import materialise

TYPO, DROPPED, ADDED, OTHER_STYLE, OWN_LETTER = 0.8, 0.3, 0.1, 0.5, 0.2
# Where neither comma nor initials tell the order of the parts; such a reading lends its form next to no prior.
AMBIGUOUS = 0.05
# Below so many letters another name is as near as a typo; only a far more frequent one takes the variant.
MIN_TYPO_LENGTH, SHORT_TYPO = 6, 0.02

# Common short forms of given names and the names they stand for.
NICKNAMES = {
    "abby": "abigail", "al": "albert alexander alan", "alex": "alexander alexandra", "andy": "andrew", "annie": "anne anna", "barb": "barbara", "becky": "rebecca", "bella": "isabella", "ben": "benjamin", "bernie": "bernard", "bert": "albert robert herbert", "beth": "elizabeth", "betty": "elizabeth", "bill": "william",
    "billy": "william", "bob": "robert", "bobby": "robert", "beppe": "giuseppe", "cathy": "catherine", "charlie": "charles", "chris": "christopher christina", "chuck": "charles", "cindy": "cynthia", "connie": "constance", "curt": "curtis", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah",
    "dick": "richard", "don": "donald", "dora": "dorothea theodora", "dot": "dorothy", "dottie": "dorothy", "doug": "douglas", "ed": "edward edmund", "eddie": "edward", "ella": "eleanor", "ellie": "eleanor", "fran": "frances francisco", "frank": "francis franklin", "fred": "frederick alfred", "gene": "eugene", "gerry": "gerald",
    "gigi": "luigi", "greg": "gregory", "gus": "august gustav", "hal": "harold henry", "hank": "henry", "harry": "harold henry", "hans": "johannes", "hansi": "johannes", "ike": "isaac", "jack": "john", "jake": "jacob", "jan": "johannes janet", "jeff": "jeffrey", "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald jerome", "jim": "james", "jimmy": "james",
    "joe": "joseph", "joey": "joseph", "johnny": "john", "jon": "jonathan", "josh": "joshua", "judy": "judith", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "ken": "kenneth", "kim": "kimberly", "larry": "lawrence", "lena": "helena magdalena", "leo": "leonard leopold", "lisa": "elizabeth", "liz": "elizabeth", "lou": "louis louise",
    "maggie": "margaret", "mandy": "amanda", "marge": "margaret", "matt": "matthew", "meg": "margaret", "mick": "michael", "mike": "michael", "mitch": "mitchell", "molly": "mary", "nan": "anne nancy", "nancy": "anne", "nate": "nathan", "ned": "edward", "nell": "eleanor", "nick": "nicholas", "nicky": "nicole nicholas", "nina": "antonina",
    "paco": "francisco", "pancho": "francisco", "pat": "patrick patricia", "patty": "patricia", "peggy": "margaret", "pepe": "jose", "pete": "peter", "phil": "philip", "polly": "mary", "ray": "raymond", "rich": "richard", "rick": "richard", "rob": "robert", "ron": "ronald", "sally": "sarah", "sam": "samuel samantha", "sandy": "alexander sandra",
    "sascha": "alexander", "sasha": "alexander alexandra", "sepp": "josef joseph", "steve": "stephen steven", "sue": "susan susanna", "susie": "susan susanna", "ted": "theodore edward", "terry": "terence theresa", "thea": "dorothea theodora", "tim": "timothy", "tina": "christina martina", "toby": "tobias", "tom": "thomas", "toni": "antonia anton",
    "tony": "anthony antonio", "trudy": "gertrude", "uli": "ulrich ulrike", "val": "valerie", "vanya": "ivan ivanka", "vera": "veronica", "vic": "victor", "vicky": "victoria", "walt": "walter", "wendy": "gwendolyn", "will": "william", "willi": "wilhelm", "zach": "zachary",
}
# Particles that belong to the family name, titles and degrees that don't.
PARTICLES = {"van", "von", "de", "der", "den", "del", "della", "di", "da", "la", "le", "du", "dos", "ter", "zu", "al", "el", "bin", "ibn"}
TITLES = ("Dr", "DR", "Prof", "PROF", "Professor", "Mr", "Mrs", "Sir", "Dame", "PhD", "Ph.D", "PHD")
DEGREES = ("MD", "MSc", "MPH", "DPhil", "BSc", "MA", "MS", "MBBS", "FRCP", "RN", "Jr", "Sr", "PhD")
_GROUP = re.compile(r"\bet al\b|\bgroup\b|\bconsorti|\bcollaborat|\binvestigators\b|\bnetwork\b|\bteam\b|\bcommittee\b|\bsociety\b|\bon behalf\b|\bstudy\b|\bothers\b|\bregistry\b", re.I)
# Degrees that could be initials count only behind a comma.
_TITLE = re.compile(rf"(?:^|(?<=[\s,]))(?:{'|'.join(map(re.escape, TITLES))})\.?(?=$|[\s,])|(?<=,)\s*(?:{'|'.join(DEGREES)})\.?(?=$|,)")


def plain(text: str) -> str:
    return re.sub(r"[^a-z]+", "", strip_accents(fold(text)).lower())


def _firsts(given: str) -> list[tuple[str, float]]:
    """Possible first initials of a given name with their likelihoods."""
    g = plain(given)
    if not g:
        return []
    formal = {f[0] for f in NICKNAMES.get(g, "").split()}
    out = [(c, 1.0) for c in sorted(formal)]
    if g[0] not in formal:
        out.append((g[0], OWN_LETTER if formal else 1.0))
    return out


def _person(family: list[str], given: list[str], weight: float) -> list[tuple[str, str, str, float]]:
    words = [w for w in family if w.lower() not in PARTICLES]
    fam = plain("".join(words or family))
    if len(fam) < 2 or not given:
        return []
    rest = "".join(plain(g)[:1] for g in given[1:])
    out = [(fam, first, rest, weight * p) for first, p in _firsts(given[0])]
    for particle in ("van", "von"):  # the particle written as one word with the name
        if fam.startswith(particle) and len(fam) > len(particle) + 4:
            out += [(fam[len(particle) :], first, rest, weight * p * 0.3) for first, p in _firsts(given[0])]
    return out


def read_author(name: str) -> list[tuple[str, str, str, float]]:
    """Readings of a person's name: (family name, first initial, further initials, weight); none for groups."""
    t = re.sub(r"\s+", " ", fold(name)).strip()
    if _GROUP.search(t):
        return []
    t = re.sub(r"\s*,\s*,\s*|^\s*,|,\s*$", " ", _TITLE.sub("", t)).strip(" ,;")
    t = re.sub(r"\s+", " ", t)
    if not t:
        return []
    if "," in t:
        family, _, given = t.partition(",")
        given = given.replace(",", " ").strip()
        fam = family.split()
        if re.fullmatch(r"(?:[A-ZÀ-Þ]\.?\s?-?){1,4}", given):
            return _person(fam, re.findall(r"[A-ZÀ-Þ]", given), 1.0)
        gs = [g for g in re.split(r"[\s.]+", given) if g and g.lower() not in PARTICLES]
        return _person(fam, gs, OTHER_STYLE)
    ws = [w for w in t.split(" ") if w]
    core = [w for i, w in enumerate(ws) if not (w.lower() in PARTICLES and (w.islower() or i + 1 < len(ws))) and not w.islower()]
    if len(core) < 2:
        return []
    last, first = core[-1], core[0]
    if re.fullmatch(r"[A-ZÀ-Þ]{1,3}", last) and len(core) >= 2 and (len(core[0]) > 3 or not re.fullmatch(r"[A-ZÀ-Þ]{1,3}", core[0])):
        return _person(core[:-1], list(last), 1.0)  # Surname AB
    if all(re.fullmatch(r"(?:[A-ZÀ-Þ]\.?-?){1,3}", w) for w in core[:-1]):
        return _person([last], [c for w in core[:-1] for c in re.findall(r"[A-ZÀ-Þ]", w)], 1.0)  # A. B. Surname
    if all(re.fullmatch(r"(?:[A-ZÀ-Þ]\.-?){1,3}", w) for w in core[1:]):
        return _person([first], [c for w in core[1:] for c in re.findall(r"[A-ZÀ-Þ]", w)], 1.0)  # Surname A. B.
    middle = [w for w in core[1:-1]]
    out = _person([last], [first, *middle], AMBIGUOUS)  # Given M. Surname
    out += _person([first], [last, *middle], AMBIGUOUS / 2)  # Surname Given
    return out


# How kinds of institutions are written (in several languages and abbreviated).
INSTITUTIONS = (
    ("metabolic_institute", r"institut(?:e)? (?:of|for) metabolic research|inst metab(?:olic)? res(?:earch)?|institut fur stoffwechselforschung|imr|institut de recherche metabolique|instituto de investigacion metabolica"),
    ("medical_faculty", r"(?:faculty of medicine|fac(?:ulty)? (?:of )?med(?:icine)?)(?: of)?(?: the)? univ(?:ersity)?(?: of)?|univ(?:ersity)?(?: of)? (?P<a>[a-z]+) (?:medical faculty|faculty of medicine|med fac|fac med)|(?P<b>[a-z]+) univ(?:ersity)? (?:medical faculty|faculty of medicine|med fac|fac med)|medizinische fakultat der universitat|faculte de medecine(?: de l universite)?(?: de)?|facultad de medicina(?: de la universidad)?(?: de)?|faculty of medicine|medical faculty"),
    ("childrens_hospital", r"children ?s? hosp(?:ital)?(?: of)?|hopital des enfants(?: de)?|kinderspital|kinderkrankenhaus|hospital infantil(?: de)?|ch"),
    ("university_hospital", r"univ(?:ersity)? hosp(?:ital)?(?: of)?|universitatsklinikum|universitatsspital|hopital universitaire(?: de)?|hospital universitario(?: de)?|centre hospitalier universitaire(?: de)?|uh|chu"),
    ("university", r"university of|univ(?:ersity)?(?: of)?|universitat|universite(?: de)?|universidad(?: de)?"),
    ("institute", r"institut(?:e)?(?: of| for| fur| de)?|inst"),
    ("hospital", r"hosp(?:ital)?(?: of| de)?|hopital(?: de)?|klinikum|clinic|clinique"),
)
_KINDS = [(k, re.compile(rf"(?<![a-z])(?:{p})(?![a-z])")) for k, p in INSTITUTIONS]
_UNIT = re.compile(r"^(?:dep(?:t|artment|\.)|div(?:ision|\.)?\b|lab(?:oratory|\.)?\b|unit\b|section\b|service\b|abteilung\b|departamento\b|departement\b|chair\b|ward\b|centre for\b|center for\b)", re.I)


def read_affiliation(name: str) -> list[tuple[str, str, str, float]]:
    """Readings of an institution: (city or proper name, kind, '', weight); the address' city is a second, lighter one."""
    t = strip_accents(fold(name)).lower()
    segments = [s.strip(" .;") for s in t.split(",")]
    kept = [s for s in segments if s and not _UNIT.match(s)]
    words = [re.sub(r"[^a-z]+", " ", s.replace("'", "").replace("’", "")).strip() for s in kept]
    joined = " , ".join(words)
    flat = re.sub(r"\s+", " ", joined.replace(" , ", " "))
    for kind, rx in _KINDS:
        m = rx.search(flat)
        if not m:
            continue
        inside = next((m[g] for g in ("a", "b") if g in m.re.groupindex and m[g]), None)
        left = rx.sub(" , ", " , ".join(words)) if not inside else joined
        if inside is None and rx.search(joined) is None:  # the kind spans two segments
            left = flat[: m.start()] + " , " + flat[m.end() :]
        names = [w for w in re.split(r"[\s,]+", left) if len(w) > 2 and w not in ("the", "and", "der", "des", "for", "faculty", "medicine", "university", "medical", "univ", "fac", "med", "of", "hospital")]
        if inside and len(inside) > 2:
            names = [inside, *names]
        if not names:
            return []
        out = [(names[0], kind, "", 1.0)]
        if len(names) > 1 and names[1] != names[0] and abs(len(names[1]) - len(names[0])) <= 1 and len(set(names[1]) ^ set(names[0])) <= 3:
            out.append((names[1], kind, "", 0.9))
        return out
    return []


def read_whole(name: str) -> list[tuple[str, str, str, float]]:
    """The reading of a name that no pattern reads: all its letters (an address' departments aside), or the text itself."""
    t = strip_accents(fold(name)).lower()
    kept = [s for s in (x.strip(" .;") for x in t.split(",")) if s and not _UNIT.match(s)] or [t]
    letters = re.sub(r"[\W_]+", "", kept[0])
    return [(letters or name, "whole", "", 1.0)]


_READ = {
    "author": lambda name: read_author(name) or ([] if _GROUP.search(name) else read_whole(name)),
    "affiliation": lambda name: read_affiliation(name) or read_whole(name),
}
_SCHEMA = "kind string, name string, n bigint, fuzzy string, first string, rest string, weight double"


def given_of(name: str) -> str:
    """The given name of "Surname, Given", as evidence that the word is one."""
    family, comma, given = fold(name).partition(",")
    g = plain((_TITLE.sub("", given).split() or [""])[0])
    return g if comma and len(g) > 3 and "." not in given and family.strip() and len(family.split()) <= 2 and not _GROUP.search(name) else ""


def _read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        out = [(k, name, n, *r) for k, name, n in zip(pdf["kind"], pdf["name"], pdf["n"], strict=True) for r in _READ[k](name)]
        out += [("given", name, n, g, "", "", 0.0) for k, name, n in zip(pdf["kind"], pdf["name"], pdf["n"], strict=True) if k == "author" and (g := given_of(name))]
        yield pd.DataFrame(out, columns=["kind", "name", "n", "fuzzy", "first", "rest", "weight"])


_ID = ["kind", "fuzzy", "first", "rest"]


def _keys(col: str = "fuzzy"):
    """The text itself and each form with one letter deleted."""
    c = F.col(col)
    cut = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))
    return F.array_distinct(F.concat(F.array(c), cut))


def _settle(attached: DataFrame) -> DataFrame:
    """`attached(…, to_fuzzy, to_rest)` followed to the ends of its chains by pointer doubling, written between rounds.

    Every step but one to itself leads to a form of a greater prior, so there are no circles.
    """
    top = attached
    while True:
        hop = top.select("kind", F.col("fuzzy").alias("to_fuzzy"), "first", F.col("rest").alias("to_rest"), F.col("to_fuzzy").alias("n_fuzzy"), F.col("to_rest").alias("n_rest"))
        moved = (F.col("n_fuzzy") != F.col("to_fuzzy")) | (F.col("n_rest") != F.col("to_rest"))
        top = top.join(hop, ["kind", "first", "to_fuzzy", "to_rest"]).select(*_ID, F.col("n_fuzzy").alias("to_fuzzy"), F.col("n_rest").alias("to_rest"), moved.alias("moved"))
        top = materialise(top, "settled")
        if top.where("moved").isEmpty():
            return top.drop("moved")
        top = top.drop("moved")


def spellings(documents: DataFrame) -> DataFrame:
    """(kind, name, n): distinct strings and how often each occurs, over all documents."""
    parts = [documents.select(F.lit(kind).alias("kind"), F.explode(field).alias("name")) for kind, field in (("author", "authors"), ("affiliation", "affiliations"))]
    return parts[0].unionByName(parts[1]).where("trim(name) <> ''").groupBy("kind", "name").agg(F.count("*").alias("n"))


def attribute(names: DataFrame) -> DataFrame:
    """`names(kind, name, n)` → `(kind, name, n, entity)`; `entity` is the canonical form's frequent spelling."""
    raw = materialise(names.mapInPandas(_read, _SCHEMA), "raw-readings")
    # Of the two orders of an ambiguous name, the one whose family name is known only as a given name is dropped.
    given = raw.where("kind = 'given'").groupBy("fuzzy").agg(F.count("*").alias("as_given"))
    family = raw.where((F.col("kind") == "author") & (F.col("weight") > 2 * AMBIGUOUS)).groupBy("fuzzy").agg(F.count("*").alias("as_family"))
    known = given.join(family, "fuzzy", "left").where("as_family is null or as_family < as_given").select("fuzzy", F.lit("author").alias("kind"), F.lit(True).alias("is_given"))
    raw = raw.where("kind <> 'given'").join(known, ["kind", "fuzzy"], "left")
    readings = materialise(raw.where((F.col("weight") > AMBIGUOUS) | F.col("is_given").isNull()).drop("is_given"), "readings")
    prior = F.coalesce(F.sum(F.when(F.col("weight") > AMBIGUOUS, F.col("n") * F.col("weight"))), F.lit(0.0)) + F.max("weight") * AMBIGUOUS
    best_spelling = F.max_by("name", F.struct(F.col("n") * F.col("weight"), "name")).alias("spelling")
    forms = materialise(readings.groupBy(*_ID).agg(prior.alias("prior"), best_spelling), "forms")
    keyed = forms.withColumn("key", F.explode(_keys()))
    c = keyed.select("kind", "key", "first", *[F.col(x).alias(f"c_{x}") for x in ("fuzzy", "rest", "prior", "spelling")])
    met = keyed.drop("spelling", "prior").join(c, ["kind", "key", "first"]).drop("key").distinct()
    d = F.levenshtein("fuzzy", "c_fuzzy", 2)
    swap = (F.length("fuzzy") == F.length("c_fuzzy")) & (F.array_sort(F.split("fuzzy", "")) == F.array_sort(F.split("c_fuzzy", "")))
    typo = F.when(d == 0, 0.0).when((d == 1) | ((d == 2) & swap), F.log(F.when(F.greatest(F.length("fuzzy"), F.length("c_fuzzy")) < MIN_TYPO_LENGTH, SHORT_TYPO).otherwise(TYPO)))
    rest = (
        F.when(F.col("rest") == F.col("c_rest"), 0.0)
        .when(F.startswith("c_rest", "rest"), F.log(F.lit(DROPPED)))
        .when(F.startswith("rest", "c_rest"), F.log(F.lit(ADDED)))
    )
    scored = met.withColumn("score", F.log("c_prior") + typo + rest).where("score is not null")
    # `levenshtein` with a threshold gives -1 beyond it, which is neither 0, 1 nor 2.
    best = scored.groupBy(*_ID).agg(F.max(F.struct("score", "c_prior", F.col("c_fuzzy").alias("f"), F.col("c_rest").alias("r"), "c_spelling")).alias("b"))
    best = materialise(best.select(*_ID, F.col("b.score").alias("score"), F.col("b.f").alias("to_fuzzy"), F.col("b.r").alias("to_rest")), "attached")
    # Candidates that are variants themselves pass their members on.
    top = _settle(best.select(*_ID, "to_fuzzy", "to_rest"))
    entity = forms.select("kind", F.col("fuzzy").alias("to_fuzzy"), "first", F.col("rest").alias("to_rest"), F.col("spelling").alias("entity"))
    top = top.join(entity, ["kind", "first", "to_fuzzy", "to_rest"]).select(*_ID, "entity", F.col("to_fuzzy"), F.col("to_rest"))
    chosen = readings.join(best.select(*_ID, "score"), _ID).join(top, _ID)
    chosen = chosen.groupBy("kind", "name", "n").agg(F.max(F.struct((F.col("score") + F.log("weight")).alias("s"), "entity", "first", "to_fuzzy", "to_rest")).alias("b"))
    return chosen.select("kind", "name", "n", F.concat_ws("|", "b.to_fuzzy", "b.first", "b.to_rest").alias("entity_key"), F.col("b.entity").alias("entity"))


def found(documents: DataFrame) -> DataFrame:
    """(kind, name_a, name_b) of every two different spellings of one person or institution."""
    a = materialise(attribute(spellings(documents)).select("kind", "name", "entity_key"), "attributed")
    b = a.select("kind", "entity_key", F.col("name").alias("name_b"))
    return a.withColumnRenamed("name", "name_a").join(b, ["kind", "entity_key"]).where("name_a < name_b").select("kind", "name_a", "name_b")


def entities(documents: DataFrame) -> DataFrame:
    """(kind, entity, n_spellings, n_mentions), one row per person or institution."""
    return attribute(spellings(documents)).groupBy("kind", "entity_key").agg(F.first("entity").alias("entity"), F.count("*").alias("n_spellings"), F.sum("n").alias("n_mentions")).drop("entity_key")
