"""Problem 3: deeply nested records as flat tables that keep parent-child links.

Single-pass tagged emission: a depth-first visitor walks each record once and emits one row per object, tagged with the
dotted path it stands at, with its scalar fields as payload, and one row per scalar that is an array's element. Where the record
is a struct, the visitor is compiled from its schema into one expression (no Python worker); JSON text, whose shape varies, is
visited in Arrow batches. The emission
is written once to the shared folder, partitioned by tag when tables are wanted; typed schemas are applied on reading.

Tables: the root (`record`, `phenopacket`), every array of objects and every array of scalars (field `value`). An object that
is an array's element belongs to that array's table; a single object's fields are columns of the nearest row above, prefixed
by its path (`evidence_quote`, `reference_range_low`). What has no column, or doesn't fit its column's type, stands in `other`
(JSON), so no field is lost; only null elements and empty objects and arrays leave nothing.

In the phenopacket a single object that stands where other records have an array is element 0 of it; which paths are array
places is read off the emission itself (a join on the path, no collect), so the records need no second visit. `raw` holds one
token per path segment on the way: the indices in the arrays passed (`2`, or `2/0` for arrays of arrays) or `~` for a single
object.

Cases: null and empty records, null elements (no row, index kept), elements that aren't objects (no row in `found`), text that
is no valid JSON or cut off (no rows), JSON within a JSON string (read as JSON), repeated records (one row per object), records
of one id with different contents (kept apart by `version`), objects below objects at any depth (nesting deeper than the JSON
parser's stack is read by an iterative one); other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialise, scratch

EMITTED = "record_id string, version bigint, tag string, raw string, kind string, payload string"
ROW = "record_id string, version bigint, pos string, parent_path string, parent_pos string, payload string, tag string"
MAX_PATHS = 100_000
# Stands before every key of a payload on the way, for the prefix (a control character, escaped as JSON does); and for a dot within
# a field's name.
CONTROL, MARK, DOT = "\x01", "\\u0001", "\x02"


_TOKEN = re.compile(r"[ \t\n\r]*(?:([{}\[\]:,])|(\")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?|NaN|-?Infinity)|(true|false|null))")


def _deep(text: str):
    """A JSON text of any depth, with an explicit stack; raises ValueError like the library's parser."""
    stack: list[tuple] = []  # (container, key that waits for its value)
    at, key, here, want = 0, None, None, "value"
    while True:
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"no JSON at {at}")
        at, mark = m.end(), m[1]
        if m[2]:
            value, at = scanstring(text, at, True)
            if want == "key" or want == "first key":
                key, want = value, "colon"
                continue
        elif m[3]:
            value = json.loads(m[3])
        elif m[4]:
            value = {"true": True, "false": False, "null": None}[m[4]]
        elif mark == ":" and want == "colon":
            want = "value"
            continue
        elif mark == "," and want == "more":
            want = "key" if isinstance(here, dict) else "value"
            continue
        elif mark in "{[" and want in ("value", "first value"):
            stack.append((here, key))
            here, key = ({} if mark == "{" else []), None
            want = "first key" if mark == "{" else "first value"
            continue
        elif (mark == "}" and isinstance(here, dict) and want in ("first key", "more")) or (mark == "]" and isinstance(here, list) and want in ("first value", "more")):
            value = here
            here, key = stack.pop()
            want = "value"
        else:
            raise ValueError(f"unexpected {mark!r} at {at}")
        if want not in ("value", "first value"):
            raise ValueError(f"unexpected value at {at}")
        if here is None:
            if text[at:].strip(" \t\n\r"):
                raise ValueError(f"extra data at {at}")
            return value
        if isinstance(here, dict):
            here[key] = value
        else:
            here.append(value)
        want = "more"


def _parse(text: str):
    try:
        return json.loads(text)
    except RecursionError:
        return _deep(text)


def _loads(text: str):
    """The JSON value of a text, also where it is wrapped in JSON strings; None if it is no valid JSON."""
    try:
        value = _parse(text.lstrip("\ufeff"))
        while isinstance(value, str):
            value = _parse(value)
        return value
    except ValueError:
        return None


def _inner(x):
    """The object or array that a text holds as JSON, else the value itself."""
    if isinstance(x, str) and len(x) > 1 and x[0] in '{["':
        inner = _loads(x)
        return inner if isinstance(inner, (dict, list)) else x
    return x


def _members(fields: dict) -> str:
    """Members of a JSON object, values as text, each key marked for its prefix."""
    text = {k: v if v is None or isinstance(v, str) else json.dumps(v) for k, v in fields.items()}
    return ", ".join(f'"{MARK}{json.dumps(k)[1:-1]}": {json.dumps(v)}' for k, v in text.items())


def visit(root: str, value, payload: bool, singles: bool, whole: bool) -> list[tuple]:
    """Depth-first emission of one value: (tag, raw, kind, payload); kind is element, single or (if `whole`) value.

    `singles`: single objects may be elements of arrays, and texts may hold JSON. `whole`: the root and scalar elements too.
    """
    out: list[tuple] = []
    stack = [(value, root, "", None)]  # (value, path, tokens above, index within the current field or None)
    while stack:
        v, path, up, index = stack.pop()
        if isinstance(v, dict):
            token = "~" if index is None else index
            here = f"{up}.{token}" if up else token
            fields = {}
            for k, x in v.items():
                x = _inner(x) if singles else x
                if isinstance(x, (dict, list)):
                    stack.append((x, f"{path}.{k.replace('.', DOT)}", here, None))
                elif payload:
                    fields[k] = x
            if index is not None or (whole if path == root else singles or payload):
                out.append((path, here, "single" if index is None else "element", _members(fields) if payload else None))
        else:
            for i, x in enumerate(v):
                x = _inner(x) if singles else x
                at = str(i) if index is None else f"{index}/{i}"
                if isinstance(x, (dict, list)):
                    stack.append((x, path, up, at))
                elif whole and x is not None:
                    out.append((path, f"{up}.{at}" if up else at, "value", _members({"value": x}) if payload else None))
    return out


_EMPTY = "array<struct<tag:string,raw:string,kind:string,payload:string>>"


def _payload(fields: list[Column]) -> Column:
    """The given fields (texts, aliased by `_marked`) as members of a JSON object, nulls left out."""
    if not fields:
        return F.lit("")
    return F.trim(F.to_json(F.struct(*fields)), F.lit("{}"))  # members begin and end with a quote, so only the braces go


def _marked(c: Column, name: str) -> Column:
    """A scalar as text under its marked name."""
    return c.cast("string").alias(CONTROL + name)


def _row(path: str, raw: Column, kind: str, payload: Column | None) -> Column:
    text = payload if payload is not None else F.lit(None).cast("string")
    return F.struct(F.lit(path).alias("tag"), raw.alias("raw"), F.lit(kind).alias("kind"), text.alias("payload"))


def compiled(c: Column, kind: T.StructType, path: str, raw: Column, element: bool, payload: bool, whole: bool, root: bool = False) -> Column:
    """`visit` for a struct of known schema, as one expression: an array of (tag, raw, kind, payload)."""
    nested = (T.StructType, T.ArrayType)
    parts = []
    if element or (whole if root else payload):
        members = _payload([_marked(c[f.name], f.name) for f in kind if not isinstance(f.dataType, nested)]) if payload else None
        parts.append(F.array(_row(path, raw, "element" if element else "single", members)))
    for f in kind:
        below = f"{path}.{f.name.replace('.', DOT)}"
        x = c[f.name]
        if isinstance(f.dataType, T.StructType):
            one = compiled(x, f.dataType, below, F.concat(raw, F.lit(".~")), False, payload, whole)
            parts.append(F.when(x.isNotNull(), one).otherwise(F.array().cast(_EMPTY)))
        elif isinstance(f.dataType, T.ArrayType):
            parts += _compiled_array(x, f.dataType.elementType, below, raw, None, payload, whole)
    return F.concat(*parts) if parts else F.array().cast(_EMPTY)


def _compiled_array(x: Column, kind: T.DataType, path: str, up: Column, index: Column | None, payload: bool, whole: bool) -> list[Column]:
    def each(v: Column, i: Column) -> Column:
        at = i.cast("string") if index is None else F.concat(index, F.lit("/"), i.cast("string"))
        if isinstance(kind, T.StructType):
            rows = compiled(v, kind, path, F.concat(up, F.lit("."), at), True, payload, whole)
        elif isinstance(kind, T.ArrayType):
            rows = F.concat(*(_compiled_array(v, kind.elementType, path, up, at, payload, whole) or [F.array().cast(_EMPTY)]))
        else:
            rows = F.array(_row(path, F.concat(up, F.lit("."), at), "value", _payload([_marked(v, "value")]) if payload else None))
        return F.when(v.isNotNull(), rows).otherwise(F.array().cast(_EMPTY))

    if not isinstance(kind, (T.StructType, T.ArrayType)) and not whole:
        return []
    return [F.coalesce(F.flatten(F.transform(x, each)), F.array().cast(_EMPTY))]


def _emitter(payload: bool, whole: bool):
    columns = [c.split()[0] for c in EMITTED.split(", ")]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for rid, version, root, text in zip(pdf["record_id"], pdf["version"], pdf["root"], pdf["text"], strict=True):
                value = _loads(text)
                if isinstance(value, (dict, list)):
                    rows += [(rid, version, *x) for x in visit(root, value, payload, root == "phenopacket", whole)]
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    return run


def emit(individuals: DataFrame, payload: bool = True, whole: bool = True, root: str | None = None) -> DataFrame:
    """Tagged emission of `record` (struct or JSON text) and `phenopacket` (JSON text), or of `root` alone, of every row with a record
    id."""
    parts = []
    for name in ("record", "phenopacket"):
        if root not in (None, name):
            continue
        kind = individuals.schema[name].dataType
        x = individuals.where(F.col("record_id").isNotNull() & F.col(name).isNotNull()).select("record_id", F.xxhash64(name).alias("version"), F.col(name).alias("v"))
        if isinstance(kind, T.StructType):
            x = x.select("record_id", "version", F.explode(compiled(F.col("v"), kind, name, F.lit("~"), False, payload, whole, True)).alias("e"))
            parts.append(x.select("record_id", "version", "e.tag", "e.raw", "e.kind", "e.payload"))
        else:
            parts.append(x.select("record_id", "version", F.lit(name).alias("root"), F.col("v").alias("text")).mapInPandas(_emitter(payload, whole), EMITTED))
    return reduce(DataFrame.unionByName, parts)


def resolve(emitted: DataFrame, of: str = "true") -> DataFrame:
    """Emission with final positions: in the phenopacket single objects at array places become element 0; the other single
    objects belong to the nearest row above. Reads `emitted` twice, so hand in a written one; only rows that satisfy `of` are resolved.

    `(record_id, version, path, pos, parent_path, parent_pos, is_row, is_value, prefix, payload)`: the row an emitted object
    belongs to, that row's parent (null for a root), and the prefix of the object's fields in that row.
    """
    arrays = emitted.where("kind = 'element' and tag not like 'record%'").select(F.col("tag").alias("prefix")).distinct()
    paths = emitted.select("tag").distinct()
    # For each path: which of its field prefixes are array places (a few hundred paths; joined, never collected).
    prefixes = paths.select("tag", F.posexplode(F.expr("transform(sequence(1, size(split(tag, '[.]'))), n -> array_join(slice(split(tag, '[.]'), 1, n), '.'))")).alias("i", "prefix"))
    # A root that is no array's element stays the root, also where others are arrays.
    place = F.when(F.col("i") > 0, F.coalesce("is_array", F.lit(False))).otherwise(False)
    masks = prefixes.join(arrays.withColumn("is_array", F.lit(True)), "prefix", "left").groupBy("tag").agg(F.array_sort(F.collect_list(F.struct("i", place.alias("a"))))["a"].alias("mask"))
    # The emission is small on disk and large in memory: left to its estimate the optimiser may send it instead of the paths.
    masks = F.broadcast(masks) if paths.count() <= MAX_PATHS else masks.hint("merge")
    rows = emitted.where(of).join(masks, "tag").withColumns({"tokens": F.split("raw", "[.]"), "names": F.split("tag", "[.]")})
    # Levels of the path that have an index; the last is the row's, the one before its parent's.
    rows = rows.withColumn("levels", F.expr("filter(sequence(1, size(tokens)), i -> tokens[i - 1] <> '~' or mask[i - 1])"))
    rows = rows.withColumn("at", F.expr("coalesce(array_max(levels), 0)")).withColumn("up", F.expr("coalesce(array_max(filter(levels, i -> i < at)), 0)"))
    has_parent = "at > 0 and (up > 0 or tokens[0] = '~')"
    path = "translate(array_join(slice(names, 1, greatest({0}, 1)), '.'), '\x02', '.')"
    pos = "translate(array_join(transform(filter(levels, i -> i <= {0}), i -> if(tokens[i - 1] = '~', '0', tokens[i - 1])), '.'), '/', '.')"
    return rows.select(
        "record_id", "version", F.expr(path.format("at")).alias("path"), F.expr(pos.format("at")).alias("pos"),
        F.expr(f"if({has_parent}, {path.format('up')}, null)").alias("parent_path"), F.expr(f"if({has_parent}, {pos.format('up')}, null)").alias("parent_pos"),
        F.expr("greatest(at, 1) = size(tokens)").alias("is_row"), F.expr("kind = 'value'").alias("is_value"),
        F.expr("translate(array_join(transform(slice(names, greatest(at, 1) + 1, size(names)), x -> concat(x, '.')), ''), '\x02', '.')").alias("prefix"), "payload",
    )


_KEY = ["record_id", "version", "path", "pos", "parent_path", "parent_pos"]


def found(individuals: DataFrame) -> DataFrame:
    """(record_id, path, pos) of every object that is an array's element, at any depth."""
    emitted = materialise(emit(individuals, whole=False), "emission")
    # In the record single objects are never elements, so an element's indices are its tokens without those of single objects; only
    # the phenopacket's places have to be resolved.
    plain = emitted.where("kind = 'element' and tag like 'record%'").selectExpr("record_id", "translate(tag, '\x02', '.') as path", "translate(replace(raw, '~.', ''), '/', '.') as pos")
    placed = resolve(emitted, "tag not like 'record%'").where("is_row").select("record_id", "path", "pos")
    return plain.unionByName(placed).distinct()


def links(individuals: DataFrame) -> DataFrame:
    """Per pair of child and parent table: rows, records and rows without their parent row (always 0). Roots have no parent."""
    rows = materialise(resolve(materialise(emit(individuals, payload=False), "emission")).where("is_row").select(*_KEY).distinct(), "resolved")
    up = rows.select("record_id", "version", F.col("path").alias("parent_path"), F.col("pos").alias("parent_pos"), F.lit(1).alias("there"))
    joined = rows.join(up, ["record_id", "version", "parent_path", "parent_pos"], "left")
    lost = F.col("parent_path").isNotNull() & F.col("there").isNull()
    return joined.groupBy("path", "parent_path").agg(F.count("*").alias("n_rows"), F.countDistinct("record_id").alias("n_records"), F.count_if(lost).alias("n_orphans"))


def merge(resolved: DataFrame) -> DataFrame:
    """One row per row of any table, with the fields of its own object and of the single objects below it as `payload`."""
    quoted = F.expr("substring(to_json(array(prefix)), 3, length(to_json(array(prefix))) - 4)")
    members = F.when(F.col("payload") != "", F.replace("payload", F.lit(MARK), F.when(F.col("prefix") == "", "").otherwise(quoted)))
    merged = resolved.groupBy(*_KEY).agg(F.array_sort(F.collect_set(members)).alias("members"))
    return merged.withColumn("payload", F.concat(F.lit("{"), F.array_join("members", ", "), F.lit("}"))).drop("members")


def tables(individuals: DataFrame) -> DataFrame:
    """The rows of all tables: (record_id, version, path, pos, parent_path, parent_pos, payload)."""
    return merge(resolve(materialise(emit(individuals), "emission")))


# Schemas: a dict is an object, a list of one is an array.
_EVIDENCE = {"quote": "string", "anchor": "string", "verification": {"anchor_exists": "boolean", "in_anchor": "boolean", "in_document": "boolean", "offset": ["int"]}}
_AGE = {"iso8601": "string", "text": "string", "evidence": _EVIDENCE}
_GROUNDING = {"status": "string", "confidence": "double", "method": "string", "candidates": [{"id": "string", "label": "string", "score": "double"}]}
_FACT = {"evidence": _EVIDENCE, "grounding": _GROUNDING}
_TERM = {"id": "string", "label": "string"}


def _texts(names: str) -> dict:
    return dict.fromkeys(names.split(), "string")


RECORD = {
    "local_id": "string",
    "family": {"family_id": "string", "consanguinity": "boolean", "family_history_text": "string", "relatives_in_paper": [_texts("local_id relation")]},
    "subject": _texts("sex ancestry_as_stated country_of_care vital_status") | {"age_at_onset": _AGE, "age_at_presentation": _AGE, "age_at_last_followup": _AGE, "age_at_death": _AGE, "gestational_age_weeks": "double", "birth_weight_g": "double"},
    "phenotypes": [_texts("text hpo_id hpo_label") | {"excluded": "boolean", "onset": _AGE} | _texts("severity modifier") | _FACT],
    "measurements": [_texts("analyte_text specimen") | {"value": "double"} | _texts("value_text comparator unit unit_ucum") | {"reference_range": {"low": "double", "high": "double", "text": "string"}} | _texts("interpretation timing condition panel method") | {"age": _AGE} | _FACT],
    "genetic_findings": [_texts("gene_symbol hgnc_id variant_hgvs_c variant_hgvs_p variant_hgvs_g transcript variant_text zygosity inheritance_as_stated classification_as_reported method") | {"novel": "boolean"} | _FACT],
    "diagnoses": [_texts("disease_text status confidence_tier diagnostic_route") | {"age_at_diagnosis": _AGE, "time_to_diagnosis_text": "string", "prior_misdiagnoses": ["string"]} | _FACT],
    "treatments": [_texts("text type agent response_text response") | {"evidence": _EVIDENCE}],
    "outcome": {"text": "string", "evidence": _EVIDENCE},
    "clinical_summary": "string",
    "extractor_notes": ["string"],
    "narrative_anchors": ["string"],
}
_VARIANT = {"id": "string", "geneContext": {"symbol": "string"}, "expressions": [_texts("syntax value")], "description": "string"}
PHENOPACKET = {
    "id": "string",
    "subject": {"id": "string", "sex": "string", "timeAtLastEncounter": {"age": {"iso8601duration": "string"}}, "vitalStatus": {"status": "string"}},
    "phenotypicFeatures": [{"type": _TERM, "excluded": "boolean", "evidence": [{"evidenceCode": _TERM, "reference": _texts("id description")}]}],
    "measurements": [{"assay": _TERM, "value": {"ontologyClass": _TERM, "quantity": {"unit": _TERM, "value": "double", "referenceRange": {"low": "double", "high": "double"}}}}],
    "interpretations": [_texts("id progressStatus") | {"diagnosis": {"disease": _TERM, "genomicInterpretations": [_texts("subjectOrBiosampleId interpretationStatus") | {"variantInterpretation": {"variationDescriptor": _VARIANT, "acmgPathogenicityClassification": "string"}}]}}],
    "diseases": [{"term": _TERM}],
    "medicalActions": [{"treatment": {"agent": _TERM}}],
    "metaData": _texts("createdBy phenopacketSchemaVersion") | {"resources": [{"id": "string"}], "externalReferences": [{"id": "string"}]},
    "x_source": {"tool": "string", "flags": ["string"]},
}


def _schemas(tag: str, spec: dict, prefix: str = "", row: str | None = None) -> dict[str, dict[str, str]]:
    """Per table the types of its fields, by their dotted names below the table's path."""
    row = row or tag
    out: dict[str, dict[str, str]] = {row: {}}
    for k, kind in spec.items():
        if isinstance(kind, dict):
            more = _schemas(f"{tag}.{k}", kind, f"{prefix}{k}.", row)
            out[row] |= more.pop(row)
            out |= more
        elif isinstance(kind, list):
            out |= _schemas(f"{tag}.{k}", kind[0] if isinstance(kind[0], dict) else {"value": kind[0]})
        else:
            out[row][prefix + k] = kind
    return out


TABLES = _schemas("record", RECORD) | _schemas("phenopacket", PHENOPACKET)


def typed(rows: DataFrame, tag: str) -> DataFrame:
    """Rows of one table with its fields as columns; fields without a column, or not of its type, stay in `other` as JSON."""
    fields = TABLES.get(tag, {})
    rows = rows.withColumn("f", F.from_json("payload", "map<string,string>"))
    columns = [F.col("f")[k].try_cast(kind).alias(k.replace(".", "_")) for k, kind in fields.items()]

    def unfit(k, v):
        texts = k.isin([x for x, kind in fields.items() if kind == "string"])
        fit = texts
        for kind in sorted(set(fields.values()) - {"string"}):
            fit = fit | (k.isin([x for x, y in fields.items() if y == kind]) & (v.isNull() | v.try_cast(kind).isNotNull()))
        return ~fit

    other = F.map_filter("f", unfit)
    return rows.select("record_id", "version", "pos", "parent_path", "parent_pos", *columns, F.when(F.size(other) > 0, F.to_json(other)).alias("other"))


def write_tables(individuals: DataFrame, path: str | None = None) -> str:
    """Write all tables partitioned by tag; returns the folder."""
    path = path or scratch(individuals.sparkSession, "tables")
    tables(individuals).withColumnRenamed("path", "tag").write.partitionBy("tag").parquet(path)
    return path


def read_table(spark, path: str, tag: str) -> DataFrame:
    """One flat table of `write_tables` with its schema: (record_id, version, pos, parent_path, parent_pos, fields…, other)."""
    return typed(spark.read.schema(ROW).parquet(path).where(F.col("tag") == tag), tag)


def flat_table(individuals: DataFrame, tag: str) -> DataFrame:
    """One flat table straight from the written emission of its root."""
    resolved = resolve(materialise(emit(individuals, root=tag.split(".")[0]), "emission"))
    return typed(merge(resolved.where(F.col("path") == tag)), tag)
