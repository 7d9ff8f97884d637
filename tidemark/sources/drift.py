"""JSON records whose shape drifts from file to file.

`parse` reads every line into its dotted fields, values as the text that came.
`ingest` enforces a target schema: what is of the target's type and can be written back
unchanged becomes a typed column, everything else (unknown names, other types, nulls)
stays as it came in the rescue column, so a row holds its whole record.  `changes`
reads those rows and reports what each file changed against its stream's previous file.
`promote` approves further names for a column and replays rescued values into it.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.ordered import neighbours
from tidemark.session import written

RESCUED, OBJECTS = "_rescued", "_objects"
PARSED = "ok boolean, record_id string, names array<string>, raws array<string>, objects map<string,string>"
RECORD = ["stream_id", "record_kind", "object_key", "written_at_ms", "line_number", "record_id"]


class Number(str):
    """A number as the text that came."""


def _refuse(name: str):
    raise ValueError(name)


def _clean(text: str) -> str:
    return text.encode("utf-8", "replace").decode()


def _text(value, ordered: bool = False) -> str:
    """A parsed value as JSON again, numbers unchanged; members of objects by name if ordered."""
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, str):
        return json.dumps(_clean(value), ensure_ascii=False)
    if isinstance(value, list):
        return "[" + ",".join(_text(v, ordered) for v in value) + "]"
    if isinstance(value, dict):
        items = sorted(value.items()) if ordered else value.items()
        return "{" + ",".join(_text(str(k)) + ":" + _text(v, ordered) for k, v in items) + "}"
    return json.dumps(value)


def flatten(payload: str | None, id_field: str | None) -> tuple:
    """One line as PARSED; ok is false if it isn't one JSON object.

    Objects with members are fields of their own, under `objects`; their members follow
    as fields with dotted names. A line nested too deep to parse isn't ok.
    """
    try:
        record = json.loads(payload, parse_constant=_refuse, parse_int=Number, parse_float=Number)
    except (ValueError, TypeError, RecursionError):
        record = None
    if not isinstance(record, dict):
        return False, None, [], [], {}
    held: dict[str, str] = {}
    objects: dict[str, str] = {}
    todo = [("", record)]
    while todo:
        prefix, at = todo.pop()
        for key, value in at.items():
            name = prefix + _clean(key)
            if isinstance(value, dict) and value:
                objects[name] = _text(value, ordered=True)
                todo.append((name + ".", value))
            else:
                held[name] = _text(value)
    key = record.get(id_field) if id_field else None
    return True, None if key is None else _clean(key) if isinstance(key, str) else _text(key), list(held), list(held.values()), objects


def parse(lines: DataFrame, id_fields: dict[str, str]) -> DataFrame:
    """lines(stream_id, record_kind, object_key, written_at_ms, line_number, payload) with PARSED's columns.

    id_fields: the field that identifies a record of each kind. Lines repeated verbatim
    in a file count once; unparsable ones stay, with ok = false.
    """

    @F.pandas_udf(PARSED)
    def read(payload: pd.Series, kind: pd.Series) -> pd.DataFrame:
        rows = [flatten(p, id_fields.get(k)) for p, k in zip(payload, kind)]
        return pd.DataFrame(rows, columns=["ok", "record_id", "names", "raws", "objects"])

    cols = ["stream_id", "record_kind", "object_key", "written_at_ms", "line_number", "payload"]
    return lines.select(*cols).distinct().withColumn("p", read("payload", "record_kind")).select(*cols[:-1], "p.*")


def json_type(raw: Column) -> Column:
    """string, integer, number (with decimal point or exponent), boolean, array or object; null for null."""
    first = F.substring(raw, 1, 1)
    return (
        F.when(first == '"', "string").when(first == "[", "array").when(first == "{", "object").when(first.isin("t", "f"), "boolean")
        .when(first != "n", F.when(raw.rlike("[.eE]"), "number").otherwise("integer"))
    )


def _plain(raw: Column) -> Column:
    """The string that a JSON string spells; only one with escapes needs a parser."""
    return F.when(~F.contains(raw, F.lit("\\")), F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v"))


def _typed(raw: Column, kind: str) -> Column:
    """A field's JSON text as the wanted type; null if it can't be."""
    first = F.substring(raw, 1, 1)
    if kind.startswith("array"):
        return F.when(first == "[", F.from_json(raw, kind, {"mode": "PERMISSIVE"}))
    scalar = F.when(first == '"', _plain(raw)).when(~first.isin("[", "{", "n"), raw)
    if kind == "string":
        return scalar
    if kind in ("bigint", "int"):
        number = scalar.try_cast("decimal(38,9)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return scalar.try_cast(kind)


def _same(raw: Column, kind: str) -> Column:
    """A field's JSON text as the target's type if it is of that type and can be written back; else null."""
    value = _typed(raw, kind)
    if kind == "string":
        return F.when(json_type(raw) == "string", value)
    if kind.startswith("array"):
        return F.when(F.to_json(value) == raw, value)
    return F.when(value.cast("string") == raw, value)


def column_name(field: str) -> str:
    return field.replace(".", "_")


def ingest(parsed: DataFrame, target: dict[str, str]) -> DataFrame:
    """One row per parsed record: the target's fields as typed columns, the rest as JSON in `_rescued`.

    `_rescued` is a map from field to the JSON text that came, written as JSON; null if
    nothing was left over. A null value is rescued as `null`, under known names too, so
    that the field is known to have been there; fields stand in order of their names.
    `_objects` holds the objects whose members are fields, by name. Unparsable lines
    stay, with ok = false and all of these null, as their file counts as one of its stream.
    """
    held = F.map_from_arrays("names", "raws")
    rows = parsed.select(*RECORD, "ok", F.when(F.col("ok"), held).alias("_f"), F.when(F.col("ok") & (F.size("objects") > 0), F.to_json("objects")).alias(OBJECTS))
    raws = {k: f"_raw{i}" for i, k in enumerate(target)}
    rows = rows.withColumns({c: F.col("_f")[k] for k, c in raws.items()})
    rows = rows.withColumns({column_name(k): _same(F.col(raws[k]), t) for k, t in target.items()}).drop(*raws.values())
    drop = F.array_compact(F.array(*[F.when(F.col(column_name(k)).isNotNull(), F.lit(k)) for k in target]))
    rest = F.map_filter("_f", lambda k, v: ~F.array_contains(drop, k))
    return rows.withColumn(RESCUED, F.when(F.size(rest) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(rest)))))).drop("_f")


def fields(table: DataFrame, target: dict[str, str]) -> Column:
    """All fields of an ingested row: name, JSON type (null for null) and value, written in one way."""
    names = {"bigint": "integer", "int": "integer", "double": "number"}
    what = "array<struct<name string, type string, value string>>"
    typed = []
    for k, t in target.items():
        c = F.col(column_name(k))
        # a quote before a string's value keeps it apart from a number of the same text
        value = F.to_json(c) if t.startswith("array") else F.concat(F.lit('"'), c) if t == "string" else c.cast("string")
        kind = "array" if t.startswith("array") else names.get(t, t)
        typed.append(F.when(c.isNotNull(), F.struct(F.lit(k).alias("name"), F.lit(kind).alias("type"), value.alias("value"))))
    text = lambda x: F.when(F.substring(x, 1, 1) == '"', F.concat(F.lit('"'), _plain(x))).when(json_type(x) == "number", x.cast("double").cast("string")).otherwise(x)
    entries = lambda c: F.coalesce(F.map_entries(F.from_json(c, "map<string,string>")), F.array().cast("array<struct<key string, value string>>"))
    rest = F.transform(F.concat(entries(RESCUED), entries(OBJECTS)), lambda e: F.struct(e["key"].alias("name"), json_type(e["value"]).alias("type"), text(e["value"]).alias("value")))
    return F.concat(F.array_compact(F.array(*typed)).cast(what), rest.cast(what))


def described(table: DataFrame, target: dict[str, str]) -> DataFrame:
    """Ingested rows of one kind with all their fields in one column, so that kinds can be put together."""
    return table.select(*RECORD, F.when(F.col("ok"), fields(table, target)).alias("f"))


def changes(rows: DataFrame, bucket_ms: int = 86_400_000) -> DataFrame:
    """(stream_id, object_key, change_kind, field_name, old_name) of each file against the one before.

    rows: ingested rows as `described` gives them. A field is in a file if any record has it, even as null.
    `renamed`: a gone and a new name whose values agree in every record of both files
    that has both, and in at least one; if several names would do, the one with most
    agreeing records, then the first by name. Otherwise `added` or `removed`;
    `type_changed` compares the sets of JSON types of non-null values. A stream's first
    file changes nothing.
    """
    files = rows.groupBy("stream_id", "object_key").agg(F.min("written_at_ms").alias("at"))
    pairs = (
        neighbours(files, ["stream_id"], ["at", "object_key"], [], bucket_ms)
        .where("previous is not null")
        .select("stream_id", F.col("object_key").alias("file"), F.col("previous.object_key").alias("before"))
    )
    pairs = written(pairs, "pairs")
    kinds = rows.select("stream_id", "object_key", F.explode("f").alias("f")).select("stream_id", "object_key", "f.name", "f.type").distinct()
    # at most one entry for each JSON type
    inventory = written(kinds.groupBy("stream_id", "object_key", "name").agg(F.array_sort(F.collect_set("type")).alias("types")), "inventory")
    new = inventory.withColumnRenamed("object_key", "file").join(pairs.select("stream_id", "file"), ["stream_id", "file"])
    old = inventory.withColumnRenamed("object_key", "before").join(pairs, ["stream_id", "before"]).select("stream_id", "file", "name", F.col("types").alias("old_types"))
    state = old.join(new, ["stream_id", "file", "name"], "full").select(
        "stream_id", "file", "name",
        F.when(F.col("types").isNull(), "removed").when(F.col("old_types").isNull(), "added")
        .when((F.size("types") > 0) & (F.size("old_types") > 0) & (F.col("types") != F.col("old_types")), "type_changed").alias("kind"),
    ).where("kind is not null")
    state = written(state, "state")
    # names that came or went, as many as a file's changed fields; values of others are never spread out
    moved = state.groupBy("stream_id", "file").agg(*[F.collect_list(F.when(F.col("kind") == k, F.col("name"))).alias(k) for k in ("removed", "added")]).where("size(removed) > 0 and size(added) > 0")
    moved = written(moved.join(pairs, ["stream_id", "file"]), "moved")

    def values(side: str, kind: str, name: str) -> DataFrame:
        """The last non-null value of each record and name that came (or went)."""
        names = moved.select("stream_id", F.col(side).alias("object_key"), F.col("file").alias("of_file"), kind)
        some = F.filter("f", lambda x: x["type"].isNotNull() & F.array_contains(kind, x["name"]))
        held = rows.where("record_id is not null").join(names, ["stream_id", "object_key"]).select("stream_id", F.col("of_file").alias("file"), "record_id", "line_number", F.explode(some).alias("f"))
        return held.groupBy("stream_id", "file", "record_id", F.col("f.name").alias(f"{name}_name")).agg(F.max_by("f.value", "line_number").alias(f"{name}_value"))

    same = F.col("old_value") == F.col("new_value")
    both = values("before", "removed", "old").join(values("file", "added", "new"), ["stream_id", "file", "record_id"])
    match = both.groupBy("stream_id", "file", "old_name", "new_name").agg(F.count(F.when(same, 1)).alias("n"), F.count(F.when(~same, 1)).alias("bad"))
    rank = lambda side: F.row_number().over(Window.partitionBy("stream_id", "file", side).orderBy(F.desc("n"), "old_name", "new_name"))
    renamed = match.where("n > 0 and bad = 0").withColumn("i", rank("old_name")).withColumn("j", rank("new_name")).where("i = 1 and j = 1").select("stream_id", "file", "old_name", "new_name")
    renamed = written(renamed, "renamed")
    explained = renamed.select("stream_id", "file", F.col("old_name").alias("name"), F.lit("removed").alias("kind")).unionByName(
        renamed.select("stream_id", "file", F.col("new_name").alias("name"), F.lit("added").alias("kind"))
    )
    rest = state.join(explained, ["stream_id", "file", "name", "kind"], "left_anti").select("stream_id", "file", F.col("kind").alias("change_kind"), F.col("name").alias("field_name"), F.lit("").alias("old_name"))
    named = renamed.select("stream_id", "file", F.lit("renamed").alias("change_kind"), F.col("new_name").alias("field_name"), "old_name")
    return rest.unionByName(named).withColumnRenamed("file", "object_key")


def promote(table: DataFrame, approved: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Replays rescued values into columns, for all approved fields in one pass.

    approved: of each field its type and the names, its own or others, that may fill it.
    Where its column is null, the first of them with a rescued value that can be cast
    fills it and leaves the rescue column. A column is made if the table has none, so
    new fields are promoted the same way.
    """
    for field, (kind, _) in approved.items():
        if column_name(field) not in table.columns:
            table = table.withColumn(column_name(field), F.lit(None).cast(kind))
    table = table.withColumn("_h", F.from_json(RESCUED, "map<string,string>"))
    raws = {n: f"_raw{i}" for i, n in enumerate(dict.fromkeys(n for _, names in approved.values() for n in names))}
    table = table.withColumns({c: F.col("_h")[n] for n, c in raws.items()})
    hits = {}
    for i, (field, (kind, names)) in enumerate(approved.items()):
        tried = F.array(*[F.struct(F.lit(n).alias("n"), _typed(F.col(raws[n]), kind).alias("v")) for n in names])
        hits[f"_hit{i}"] = F.when(F.col(column_name(field)).isNull(), F.try_element_at(F.filter(tried, lambda x: x["v"].isNotNull()), F.lit(1)))
    table = table.withColumns(hits).withColumn("_used", F.array_compact(F.array(*[F.col(h)["n"] for h in hits])))
    rest = F.map_filter("_h", lambda k, v: ~F.array_contains("_used", k))
    filled = {column_name(field): F.coalesce(column_name(field), F.col(h)["v"]) for field, h in zip(approved, hits)}
    left = F.when(F.size("_used") == 0, F.col(RESCUED)).when(F.size(rest) > 0, F.to_json(rest))
    return table.withColumns({**filled, RESCUED: left}).drop("_h", "_used", *raws.values(), *hits)


def aliases(renames: DataFrame, target: dict[str, str]) -> dict[str, list[str]]:
    """Other names of each target field, by name, from the `renamed` changes of one record kind.

    Follows chains of renames, one join per link, until no new name is reached. What is
    fetched are the names approved for the columns of one table, a part of its schema.
    """
    spark = renames.sparkSession
    pairs = renames.where("change_kind = 'renamed'").select(F.col("old_name").alias("name"), F.col("field_name").alias("other")).distinct()
    pairs = written(pairs.unionByName(pairs.select(F.col("other").alias("name"), F.col("name").alias("other"))).distinct(), "renames")
    pairs = pairs.where(~F.col("other").isin(list(target)))
    reached = step = spark.createDataFrame([(k, k) for k in target], "field string, name string")
    while True:
        step = step.join(pairs, "name").select("field", F.col("other").alias("name")).distinct().join(reached, ["field", "name"], "left_anti")
        step = written(step, "names")
        if step.isEmpty():
            break
        reached = reached.unionByName(step)
    out: dict[str, list[str]] = {}
    for r in reached.where("field <> name").orderBy("field", "name").toLocalIterator():
        out.setdefault(r.field, []).append(r.name)
    return out
