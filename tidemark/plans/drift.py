"""Queries over raw object lines, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import written
from tidemark.sources import drift
from tidemark.sources.tables import table

ID_FIELDS = {"structured_packet": "packet_id", "market_l1_manifest": "l1_run_id"}
TARGETS = {
    "structured_packet": {
        "packet_id": "string", "packet_family_id": "string", "schema_version": "string", "event_timestamp_ms": "bigint",
        "decision_available_at_ms": "bigint", "revision": "int", "supersedes_packet_id": "string", "event_type": "string",
        "confidence_band": "string", "novelty_score": "double", "normalized_symbols": "array<string>",
        "market_context_ref.status": "string", "market_context_ref.manifest_key": "string", "market_context_ref.window_start_ms": "bigint",
    },
    "market_l1_manifest": {
        "l1_run_id": "string", "schema_version": "string", "status": "string", "finished_at_ms": "bigint", "report_key": "string",
        "output_object_keys": "array<string>", "market_feature_delta_key": "string", "market_regime_context_key": "string",
        "symbol_universe_snapshot_key": "string", "output_record_count": "bigint", "slice_count_total": "bigint",
        "fallback_alert": "boolean", "limits.max_lag_ms": "bigint", "limits.tier": "string",
    },
}


def _ingested(spark: SparkSession, d: str, kind: str) -> DataFrame:
    lines = table(spark, d, "raw_object_lines").where(F.col("record_kind") == kind)
    return drift.ingest(drift.parse(lines, ID_FIELDS), TARGETS[kind])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of a file, read off the ingested rows."""
    return drift.changes(written(reduce(DataFrame.unionByName, [drift.described(_ingested(spark, d, kind), TARGETS[kind]) for kind in TARGETS]), "described"))


def _table(spark: SparkSession, d: str, kind: str) -> DataFrame:
    rows = written(_ingested(spark, d, kind), "ingested")
    names = drift.aliases(drift.changes(written(drift.described(rows, TARGETS[kind]), "described")), TARGETS[kind])
    out = drift.promote(rows.where("ok"), {k: (t, [k, *names.get(k, [])]) for k, t in TARGETS[kind].items()})
    return out.drop("record_kind", "ok", drift.OBJECTS)


def p2_packets(spark: SparkSession, d: str) -> DataFrame:
    """All packet records in one typed table, renamed fields brought home."""
    return _table(spark, d, "structured_packet")


def p2_manifests(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "market_l1_manifest")


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_packets, p2_manifests)}


#: Lines, their fields at all depths of objects, and the files with the one before each.
_FIELDS = """
l AS (SELECT DISTINCT stream_id, record_kind, object_key, written_at_ms, line_number, payload FROM raw_object_lines WHERE {where} AND json_valid(payload) AND json_type(payload) = 'OBJECT'),
i AS (SELECT *, row_number() OVER () AS row, json_extract_string(payload, CASE record_kind WHEN 'structured_packet' THEN '$.packet_id' WHEN 'market_l1_manifest' THEN '$.l1_run_id' END) AS record_id FROM l),
f AS (
  SELECT i.row, stream_id, object_key, record_id, line_number, replace(substr(fullkey, 3), '"', '') AS name, CAST(t.value AS VARCHAR) AS raw,
    CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number'
      WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' END AS type
  FROM i, json_tree(payload) t WHERE fullkey <> '$' AND fullkey NOT LIKE '%[%'
), files AS (SELECT stream_id, object_key, min(written_at_ms) AS since FROM raw_object_lines WHERE {where} GROUP BY ALL),
p AS (SELECT stream_id, object_key AS file, lag(object_key) OVER (PARTITION BY stream_id ORDER BY since, object_key) AS before FROM files),
v AS (SELECT stream_id, object_key, name, list_sort(list(DISTINCT type) FILTER (type IS NOT NULL)) AS types FROM f GROUP BY ALL),
new AS (SELECT p.stream_id, file, name, types FROM p JOIN v ON v.stream_id = p.stream_id AND v.object_key = file WHERE before IS NOT NULL),
old AS (SELECT p.stream_id, file, name, types FROM p JOIN v ON v.stream_id = p.stream_id AND v.object_key = before),
state AS (
  SELECT coalesce(n.stream_id, o.stream_id) AS stream_id, coalesce(n.file, o.file) AS file, coalesce(n.name, o.name) AS name,
    CASE WHEN n.name IS NULL THEN 'removed' WHEN o.name IS NULL THEN 'added' WHEN len(n.types) > 0 AND len(o.types) > 0 AND n.types <> o.types THEN 'type_changed' END AS kind
  FROM new n FULL JOIN old o ON n.stream_id = o.stream_id AND n.file = o.file AND n.name = o.name
), val AS (SELECT stream_id, object_key, record_id, name, arg_max(CASE type WHEN 'number' THEN CAST(CAST(raw AS DOUBLE) AS VARCHAR) ELSE raw END, line_number) AS x FROM f WHERE record_id IS NOT NULL AND type IS NOT NULL GROUP BY ALL),
m AS (
  SELECT p.stream_id, p.file, a.name AS old_name, b.name AS new_name, count(*) FILTER (a.x = b.x) AS n, count(*) FILTER (a.x <> b.x) AS bad
  FROM p JOIN val a ON a.stream_id = p.stream_id AND a.object_key = p.before JOIN val b ON b.stream_id = p.stream_id AND b.object_key = p.file AND b.record_id = a.record_id
  JOIN state r ON r.stream_id = p.stream_id AND r.file = p.file AND r.name = a.name AND r.kind = 'removed' JOIN state s ON s.stream_id = p.stream_id AND s.file = p.file AND s.name = b.name AND s.kind = 'added'
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stream_id, file, old_name ORDER BY n DESC, old_name, new_name) AS k, row_number() OVER (PARTITION BY stream_id, file, new_name ORDER BY n DESC, old_name, new_name) AS j
  FROM m WHERE n > 0 AND bad = 0
), ren AS (SELECT * FROM ranked WHERE k = 1 AND j = 1)"""
_CHANGES = "WITH " + _FIELDS.format(where="true") + """
SELECT stream_id, file AS object_key, 'renamed' AS change_kind, new_name AS field_name, old_name FROM ren
UNION ALL SELECT s.stream_id, s.file, kind, name, '' FROM state s WHERE kind IS NOT NULL
  AND NOT (kind = 'removed' AND EXISTS (FROM ren r WHERE r.stream_id = s.stream_id AND r.file = s.file AND r.old_name = s.name))
  AND NOT (kind = 'added' AND EXISTS (FROM ren r WHERE r.stream_id = s.stream_id AND r.file = s.file AND r.new_name = s.name))"""


def _typed_sql(kind: str) -> str:
    """A field's JSON text as a type; null if it can't be."""
    scalar = "CASE WHEN left(raw, 1) NOT IN ('[', '{') THEN json_extract_string(raw, '$') END"
    if kind == "string":
        return scalar
    if kind.startswith("array"):
        return "CASE WHEN left(raw, 1) = '[' THEN list_transform(json_extract(raw, '$[*]'), lambda x: json_extract_string(x, '$')) END"
    if kind in ("bigint", "int"):
        number = f"TRY_CAST({scalar} AS DECIMAL(38, 9))"
        return f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS {kind}) END"
    return f"TRY_CAST({scalar} AS {kind})"


def _table_sql(kind: str) -> str:
    """The typed table of one record kind: each column from the first of its names with a fitting value."""
    target = TARGETS[kind]
    rows = " UNION ALL ".join(f"SELECT '{k}' AS field" for k in target)
    fits = " ".join(f"WHEN '{k}' THEN ({_typed_sql(t)}) IS NOT NULL" for k, t in target.items())
    columns = ", ".join(f"any_value({_typed_sql(t)}) FILTER (field = '{k}') AS {drift.column_name(k)}" for k, t in target.items())
    where = f"record_kind = '{kind}'"
    return f"""WITH RECURSIVE {_FIELDS.format(where=where)},
t AS ({rows}), pairs AS (SELECT old_name AS name, new_name AS other FROM ren UNION SELECT new_name, old_name FROM ren),
reach AS (SELECT field, field AS name FROM t UNION SELECT field, other FROM reach JOIN pairs USING (name) WHERE other NOT IN (SELECT field FROM t)),
leaf AS (SELECT row, name, raw FROM f WHERE type IS DISTINCT FROM 'object' OR raw = '{{}}'),
c AS (SELECT row, name, coalesce(raw, 'null') AS raw, field FROM leaf JOIN reach USING (name)),
ok AS (SELECT *, row_number() OVER (PARTITION BY row, field ORDER BY name <> field, name) AS k FROM c WHERE CASE field {fits} END),
used AS (SELECT * FROM ok WHERE k = 1),
cols AS (SELECT row, {columns} FROM used GROUP BY row),
rest AS (SELECT row, '{{' || string_agg(to_json(name) || ':' || to_json(coalesce(raw, 'null')), ',' ORDER BY name) || '}}' AS _rescued FROM leaf WHERE NOT EXISTS (FROM used u WHERE u.row = leaf.row AND u.name = leaf.name) GROUP BY row)
SELECT stream_id, object_key, written_at_ms, line_number, record_id, cols.* EXCLUDE (row), _rescued FROM i LEFT JOIN cols USING (row) LEFT JOIN rest USING (row)"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _CHANGES, "p2_packets": _table_sql("structured_packet"), "p2_manifests": _table_sql("market_l1_manifest")}
