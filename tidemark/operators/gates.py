"""Checks that split a stream of records into good ones and ones with a named error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import blank

# Terms that no output may hold.
FORBIDDEN = ["buy", "sell", "long", "short", "position_size", "live_ready", "execution_approved"]
_TERM = r"(?i)(?<![A-Za-z0-9_])(" + "|".join(FORBIDDEN) + r")(?![A-Za-z0-9_])"


def forbidden(c: Column) -> Column:
    """True if a whole token of c is a forbidden term; apply to every text, not to its JSON."""
    return F.coalesce(c.rlike(_TERM), F.lit(False))


def redacted(c: Column) -> Column:
    return F.regexp_replace(c, _TERM, "[blocked_output_term]")


def key_error(key: Column, prefix: bool = False) -> Column:
    """Why an object key (or prefix) is malformed; null if it is fine."""
    bare = F.regexp_replace(key, "/$", "") if prefix else key
    return (
        F.when(key.isNull() | (key == ""), "empty")
        .when(key.rlike(r"(?U)^\s|\s$"), "edge_space")
        .when(F.octet_length(key) > 1024, "too_long")
        .when(key.startswith("/") | key.startswith("s3://"), "absolute")
        .when(key.rlike(r"[?#\\\x00-\x20\x7f]"), "bad_character")
        .when(bare.rlike(r"(^|/)(\.\.?)?(/|$)"), "bad_segment")
    )


def pointer_error(p: DataFrame, version: str, kind: str) -> Column:
    """The first thing wrong with a raw pointer; null if nothing is."""
    ref = p["storage_ref"]
    return (
        F.when(~p["schema_version"].eqNullSafe(version), "schema_version")
        .when(blank(p["event_id"]), "event_id")
        .when(~ref["kind"].eqNullSafe(kind), "kind")
        .when(blank(ref["bucket"]) | blank(ref["key"]), "location")
        .when(F.coalesce(ref["byte_length"] <= 0, F.lit(True)), "byte_length")
        .when(~F.coalesce(ref["content_sha256"].startswith("sha256:"), F.lit(False)), "content_sha256")
    )


def read_ranges(pointers: DataFrame, objects: DataFrame) -> DataFrame:
    """The bytes each pointer names and whether they are what it says.

    pointers(event_id, object_key, byte_offset, byte_length, content_sha256),
    objects(object_key, content binary). error: missing_object, out_of_range or
    checksum; null for verified records. The range is cut in the join itself: objects
    travel once, and only ranges go further. A range that is null or ends beyond 2 GiB,
    the most that one value holds, is out of range.
    """
    low, size = F.col("byte_offset").cast("long"), F.col("byte_length").cast("long")
    fits = F.coalesce((low >= 0) & (size > 0) & (low + size <= F.octet_length("content")), F.lit(False))
    part = F.when(fits, F.substring(F.col("content"), (low + 1).cast("int"), size.cast("int")))
    rows = pointers.join(objects.select("object_key", "content"), "object_key", "left").withColumn("record", part)
    error = (
        F.when(F.col("content").isNull(), "missing_object").when(~fits, "out_of_range")
        .when(~F.concat(F.lit("sha256:"), F.sha2("record", 256)).eqNullSafe(F.col("content_sha256")), "checksum")
    )
    return rows.withColumn("error", error).drop("content")


def verified(ranges: DataFrame, schema_version: str, ident: str, **same: str) -> DataFrame:
    """ranges as `read_ranges` gives them, with what else is wrong with a record, in this order.

    not_json: no JSON object; schema_version: another one than expected; identity: its
    field `ident` is not the pointer's event_id; then each of `same`, a field that must
    equal the pointer's column of that name. Fields at the top level, compared as text.
    """
    text = F.decode("record", "UTF-8")
    body = F.when(F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{"), text)
    field = lambda name: F.get_json_object(body, f"$.{name}")
    error = (
        F.when(F.col("error").isNotNull(), F.col("error")).when(body.isNull(), "not_json")
        .when(~field("schema_version").eqNullSafe(F.lit(schema_version)), "schema_version").when(~field(ident).eqNullSafe(F.col("event_id")), "identity")
    )
    for name, column in same.items():
        error = error.when(~field(name).eqNullSafe(F.col(column)), name)
    return ranges.withColumn("error", error)


def jsonl_objects(lines: DataFrame, file: str, order: str, payload: str) -> DataFrame:
    """(object_key, content): the lines of each file as one JSONL object, a newline after each.

    An object is one value, so its lines meet in one row; `locators` needs no such row.
    """
    rows = lines.where(F.col(payload).isNotNull()).groupBy(F.col(file).alias("object_key")).agg(F.array_sort(F.collect_list(F.struct(order, payload))).alias("l"))
    return rows.select("object_key", F.encode(F.concat(F.array_join(F.transform("l", lambda x: x[payload]), "\n"), F.lit("\n")), "UTF-8").alias("content"))


def lines_of(objects: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(object_key, line_no) → with line; null if the object or the line doesn't exist.

    Every object is cut into lines once, whatever the number of lines wanted of it. A
    last line without a newline counts, an empty one after the last newline doesn't.
    """
    text = F.regexp_replace(F.decode("content", "UTF-8"), r"\n\z", "")
    cut = objects.join(wanted.select("object_key").distinct(), "object_key", "left_semi").where(F.octet_length("content") > 0)
    lines = cut.select("object_key", F.posexplode(F.split(text, "\n", -1)).alias("i", "line")).select("object_key", (F.col("i") + 1).alias("line_no"), "line")
    return wanted.join(lines, ["object_key", "line_no"], "left")


def outcomes(deliveries: DataFrame, error: Column, done: DataFrame, stored: DataFrame) -> DataFrame:
    """What becomes of each delivery: (delivery_id, outcome, quarantined).

    deliveries(delivery_id, event_id, content_hash), done(event_id): processed events,
    stored(event_id, content_hash). A pointer with an error is acknowledged and
    quarantined (`invalid_pointer`); one of a processed event is acknowledged
    (`duplicate`); one whose record isn't there is not acknowledged and comes again
    (`retry`); one whose record has another hash can never succeed, and is quarantined
    (`permanent_input_failure`); the others are processed.
    """
    rows = deliveries.select("delivery_id", "event_id", "content_hash", error.alias("_e"))
    seen = done.select("event_id").distinct().withColumn("_done", F.lit(True))
    held = stored.where("event_id is not null").groupBy("event_id").agg(F.min("content_hash").alias("_hash"), F.max("content_hash").alias("_last")).withColumn("_there", F.lit(True))
    rows = rows.join(seen, "event_id", "left").join(held, "event_id", "left")
    same = F.col("content_hash").eqNullSafe(F.col("_hash")) | F.col("content_hash").eqNullSafe(F.col("_last"))
    outcome = (
        F.when(F.col("_e").isNotNull(), "invalid_pointer").when(F.col("_done"), "duplicate").when(F.col("_there").isNull(), "retry")
        .when(~same, "permanent_input_failure").otherwise("processed")
    )
    rows = rows.select("delivery_id", outcome.alias("outcome"))
    return rows.withColumn("quarantined", F.col("outcome").isin("invalid_pointer", "permanent_input_failure"))


def start_positions(messages: DataFrame, subject: str, position: str) -> DataFrame:
    """(policy, subject, start): where a consumer begins. `new` is one after the last message; no messages, no rows."""
    ends = messages.agg(F.min(position).alias("low"), F.max(position).alias("high")).where("high is not null")
    whole = ends.select(F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), c.alias("start")) for p, c in (("all", F.col("low")), ("new", F.col("high") + 1), ("last", F.col("high")))])).alias("x"))
    each = messages.groupBy(F.col(subject).alias("subject")).agg(F.max(position).alias("start")).select(F.lit("last_per_subject").alias("policy"), "subject", "start")
    return whole.select("x.policy", F.lit(None).cast("string").alias("subject"), "x.start").unionByName(each)


def unseen(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """rows whose key is not in done, each key once."""
    return rows.join(done.select(key).distinct(), key, "left_anti").dropDuplicates([key])


def locators(lines: DataFrame, file: str, order: str, payload: str) -> DataFrame:
    """Where each line of a file begins: its number, byte offset and length, and checksum.

    A line takes its bytes and one for the newline. Files are written by one task each,
    so a file's lines fit one window partition.
    """
    from pyspark.sql import Window

    size = F.octet_length(payload).cast("long")
    w = Window.partitionBy(file).orderBy(order, payload)
    return lines.select(
        file, F.row_number().over(w).alias("line_no"),
        F.coalesce(F.sum(size + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("byte_offset"),
        size.alias("byte_length"), F.concat(F.lit("sha256:"), F.sha2(payload, 256)).alias("content_sha256"),
    )
