"""Deterministic identifiers and object keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def short_id(prefix: str, *parts: Column) -> Column:
    """prefix_ + first 24 hex digits of the SHA-256 of the parts, a NUL after every part."""
    joined = F.concat(*[x for p in parts for x in (p, F.lit("\x00"))])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 24))


def content_sha(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def utc(ms: Column, pattern: str) -> Column:
    """Session time zone must be UTC."""
    return F.date_format(F.timestamp_millis(ms), pattern)


def run_id(policy: Column, ms: Column) -> Column:
    return F.concat(F.lit("intel-l1-"), short_id("policy", policy), F.lit("-"), utc(ms, "yyyyMMdd'T'HHmmssSSS'Z'"))


def path_segment(c: Column) -> Column:
    """A key segment: other characters become _, and so do the empty and dot segments."""
    safe = F.regexp_replace(c, "[^A-Za-z0-9._-]", "_")
    return F.when(safe.isin("", ".", ".."), "_").otherwise(safe)


def dated_key(family: str, schema: str, ms: Column, record: Column, name: str, ident: Column, tail: str) -> Column:
    """family/schema=…/dt=…/hour=…/raw_event_id=…/name=… and the tail: Hive-style, so scans prune by day and hour."""
    return F.concat(
        F.lit(f"{family}/schema={schema}/dt="), utc(ms, "yyyy-MM-dd"), F.lit("/hour="), utc(ms, "HH"),
        F.lit("/raw_event_id="), path_segment(record), F.lit(f"/{name}="), path_segment(ident), F.lit(tail),
    )


def sampled(ident: Column, ratio: float) -> Column:
    """A share of identifiers, always the same ones: by the first 32 bits of their SHA-256."""
    if ratio <= 0 or ratio >= 1:
        return F.lit(ratio >= 1)
    return F.conv(F.substring(F.sha2(ident, 256), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0) < F.lit(float(ratio))
