"""Text primitives with fixed meaning, independent of locale and JVM defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(c: Column) -> Column:
    """Only A-Z change; `lower` would also fold Ä or İ."""
    return F.translate(c, UPPER, LOWER)


def ascii_upper(c: Column) -> Column:
    return F.translate(c, LOWER, UPPER)


def utrim(c: Column) -> Column:
    """Without surrounding white space of any Unicode kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return utrim(F.regexp_replace(c, r"(?U)\s+", " "))


def blank(c: Column) -> Column:
    """True for null and for white space only."""
    return c.isNull() | (utrim(c) == "")


def record_key(c: Column) -> Column:
    """An identifier in lower case without surrounding white space; null if blank."""
    return F.nullif(F.lower(utrim(c)), F.lit(""))


def any_of(c: Column, words: list[str]) -> Column:
    """True if c contains any of the words. An OR chain stays in generated code."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def floor_to(ms: Column, width: int) -> Column:
    """Start of the window of the given width that holds ms, also before 1970."""
    return ms - F.pmod(ms, F.lit(width).cast("long"))


def epoch_ms(c: Column) -> Column:
    """Seconds, milliseconds, microseconds or nanoseconds since 1970 as whole milliseconds.

    The unit is read off the magnitude: every date from 1973 to 5138 has a value under
    1e11 in seconds, under 1e14 in milliseconds and under 1e17 in microseconds.
    """
    size = F.abs(c)

    def down(by: int) -> Column:
        unit = F.lit(by).cast("long")
        return F.call_function("div", c - F.pmod(c, unit), unit)

    return (
        F.when(size < F.lit(10**11), c * F.lit(1000).cast("long"))
        .when(size < F.lit(10**14), c)
        .when(size < F.lit(10**17), down(1000))
        .otherwise(down(1_000_000))
    )


def published_ms(published: Column, fetched: Column) -> Column:
    """A publication time in any unit as milliseconds; the fetch time where it is null or 0."""
    return F.coalesce(F.when(published != 0, epoch_ms(published)), fetched)
