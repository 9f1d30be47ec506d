"""Reusable column expressions for the cleansing and mart rules.

All are plain ``Column`` builders so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_or", "tokenize", "trim_or_default", "row_fingerprint", "amount_or_zero",
    "strip_prefix", "completed_years", "calendar_years", "days_between",
    "tiered", "flag", "in_year", "valid_on", "changed_any", "lit_date",
    "lit_ts", "year_start", "ts_start_of_day",
]


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def lit_ts(t: dt.datetime | str) -> Column:
    """Naive (wall-clock) timestamp literal, built from text so neither the
    Python process zone nor the session zone can shift it."""
    text = t if isinstance(t, str) else t.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def ts_start_of_day(d: dt.date) -> Column:
    return lit_ts(dt.datetime.combine(d, dt.time()))


def tokenize(c, salt: str | None = None) -> Column:
    """SHA-256 token of a value; NULL tokenizes like the empty string."""
    v = F.coalesce(col_or(c), F.lit(""))
    if salt:
        v = F.concat(F.lit(salt), v)
    return F.sha2(v, 256)


def trim_or_default(c, default: str) -> Column:
    """``coalesce(trim(x), default)``: trims spaces only; blank stays ''."""
    return F.coalesce(F.trim(col_or(c)), F.lit(default))


def row_fingerprint(*cols) -> Column:
    """SHA-256 of ``concat_ws('|', ...)`` (NULL parts are skipped)."""
    return F.sha2(F.concat_ws("|", *[col_or(c).cast("string") for c in cols]), 256)


def amount_or_zero(c, precision: int = 12, scale: int = 2) -> Column:
    """NULL amount -> 0.00, kept in exact decimal arithmetic."""
    typ = f"decimal({precision},{scale})"
    return F.coalesce(col_or(c).cast(typ), F.lit(0).cast(typ))


def strip_prefix(c, prefix: str) -> Column:
    """Remove a leading literal prefix (``regexp_replace(x, '^P', '')``)."""
    import re
    return F.regexp_replace(col_or(c), "^" + re.escape(prefix), "")


def completed_years(ts, birth) -> Column:
    """Completed years between birth and ts: ``floor(months_between/12)``."""
    return F.floor(F.months_between(col_or(ts), col_or(birth)) / F.lit(12)).cast("int")


def calendar_years(ts, birth) -> Column:
    """Calendar-year difference ``year(ts) - year(birth)``."""
    return (F.year(col_or(ts)) - F.year(col_or(birth))).cast("int")


def days_between(later, earlier) -> Column:
    return F.datediff(col_or(later), col_or(earlier))


def tiered(value, tiers: list[tuple[int, str]], default: str) -> Column:
    """``CASE WHEN v > t1 THEN l1 WHEN v > t2 THEN l2 ... ELSE default``.

    A NULL value falls through to the default, like SQL CASE.
    """
    v = col_or(value)
    out = None
    for threshold, label in tiers:
        cond = v > F.lit(threshold)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default) if out is not None else F.lit(default)


def flag(cond: Column, yes: str = "Y", no: str = "N") -> Column:
    """Binary Y/N flag; a NULL condition yields ``no`` (CASE semantics)."""
    return F.when(cond, yes).otherwise(no)


def year_start(year: int) -> dt.datetime:
    return dt.datetime(year, 1, 1)


def in_year(ts, year: int) -> Column:
    """``year(ts) = Y`` written as a half-open range so Parquet can prune."""
    c = col_or(ts)
    return (c >= lit_ts(year_start(year))) & (c < lit_ts(year_start(year + 1)))


def valid_on(effective, expiration, day: dt.date) -> Column:
    """Effective-dated validity, inclusive at both ends; NULL expiry = open."""
    d = lit_date(day)
    exp = col_or(expiration)
    return (exp.isNull() | (exp >= d)) & (col_or(effective) <= d)


def changed_any(left_prefix: str, right_prefix: str, attrs: list[str],
                null_safe: tuple[str, ...] = ()) -> Column:
    """OR-chain of attribute changes between two aliased frames.

    Plain ``!=`` for NOT NULL attributes; ``NOT (a <=> b)`` for nullable ones.
    """
    out = None
    for a in attrs:
        lc, rc = F.col(f"{left_prefix}.{a}"), F.col(f"{right_prefix}.{a}")
        c = ~lc.eqNullSafe(rc) if a in null_safe else (lc != rc)
        out = c if out is None else (out | c)
    return out
