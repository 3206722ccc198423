"""Scalar column functions: record-key parts, ISO instants, trading dates, path segments, trading sessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trading-session defaults of the quote producer
TRADING_ZONE = "Europe/Amsterdam"
REGULAR_OPEN = "09:00"
REGULAR_CLOSE = "17:30"
DAY_US = 86_400_000_000


def key_part(key: Column, index: int) -> Column:
    """P5 / Q9: part ``index`` of ``key`` split on ':' the way Java's ``String.split`` does it: trailing empty
    parts are dropped, and a key of only separators has no parts at all (``""`` still has one empty part)."""
    parts = F.split(F.regexp_replace(key, ":+$", ""), ":", -1)
    return F.when(key.isNotNull() & ~key.rlike("^:+$"), F.get(parts, index))


def iso_instant(us: Column) -> Column:
    """Epoch micros -> ISO-8601 UTC text as ``Instant.toString`` writes it (0, 3 or 6 fraction digits)."""
    base = F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.pmod(us, F.lit(1_000_000))
    return (
        F.when(us.isNull(), F.lit(None))
        .when(frac == 0, F.concat(base, F.lit("Z")))
        .when(frac % 1000 == 0, F.concat(base, F.lit("."), F.lpad((frac / 1000).cast("int").cast("string"), 3, "0"), F.lit("Z")))
        .otherwise(F.concat(base, F.lit("."), F.lpad(frac.cast("string"), 6, "0"), F.lit("Z")))
    )


def trading_date(us: Column) -> Column:
    """UTC calendar date of an epoch-micros instant, as ``YYYY-MM-DD`` text."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd")


def safe_path_segment(s: Column) -> Column:
    """Characters other than letters, digits, '.', '_', '=', '-' become '_'."""
    return F.regexp_replace(s, "[^A-Za-z0-9._=-]", "_")


def _hhmm_us(hhmm: str) -> int:
    h, m = hhmm.split(":", 1)
    return (int(h) * 60 + int(m)) * 60_000_000


def session_label(us: Column, zone: str = TRADING_ZONE, open_hhmm: str = REGULAR_OPEN,
                  close_hhmm: str = REGULAR_CLOSE) -> Column:
    """P20: ``premarket`` before the local open, ``regular`` up to and including the local close (to the
    microsecond), ``afterhours`` after it, ``unknown`` without a time. Every day is a trading day."""
    local_us = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), zone))
    tod = F.pmod(local_us, F.lit(DAY_US))
    return (
        F.when(us.isNull(), F.lit("unknown"))
        .when(tod < _hhmm_us(open_hhmm), F.lit("premarket"))
        .when(tod <= _hhmm_us(close_hhmm), F.lit("regular"))
        .otherwise(F.lit("afterhours"))
    )


def resolve_date(text: Column) -> Column:
    """A ``YYYY-MM-DD`` parameter, or today's UTC date when missing or not a date."""
    ok = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.coalesce(F.when(ok, text.try_cast("date")), F.current_date())
