"""Column expressions for the text rules of the log format.

All helpers return ``Column`` objects built from Spark built-ins, so they stay
inside whole-stage codegen. None depends on the session time zone: timestamps
are rendered from ``unix_micros`` arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Unicode White_Space characters trimmed around fields
# (U+0009-U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028,
# U+2029, U+202F, U+205F, U+3000). ``trim`` alone strips only U+0020.
UNICODE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# RFC 3339 with 'T', optional fraction ('.' or ','), 'Z' or a numeric offset.
RFC3339_RE = r"\A(\d{4})-(\d\d)-(\d\d)T(\d{1,2}):(\d\d):(\d\d)(?:[.,](\d+))?(Z|[+-]\d\d:\d\d)\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c) -> Column:
    """Strip leading and trailing Unicode white space (a character-set trim, no regex)."""
    return F.trim(_col(c), F.lit(UNICODE_SPACE))


def trim_prefix(c, prefix: str) -> Column:
    """Remove ``prefix`` once if the value starts with it."""
    c = _col(c)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


def trim_suffix(c, suffix: str) -> Column:
    """Remove ``suffix`` once if the value ends with it."""
    c = _col(c)
    return F.when(c.endswith(suffix), F.left(c, F.length(c) - len(suffix))).otherwise(c)


_LATENCY_RE = r"\A(?:latency=)?([+-]?[0-9]+)(?:ms)?\z"


def parse_latency_ms(c) -> Column:
    """``latency=45ms`` -> 45: trim, drop one ``latency=`` prefix and one ``ms``
    suffix, parse a base-10 integer; anything else (or out of BIGINT range) -> 0.

    One anchored regex gives the same result as the three steps (the optional
    groups match at most once, so ``latency=latency=4ms`` and ``4msms`` fail).
    """
    digits = F.regexp_extract(trim_space(c), _LATENCY_RE, 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_rfc3339(c) -> Column:
    """Parse an RFC 3339 timestamp text.

    Returns ``struct<ts: timestamp, ts_nanos: int, tz_offset: string>``; ``ts`` is
    NULL when the text is not a valid RFC 3339 time (shape checked by regex, the
    calendar by ``try_cast``: Feb 30, hour 24 and second 60 fail). ``ts`` keeps
    microseconds; ``ts_nanos`` holds fraction digits 7-9 (ordering tie-break
    only); ``tz_offset`` is ``Z`` or ``+hh:mm`` (a zero offset is written ``Z``).
    Reference it through a column alias: the struct is meant to be computed once.
    """
    c = _col(c)
    ok = c.rlike(RFC3339_RE) & ~c.startswith("0000")
    # ',' is accepted as the decimal mark; the cast keeps microseconds of any fraction.
    ts = F.when(ok, F.when(c.contains(","), F.translate(c, ",", ".")).otherwise(c).try_cast("timestamp"))
    zulu = c.endswith("Z")
    # Digits 7-9 of the fraction, computed only when the fraction is that long.
    dot = F.greatest(F.instr(c, "."), F.instr(c, ","))
    n_frac = F.when(dot > 0, F.length(c) - dot - F.when(zulu, F.lit(1)).otherwise(F.lit(6))).otherwise(F.lit(0))
    extra = F.substring(c, dot + 7, F.least(n_frac - 6, F.lit(3)))
    nanos = F.when(ok & (n_frac > 6), F.rpad(extra, 3, "0").try_cast("int")).otherwise(F.lit(0))
    off = F.when(zulu, F.lit("Z")).otherwise(F.substring(c, -6, 6))
    tz = F.when(ok, F.when(off.isin("+00:00", "-00:00"), F.lit("Z")).otherwise(off))
    return F.struct(ts.alias("ts"), nanos.alias("ts_nanos"), tz.alias("tz_offset"))


def offset_seconds(tz_offset) -> Column:
    """``Z`` -> 0, ``+05:30`` -> 19800, ``-01:00`` -> -3600."""
    o = _col(tz_offset)
    mag = F.substring(o, 2, 2).try_cast("int") * 3600 + F.substring(o, 5, 2).try_cast("int") * 60
    return F.when(o == "Z", F.lit(0)).when(o.startswith("-"), -mag).otherwise(mag)


def _date_time_text(micros: Column) -> tuple[Column, Column]:
    secs = F.floor(micros / 1_000_000)
    day = F.date_from_unix_date(F.floor(secs / 86400).cast("int")).cast("string")
    sod = F.pmod(secs, F.lit(86400))
    hms = F.format_string("%02d:%02d:%02d", (sod / 3600).cast("int"), ((sod / 60) % 60).cast("int"), (sod % 60).cast("int"))
    return day, hms


def format_rfc3339_seconds(ts, tz_offset) -> Column:
    """Render ``ts`` in its parsed offset, truncated to seconds: ``2026-03-16T15:56:03Z``."""
    off = _col(tz_offset)
    local = F.unix_micros(_col(ts)) + offset_seconds(off).cast("bigint") * 1_000_000
    day, hms = _date_time_text(local)
    return F.concat(day, F.lit("T"), hms, off)


def format_utc_micros(ts) -> Column:
    """Render ``ts`` in UTC with six fraction digits: ``2024-01-01T00:00:07.179575Z``."""
    us = F.unix_micros(_col(ts))
    day, hms = _date_time_text(us)
    return F.concat(day, F.lit("T"), hms, F.lit("."), F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"), F.lit("Z"))


def duration_text_ms(ms) -> Column:
    """Text of a whole-millisecond duration as the log tool prints it.

    ``0`` -> ``0s``, ``503`` -> ``503ms``, ``1505`` -> ``1.505s``, ``60000`` -> ``1m0s``,
    ``3600500`` -> ``1h0m0.5s``; negative values get a leading ``-``.
    """
    ms = _col(ms).cast("bigint")
    a = F.abs(ms)
    h = F.floor(a / 3_600_000)
    m = F.pmod(F.floor(a / 60_000), F.lit(60))
    s = F.pmod(F.floor(a / 1000), F.lit(60))
    frac = F.pmod(a, F.lit(1000))
    frac_txt = F.when(frac > 0, F.concat(F.lit("."), F.rtrim(F.lpad(frac.cast("string"), 3, "0"), F.lit("0")))).otherwise(F.lit(""))
    long_txt = F.concat(
        F.when(h > 0, F.concat(h.cast("string"), F.lit("h"))).otherwise(F.lit("")),
        F.when(a >= 60_000, F.concat(m.cast("string"), F.lit("m"))).otherwise(F.lit("")),
        s.cast("string"), frac_txt, F.lit("s"),
    )
    body = F.when(a < 1000, F.concat(a.cast("string"), F.lit("ms"))).otherwise(long_txt)
    return F.when(ms == 0, F.lit("0s")).when(ms < 0, F.concat(F.lit("-"), body)).otherwise(body)
