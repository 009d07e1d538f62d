import datetime as dt
import random

import pytest

from bruteforce import parse
from conftest import line
from logweave.operators.parse import first_rejects, parse_lines, parse_logs, parse_stats
from logweave.params import Params

UTC = dt.timezone.utc


def parse_one(lines_df, raw):
    return parse_lines(lines_df([raw])).collect()[0]


# --- lines from pools of field values, against the plain parser -----------------------

#: Per field: values that are fine, and values that are not, with the kind and the text of the reject.
POOLS = [
    (["1999-12-31T23:59:59.5Z", " 2040-02-29T00:00:00Z"], [("31.12.1999", "timestamp", 'parse timestamp: invalid RFC 3339 time "31.12.1999"')]),
    (["ledger", "  mailer\t"], [("\t ", "service", "missing service name")]),
    (["DEBUG", " WARN "], [("FATAL", "level", "invalid log level: FATAL"), ("Warn", "level", "invalid log level: Warn")]),
    (["tx:9", " tx:10 "], [("", "request_id", "missing request ID")]),
    (["queue drained", " cache timeout"], [("   ", "message", "missing message")]),
    (["latency=3ms", "latency=fast", "", "-12", "latency=7"], []),
]


def test_every_mix_of_field_values(lines_df):
    """All good values with each other, and one or two bad values among good ones: the first bad field decides."""
    rng = random.Random(1)
    want = {}
    for _ in range(120):
        fields = [rng.choice(good) for good, _ in POOLS]
        want[" | ".join(fields)] = None
    for _ in range(120):
        fields = [rng.choice(good) for good, _ in POOLS]
        places = sorted(rng.sample(range(5), rng.choice((1, 2))))
        chosen = [rng.choice(POOLS[k][1]) for k in places]
        for k, (value, _, _) in zip(places, chosen):
            fields[k] = value
        want[" | ".join(fields)] = chosen[0][1:]
    for n in range(1, 6):
        want[" | ".join(rng.choice(good) for good, _ in POOLS[:n])] = ("fields", f"expected 6 pipe-delimited fields, got {n}")
    rows = parse_lines(lines_df(list(want))).collect()
    assert len(rows) == len(want)
    for r in rows:
        plain = parse(r.raw)
        assert (plain is None) == (want[r.raw] is not None) == (r.error_kind is not None)
        if plain is None:
            assert (r.error_kind, r.parse_error) == want[r.raw]
        else:
            assert (r.ts, r.service, r.level, r.request_id, r.message, r.latency_ms) == tuple(plain[k] for k in ("ts", "service", "level", "rid", "msg", "ms"))


# --- boundaries ----------------------------------------------------------------------

def test_first_failing_check_wins(lines_df):
    r = parse_one(lines_df, line(ts="nope", service=" ", level="X"))
    assert r.error_kind == "timestamp"
    r = parse_one(lines_df, line(service=" ", level="X", rid=" "))
    assert r.error_kind == "service"


def test_unicode_whitespace_is_trimmed(lines_df):
    r = parse_one(lines_df, line(service="\torder-service ", rid=" req-1\t"))
    assert r.parse_error is None
    assert (r.service, r.request_id) == ("order-service", "req-1")


@pytest.mark.parametrize("pad", ["\u00a0", "\u3000", "\u2003", "\u0085", "\x0b", "\r"])
def test_every_unicode_space_is_trimmed(lines_df, pad):
    r = parse_one(lines_df, line(service=pad + "order-service" + pad, msg=pad + "m" + pad))
    assert r.parse_error is None and (r.service, r.message) == ("order-service", "m")


def test_non_space_is_not_trimmed(lines_df):
    r = parse_one(lines_df, line(service="\u200bsvc"))  # zero-width space is not White_Space
    assert r.service == "\u200bsvc"


def test_levels_are_case_sensitive_and_debug_is_valid(lines_df):
    assert parse_one(lines_df, line(level="DEBUG")).parse_error is None
    assert parse_one(lines_df, line(level="info")).error_kind == "level"


def test_message_with_separator_loses_tail_but_is_accepted(lines_df):
    r = parse_one(lines_df, line(msg="a | b"))
    assert r.parse_error is None
    assert r.message == "a" and r.latency_ms == 0


@pytest.mark.parametrize(
    "lat, ms",
    [("latency=-5ms", -5), ("latency=+5ms", 5), ("63", 63), ("latency=63", 63), (" latency=63ms ", 63),
     ("latency= 45ms", 0), ("latency=45.5ms", 0), ("latency=" + "9" * 20 + "ms", 0), ("latency=63msms", 0), ("latency=latency=4ms", 0)],
)
def test_latency_forms(lines_df, lat, ms):
    assert parse_one(lines_df, line(lat=lat)).latency_ms == ms


@pytest.mark.parametrize(
    "ts, ok",
    [
        ("2031-11-02T09:15:42Z", True),
        ("2031-11-02T09:15:42,5Z", True),
        ("2031-11-02T1:01:23Z", True),
        ("2031-11-02T09:15:42.123456789Z", True),
        ("2031-11-02T09:15:42.1234567891Z", True),
        ("2031-11-02T09:15:42+05:30", True),
        ("2031-11-02", False),
        ("2031-11-02 09:15:42Z", False),
        ("T12:00:00", False),
        ("2026-02-30T00:00:00Z", False),
        ("2031-11-02T24:00:00Z", False),
        ("2031-11-02T00:00:60Z", False),
        ("2031-11-02T09:15:42", False),
        ("2031-11-02t09:15:42z", False),
        ("0000-01-01T00:00:00Z", False),
        ("2031-11-02T09:15:42.Z", False),
    ],
)
def test_timestamp_shapes(lines_df, ts, ok):
    r = parse_one(lines_df, line(ts=ts))
    assert (r.parse_error is None) == ok, r.parse_error


def test_offsets_nanos_and_zero_offset(lines_df):
    r = parse_one(lines_df, line(ts="2031-11-02T14:45:42.123456789+05:30"))
    assert r.ts == dt.datetime(2031, 11, 2, 9, 15, 42, 123456)
    assert r.ts_nanos == 789 and r.tz_offset == "+05:30"
    assert parse_one(lines_df, line(ts="2031-11-02T09:15:42+00:00")).tz_offset == "Z"


def test_long_lines_are_entries_unless_a_limit_is_set(lines_df):
    df = lines_df([line(msg="x" * (2 << 20)), line()])
    parsed = parse_lines(df)
    assert [r.error_kind for r in parsed.select("error_kind").collect()] == [None, None]
    assert parse_stats(parsed).collect()[0].long_lines == 1
    limited = parse_lines(df, Params(max_line_bytes=1 << 20)).select("error_kind", "parse_error").collect()
    assert sorted(str(r.error_kind) for r in limited) == ["None", "line_too_long"]


def test_split_and_stats(lines_df):
    df = lines_df([line(), line(level="BAD"), line(ts="x"), "   "])
    entries, rejects = parse_logs(df)
    assert entries.count() == 1 and rejects.count() == 3
    s = parse_stats(parse_lines(df)).collect()[0]
    assert (s.total_lines, s.rejected_lines, s.accepted_lines, s.rejected_fields, s.rejected_level, s.rejected_timestamp) == (4, 3, 1, 1, 1, 1)
    assert len(first_rejects(rejects).collect()) == 3
