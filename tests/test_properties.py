"""Property tests: Spark operators against plain-Python brute force on random inputs.

Each hypothesis example becomes one small DataFrame (one Spark job per example).
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bruteforce import dur, parse
from logweave.functions.text import duration_text_ms
from logweave.operators.correlate import correlate, dedup_entries
from logweave.operators.parse import accepted, parse_lines

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

pad = st.sampled_from(["", " ", "  ", "\t", " \t "])
service = st.sampled_from(["api-gateway", "auth-service", "order-service", "x", "", " "])
level = st.sampled_from(["INFO", "WARN", "ERROR", "DEBUG", "info", "TRACE", ""])
rid = st.sampled_from(["req-1", "req-2", "r", "", "  "])
msg = st.sampled_from(["ok", "Gateway Timeout", "a | b", "", "context deadline exceeded"])
lat = st.sampled_from(["latency=45ms", "latency=501ms", "45", "latency=slow", "", "latency=-5ms", "latency=+7ms", "latency=45.5ms", "latency= 4ms"])


@st.composite
def log_line(draw):
    t = dt.datetime(2026, 3, 16) + dt.timedelta(microseconds=draw(st.integers(0, 86_400_000_000)))
    ts = draw(st.sampled_from([t.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), t.strftime("%Y-%m-%dT%H:%M:%SZ"), "yesterday", t.strftime("%Y-%m-%d %H:%M:%S")]))
    fields = [ts, draw(service), draw(level), draw(rid), draw(msg), draw(lat)]
    n = draw(st.sampled_from([6, 6, 6, 5, 3]))
    return " | ".join(draw(pad) + f + draw(pad) for f in fields[:n])


@SETTINGS
@given(st.lists(log_line(), min_size=1, max_size=40))
def test_parse_matches_brute_force(lines_df, lines):
    got = {}
    for r in parse_lines(lines_df(lines)).collect():
        got.setdefault(r.raw, set()).add(
            None if r.error_kind else (r.ts, r.service, r.level, r.request_id, r.message, r.latency_ms)
        )
    for raw in lines:
        e = parse(raw)
        want = None if e is None else (e["ts"], e["service"], e["level"], e["rid"], e["msg"], e["ms"])
        assert got[raw] == {want}, raw


@SETTINGS
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=50))
def test_duration_text_matches_brute_force(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "ms bigint").select("ms", duration_text_ms("ms").alias("d")).collect()
    assert {(r.ms, r.d) for r in rows} == {(v, dur(v)) for v in values}


@SETTINGS
@given(st.lists(log_line(), min_size=1, max_size=40), st.randoms(use_true_random=False))
def test_dedup_idempotent_and_order_invariant(lines_df, lines, rnd):
    lines = lines + lines[: len(lines) // 2]  # repeats
    shuffled = list(lines)
    rnd.shuffle(shuffled)
    e1, e2 = accepted(parse_lines(lines_df(lines))), accepted(parse_lines(lines_df(shuffled)))
    d1 = sorted(dedup_entries(e1).select("raw").collect())
    assert d1 == sorted(dedup_entries(dedup_entries(e1)).select("raw").collect())
    assert len(d1) == len({r.raw for r in d1})
    key = lambda df: sorted((r.request_id, r.entry_pos, r.raw) for r in correlate(df).collect())
    assert key(e1) == key(e2)
