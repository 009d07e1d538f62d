"""Late lines, replays and counters of a landed stream, against batch results."""

import datetime as dt
import os
import random
from datetime import timedelta

import pytest

from conftest import line
from logweave.operators.correlate import dedup_entries
from logweave.operators.parse import accepted, parse_lines, parse_stats
from logweave.params import Params
from logweave.streaming import landing as S
from logweave.streaming.live import stream_dedup, stream_error_rate, stream_reports

T0 = dt.datetime(2030, 6, 1, 12, 0, 0)
SERVICES = ["api-gateway", "auth-service", "order-service", "payment-service", "inventory-service"]
DELAY = timedelta(seconds=20)


def log_line(rng, second):
    at = T0 + dt.timedelta(seconds=second, microseconds=rng.randrange(10**6))
    return line(ts=at.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), service=rng.choice(SERVICES), level=rng.choice(["INFO", "ERROR", "WARN"]), rid=f"flow-{rng.randrange(9)}", msg=rng.choice(["done", "read timeout"]))


def shuffled_files(folder, seed, n_files=6, per_file=60):
    """Files that arrive out of order: each spans a stretch of time, with stray lines from all of it."""
    rng = random.Random(seed)
    lines = []
    for k in range(n_files):
        own = [log_line(rng, 60 * k + rng.randrange(60)) if rng.random() < 0.7 else log_line(rng, rng.randrange(60 * n_files)) for _ in range(per_file)]
        own += rng.sample(lines, min(len(lines), 5)) + ["not a log line"] * (k % 3)
        lines += own
        path = os.path.join(folder, f"{k}.log")
        with open(path, "w") as fh:
            fh.write("\n".join(own) + "\n")
        os.utime(path, (1_900_000_000 + k, 1_900_000_000 + k))
    return lines


def all_batches(query):
    query.awaitTermination(300)
    assert query.exception() is None
    return query


def to_memory(df, name, folder):
    writer = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{folder}/{name}")
    return all_batches(writer.trigger(availableNow=True).start())


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    src, out = str(tmp_path_factory.mktemp("in")), str(tmp_path_factory.mktemp("landing"))
    lines = shuffled_files(src, 4)
    all_batches(S.land_logs(spark, src, out, delay=DELAY, max_files_per_trigger=1))
    return lines, out, src


def batch_of(spark, lines):
    return parse_lines(spark.createDataFrame([(x,) for x in lines], "raw string"))


def test_every_line_lands_once_and_late_ones_are_marked(spark, landed):
    lines, out, _ = landed
    rows = S.landed(spark, out).collect()
    assert sorted(r.raw for r in rows) == sorted(lines) and {r.batch_id for r in rows} == set(range(6))
    latest = {b: max((r.ts for r in rows if r.ts and r.batch_id <= b)) for b in range(6)}
    for r in rows:
        wm = latest[r.batch_id - 1] - DELAY if r.batch_id else None
        assert r.watermark == wm
        gap = Params().correlation_window
        want = [] if wm is None or r.ts is None else [n for n, reach in (("dedup", timedelta(0)), ("sessions", gap)) if r.ts + reach <= wm]
        assert r.late_for == want
    late = S.late_rows_table(spark, out).collect()
    assert len(late) == sum(len(r.late_for) for r in rows) > 40 and {r.operator for r in late} == {"dedup", "sessions"}


def test_counters_equal_the_batch_statistics(spark, landed):
    lines, out, _ = landed
    counters = S.landing_counters(spark, out)
    totals = counters.groupBy().sum().collect()[0].asDict()
    want = parse_stats(batch_of(spark, lines)).collect()[0].asDict()
    assert {k: totals[f"sum({k})"] for k in want} == want
    late = {r.operator: r["count"] for r in S.late_rows_table(spark, out).groupBy("operator").count().collect()}
    assert {k: totals[f"sum(late_for_{k})"] for k in late} == late


def test_a_replayed_batch_changes_nothing(spark, landed):
    lines, out, src = landed
    before = sorted(map(str, S.landed(spark, out).collect()))
    again = S.land_batch(spark.createDataFrame([("other | lines",)], "raw string"), 3, out, Params(), DELAY, S.default_reach(Params()))
    assert again["batch_id"] == 3 and sorted(map(str, S.landed(spark, out).collect())) == before
    all_batches(S.land_logs(spark, src, out, delay=DELAY, max_files_per_trigger=1))  # restarted: no new files
    assert sorted(map(str, S.landed(spark, out).collect())) == before


def test_a_failed_batch_leaves_no_trace_and_is_landed_later(spark, tmp_path, monkeypatch):
    lines = spark.createDataFrame([(x,) for x in ["a | b", line()]], "raw string")
    args = (str(tmp_path), Params(), DELAY, S.default_reach(Params()))
    with monkeypatch.context() as m:
        m.setattr(S, "_write_json", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            S.land_batch(lines, 0, *args)
    assert S._batches(spark, str(tmp_path)) == []
    assert S.land_batch(lines, 0, *args)["total_lines"] == 2 and S.landed(spark, str(tmp_path)).count() == 2


def test_result_and_side_table_make_the_batch_result(spark, landed, tmp_path):
    lines, out, _ = landed
    entries = accepted(batch_of(spark, lines))
    late, all_landed = S.late_rows_table(spark, out), S.landed_entries(spark, out)
    dropped = S.DroppedRows()
    spark.streams.addListener(dropped)
    try:
        # A line far ahead closes every window; it lands as a batch of its own.
        ahead = line(ts="2030-06-02T12:00:00Z", rid="ahead")
        S.land_batch(spark.createDataFrame([(ahead,)], "raw string"), 6, out, Params(), DELAY, S.default_reach(Params()))
        on_time = {op: S.on_time_entries(spark, out, op) for op in ("dedup", "sessions")}
        to_memory(stream_dedup(on_time["dedup"], DELAY), "ld_dedup", tmp_path)
        to_memory(stream_reports(on_time["sessions"], delay=DELAY, anomalous_only=False), "ld_sessions", tmp_path)
        to_memory(stream_error_rate(on_time["dedup"], delay=DELAY), "ld_rate", tmp_path)
    finally:
        spark.streams.removeListener(dropped)
    assert not any(dropped.dropped.values())

    def rows(df):
        return sorted(map(str, df.collect()))

    result = spark.table("ld_dedup").where("request_id <> 'ahead'")
    assert rows(S.repaired_entries(result, late).select("raw")) == rows(dedup_entries(entries).select("raw"))
    columns = ["request_id", "session", "rules", "n_lines"]
    reports = spark.table("ld_sessions")
    want = S.batch_sessions(entries)
    assert rows(reports.select(*columns)) != rows(want.select(*columns))  # late rows did change sessions
    assert rows(S.repaired_reports(reports, all_landed, late, anomalous_only=False).select(*columns)) == rows(want.select(*columns))
    errors = dedup_entries(entries.where("level = 'ERROR'"))
    counts = errors.groupBy(S.F.window("ts", "60 seconds", "1 second").alias("w")).count()
    got = S.repaired_error_rate(spark.table("ld_rate"), result, late)
    assert rows(got.selectExpr("window_start", "errors")) == rows(counts.selectExpr("w.start as window_start", "count as errors"))


def test_a_plain_stream_drops_what_the_landing_marks(spark, landed, tmp_path):
    """Spark's own counter over one file per batch: rows of one batch less than the landing marks, never more."""
    from logweave.streaming.live import stream_entries

    _, out, src = landed
    dropped = S.DroppedRows()
    spark.streams.addListener(dropped)
    try:
        entries, _ = stream_entries(spark, src, max_files_per_trigger=1)
        query = to_memory(stream_dedup(entries, DELAY), "ld_plain", tmp_path)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(dropped)
    marked = S.late_rows_table(spark, out).where("operator = 'dedup' and batch_id < 6").count()
    assert 0 < dropped.dropped[str(query.id)] <= marked


def test_edge_cases(spark, tmp_path):
    args = (str(tmp_path), Params(), DELAY, S.default_reach(Params()))
    assert S.land_batch(spark.createDataFrame([], "raw string"), 0, *args)["max_ts_us"] is None
    assert S.land_batch(spark.createDataFrame([("x",), (None,)], "raw string"), 1, *args)["watermark_us"] is None
    got = S.land_batch(spark.createDataFrame([(line(),)], "raw string"), 2, *args)
    assert got["watermark_us"] is None and got["max_ts_us"] is not None
    assert S.landing_counters(spark, str(tmp_path)).count() == 3 and S.late_rows_table(spark, str(tmp_path)).count() == 0
