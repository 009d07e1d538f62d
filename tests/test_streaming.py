import datetime as dt
import os
import tempfile

from conftest import line
from logweave.streaming.live import stream_dedup, stream_entries, stream_error_rate, stream_reports

CHAIN = ["api-gateway", "auth-service", "order-service", "payment-service", "inventory-service"]


def _write(d, name, lines):
    with open(os.path.join(d, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _run(df, name, mode="append"):
    ckpt = tempfile.mkdtemp(prefix="lw-stream-ckpt-")
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return q


def flow(rid, start, level="INFO", n=5):
    return [line(ts=(start + dt.timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%SZ"), service=CHAIN[i], level=level, rid=rid) for i in range(n)]


def test_stream_reports_close_sessions_with_sentinel(spark):
    d = tempfile.mkdtemp(prefix="lw-stream-")
    t0 = dt.datetime(2026, 3, 16, 15, 0, 0)
    _write(d, "a.log", flow("ok", t0) + flow("bad", t0, level="ERROR") + flow("short", t0, n=3) + ["garbage"])
    # a far-future line of its own request moves the watermark past every session
    _write(d, "b.log", [line(ts="2026-03-17T00:00:00Z", rid="sentinel", level="ERROR")])
    entries, rejects = stream_entries(spark, d)
    _run(stream_reports(entries), "lw_reports")
    rows = {r.request_id: r.rules for r in spark.sql("SELECT * FROM lw_reports").collect()}
    assert rows == {"bad": ["error_detected"], "short": ["missing_hop(payment-service)", "missing_hop(inventory-service)"]}


def test_stream_dedup_and_rejects(spark):
    d = tempfile.mkdtemp(prefix="lw-stream-")
    t0 = dt.datetime(2026, 3, 16, 15, 0, 0)
    lines = flow("r", t0)
    _write(d, "a.log", lines + lines[:2] + ["bad line"])
    entries, rejects = stream_entries(spark, d)
    _run(stream_dedup(entries), "lw_dedup")
    assert spark.sql("SELECT count(*) AS n FROM lw_dedup").collect()[0].n == 5
    _run(rejects, "lw_rejects")
    assert [r.error_kind for r in spark.sql("SELECT * FROM lw_rejects").collect()] == ["fields"]


def test_stream_error_rate_flags_spike(spark):
    d = tempfile.mkdtemp(prefix="lw-stream-")
    t0 = dt.datetime(2026, 3, 16, 15, 0, 0)
    errs = [line(ts=(t0 + dt.timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%SZ"), level="ERROR", rid=f"e{i}") for i in range(12)]
    _write(d, "a.log", errs)
    _write(d, "b.log", [line(ts="2026-03-17T00:00:00Z", rid="sentinel", level="ERROR")])
    entries, _ = stream_entries(spark, d)
    _run(stream_error_rate(entries), "lw_rate")
    spikes = spark.sql("SELECT * FROM lw_rate WHERE spike").collect()
    assert spikes and max(r.errors for r in spikes) == 12


def test_stream_alerts_to_json_sink(spark):
    from logweave.streaming.live import stream_alerts

    d = tempfile.mkdtemp(prefix="lw-stream-")
    t0 = dt.datetime(2026, 3, 16, 15, 0, 0)
    _write(d, "a.log", flow("ok", t0) + flow("bad", t0, level="ERROR") + flow("bad", t0 + dt.timedelta(minutes=5), n=2))
    _write(d, "b.log", [line(ts="2026-03-17T00:00:00Z", rid="sentinel", level="ERROR")])
    entries, _ = stream_entries(spark, d)
    out = tempfile.mkdtemp(prefix="lw-stream-out-")
    q = (stream_alerts(entries).writeStream.format("json").option("path", out)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="lw-stream-ckpt-")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = sorted((r.request_id, r.severity, r.root_cause) for r in spark.read.json(out).collect())
    assert rows == [
        ("bad", "critical", "Rule-based detection: error_detected"),
        ("bad", "warning", "Rule-based detection: missing_hop(order-service), missing_hop(payment-service), missing_hop(inventory-service)"),
    ]


def test_stream_error_rate_closes_windows_on_non_error_lines(spark):
    d = tempfile.mkdtemp(prefix="lw-stream-")
    t0 = dt.datetime(2026, 3, 16, 15, 0, 0)
    errs = [line(ts=(t0 + dt.timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%SZ"), level="ERROR", rid=f"e{i}") for i in range(3)]
    _write(d, "a.log", errs + [line(ts="2026-03-17T00:00:00Z", rid="quiet", level="INFO")])
    entries, _ = stream_entries(spark, d)
    _run(stream_error_rate(entries), "lw_rate_quiet")
    rows = spark.sql("SELECT * FROM lw_rate_quiet").collect()
    # every window that holds one of the three errors is emitted: 60 + 2 start positions
    assert len(rows) == 62 and max(r.errors for r in rows) == 3
