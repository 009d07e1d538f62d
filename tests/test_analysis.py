import datetime as dt
import json
import os
import random
import tempfile

import pytest

from bruteforce import CHAIN, analyze as brute
from logweave.plans.analysis import analyze
from logweave.sources.logfiles import read_logs
from logweave.sources.sinks import write_alerts, write_alerts_json

BASE = dt.datetime(2026, 3, 16, 15, 56, 2)


def gen_lines(seed, n_requests=60):
    rnd = random.Random(seed)
    lines = []
    for r in range(n_requests):
        rid = f"req-{seed}-{r:03d}"
        t = BASE + dt.timedelta(milliseconds=200 * r)
        hops = CHAIN[: rnd.choice([5, 5, 5, 4, 3, 1])]
        for i, svc in enumerate(hops):
            t += dt.timedelta(milliseconds=rnd.randint(1, 400))
            level = rnd.choice(["INFO"] * 6 + ["WARN", "ERROR", "ERROR", "DEBUG"])
            msg = rnd.choice(["Received incoming request", "Upstream timeout", "context deadline exceeded", "Payment declined", "ok"])
            lat = rnd.choice([10, 90, 499, 500, 501, 1505, 61500])
            raw = f"{t.strftime('%Y-%m-%dT%H:%M:%S.%f')}Z | {svc:<17} | {level:<5} | {rid:<19} | {msg:<45} | latency={lat}ms"
            lines.append(raw)
            if rnd.random() < 0.1:
                lines.append(raw)  # repeated line
    lines += ["garbage", "   ", "2026-03-16T15:56:02Z | svc | BAD | r | m | latency=1ms"]
    rnd.shuffle(lines)
    return lines


def write_files(lines, d, n_files=5):
    for i in range(n_files):
        with open(os.path.join(d, f"svc{i}.log"), "w", newline="") as fh:
            for x in lines[i::n_files]:
                fh.write(x + ("\r\n" if i == 0 else "\n"))


@pytest.mark.parametrize("seed", [11, 12])
def test_end_to_end_matches_brute_force(spark, seed):
    lines = gen_lines(seed)
    d = tempfile.mkdtemp(prefix="lw-e2e-")
    write_files(lines, d)
    a = analyze(read_logs(spark, d))
    got = [r.asDict() for r in a.alerts.orderBy("alert_pos").collect()]
    want = brute(lines)
    assert [g["request_id"] for g in got] == [w["request_id"] for w in want]
    for g, w in zip(got, want):
        assert g["severity"] == w["severity"]
        if w["request_id"] == "GLOBAL_SYSTEM_SPIKE":
            assert g["root_cause"].endswith(f"starting at {w['start']}.")
        else:
            assert g["root_cause"] == w["root_cause"]
    s = a.summary.collect()[0]
    assert s.total == len(want) and s.critical + s.warning + s.info == len(want)
    assert a.stats()["parse"]["rejected_lines"] == 3


def test_read_logs_line_rules(spark):
    d = tempfile.mkdtemp(prefix="lw-src-")
    with open(os.path.join(d, "a.log"), "wb") as fh:
        fh.write(b"one\r\ntwo\rstill two\n\n   \n\r\nlast-no-newline")
    with open(os.path.join(d, "b.txt"), "w") as fh:
        fh.write("not a log\n")
    os.makedirs(os.path.join(d, "nested"))
    with open(os.path.join(d, "nested", "c.log"), "w") as fh:
        fh.write("nested\n")
    got = sorted(r.raw for r in read_logs(spark, d).collect())
    assert got == sorted(["one", "two\rstill two", "   ", "last-no-newline"])


def test_read_logs_same_file_twice_gives_duplicates(spark):
    d = tempfile.mkdtemp(prefix="lw-dup-")
    for name in ("x.log", "y.log"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("2026-03-16T15:56:02Z | api-gateway | ERROR | r1 | boom | latency=1ms\n")
    a = analyze(read_logs(spark, d))
    assert a.entries.count() == 2
    assert a.reports.count() == 1


def test_no_log_files_is_an_error(spark):
    d = tempfile.mkdtemp(prefix="lw-none-")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|Path does not exist"):
        read_logs(spark, d).count()


def test_sinks_fan_out(spark):
    d = tempfile.mkdtemp(prefix="lw-sink-")
    write_files(gen_lines(3, 10), d)
    a = analyze(read_logs(spark, d))
    out = os.path.join(tempfile.mkdtemp(prefix="lw-out-"), "alerts")

    def broken(_df):
        raise RuntimeError("webhook down")

    res = write_alerts(a.alerts, {"file": lambda df: write_alerts_json(df, out), "webhook": broken})
    assert res["file"] is None and "webhook down" in res["webhook"]
    back = spark.read.json(out)
    assert sorted(back.columns) == ["recommendation", "request_id", "root_cause", "severity"]
    assert back.count() == a.alerts.count()
    for r in back.limit(3).collect():
        json.dumps(r.asDict())


def test_run_writes_nothing_without_anomalies(spark):
    from logweave.plans.analysis import run

    d = tempfile.mkdtemp(prefix="lw-run-")
    t0 = BASE
    with open(os.path.join(d, "a.log"), "w") as fh:
        for i, svc in enumerate(CHAIN):
            fh.write(f"{(t0 + dt.timedelta(seconds=i)).strftime('%Y-%m-%dT%H:%M:%SZ')} | {svc} | INFO | r1 | ok | latency=5ms\n")
    written = []
    res = run(spark, d, {"file": written.append})
    assert res["status"] == "no anomalies" and written == []
    assert res["stats"]["detection"] == {"total_groups": 1, "anomalous_groups": 0}


def test_run_alerts(spark):
    from logweave.plans.analysis import run

    d = tempfile.mkdtemp(prefix="lw-run-")
    write_files(gen_lines(5, 20), d)
    written = []
    res = run(spark, d, {"mem": lambda df: written.append(df.count())})
    assert res["status"] == "alerted" and res["sinks"] == {"mem": None}
    assert written[0] == res["summary"]["total"]
    assert res["stats"]["parse"]["rejected_lines"] == 3 and len(res["first_rejects"]) == 3


def test_cli(spark):
    from logweave.cli import main

    d = tempfile.mkdtemp(prefix="lw-cli-")
    write_files(gen_lines(9, 15), d)
    out = os.path.join(tempfile.mkdtemp(prefix="lw-cli-out-"), "alerts")
    res = main([d, "--alerts-out", out, "--latency-threshold", "500ms", "--spike-window", "1m"])
    assert res["status"] == "alerted" and res["sinks"] == {"file": None}
    assert spark.read.json(out).count() == res["summary"]["total"]


def test_json_sink_keeps_alert_order_across_files(spark):
    import glob as _glob

    d = tempfile.mkdtemp(prefix="lw-order-")
    write_files(gen_lines(21, 80), d)
    a = analyze(read_logs(spark, d))
    want = [r.request_id for r in a.alerts.orderBy("alert_pos").collect()]
    out = os.path.join(tempfile.mkdtemp(prefix="lw-order-out-"), "alerts")
    write_alerts_json(a.alerts.repartition(4), out)
    got = []
    for fn in sorted(_glob.glob(os.path.join(out, "part-*.json"))):
        with open(fn) as fh:
            got += [json.loads(x)["request_id"] for x in fh if x.strip()]
    assert got == want


def test_staged_run_observes_parse_counters(spark):
    d = tempfile.mkdtemp(prefix="lw-obs-")
    write_files(gen_lines(4, 10), d)
    staged = analyze(read_logs(spark, d), stage_parsed=True)
    plain = analyze(read_logs(spark, d))
    assert staged.stats() == plain.stats()
    assert getattr(staged, "_parse_observation", None) is not None


def test_source_file_provenance_and_custom_raw_column(spark):
    from logweave.operators.correlate import dedup_entries
    from logweave.operators.parse import parse_logs

    d = tempfile.mkdtemp(prefix="lw-src-file-")
    for name in ("x.log", "y.log"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("2026-03-16T15:56:02Z | api-gateway | ERROR | r1 | boom | latency=1ms\nbad line\n")
    entries, rejects = parse_logs(read_logs(spark, d, with_source_file=True))
    assert sorted(os.path.basename(r.source_file) for r in entries.collect()) == ["x.log", "y.log"]
    assert sorted(os.path.basename(r.source_file) for r in rejects.collect()) == ["x.log", "y.log"]
    assert dedup_entries(entries).count() == 1  # the same line from two files is one entry

    other = spark.createDataFrame([("2026-03-16T15:56:02Z | svc | INFO | r | m | latency=2ms", 7)], "line string, n int")
    e, _ = parse_logs(other, raw_col="line")
    r = e.collect()[0]
    assert (r.raw, r.n, r.latency_ms) == ("2026-03-16T15:56:02Z | svc | INFO | r | m | latency=2ms", 7, 2)
