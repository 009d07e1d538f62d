"""Alerts as one JSON document and as size-bounded JSON arrays."""

import json
import os
import random

import pytest

from logweave.operators.alerts import alert_payload_arrays
from logweave.sources.sinks import write_alerts, write_alerts_document


def alerts(spark, n, seed=1, long=()):
    rng = random.Random(seed)
    rows = [(i + 1, f"flow-{i} \"é\\", "cause " + "x" * (rng.randrange(200) if i not in long else 900), "line\nbreak", rng.choice(["critical", "info"])) for i in range(n)]
    df = spark.createDataFrame(rows, "alert_pos long, request_id string, root_cause string, recommendation string, severity string")
    return df.repartition(5), [dict(zip(("request_id", "root_cause", "recommendation", "severity"), r[1:])) for r in rows]


def test_document_is_one_ordered_array(spark, tmp_path):
    path = str(tmp_path / "alerts.json")
    for n in (0, 1, 300, 40):  # each one replaces the one before
        df, rows = alerts(spark, n)
        write_alerts_document(df, path)
        with open(path, "rb") as fh:
            assert json.loads(fh.read()) == rows
        assert [f for f in os.listdir(tmp_path) if f != ".alerts.json.crc"] == ["alerts.json"]


def test_a_failed_write_leaves_the_old_document(spark, tmp_path, monkeypatch):
    from logweave.sources import sinks

    path = str(tmp_path / "alerts.json")
    df, rows = alerts(spark, 12)
    write_alerts_document(df, path)
    broken = df.selectExpr("alert_pos", "request_id", "root_cause", "if(alert_pos = 7, raise_error('task lost'), recommendation) AS recommendation", "severity")
    results = write_alerts(broken, {"document": lambda x: write_alerts_document(x, path)})
    assert "task lost" in results["document"]
    monkeypatch.setattr(sinks, "_joined", lambda *a: (_ for _ in ()).throw(OSError("store gone")))
    with pytest.raises(OSError):
        write_alerts_document(alerts(spark, 3)[0], path)
    with open(path) as fh:
        assert json.load(fh) == rows
    assert not [f for f in os.listdir(tmp_path) if "draft" in f]


@pytest.mark.parametrize("limit", [400, 1500, 100_000])
def test_arrays_are_bounded_and_hold_every_alert_in_order(spark, limit):
    df, rows = alerts(spark, 150, seed=limit, long={0, 31, 32, 149})
    out = sorted(alert_payload_arrays(df, limit).collect(), key=lambda r: r.first_pos)
    assert [x for r in out for x in json.loads(r.payload)] == rows
    at = 1
    for r in out:
        assert (r.first_pos, r.last_pos - r.first_pos + 1) == (at, r.n_alerts)
        assert len(r.payload.encode()) <= limit or r.n_alerts == 1
        at = r.last_pos + 1
    if limit == 100_000:
        assert len(out) == 1
    else:  # at least as full as halves can be
        assert len(out) <= 2 + 8 + 2 * sum(len(json.dumps(x, ensure_ascii=False).encode()) for x in rows) / (limit / 2 - 1)


def test_no_alerts_no_arrays(spark):
    assert alert_payload_arrays(alerts(spark, 0)[0]).collect() == []
