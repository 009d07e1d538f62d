import pytest
from pyspark.sql import functions as F

from conftest import line
from logweave.functions.text import duration_text_ms
from logweave.operators.parse import accepted, parse_lines
from logweave.operators.rules import detect, detection_stats, evaluate_rules, service_chain_gaps
from logweave.params import Params

CHAIN = ["api-gateway", "auth-service", "order-service", "payment-service", "inventory-service"]


def entries_of(lines_df, lines):
    return accepted(parse_lines(lines_df(lines)))


def full_flow(rid, level="INFO", lat=10, msg="ok", start=0):
    return [line(ts=f"2026-03-16T15:56:{start + i:02d}Z", service=s, level=level, rid=rid, msg=msg, lat=f"latency={lat}ms") for i, s in enumerate(CHAIN)]


@pytest.mark.parametrize(
    "ms, text",
    [(0, "0s"), (1, "1ms"), (503, "503ms"), (999, "999ms"), (1000, "1s"), (1500, "1.5s"), (1505, "1.505s"), (60000, "1m0s"),
     (61500, "1m1.5s"), (3600000, "1h0m0s"), (3600500, "1h0m0.5s"), (90061001, "25h1m1.001s"), (-1500, "-1.5s"), (-20, "-20ms")],
)
def test_duration_text(spark, ms, text):
    assert spark.range(1).select(duration_text_ms(F.lit(ms)).alias("d")).collect()[0].d == text


def test_healthy_flow_has_no_report(lines_df):
    e = entries_of(lines_df, full_flow("r1"))
    assert detect(e).count() == 0
    assert detection_stats(evaluate_rules(e)).collect()[0].asDict() == {"total_groups": 1, "anomalous_groups": 0}


def test_rules_in_order(lines_df):
    lines = [
        line(ts="2026-03-16T15:56:00Z", service="api-gateway", level="ERROR", rid="r", msg="Gateway TIMEOUT", lat="latency=700ms"),
        line(ts="2026-03-16T15:55:59Z", service="order-service", rid="r", lat="latency=1505ms"),
        line(ts="2026-03-16T15:56:01Z", service="custom-svc", rid="r"),
    ]
    r = detect(entries_of(lines_df, lines)).collect()[0]
    assert r.rules == [
        "error_detected",
        "high_latency(1.505s in order-service)",
        "missing_hop(auth-service)",
        "missing_hop(payment-service)",
        "missing_hop(inventory-service)",
        "timeout_pattern",
    ]
    assert r.summary == (
        "Request r touched 3 services [api-gateway, custom-svc, order-service], triggered rules: " + ", ".join(r.rules)
    )


def test_latency_threshold_is_strict(lines_df):
    assert detect(entries_of(lines_df, full_flow("r", lat=500))).count() == 0
    assert detect(entries_of(lines_df, full_flow("r", lat=501))).collect()[0].rules == ["high_latency(501ms in api-gateway)"]
    p = Params(latency_threshold=Params().latency_threshold * 2)
    assert detect(entries_of(lines_df, full_flow("r", lat=501)), p).count() == 0


def test_first_slow_entry_not_the_slowest(lines_df):
    lines = full_flow("r", lat=10)
    lines[3] = lines[3].replace("latency=10ms", "latency=900ms")
    lines[1] = lines[1].replace("latency=10ms", "latency=600ms")
    assert detect(entries_of(lines_df, lines)).collect()[0].rules == ["high_latency(600ms in auth-service)"]


def test_context_deadline_and_repeats_do_not_change_rules(lines_df):
    lines = full_flow("r", msg="Context Deadline Exceeded while calling")
    e = entries_of(lines_df, lines + lines)
    assert detect(e).collect()[0].rules == ["timeout_pattern"]


def test_chain_is_a_parameter(lines_df):
    p = Params(service_chain=("api-gateway", "error-tracker"))
    r = detect(entries_of(lines_df, full_flow("r")), p).collect()[0]
    assert r.rules == ["missing_hop(error-tracker)"]


def test_service_chain_gaps_relational_form(lines_df):
    lines = full_flow("a")[:3] + full_flow("b")
    gaps = {(r.request_id, r.service, r.hop) for r in service_chain_gaps(entries_of(lines_df, lines)).collect()}
    assert gaps == {("a", "payment-service", 3), ("a", "inventory-service", 4)}
