import datetime as dt
import json
import random
import re

import pytest

from conftest import line
from logweave.operators.diagnose import (
    FALLBACK_RECOMMENDATION,
    build_prompts,
    build_requests,
    diagnose,
    fallback_diagnose,
    parse_responses,
)
from logweave.operators.parse import accepted, parse_lines
from logweave.operators.rules import detect
from logweave.params import Params

BASE = dt.datetime(2026, 3, 16, 15, 56, 0)


def entries_of(lines_df, lines):
    return accepted(parse_lines(lines_df(lines)))


def error_lines(n, rid="flow/4c"):
    """``n`` lines at different times, each with a message of its own."""
    return [line(ts=(BASE + dt.timedelta(minutes=11 * i)).strftime("%Y-%m-%dT%H:%M:%SZ"), level="ERROR", rid=rid, msg=f"fault {i * i} of {n}") for i in range(n)]


LIMITS = [Params(), Params(prompt_max_entries=7, prompt_head=2, prompt_tail=4), Params(prompt_max_entries=12, prompt_head=1, prompt_tail=9)]


@pytest.mark.parametrize("params", LIMITS, ids=lambda p: str(p.prompt_max_entries))
def test_prompts_keep_what_a_list_slice_keeps(lines_df, params):
    """Requests with entry counts around the limit, their lines in random order and partly repeated."""
    rng = random.Random(params.prompt_max_entries)
    most = params.prompt_max_entries
    sizes = [1, most - 1, most, most + 1, *(rng.randrange(most + 2, 3 * most) for _ in range(2))]
    flows = {f"flow/{k}": error_lines(n, f"flow/{k}") for k, n in enumerate(sizes)}
    lines = [x for own in flows.values() for x in own + rng.sample(own, len(own) // 3)]
    rng.shuffle(lines)
    e = entries_of(lines_df, lines)
    prompts = {r.request_id: r.prompt for r in build_prompts(e, detect(e), params).collect()}
    assert set(prompts) == set(flows)
    for rid, own in flows.items():
        shown = own if len(own) <= most else own[: params.prompt_head] + own[len(own) - params.prompt_tail :]
        messages = [x.split(" | ")[4] for x in shown]
        listed = [x.split(" | ")[2] for x in prompts[rid].split("\n") if x.startswith("  [") and " | " in x]
        assert listed == messages
        notes = re.findall(r"\[(\d+) logs omitted", prompts[rid])
        assert notes == ([] if len(own) <= most else [str(len(own) - most)])


def prompt_of(lines_df, lines):
    e = entries_of(lines_df, lines)
    return build_prompts(e, detect(e)).collect()[0].prompt


def test_prompt_layout_small(lines_df):
    p = prompt_of(lines_df, [line(ts="2026-03-16T15:56:03.9Z", service="svc", level="ERROR", rid="r", msg="boom", lat="latency=7ms")])
    rules = "error_detected, missing_hop(api-gateway), missing_hop(auth-service), missing_hop(order-service), missing_hop(payment-service), missing_hop(inventory-service)"
    assert p == (
        "Analyze the following anomalous request flow (request_id: r).\n\n"
        f"Triggered anomaly rules: {rules}\n\n"
        "Log entries (chronological):\n"
        "  [2026-03-16T15:56:03Z] svc | ERROR | boom | latency=7ms\n"
        "\nProvide root cause analysis, a recommended fix, and severity level."
    )


def test_request_body(lines_df):
    e = entries_of(lines_df, error_lines(3))
    body = json.loads(build_requests(build_prompts(e, detect(e))).collect()[0].body)
    assert body["model"] == "meta/llama3-70b-instruct"
    assert [m["role"] for m in body["messages"]] == ["system", "user"]
    assert abs(body["temperature"] - 0.1) < 1e-6


def test_fallback_and_severity(spark):
    reports = spark.createDataFrame(
        [("a", ["missing_hop(error-tracker)"]), ("b", ["high_latency(1s in x)"]), ("c", ["timeout_pattern"])],
        "request_id string, rules array<string>",
    ).selectExpr("*", "timestamp'2026-01-01 00:00:00' AS start_ts", "0 AS start_nanos")
    rows = {r.request_id: r for r in fallback_diagnose(reports).collect()}
    assert rows["a"].severity == "critical" and rows["b"].severity == "warning" and rows["c"].severity == "critical"
    assert rows["b"].root_cause == "Rule-based detection: high_latency(1s in x)"
    assert rows["b"].recommendation == FALLBACK_RECOMMENDATION


def envelope(content):
    return json.dumps({"choices": [{"message": {"content": content}}]})


OBJ = '{"root_cause": "db", "recommendation": "fix", "severity": "info"}'


CASES = [
    (200, envelope(OBJ), ("db", "fix", "info")),
    (200, envelope("```json\n" + OBJ + "\n```"), ("db", "fix", "info")),
    (200, envelope("```\n" + OBJ + "\n```"), ("db", "fix", "info")),
    (200, envelope("Sure! " + OBJ + " hope this helps"), ("db", "fix", "info")),
    (200, envelope('{"Root_Cause": "db", "SEVERITY": "warning"}'), ("db", "", "warning")),
    (200, envelope('{"root_cause": "a", "ROOT_CAUSE": "b"}'), ("b", "", "")),
    (200, envelope('{"root_cause": null}'), ("", "", "")),
    (200, envelope("null"), ("", "", "")),
    (200, envelope('{"root_cause": "x", "extra": {"deep": [1, 2]}}'), ("x", "", "")),
    (200, envelope('{"root_cause": 5}'), None),
    (200, envelope('{"request_id": 7}'), None),
    (200, envelope('{"root_cause": "x",}'), None),
    (200, envelope('{"root_cause": "a"} and {"severity": "b"}'), None),
    (200, envelope('{"a":"b"}],[{"c":"d"}'), None),
    (200, envelope('{"a":"b"}} x'), None),
    (200, envelope(""), None),
    (200, envelope("not json"), None),
    (200, envelope('{"a": NaN}'), None),
    (200, envelope('{"a": 01}'), None),
    (200, envelope('{"a": "x\ny"}'), None),
    (200, envelope("{'a': 'b'}"), None),
    (200, json.dumps({"choices": []}), None),
    (200, json.dumps({"choices": None}), None),
    (200, json.dumps({"choices": [{"message": {"content": 5}}]}), None),
    (200, '{"choices": [{"message": {"content": "{}"}}]} trailing', None),
    (200, "{}", None),
    (500, envelope(OBJ), None),
    (200, json.dumps({"Choices": [{"Message": {"Content": OBJ}}]}), ("db", "fix", "info")),
    # a wrong type at every level, in any choice
    *[(200, json.dumps({"choices": x}), None) for x in ("x", 5, True, {"message": {"content": OBJ}}, ["x"], [5], [[1]])],
    *[(200, json.dumps({"choices": [{"message": x}]}), None) for x in ("hi", 5, True, [1], [{"content": OBJ}], None)],
    *[(200, json.dumps({"choices": [{"message": {"content": x}}]}), None) for x in (5, True, [OBJ], {"a": 1}, None)],
    *[(200, json.dumps({"choices": [{"message": {"content": OBJ}}, x]}), None) for x in ("x", 1, [], {"message": "x"}, {"message": {"content": 1}})],
    *[(200, json.dumps({"choices": [{"message": {"content": OBJ}}, x]}), ("db", "fix", "info")) for x in (None, {}, {"message": None}, {"message": {"content": "x"}})],
    *[(200, x, None) for x in ("[]", "5", "null", '"x"', "", "[1,2]", None)],
    # repeated keys in what is ignored, and at every level of the envelope (the last counts)
    (200, envelope('{"root_cause":"a","x":{"k":1,"k":2}}'), ("a", "", "")),
    (200, envelope('{"x":[{"k":{"k":1,"k":[]}},{"k":1,"K":2,"k":3}],"severity":"info","y":{"root_cause":5}}'), ("", "", "info")),
    (200, '{"id":{"a":1,"a":2},"choices":[{"message":{"content":"no","content":"{}"},"message":{"content":' + json.dumps(OBJ) + "}}]}", ("db", "fix", "info")),
    (200, envelope('{"root_cause":"a","x":{"k":1,}}'), None),
    (200, envelope('{"root_cause":"a","x":{"k":"\u00e9\\q"}}'), None),  # a wrong escape in what is ignored
    # texts that look like other values, or like the decoder's own marks
    *[(200, envelope(json.dumps({"root_cause": x})), (x, "", "")) for x in ('s:"', "{", "[1]", "5", "null", 's:s:\\"{}', "\\", 'a\\\\"b', "\n\t\u2028é", "")],
    (200, envelope(json.dumps({'odd"key\\': {'a"': "}"}, "severity": "info"})), ("", "", "info")),
]


def test_strict_response_decoding(spark):
    df = spark.createDataFrame([(str(i), status, body) for i, (status, body, _) in enumerate(CASES)], "request_id string, status int, body string")
    rows = {int(r.request_id): r for r in parse_responses(df).collect()}
    for i, (_, body, expected) in enumerate(CASES):
        r = rows[i]
        got = (r.root_cause, r.recommendation, r.severity) if r.valid else None
        assert got == expected, body
        assert r.valid or r.root_cause is None


def test_diagnose_uses_valid_response_else_fallback(spark, lines_df):
    e = entries_of(lines_df, error_lines(2, "a") + error_lines(2, "b") + error_lines(2, "c"))
    reports = detect(e)
    responses = spark.createDataFrame(
        [("a", 200, envelope(OBJ)), ("b", 200, envelope("garbage")), ("zzz", 200, envelope(OBJ))],
        "request_id string, status int, body string",
    )
    rows = {r.request_id: r for r in diagnose(reports, responses).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].root_cause == "db"
    assert rows["b"].root_cause.startswith("Rule-based detection: ") and rows["c"].root_cause.startswith("Rule-based detection: ")
    assert diagnose(reports).count() == 3
