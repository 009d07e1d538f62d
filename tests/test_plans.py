"""Physical-plan checks for the scale properties the operators rely on."""

import contextlib
import io
import os
import re
import tempfile

import pytest

import __spark_entry__ as E
from logweave.operators.diagnose import prompt_entries
from logweave.operators.correlate import dedup_entries
from logweave.operators.parse import accepted, parse_lines
from logweave.operators.rules import detect
from logweave.sources.logfiles import read_logs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def entries(spark):
    d = tempfile.mkdtemp(prefix="lw-plan-")
    with open(os.path.join(d, "a.log"), "w") as fh:
        fh.write("2026-03-16T15:56:02Z | api-gateway | ERROR | r1 | boom | latency=1ms\n")
    return accepted(parse_lines(read_logs(spark, d)))


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_detect_is_one_partial_final_aggregation(entries):
    p = plan(detect(entries))
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1
    assert "partial_min_by" in p and "partial_collect_set" in p  # map-side combine
    assert "Window" not in p


def test_parse_is_one_codegen_stage_without_reparse(entries):
    p = plan(entries)
    assert "Exchange" not in p
    # barrier: the accepted filter stays above the Generate, the parse runs once below it
    assert re.search(r"Filter \(\d+\)\n\s*\+- \* Generate \(\d+\)", p)
    assert len(re.findall(r"split\(", p)) >= 1


def test_dedup_hashes_on_the_whole_line(entries):
    p = plan(dedup_entries(entries))
    m = re.search(r"hashpartitioning\(([^)]*)\)", p)
    assert m and "raw" in m.group(1) and "request_id" in m.group(1)


def test_prompt_windows_limit_before_the_shuffle(spark, entries):
    """Head and tail: the partial limit stands below the exchange of both windows, broadcasts or not."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        p = plan(prompt_entries(entries))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"WindowGroupLimit \[.*Partial", p)) >= 2 or len(re.findall(r"Partial", p)) >= 2
    # no join stands between the deduplicated entries and a window
    for part in re.split(r"Window \(", p)[1:]:
        assert "Join" not in part.split("WindowGroupLimit")[0]


def test_events_filter_reaches_the_scan(spark):
    from logweave.plans.catalog import _event_errors

    p = plan(_event_errors(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in p
    assert re.search(r"ReadSchema: struct<(ts:timestamp_ntz,event_type:string|event_type:string,ts:timestamp_ntz)>", p)
