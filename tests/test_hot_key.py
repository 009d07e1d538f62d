"""One request id holding a third of all lines: results stay exact."""

import datetime as dt


from bruteforce import CHAIN
from logweave.operators.correlate import correlate, group_bounds, dedup_entries
from logweave.operators.diagnose import build_prompts
from logweave.operators.parse import accepted, parse_lines
from logweave.operators.rules import detect

BASE = dt.datetime(2026, 3, 16, 15, 0, 0)


def test_hot_request(spark):
    lines = []
    for i in range(3000):
        rid = "hot" if i % 3 == 0 else f"r{i % 97}"
        t = BASE + dt.timedelta(milliseconds=37 * i)
        level = "ERROR" if i % 11 == 0 else "INFO"
        lines.append(f"{t.strftime('%Y-%m-%dT%H:%M:%S.%fZ')} | {CHAIN[i % 5]} | {level} | {rid} | m{i} | latency={i % 700}ms")
    lines += lines[::7]  # repeats
    df = spark.createDataFrame([(x,) for x in lines], "raw string").repartition(6)
    e = accepted(parse_lines(df))

    pos = {r.raw: r.entry_pos for r in correlate(e).where("request_id = 'hot'").collect()}
    hot_lines = sorted({x for x in lines if "| hot |" in x})
    assert len(pos) == len(hot_lines) == 1000
    assert [pos[x] for x in hot_lines] == list(range(1, 1001))  # timestamps increase with i

    b = group_bounds(dedup_entries(e)).where("request_id = 'hot'").collect()[0]
    assert b.n_entries == 1000

    r = detect(e).where("request_id = 'hot'").collect()[0]
    assert r.rules[0] == "error_detected"
    first_slow = next(x for x in hot_lines if int(x.rsplit("latency=", 1)[1][:-2]) > 500)
    svc = first_slow.split(" | ")[1].strip()
    ms = int(first_slow.rsplit("latency=", 1)[1][:-2])
    assert f"high_latency({ms}ms in {svc})" in r.rules

    p = build_prompts(e, detect(e)).where("request_id = 'hot'").collect()[0].prompt
    assert "[950 logs omitted to fit token limits]" in p
    shown = [ln for ln in p.split("\n") if ln.startswith("  [")]
    assert len(shown) == 50
    msgs = [ln.split(" | ")[2] for ln in shown]
    want = [x.split(" | ")[4] for x in hot_lines[:20] + hot_lines[-30:]]
    assert msgs == want
