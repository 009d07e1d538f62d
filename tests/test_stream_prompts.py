"""Prompts of closed sessions against build_prompts over each session's entries."""

import datetime as dt
import os
import random
from datetime import timedelta

from pyspark.sql import functions as F

from conftest import line
from logweave.operators.diagnose import build_prompts
from logweave.operators.parse import accepted, parse_lines
from logweave.operators.rules import detect
from logweave.params import Params
from logweave.streaming.live import stream_entries
from logweave.streaming.prompts import OpenSessions, stream_prompts
from logweave.streaming.spikes import rocksdb_state

T0 = dt.datetime(2033, 1, 1)
PARAMS = Params(prompt_max_entries=9, prompt_head=3, prompt_tail=4)
SERVICES = ["api-gateway", "auth-service", "order-service", "payment-service", "inventory-service"]


def stamp(us):
    return (T0 + timedelta(microseconds=us)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def generated(seed):
    """(us, line) of flows with several sessions each; gaps of exactly the idle time part sessions."""
    rng = random.Random(seed)
    rows = []
    for flow in range(6):
        at = rng.randrange(60_000_000)
        for _ in range(rng.randrange(2, 5)):
            for k in range(rng.choice([1, 3, 9, 10, 30])):
                at += rng.choice([0, 1, 400_000, 2_500_000, 9_999_999])
                lat = rng.choice(["latency=3ms", "latency=501ms", "latency=1700ms"])
                rows.append((at, line(ts=stamp(at), service=rng.choice(SERVICES), level=rng.choice(["INFO"] * 5 + ["ERROR"]), rid=f"flow-{flow}", msg=rng.choice(["fine", "read Timeout"]) + f" {k}", lat=lat)))
            at += rng.choice([10_000_000, 10_000_001, 45_000_000])
    return rows + rng.sample(rows, len(rows) // 5)


def expected(spark, rows):
    """build_prompts with every session as a request of its own."""
    named = {}
    by_flow = {}
    for at, raw in set(rows):
        by_flow.setdefault(raw.split(" | ")[3], []).append((at, raw))
    for flow, own in by_flow.items():
        last, k = None, 0
        for at, raw in sorted(own):
            k += last is not None and at - last >= 10_000_000
            named[raw] = f"{flow}@{k}@"
            last = at
    names = spark.createDataFrame(list(named.items()), "raw string, session string")
    entries = accepted(parse_lines(spark.createDataFrame([(x,) for _, x in rows], "raw string")))
    entries = entries.join(names, "raw").withColumn("request_id", F.col("session")).drop("session")
    return sorted((r.request_id.split("@")[0], r.prompt.replace(r.request_id, r.request_id.split("@")[0])) for r in build_prompts(entries, detect(entries, PARAMS), PARAMS).collect())


def test_prompts_of_closed_sessions(spark, tmp_path):
    rows = generated(5)
    rng = random.Random(6)
    source = tmp_path / "in"
    source.mkdir()
    order = sorted(rows, key=lambda r: r[0] + rng.randrange(30_000_000))  # up to 30 s out of order
    files = [[x for _, x in order[i : i + 70]] for i in range(0, len(order), 70)] + [[line(ts=stamp(10**12), rid="ahead")]]
    for k, own in enumerate(files):
        path = source / f"{k:03d}.log"
        path.write_text("\n".join(own) + "\n")
        os.utime(path, (1_900_000_000 + k, 1_900_000_000 + k))
    entries, _ = stream_entries(spark, str(source), max_files_per_trigger=1)
    with rocksdb_state(spark):
        writer = stream_prompts(entries, PARAMS, timedelta(seconds=40)).writeStream.format("parquet").option("path", f"{tmp_path}/out")
        query = writer.option("checkpointLocation", f"{tmp_path}/ckpt").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(300)
    assert query.exception() is None
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    want = expected(spark, rows)
    assert len(want) > 12 and sorted((r.request_id, r.prompt) for r in got) == want
    assert any(r.n_entries > PARAMS.prompt_max_entries for r in got)
    assert sum("omitted" in p for _, p in want) == sum(r.n_entries > PARAMS.prompt_max_entries for r in got)


def test_session_state_is_bounded_and_independent_of_order():
    entries = [[us, 0, f"raw {us}", "Z", f"line {us}"] for us in [*range(0, 500), *range(700, 720), 5000]]
    results = []
    for seed in range(4):
        held = OpenSessions(gap_us=100, head=9, tail=4)
        own = entries[:]
        random.Random(seed).shuffle(own)
        for e in own:
            held.add(e, e[0] == 3, False, [*e[:3], e[0], "svc"] if e[0] > 400 else None, f"s{e[0] % 3}")
            assert all(len(s["head"]) <= 9 and len(s["tail"]) <= 4 for s in held.sessions)
        results.append(held.sessions)
    assert all(r == results[0] for r in results)
    assert [(s["n"], s["head"][0][0], s["tail"][-1][0], s["error"]) for s in results[0]] == [(500, 0, 499, True), (20, 700, 719, False), (1, 5000, 5000, False)]
    assert results[0][0]["slow"][0] == 401
    held = OpenSessions(100, 9, 4, results[0])
    assert [s["n"] for s in held.close(819)] == [500, 20] and len(held.sessions) == 1


def test_entries_of_a_batch_are_added_together(monkeypatch):
    rng = random.Random(3)
    rows = [([rng.randrange(4_000), 0, f"r{i}", None, f"line {i}"], rng.random() < 0.1, rng.random() < 0.1, [i, 0, f"r{i}", 5, "a"] if i % 7 == 0 else None, f"s{i % 3}") for i in range(300)]
    singly, together = OpenSessions(20, 5, 3), OpenSessions(20, 5, 3)
    for r in rows:
        singly.add(*r)
    merges = []
    merged = OpenSessions._merged
    monkeypatch.setattr(OpenSessions, "_merged", lambda self, a, b: merges.append(1) or merged(self, a, b))
    for part in (rows[:150], rows[150:]):
        together.add_all(part)
    assert together.sessions == singly.sessions and len(singly.sessions) > 3
    assert len(merges) < 100  # singly: one for nearly every entry
