import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import line
from logweave.operators.correlate import correlate, correlation_stats, dedup_entries, group_bounds, group_order
from logweave.operators.parse import accepted, parse_lines
from logweave.operators.ranking import rank_within, running_sum_within


def entries_of(lines_df, lines):
    return accepted(parse_lines(lines_df(lines)))


def generated(seed, n=120):
    """Lines of several flows in random order, some of them repeated, some at equal times."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        at = f"2029-08-{rng.randrange(1, 4):02d}T{rng.randrange(24):02d}:{rng.choice((5, 35)):02d}:{rng.randrange(3):02d}Z"
        rows.append((f"trace/{rng.randrange(7)}", at, f"step {rng.randrange(5)}"))
    rows += rng.sample(rows, n // 4)
    rng.shuffle(rows)
    return [(rid, at, line(ts=at, rid=rid, msg=msg)) for rid, at, msg in rows]


@pytest.mark.parametrize("seed", [3, 8])
def test_flows_against_plain_lists(lines_df, seed):
    rows = generated(seed)
    flows = {}
    for rid, at, raw in set(rows):
        flows.setdefault(rid, []).append((at, raw))
    e = entries_of(lines_df, [raw for _, _, raw in rows])
    want = {(rid, pos, raw) for rid, own in flows.items() for pos, (_, raw) in enumerate(sorted(own), 1)}
    assert {(r.request_id, r.entry_pos, r.raw) for r in correlate(e).collect()} == want
    by_start = sorted(flows, key=lambda rid: (min(flows[rid])[0], rid))
    order = group_order(group_bounds(dedup_entries(e))).collect()
    assert {(r.request_id, r.group_pos, r.n_entries) for r in order} == {(rid, i, len(flows[rid])) for i, rid in enumerate(by_start, 1)}
    assert correlation_stats(e).collect()[0].asDict() == {"entries_read": len(rows), "request_groups": len(flows)}


def test_bounds_use_offsets_and_nanos(lines_df):
    e = entries_of(lines_df, [line(ts="2026-03-13T12:00:00+02:00", rid="r"), line(ts="2026-03-13T10:00:00.000000001Z", rid="r", msg="b")])
    b = group_bounds(e).collect()[0]
    assert b.start_tz == "+02:00" and b.end_nanos == 1 and b.n_entries == 2


def test_rank_within_matches_row_number_with_hot_key(spark):
    rnd = random.Random(7)
    rows = [(("hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"), rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    got = rank_within(df, ["k"], ["t", "id"], name="pos", num_partitions=11)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    assert got.join(want, "id").where("pos != rn").count() == 0
    assert got.count() == 3000
    glob = rank_within(df, [], ["t", "id"], name="pos", num_partitions=7)
    wantg = df.withColumn("rn", F.row_number().over(Window.orderBy("t", "id")))
    assert glob.join(wantg, "id").where("pos != rn").count() == 0


def test_running_sum_matches_window(spark):
    rnd = random.Random(3)
    rows = [(f"k{rnd.randint(0, 3)}", i, rnd.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t int, w int")
    got = running_sum_within(df, ["k"], ["t"], "w", name="cum", num_partitions=9)
    want = df.withColumn("c", F.sum("w").over(Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.join(want, ["k", "t"]).where("cum != c").count() == 0
