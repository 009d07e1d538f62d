"""Exact spikes of a stream over several micro-batches against the batch operator."""

import datetime as dt
import os
import random
from datetime import timedelta

import numpy as np
import pytest

from conftest import line
from logweave.operators.parse import accepted, parse_lines
from logweave.operators.spike import error_entries, error_spikes
from logweave.params import Params
from logweave.streaming import spikes as S
from logweave.streaming.live import stream_entries

T0 = dt.datetime(2028, 2, 28, 23, 58, 0)


def error_at(seconds, i, level="ERROR", zone="Z"):
    at = T0 + timedelta(microseconds=round(seconds * 1_000_000))
    if zone != "Z":
        at += timedelta(hours=5, minutes=30)
    return line(ts=at.strftime("%Y-%m-%dT%H:%M:%S.%f") + zone, level=level, rid=f"job-{i % 17}", msg=f"failure {i}")


def write_files(folder, batches):
    for k, own in enumerate(batches):
        path = os.path.join(folder, f"{k:03d}.log")
        with open(path, "w") as fh:
            fh.write("\n".join(own) + "\n")
        os.utime(path, (1_900_000_000 + k, 1_900_000_000 + k))


def run_stream(spark, source, state, params, delay):
    entries, _ = stream_entries(spark, source, max_files_per_trigger=1)
    with S.rocksdb_state(spark):
        query = S.stream_spikes(entries, params, delay).writeStream.format("parquet").option("path", f"{state}/out")
        query = query.option("checkpointLocation", f"{state}/ckpt").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(300)
    assert query.exception() is None
    rows = spark.read.parquet(f"{state}/out").collect()
    return query, sorted((r.start_us, r.start_tz, r.errors_in_window) for r in rows)


def test_equal_to_batch_over_disordered_batches(spark, tmp_path):
    """A burst between two slide steps, a hot second, equal instants, repeats, other offsets; lines up to 40 s out of order."""
    rng = random.Random(12)
    times = [rng.random() * 400 for _ in range(160)] + [200.4 + 1e-6 * rng.randrange(900) for _ in range(40)] + [61.5 + i * 5.2 for i in range(12)]
    own = [(t, error_at(t, i, zone=rng.choice(["Z", "+05:30"]))) for i, t in enumerate(times)]
    own += [(t, error_at(t, i, level="INFO")) for i, t in enumerate(rng.random() * 400 for _ in range(60))]
    own += [(200.5, error_at(200.5, 900, zone=z)) for z in ("Z", "+05:30")]
    own += rng.sample(own, 30)
    own.sort(key=lambda x: x[0] + rng.random() * 40)
    lines = [x for _, x in own]
    batches = [lines[i : i + 60] for i in range(0, len(lines), 60)] + [[error_at(5000, 1, level="INFO")]]
    source = tmp_path / "in"
    source.mkdir()
    write_files(source, batches)
    entries = accepted(parse_lines(spark.createDataFrame([(x,) for x in lines], "raw string")))
    params = Params(spike_threshold=20)
    want = sorted((r.start_us, r.start_tz, r.errors_in_window) for r in error_spikes(error_entries(entries), params).collect())
    query, got = run_stream(spark, str(source), str(tmp_path), params, timedelta(seconds=60))
    assert len(want) > 40 and got == want
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == len(batches)
    # A restart goes on from the state folder: later errors only add windows of their own.
    more = [error_at(9000 + i * 0.3, 3000 + i) for i in range(25)] + [error_at(20000, 2, level="INFO")]
    write_files(source, [*batches, more[:10], more[10:]])
    later = accepted(parse_lines(spark.createDataFrame([(x,) for x in more], "raw string")))
    want += [(r.start_us, r.start_tz, r.errors_in_window) for r in error_spikes(error_entries(later), params).collect()]
    assert run_stream(spark, str(source), str(tmp_path), params, timedelta(seconds=60))[1] == sorted(want)


def test_state_is_removed_when_windows_close(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_files(source, [[error_at(60 * k + i, 100 * k + i) for i in range(30)] for k in range(6)])
    query, _ = run_stream(spark, str(source), str(tmp_path), Params(), timedelta(seconds=1))
    held = [max(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert held and held[-1] <= 4 * 90  # three buckets of thirty seconds' entries, not six


@pytest.mark.parametrize("seed", [1, 2])
def test_qualifying_windows_equal_naive(seed):
    rng = random.Random(seed)
    us = sorted(rng.randrange(-200, 900) for _ in range(300))
    t, n, tz = S.merged(np.array(us), np.ones(300, np.int64), np.array([rng.choice([b"Z", b"+05:30"]) for _ in us], "S6"))
    for start in (-200, 0, 300):
        got = S.qualifying(t, n, tz, start, 100, 25)
        rows = [(x, sum(x <= y < x + 100 for y in us)) for x in sorted(set(us)) if x < start + 100]
        assert list(zip(got["start_us"].tolist(), got["errors_in_window"].tolist())) == [r for r in rows if r[1] > 25]
