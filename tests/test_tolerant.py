"""Folders with files that cannot be read to their end."""

import gzip
import os

import pytest
from pyspark.errors import AnalysisException

from conftest import line
from logweave.plans.analysis import run
from logweave.sources import tolerant as T
from logweave.sources.logfiles import read_logs


def lines(prefix, n=400):
    return [line(rid=f"{prefix}-{i}", level="ERROR" if i % 7 == 0 else "INFO", msg=f"message {i * 7919 % 1000}") for i in range(n)]


@pytest.fixture
def folder(tmp_path):
    """Two whole files, one truncated gzip, one that is no gzip, an empty one and one that is not read."""
    files = {name: lines(name) for name in ("whole.log", "packed.log.gz", "cut.log.gz", "noise.log.gz", "other.txt")}
    for name in ("whole.log", "other.txt"):
        (tmp_path / name).write_text("\n".join(files[name]) + "\n")
    packed = {name: gzip.compress("\n".join(files[name]).encode()) for name in ("packed.log.gz", "cut.log.gz")}
    (tmp_path / "packed.log.gz").write_bytes(packed["packed.log.gz"])
    (tmp_path / "cut.log.gz").write_bytes(packed["cut.log.gz"][: len(packed["cut.log.gz"]) // 2])
    (tmp_path / "noise.log.gz").write_bytes(os.urandom(3000))
    (tmp_path / "empty.log").write_bytes(b"")
    return str(tmp_path), files


def test_damaged_files_are_reported_and_the_others_arrive(spark, folder):
    path, files = folder
    with pytest.raises(T.READ_ERRORS):
        read_logs(spark, path, "*.log*").count()
    got, outcomes = T.read_logs_tolerant(spark, path, "*.log*")
    by_file = {}
    for r in got.collect():
        by_file.setdefault(os.path.basename(r.source_file), []).append(r.raw)
    assert sorted(by_file["whole.log"]) == sorted(files["whole.log"]) and sorted(by_file["packed.log.gz"]) == sorted(files["packed.log.gz"])
    cut = by_file.get("cut.log.gz", [])
    assert cut == files["cut.log.gz"][: len(cut)] or cut[:-1] == files["cut.log.gz"][: len(cut) - 1]  # a head of it
    assert "noise.log.gz" not in by_file and "other.txt" not in by_file
    rows = {os.path.basename(r.file): r for r in outcomes.collect()}
    assert set(rows) == {"whole.log", "packed.log.gz", "cut.log.gz", "noise.log.gz"}
    assert {n for n, r in rows.items() if r.error} == {"cut.log.gz", "noise.log.gz"}
    assert "nexpected end" in rows["cut.log.gz"].error
    assert all(r.n_lines == len(by_file.get(n, [])) and r.length == os.path.getsize(os.path.join(path, n)) for n, r in rows.items())


def test_a_sound_folder_is_read_in_one_pass(spark, tmp_path, monkeypatch):
    (tmp_path / "a.log").write_text("\n".join(lines("a")))
    monkeypatch.setattr(T, "unreadable_files", lambda *a: pytest.fail("probed"))
    got, outcomes = T.read_logs_tolerant(spark, str(tmp_path))
    assert got.count() == 400 and [(r.n_lines, r.error) for r in outcomes.collect()] == [(400, None)]


def test_a_file_that_goes_meanwhile(spark, tmp_path):
    for n in ("a.log", "b.log"):
        (tmp_path / n).write_text("\n".join(lines(n)))
    files = [r.file for r in T.list_log_files(spark, str(tmp_path)).collect()]
    (tmp_path / "b.log").unlink()
    gone = [f for f in files if f.endswith("b.log")]
    assert set(T._probe(spark, files)) == set(gone)


def test_many_damaged_files_and_errors_without_a_name(spark, tmp_path, monkeypatch):
    for i in range(12):
        (tmp_path / f"f{i}.log.gz").write_bytes(os.urandom(200) if i % 3 == 0 else gzip.compress(lines(str(i), 5)[0].encode()))
    want = {f"f{i}.log.gz" for i in range(0, 12, 3)}
    assert {os.path.basename(f) for f in T.unreadable_files(spark, str(tmp_path), "*.gz")} == want
    monkeypatch.setattr(T, "_named", lambda error, files: [])
    assert {os.path.basename(f) for f in T.unreadable_files(spark, str(tmp_path), "*.gz")} == want


def test_no_file_at_all(spark, tmp_path):
    with pytest.raises(AnalysisException):
        T.read_logs_tolerant(spark, str(tmp_path))


def test_a_whole_run_goes_on(spark, folder):
    path, files = folder
    seen = []
    out = run(spark, path, {"count": lambda df: seen.append(df.count())}, pattern="*.log*")
    assert {os.path.basename(f) for f in out["unreadable_files"]} == {"cut.log.gz", "noise.log.gz"}
    assert out["status"] == "alerted" and seen[0] > 0 and out["stats"]["parse"]["total_lines"] >= 800
