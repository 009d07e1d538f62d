import os
import subprocess
import sys
import textwrap

import duckdb
import pytest

import __spark_entry__ as E
from logweave.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["alert_pos", "request_id", "root_cause", "recommendation", "severity"]
    assert len(rows) > 0


OWN = sorted(QUERIES)  # without the optional subpackage


def test_every_query_has_oracle_sql():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql()) <= set(E.queries())


def test_runs_from_a_foreign_folder(tmp_path):
    """The entry file is imported by path in another working folder: workers must find the package too."""
    script = tmp_path / "go.py"
    root = os.path.dirname(os.path.abspath(E.__file__))
    script.write_text(textwrap.dedent(f"""
        import importlib.util
        from pyspark.sql import SparkSession
        spec = importlib.util.spec_from_file_location("__spark_entry__", {root!r} + "/__spark_entry__.py")
        e = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(e)
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
        print("ROWS", e.entry(spark).count(), *(e.queries()[n](spark, {SF!r}).count() for n in ("correlate_entries", "error_spikes_default")))
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert all(int(n) > 0 for n in out.stdout.split("ROWS")[1].split())


@pytest.mark.parametrize("name", OWN)
def test_queries_match_oracle_on_smallest_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    key = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in key) for r in df.collect())
    idx = [rel.columns.index(c) for c in key]
    want = sorted(tuple(str(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
