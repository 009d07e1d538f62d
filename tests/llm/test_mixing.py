import duckdb
import pytest

from logweave.llm.mixing import BLOCK, _laid_out, mix, mixed_documents, mixed_words
from logweave.llm.oracle import MIXING

SF = "/root/testdata/sf0.01"


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, done, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(2 * sizes[s] for s in done)
        w = sum(weight[s] for s in sizes if s not in done)
        target = {s: 2.0 * sizes[s] if s in done else (rest * weight[s] / w if w else 0.0) for s in sizes}
        over = {s for s in sizes if s not in done and target[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return target
        done |= over


def check(rows):
    sizes, taken = {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = brute_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


def with_source(spark, docs):
    out = mixed_words(docs)
    return out.join(docs.select("doc_id", "source"), "doc_id").collect()


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check([r.asDict() for r in with_source(spark, docs)])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({MIXING})").fetchall())
    assert sorted(tuple(r) for r in mixed_words(docs).collect()) == want


def test_schedule_keeps_every_source_near_its_share(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines, targets = _laid_out(docs)
    rows = mix(lines, targets).collect()
    want = {r.s: r.target for r in targets.collect()}
    total = sum(want.values())
    slots = sorted({(r.slot, r.s) for r in rows})
    seen = dict.fromkeys(want, 0)
    for i, (_, s) in enumerate(slots, 1):
        seen[s] += 1
        if i % 500 == 0:
            for t in want:
                assert abs(seen[t] - i * want[t] / total) < 14  # logarithmic, not growing with i
    per_slot = {}
    for r in rows:
        per_slot[r.slot] = per_slot.get(r.slot, 0) + r.words
    assert max(per_slot.values()) <= BLOCK and sum(per_slot.values()) == sum(round(t) for t in want.values())


def test_edge_cases(spark):
    rows = [(1, "a b c d", "s1"), (1, "a b c d", "s1"), (2, None, "s1"), (3, "", None), (None, "x y", None), (4, " one\ttwo\nthree ", "s0"), (5, "w " * 5000, "é"), (6, "q", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "'q' as taken")
    out = mixed_words(docs).collect()
    assert sorted((r.doc_id or -1, r.size) for r in out) == [(-1, 2), (1, 4), (1, 4), (2, 0), (3, 0), (4, 3), (5, 5000), (6, 1)]
    assert all(r.taken <= 2 * r.size for r in out)
    assert sum(r.taken for r in out) == pytest.approx(1.5 * 5014, abs=3)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        assert any(t and t.startswith(r.text) for _, t, _ in rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixed_words(docs).collect() == []
    assert mixed_documents(docs).collect() == []
    docs = spark.createDataFrame([(1, "", "a")], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixed_words(docs).collect()] == [(1, 0, 0, 0.0, 0)]


def test_documents_follow_the_words_taken(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixed_words(docs).collect()}
    got = {}
    for r in mixed_documents(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert got == {k: v for k, v in taken.items() if v}
