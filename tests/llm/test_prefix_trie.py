import hashlib
import random
import zlib

import duckdb
import pytest

from logweave.llm import prefix_trie as T
from logweave.llm.oracle import LLM_ORACLE

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(convs):
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def sums(p):
        leaves, saved = 0, 0
        todo = [p]
        while todo:
            x = todo.pop()
            leaves += not children.get(x)
            saved += (len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0
            todo += children.get(x, [])
        return leaves, saved

    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *sums(p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def key(rows):
    return sorted(tuple(map(str, r)) for r in rows)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "lo long, hi long").select("lo", "hi", T.two_fattest(*map(__import__("pyspark.sql.functions").sql.functions.col, ("lo", "hi"))).alias("f")).collect()
    for r in got:
        assert r.f == max(range(r.lo + 1, r.hi + 1), key=lambda x: x & -x)


def generated(seed, n=150):
    rng = random.Random(seed)
    rows, ids = [], rng.sample(range(-40, 400), n)
    shared = [("user", f"line {i} é") for i in range(30)]
    for c in ids:
        k = rng.choice([0, 1, 3, 9, 30])
        turns = shared[: rng.randrange(k + 1)] + [(rng.choice(["user", None]), rng.choice(["a", "b", "", None])) for _ in range(rng.randrange(1, 12))]
        rows += [(c, i if rng.random() > 0.05 else None, *t) for i, t in enumerate(turns)]
    rows += [(None, 0, "user", "nobody"), (7, 1, "user", "twice"), (7, 1, "user", "twice"), (5, None, None, None)]
    rng.shuffle(rows)
    return rows


def direct(spark, paths):
    """The trie of given sequences, without the contract's rebuilding."""
    turns = [(c, d + 1, hash(x) >> 3, len(x), len(x)) for c, p in paths.items() for d, x in enumerate(p)]
    return T.prefix_trie(spark.createDataFrame(turns, "conv long, d long, k1 long, k2 long, size long"), spark.createDataFrame([(c,) for c in paths], "conv long"))


def test_rebuilt_conversations_against_brute_force(spark):
    rows = generated(1)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as d", "'x' as conv", "2 as pos").repartition(5)
    out = T.rebuilt_trie(docs)
    assert out.columns == COLUMNS
    assert key(out.collect()) == key(brute(rebuilt(rows)))


def test_deep_paths_across_blocks(spark, monkeypatch):
    """One long path that others leave at many depths, over small blocks and pieces; copies share its end."""
    monkeypatch.setattr(T, "BLOCK", 8)
    monkeypatch.setattr(T, "PIECE", 4)
    monkeypatch.setattr(T, "CHUNK_IDS", 3)
    long = tuple(f"t{i}" for i in range(70))
    paths = {i: long[: 2 * i] + (("own", f"x{i}") if i % 3 else ()) for i in range(34)} | {100 + i: long for i in range(10)} | {-3: ()}
    paths = {c: tuple(map(str, p)) for c, p in paths.items()}
    want = brute({c: tuple(("", x) for x in p) for c, p in paths.items()})
    assert key(direct(spark, paths).collect()) == key(want)


def test_edge_cases(spark):
    for rows in ([], [(None, 1, "user", "x")], [(3, 0, "user", "only")], [(9, None, None, None)], [(5, 0, "u", "a"), (6, 0, "u", "a"), (7, 0, "u", "a")]):
        out = T.rebuilt_trie(spark.createDataFrame(rows, SCHEMA))
        assert key(out.collect()) == key(brute(rebuilt(rows)))


@pytest.mark.parametrize("table", [SF])
def test_whole_table_against_brute_force_and_sql(spark, table):
    df = spark.read.parquet(f"{table}/conversations.parquet")
    got = key(T.rebuilt_trie(df).collect())
    assert got == key(brute(rebuilt([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{table}/conversations.parquet')")
    rel = con.sql(LLM_ORACLE["op12_prefix_trie"])
    at = [rel.columns.index(c) for c in COLUMNS]
    assert got == key(tuple(r[i] for i in at) for r in rel.fetchall())
