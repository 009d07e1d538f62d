import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from logweave.llm import periodic_runs as P

SF = "/root/testdata/sf0.01"


def brute_runs(w, length=6, power=4):
    """All runs, by trying every period."""
    n, found = len(w), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, power * q):
                found.setdefault((i, j + q), q)  # the smallest period of a stretch comes first
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, text):
    w = words_of(doc_id, text)
    runs = brute_runs(w)
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def strings():
    rng = random.Random(11)
    yield from ([], [0], [0] * 5, [0] * 6, [0] * 200, [0, 1] * 4, [0, 1] * 3 + [0], [0, 1, 2] * 30 + [0, 1], list(range(40)))
    for _ in range(400):
        w = [rng.randrange(rng.choice([1, 2, 2, 3, 4])) for _ in range(rng.randrange(1, 120))]
        if rng.random() < 0.6:
            q = rng.randrange(1, 12)
            w[10:10] = (w + [7])[:q] * rng.randrange(2, 9)
        yield w
    a, b = [0], [0, 1]
    for _ in range(11):  # Fibonacci words have many runs
        a, b = b, b + a
    yield b
    yield (b[:30] * 5 + [9]) * 4


def test_suffix_and_lcp_arrays():
    for w in strings():
        s = np.array(w, np.int64)
        if not len(s):
            continue
        sa, isa = P.suffix_array(s)
        want = sorted(range(len(w)), key=lambda i: w[i:])
        assert sa.tolist() == want and all(isa[i] == k for k, i in enumerate(want))
        lcp = [0]
        for x, y in zip(want, want[1:]):
            n = 0
            while max(x, y) + n < len(w) and w[x + n] == w[y + n]:
                n += 1
            lcp.append(n)
        assert P.lcp_array(s, sa, isa).tolist() == lcp


def test_runs_are_those_of_brute_force():
    for w in strings():
        assert P.runs_of(np.array(w, np.int64)) == brute_runs(w) if w else True
        assert P._found([[b"%d" % x for x in w], [b"x"], []], 6, 4)[0] == brute_runs(w)
        if w:
            assert P.runs_of(np.array(w, np.int64), 2, 2) == brute_runs(w, 2, 2)


def test_documents_of_a_batch_do_not_meet():
    one = [b"a", b"b"] * 3
    assert P._found([one, one, one], 6, 4) == [[], [], []]
    assert P._found([one * 2, [b"z"], one * 2], 6, 4) == [[(0, 12, 2)], [], [(0, 12, 2)]]


def test_long_texts_with_one_word_are_fast(monkeypatch):
    monkeypatch.setattr(P, "PART", 1 << 16)
    assert P.runs_of(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    assert P.runs_of(np.tile(np.arange(70), 400)) == [(0, 28_000, 70)]


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = [r for r in docs.collect() if r.text is None or len(r.text) < 6000 or zlib.crc32(str(r.doc_id).encode()) % 10 == 0 and len(r.text) < 12000]
    got = {r.doc_id: tuple(r) for r in P.runs_digest(docs).collect()}
    assert len(got) == docs.count() and len(some) > 800
    want = [expected(r.doc_id, r.text) for r in some]
    assert [got[w[0]] for w in want] == want
    assert sum(w[1] for w in want) > 50


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a " * 6), (4, "a b " * 4), (4, "a b " * 4), (None, "x\t\n" * 9), (5, "one two"), (6, "é 　 " * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as runs", "2 as h")
    out = P.runs_digest(docs)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert P.runs_digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    full = P.periodic_runs(docs).where("doc_id = 3").first()
    assert full.collapsed == "a" and full.n_words == 6 and [tuple(r) for r in full.runs] == [(0, 6, 1)]
