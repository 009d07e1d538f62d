import random

from logweave.llm.substring_dedup import passages, remove_repeats, repeated_passages, repeated_runs, repeated_text, tune_bands
from logweave.plans import materialize
from tests.llm.test_minhash_dedup import shingles, words_of

SF = "/root/testdata/sf0.01"


def brute(docs, least=50):
    """(doc_id, start) -> (cluster, removed) for passages that occur more than once, exactly or nearly."""
    occ = []
    for doc_id, text in docs:
        for s, e in passages(text or ""):
            w = words_of(text[s:e])
            if len(w) >= least:
                occ.append((doc_id, s, tuple(w)))
    sets = {w: shingles(" ".join(w)) for _, _, w in occ}
    index = {}
    for w, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(w)
    parent = {w: w for w in sets}

    def find(w):
        while parent[w] != w:
            w = parent[w]
        return w

    for w, s in sets.items():
        for v in {v for x in s for v in index[x]}:
            if v < w and 100 * len(s & sets[v]) >= 75 * len(s | sets[v]):
                a, b = find(v), find(w)
                if a != b:
                    parent[b] = a
    groups = {}
    for o in occ:
        groups.setdefault(find(o[2]), []).append(o[:2])
    return {o: (min(g), o != min(g)) for g in groups.values() if len(g) > 1 for o in g}


def compare(rows, docs, least=50):
    got = {(r.doc_id, r.start): (r.cluster_id, r.keep_doc_id, r.removed) for r in rows}
    want = brute(docs, least)
    assert set(got) == set(want)
    for k, (cluster, keep, removed) in got.items():
        assert (keep, removed) == (want[k][0][0], want[k][1])
    clusters = {}
    for k, (cluster, _, _) in got.items():
        clusters.setdefault(cluster, set()).add(want[k][0])
    assert all(len(v) == 1 for v in clusters.values())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    compare(repeated_passages(docs).collect(), texts)
    compare(repeated_passages(docs, min_words=10).collect(), texts, 10)


def random_text(rng, n):
    out = []
    for i in range(n):
        w = "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
        out.append(w + rng.choice(["", "", "", "", "", "", "", ".", "."]))
    return " ".join(out)


def test_passage_inside_other_lines_is_caught(spark):
    rng = random.Random(11)
    found = 0
    docs, planted = [], []
    for i in range(60):
        passage = random_text(rng, rng.randint(60, 150)) + "."
        pair = []
        for _ in range(2):
            a, b = random_text(rng, rng.randint(5, 80)), random_text(rng, rng.randint(5, 80))
            docs.append((len(docs), f"{a} {passage} {b}"))
            pair.append(len(docs) - 1)
        planted.append(pair)
    clean = [(1000 + i, random_text(rng, 200)) for i in range(60)]
    rows = repeated_text(spark.createDataFrame(docs + clean, "doc_id long, text string")).collect()
    hit = {r.doc_id for r in rows}
    found = sum(set(p) <= hit for p in planted)
    assert found >= 57 and not any(d >= 1000 for d in hit)
    assert {r.doc_id for r in rows if r.removed} <= {b for _, b in planted}


def test_removal_and_edge_cases(spark):
    p = "this passage has more than ten words and it stands in many documents"
    q = "another passage of more than ten plain words which only stands here alone"
    docs = [(1, f"{p}\n{q} one\nend"), (2, f"start\n{p.upper()}\n"), (3, p), (4, None), (5, ""), (None, p), (6, "short\nshort"), (7, f"a {q} b\n{p}\nzwölf ü"), (8, f"{p}\n{p}\nx"), (8, f"{p}\n{p}\nx")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "length(text) as n_chars", "0 as start", "'k' as mark")
    rows = repeated_passages(df, min_words=10).collect()
    assert sorted(((r.doc_id or -1), r.start, r.removed) for r in rows if r.n_words == 13) == sorted(
        [(1, 0, False), (2, 6, True), (3, 0, True), (-1, 0, True), (7, q.__len__() + 5, True), (8, 0, True), (8, 0, True), (8, len(p) + 1, True), (8, len(p) + 1, True)]
    )
    out = remove_repeats(df, lambda d: repeated_text(d, min_words=10))
    assert out.columns == df.columns
    got = sorted((r.doc_id or -1, r.text or "", r.n_chars) for r in out.collect())
    assert (2, "start\n", 6) in got and (1, docs[0][1], len(docs[0][1])) in got and (-1, p, len(p)) in got
    assert (8, "x", 1) in got and not any(r[0] == 3 for r in got) and (4, "", None) in got and (5, "", 0) in got


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert repeated_passages(empty).collect() == [] and remove_repeats(empty).collect() == []


def test_bands_and_spans():
    bands, rows = tune_bands()
    assert 1 - (1 - 0.75**rows) ** bands >= 0.99999
    for t in ("", "a", "a. b. c", "x\n\ny. Z!", "\n", "one two.  three\n"):
        spans = passages(t)
        assert "".join(t[s:e] for s, e in spans) == t


def shared_runs(texts, n=50):
    """Word positions (text, word) that lie in a stretch of ``n`` words that stands in two places."""
    places = {}
    for i, t in enumerate(texts):
        w = words_of(t)
        for k in range(len(w) - n + 1):
            places.setdefault(tuple(w[k : k + n]), []).append((i, k))
    return [p for p in places.values() if len({i for i, _ in p}) > 1]


def test_every_shared_run_of_50_words_is_found(spark):
    """Against a brute force without passages(): one-line hosts, copies cut anywhere, stops of other scripts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijé") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def text(n):
        return [rng.choice(words) + rng.choice(["", "", "", "", "。", "."]) for _ in range(n)]

    docs = []
    for n in [50, 50, 50, 51, 53, 57, 60, 70, 80, 120] * 6:
        copy = text(n)
        docs += [" ".join(text(rng.randint(0, 60)) + copy + text(rng.randint(0, 60))) for _ in range(2)]
    docs += [" ".join(text(300)) for _ in range(20)] + ["x y " * 100, None, "", "a\x0bb\n" * 60]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {}
    for r in repeated_runs(df).collect():
        before, own = docs[r.doc_id][: r.start].split(), docs[r.doc_id][r.start : r.start + r.length]
        assert len(own.split()) == 25 == r.n_words and own == own.strip()
        found.setdefault(r.doc_id, []).append((len(before), r.cluster_id, r.removed, r.keep_doc_id))
    want = shared_runs([t or "" for t in docs])
    assert len(want) > 500
    for places in want:
        held = [{c for at, c, _, _ in found.get(i, []) if k <= at <= k + 25} for i, k in places]
        assert set.intersection(*held)
    inside = {i for i, t in enumerate(docs) if t and len(set(t.split())) < 3}  # these repeat themselves
    assert all(removed == (i != keep) for i, rows in found.items() for _, _, removed, keep in rows if i not in inside)
    assert set(found) == {i for p in want for i, _ in p} | inside


def test_removal_of_a_run_inside_a_line(spark):
    rng = random.Random(8)
    w = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    copy = " ".join(w[:120])
    docs = [(1, " ".join([*w[120:150], copy, *w[150:180]])), (2, " ".join([*w[200:230], copy, *w[230:260]]))]
    out = {r.doc_id: r.text for r in remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), repeated_text).collect()}
    assert out[1] == docs[0][1]
    left = out[2].split()
    assert left[:30] == w[200:230] and left[-30:] == w[230:260] and 60 <= len(left) <= 60 + 2 * 25


def test_short_shared_text_stays(spark):
    """Fewer than 50 shared words are no repeat, whatever lies around them and however often they stand."""
    rng = random.Random(3)
    w = ["".join(rng.choice("abcdefghijklm") for _ in range(8)) for _ in range(6000)]
    common = w[:49]
    docs = [" ".join([*w[100 * i + 100 : 100 * i + 140], *common[: 25 + i % 25], *w[100 * i + 140 : 100 * i + 200]]) for i in range(50)]
    longer = [" ".join([*w[:49], w[59], *w[5900 + i * 30 : 5930 + i * 30]]) for i in range(2)]
    df = spark.createDataFrame(list(enumerate(docs + longer)), "doc_id long, text string")
    rows = repeated_text(df).collect()
    assert {r.doc_id for r in rows} == {50, 51} and {r.keep_doc_id for r in rows} == {50}


def test_one_pass_equals_two(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    both = sorted(map(str, repeated_text(docs).collect()))
    assert both == sorted(map(str, repeated_passages(docs).unionByName(repeated_runs(docs)).collect())) and both


def test_broadcasts_in_halves_give_the_same(spark, monkeypatch):
    from logweave.llm import substring_dedup

    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[20 * (i % 5) : 20 * (i % 5) + 150]) + f" end {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(str, substring_dedup.repeated_runs(docs).collect()))
    monkeypatch.setattr(substring_dedup, "HALVED_ROWS", 0)
    assert whole and sorted(map(str, substring_dedup.repeated_runs(docs).collect())) == whole


def test_tables_go_when_read_for_the_last_time(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    since = materialize.written()
    out = repeated_text(docs)
    left = [path.rpartition("/")[2].rpartition("-")[0] for path in materialize._WRITTEN[since:]]
    assert not {"llm-found", "llm-sets", "llm-nodes", "llm-gram-sides", "llm-gram-windows"} & {*left}, left
    want = repeated_passages(docs).unionByName(repeated_runs(docs))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
