import numpy as np
import pytest

from logweave.llm.minhash_dedup import drop_near_duplicates, near_duplicates
from logweave.llm.near_links import agreement_limit
from logweave.llm.sketch import similarity_sketch, sketch_bits

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for ch in (text or "") + " ":
        if ch in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    return out


def shingles(text, k=5):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, percent=75):
    """doc_id -> (set size, smallest reachable id); candidates share a shingle, every such pair is tested."""
    sets = {i: shingles(t) for i, t in rows}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, set()).add(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        near = set().union(*(index[x] for x in s)) if s else set()
        for j in near:
            if j < i and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_chains_and_hot_groups(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 60)]
    rows = [(1000, " ".join(base))]
    for i in range(1, 60):  # a chain: each text changes one more word of the one before
        base = list(base)
        base[i % 60] = f"x{i}"
        rows.append((1000 - i, " ".join(base)))
    group = [f"g{i}" for i in rng.integers(0, 10**6, 120)]
    for i in range(300):  # edits of one text: some pairs are linked, some are not
        w = list(group)
        for p in rng.integers(0, 120, 4):
            w[p] = f"e{i}-{p}"
        rows.append((5000 + i, " ".join(w)))
    rows += [(9000 + i, " ".join(group)) for i in range(50)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_edge_cases(spark):
    rows = [
        (1, "A b c", "x"), (2, "a B C", "x"), (3, "a b", "y"), (4, "", "y"), (5, None, None), (6, " \t\n", "z"),
        (7, "one two three four five six", "q"), (7, "one two three four five six", "q"),
        (None, "one two three four five six", "q"), (None, "alone in the world without any id", "q"), (8, "a b c", "q"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id or -1), r.n_shingles, (r.component_id or -1), r.kept) for r in near_duplicates(docs).collect())
    assert got == [
        (-1, 2, 7, False), (-1, 3, -1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 0, 4, True),
        (5, 0, 5, True), (6, 0, 6, True), (7, 2, 7, True), (7, 2, 7, True), (8, 1, 8, True),
    ]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 3, 4, 5, 6, 7, 8]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    assert drop_near_duplicates(empty).collect() == []


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for common, own in ((300, 50), (30, 5), (5, 1), (1, 0)):
        base = rng.integers(0, 2**63, common + 2 * own).astype(np.uint64)
        sets = [np.unique(base[: common + own]), np.unique(np.concatenate([base[:common], base[common + own :]]))]
        s = similarity_sketch(sets)
        assert not (s == np.uint64(0xFFFFFFFFFFFFFFFF)).any()  # every coordinate is filled
        assert abs((s[0] == s[1]).mean() - common / (common + 2 * own)) < 0.17


@pytest.mark.parametrize("size", [1, 3])
def test_tiny_sets_fill_every_bin(size):
    s = similarity_sketch([np.arange(1, size + 1, dtype=np.uint64)])
    assert not (s == np.uint64(0xFFFFFFFFFFFFFFFF)).any()


def test_bits_of_similar_sets_agree():
    rng = np.random.default_rng(4)
    for common, own in ((300, 50), (24, 4), (6, 1)):  # similarity 0.75
        for _ in range(20):
            base = rng.integers(0, 2**63, common + 2 * own).astype(np.uint64)
            a, b = sketch_bits([np.unique(base[: common + own]), np.unique(np.concatenate([base[:common], base[common + own :]]))], 512)
            assert sum(bin(int(x) & (2**64 - 1)).count("1") for x in a ^ b) <= agreement_limit(75, 512)
