import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from logweave.llm import interpolated_lm as L
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
END, START = object(), object()


def tokens(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [END]


def part_of(doc_id):
    crc = zlib.crc32(str(doc_id).encode())
    return L.NOT_LEARNED if doc_id is None or crc % 5 == 1 else L.DELETED if crc // 5 % 10 == 0 else L.KEPT


def grams(seq, k):
    padded = [START] * (k - 1) + seq
    return [tuple(padded[i : i + k]) for i in range(len(seq))]


class Plain:
    """Dictionaries of n-grams and EM over single tokens."""

    def __init__(self, rows, order, parts):
        self.order = order
        self.counts = {p: [Counter() for _ in range(order + 1)] for p in (L.KEPT, L.DELETED)}
        self.texts = Counter()
        for (_, text), p in zip(rows, parts):
            if p != L.NOT_LEARNED:
                self.texts[p] += 1
                for k in range(1, order + 1):
                    self.counts[p][k].update(grams(tokens(text), k))
        both = self.counts[L.KEPT][1] + self.counts[L.DELETED][1]
        self.n, self.v, self.words = sum(both.values()), len(both), both
        self.weights = [None]
        for k in range(1, order + 1):
            seen = {}
            for (_, text), p in zip(rows, parts):
                if p == L.DELETED:
                    seq = tokens(text)
                    for i in range(len(seq)):
                        likely, bucket = self.estimate(seq, i, k, (L.KEPT,))
                        seen.setdefault(bucket, []).append(likely / self.p(seq, i, k - 1, (L.KEPT,)))
            own = np.zeros(65)
            for b in range(1, 65):
                own[b] = self.em(seen[b]) if b in seen else own[b - 1] or 0.5
            self.weights.append(own)

    def em(self, ratios):
        share = 0.5
        r = np.array(ratios)
        for _ in range(3000):
            share = ((share * r / (share * r + 1 - share)).sum() + 1) / (len(r) + 2)
        return share

    def count(self, gram, k, parts):
        if k == 0:
            return sum(sum(self.counts[p][1].values()) for p in parts)
        if all(x is START for x in gram):
            return sum(self.texts[p] for p in parts)
        return sum(self.counts[p][k][gram] for p in parts)

    def estimate(self, seq, i, k, parts):
        gram = grams(seq, k)[i]
        context = self.count(gram[:-1], k - 1, parts)
        return (self.count(gram, k, parts) / context if context else 0.0), int(math.log2(context)) + 1 if context else 0

    def p(self, seq, i, k, parts):
        if k == 0:
            return 1 / (self.v + 1)
        likely, bucket = self.estimate(seq, i, k, parts)
        share = self.weights[k][bucket]
        return share * likely + (1 - share) * self.p(seq, i, k - 1, parts)


def corpus(seed, n=120):
    rng = random.Random(seed)
    follow = {w: [rng.choice("abcdefghij") for _ in range(3)] for w in "abcdefghij"}
    rows = []
    for i in range(n):
        w, out = rng.choice("abcdefghij"), []
        for _ in range(rng.randrange(0, 40)):
            w = rng.choice(follow[w]) if rng.random() < 0.9 else f"rare{rng.randrange(60)}"
            out.append(w.upper() if rng.random() < 0.2 else w)
            w = w if w in follow else rng.choice("abcdefghij")
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(out)))
    return rows + [(1000, None), (1001, ""), (None, "a b c"), (1002, "a b"), (1002, "a b"), (1003, "Zürich É a"), (1004, "a " * 500)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_and_weights_equal_plain_dictionaries(spark, monkeypatch, order):
    monkeypatch.setattr(L, "SHARD_KEYS", 300)  # several shards and chunks
    rows = corpus(order)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "'x' as chunk").repartition(3)
    part = F.when(F.col("doc_id").isNull(), L.NOT_LEARNED)
    for p in (L.NOT_LEARNED, L.DELETED, L.KEPT):
        part = part.when(F.col("doc_id").isin([i for i, _ in rows if i is not None and part_of(i) == p]), p)
    scores, model = L.train_and_score(docs, part, order)
    plain = Plain(rows, order, [part_of(i) for i, _ in rows])
    assert (model.types, sum(model.tokens)) == (plain.v, plain.n)
    for got, want in zip(model.weights[1:], plain.weights[2:]):
        assert np.allclose(got, want, atol=5e-3)
    plain.weights = [None, *model.weights]
    want = []
    for doc_id, text in rows:
        seq = tokens(text)
        both = (L.KEPT, L.DELETED)
        score = sum(math.log10(plain.p(seq, i, order, both)) for i in range(len(seq)))
        base = sum(math.log10((plain.words[(t,)] + 0.5) / (plain.n + 0.5 * (plain.v + 1))) for t in seq)
        want.append((str(doc_id), len(seq), sum(plain.words[(t,)] > 0 for t in seq), round(base, 6), round(score, 6)))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in scores.collect()]
    assert sorted(got) == sorted(want)


def test_probabilities_of_all_words_add_up_to_one(spark):
    rows = corpus(5)
    plain = Plain(rows, 2, [part_of(i) for i, _ in rows])
    for context in ([], ["a"], ["never seen"]):
        words = [w for (w,) in plain.words]
        total = sum(plain.p([*context, w], len(context), 2, (L.KEPT, L.DELETED)) for w in words)
        unknown = plain.p([*context, "unknown word"], len(context), 2, (L.KEPT, L.DELETED))
        assert abs(total + unknown - 1) < 1e-9


def test_packing_of_numbers():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        keys = np.sort(rng.integers(0, 1 << 64, n, np.uint64))
        assert (L.unpack_sorted(L.pack_sorted(keys), n) == keys).all()
        assert (L.unpack(L.pack(keys), n) == keys).all()
        assert L.shard_ends(keys, 3).tolist() == [0, *[int((keys < (i << 61)).sum()) for i in range(1, 8)], n]
        assert L.shard_ends(keys, 0).tolist() == [0, n]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in L.lm_scores(docs).collect()}
    assert len(got) == len(rows)
    words = Counter(t for i, text in rows if part_of(i) != L.NOT_LEARNED for t in tokens(text))
    n, v = sum(words.values()), len(words)
    shuffled, rng = [], random.Random(2)
    for doc_id, text in rows:
        r, seq = got[doc_id], tokens(text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(doc_id).encode()) % 5 == 1, len(seq), sum(words[t] > 0 for t in seq), n)
        assert abs(r.base_score - sum(math.log10((words[t] + 0.5) / (n + 0.5 * (v + 1))) for t in seq)) < 1e-6 * len(seq)
        if r.held_out:
            own = (text or "").split()
            rng.shuffle(own)
            shuffled.append((10_000_000 + doc_id, " ".join(own)))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # Word order counts: shuffled copies of unseen texts are less likely.
    more = docs.select("doc_id", "text").union(spark.createDataFrame(shuffled, "doc_id long, text string"))
    part = F.when(F.col("doc_id") >= 10_000_000, L.NOT_LEARNED).when(F.col("doc_id").isin([r.doc_id for r in held]), L.NOT_LEARNED).when(F.col("doc_id") % 10 == 0, L.DELETED).otherwise(L.KEPT)
    again = {r.doc_id: r.score for r in L.train_and_score(more, part)[0].collect()}
    assert sum(again[i - 10_000_000] - again[i] for i, _ in shuffled) > 0


def test_edge_cases(spark):
    for rows in ([], [(1, None)], [(None, "x y"), (None, None)], [(2, "a b"), (2, "a b")]):
        out = L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"))
        assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        got = out.collect()
        assert sorted(r.n_tokens for r in got) == sorted(len(tokens(t)) for _, t in rows)
        assert all(math.isfinite(r.score) and r.held_out is not None for r in got)
