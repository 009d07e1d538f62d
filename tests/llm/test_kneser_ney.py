import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from logweave.llm import kneser_ney
from logweave.llm.common import mix
from logweave.llm.interpolated_lm import pack, pack_sorted
from logweave.llm.kneser_ney import HELD, MIN_TRUSTED, perplexities
from tests.llm.test_minhash_dedup import words_of

SF = "/root/testdata/sf0.001"
ORDER = 3


def held_out(doc_id):
    return not zlib.crc32(str(doc_id).encode()) % HELD


class Brute:
    """Interpolated modified Kneser-Ney over the words of texts, straight from the definition."""

    def __init__(self, texts):
        raw = Counter()
        for text in texts:
            s = self.sequence(text)
            for i in range(1, len(s)):
                for k in range(1, min(ORDER, i + 1) + 1):
                    raw[s[i + 1 - k : i + 1], i + 1 == k] += 1  # (gram, begins the text)
        self.n = [None] + [Counter() for _ in range(ORDER)]
        for (g, start), c in raw.items():
            if len(g) == ORDER or (start and len(g) > 1):
                self.n[len(g)][g] += c
        for k in range(ORDER - 1, 0, -1):
            for g in list(self.n[k + 1]):
                self.n[k][g[1:]] += 1
        self.types = len(self.n[1])
        self.d, self.total, self.cut = [None], [None], [None]
        for k in range(1, ORDER + 1):
            coc = Counter(self.n[k].values())
            y = coc[1] / (coc[1] + 2 * coc[2]) if coc[1] else 0
            d = [0.0]
            for i in (1, 2, 3):
                x = i - (i + 1) * y * coc[i + 1] / coc[i] if coc[i] and coc[1] else i * 0.5
                d.append(max(0.05, min(i - 0.05, x)))
            total, cut = defaultdict(float), defaultdict(float)
            for g, c in self.n[k].items():
                total[g[:-1]] += c
                cut[g[:-1]] += d[min(c, 3)]
            self.d.append(d), self.total.append(total), self.cut.append(cut)

    @staticmethod
    def sequence(text):
        words = words_of(text)
        return ("<s>", *words, "</s>") if words else ()

    def p(self, h, w):
        k = len(h) + 1
        lower = self.p(h[1:], w) if h else 1 / (self.types + 1)
        if not self.total[k][h]:
            return lower
        n = self.n[k][(*h, w)]
        return (n - self.d[k][min(n, 3)] + self.cut[k][h] * lower) / self.total[k][h]

    def perplexity(self, text):
        s = self.sequence(text)
        logs = [math.log(self.p(s[max(0, i - ORDER + 1) : i], s[i])) for i in range(1, len(s))]
        return math.exp(-sum(logs) / len(logs)) if logs else None


def check(spark, docs, trusted):
    """Every row's perplexity against the definition."""
    good = {r.doc_id for r in trusted.collect()}
    rows = docs.collect()
    by_lang = defaultdict(list)
    for r in rows:
        if r.doc_id in good and not held_out(r.doc_id):
            by_lang[r.lang].append(r.text)
    models = {lang: Brute(t) for lang, t in by_lang.items() if len(t) >= MIN_TRUSTED}
    whole = Brute([t for ts in by_lang.values() for t in ts])
    got = defaultdict(list)
    for r in perplexities(docs, trusted).collect():
        got[r.doc_id].append(r.perplexity)
    assert models and sum(map(len, got.values())) == len(rows)
    for r in rows:
        want = models.get(r.lang, whole).perplexity(r.text)
        assert any(x == want if want is None else x == pytest.approx(want, rel=1e-9) for x in got[r.doc_id]), r
    return models, len(by_lang)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(spark, docs, spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id"))


def random_docs(spark, n=160):
    """Texts of few words in two languages, one of them small, so that grams repeat and orders back off."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(30)], k=rng.randrange(0, 25))), "xx" if i % 11 == 0 else "en") for i in range(n)]
    return spark.createDataFrame(rows + rows[:9], "doc_id long, text string, lang string"), spark.createDataFrame([(i,) for i in range(0, n, 2)], "doc_id long")


def test_small_chunks_and_many_shards_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "CHUNK_TOKENS", 60)
    monkeypatch.setattr(kneser_ney, "SHARD_KEYS", 100)
    models, langs = check(spark, *random_docs(spark))
    assert len(models) < langs  # one language has the model of all


def test_probabilities_add_up():
    brute = Brute(["the cat the dog that rat", "a cat"])
    words = [*{w for (w,) in brute.n[1]}, "unknown"]
    for h in (("<s>", "the"), ("the",), ("zzz", "yyy"), ("a", "cat"), ()):
        assert sum(brute.p(h, w) for w in words) == pytest.approx(1)


def test_shuffled_words_are_less_likely(spark):
    sentence = "the quick fox jumps over a lazy dog while rain falls on green hills".split()
    rng = random.Random(1)
    shuffled = [rng.sample(sentence, len(sentence)) for _ in range(20)]
    rows = [(i, " ".join(sentence) + f" n{i}", "en") for i in range(100)] + [(1000 + i, " ".join(w), "en") for i, w in enumerate(shuffled)] + [(2000, " ".join(sentence), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    by = {r.doc_id: r.perplexity for r in perplexities(docs, spark.range(100).toDF("doc_id")).collect()}
    assert all(by[1000 + i] > 2 * by[2000] for i, w in enumerate(shuffled) if w != sentence)


def test_clean_stays_and_noise_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = perplexities(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    noise = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) / len(clean) > 0.99 and sum(noise) / len(noise) < 0.4


def test_edge_cases(spark):
    rows = [(i, f"common words and more words {i}", "en") for i in range(30)]
    rows += [(100, None, "en"), (101, "", None), (102, "ümläut wörter", None), (None, "common words", "en"), (3, "common words and more words 3", "en"), (103, "zq##xv~~", "en"), (104, "w" * 100_000, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as perplexity", "true as trusted", "2 as model")
    trusted = spark.createDataFrame([(i,) for i in [*range(30), 5, 9999, None]], "doc_id long")
    out = perplexities(docs, trusted).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[100].perplexity is None and not by[100].kept and by[101].n_symbols == 0
    assert by[0].kept and not by[103].kept and by[104].perplexity > by[0].perplexity


def test_nothing_trusted_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    [r] = perplexities(docs, none).collect()
    assert r.perplexity == pytest.approx(1) and not r.kept
    assert perplexities(docs.where("doc_id = 2"), none).collect() == []


def test_threshold_is_the_quantile_of_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = perplexities(docs, labels.where("quality = 1").select("doc_id")).join(docs.select("doc_id", "lang"), "doc_id").join(labels, "doc_id").collect()
    by_lang = defaultdict(list)
    for r in rows:
        if r.quality == 1 and r.perplexity is not None and held_out(r.doc_id):
            by_lang[r.lang, r.threshold].append(r.perplexity)
    for (_, threshold), values in by_lang.items():
        if len(values) >= kneser_ney.MIN_TRUSTED:
            exact = sorted(values)[math.ceil(0.995 * len(values)) - 1]
            assert exact <= threshold <= 1.01 * exact + 0.01
    kept = {q: [r.kept for r in rows if r.quality == q] for q in (1, 0)}
    print("KEPT", {q: (sum(k), len(k)) for q, k in kept.items()})
    assert sum(kept[1]) / len(kept[1]) >= 0.995 and sum(kept[0]) / len(kept[0]) < 0.4


def test_a_chunk_takes_little_memory():
    """Counting and scoring a chunk of one shard; all columns of counts and all orders' hashes took over 200 bytes a word."""
    n = 1_000_000
    rng = np.random.default_rng(3)
    words, tokens = np.unique(rng.zipf(1.2, n) % 50_000, return_inverse=True)
    row = {"chunk": 1, "model": "=en", "doc_ids": [*range(100)], "langs": ["en"] * 100, "parts": [kneser_ney.LEARNED] * 100, "lengths": [n // 100] * 100}
    row |= {"words": pack(mix(words.astype(np.uint64)) >> np.uint64(16)), "tokens": pack(tokens)}
    keys = kneser_ney.Keys(n)
    answers, sent = None, []
    for level in range(ORDER, 0, -1):
        tracemalloc.start()
        grams, counts = kneser_ney._added(kneser_ney.Chunk(row, keys), level, answers, None)
        peak = tracemalloc.get_traced_memory()[1]
        asked = {"shard": [0], "chunk": [1], "model": ["=en"], "n": [len(grams.keys)], "keys": [pack_sorted(grams.keys)], "counts": [kneser_ney.pack_counts(counts)]}
        del grams, counts
        tracemalloc.reset_peak()
        answers = kneser_ney._answers(level)(pa.table(asked))
        peak = max(peak, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert peak / n < 130, (level, peak / n)
        answers = answers.filter(pc.is_valid(answers["chunk"]))
        sent.append(answers)
    orders = [kneser_ney.Order(90, 40, 20, 10, 500, n)] * ORDER
    tracemalloc.start()
    p = kneser_ney._probabilities(kneser_ney.Chunk(row, keys), pa.concat_tables(sent), orders)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(p) == n and peak / n < 130, peak / n


def test_halves_of_the_hashes_hold_every_gram_once():
    n = 3000
    words = np.arange(400, dtype=np.uint64)
    row = {"chunk": 1, "model": "*", "doc_ids": [1, 2], "langs": ["en"] * 2, "parts": [kneser_ney.LEARNED] * 2, "lengths": [1000, 2000], "words": pack(mix(words)), "tokens": pack(np.random.default_rng(1).permutation(n) % 400)}
    keys = kneser_ney.Keys(kneser_ney.SHARD_KEYS)
    chunk = kneser_ney.Chunk(row, keys)
    for level in (1, 2, 3):
        whole, halves = chunk.grams(level), [chunk.grams(level, half) for half in keys.halves()]
        assert len(halves) == 2 and np.array_equal(np.concatenate([h.keys for h in halves]), whole.keys)
        assert sorted(np.concatenate([h.places for h in halves])) == whole.places.tolist()
