import random
import zlib

import numpy as np

from logweave.llm.toxicity import IDENTITY_TERMS, TOXIC_WEIGHT, Sparse, fit, swaps, text_features, toxicity, train, word_features


def test_held_out_accuracy_of_the_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    hits = {0: [], 1: []}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out and i in truth:
            hits[truth[i]].append(r.predicted == truth[i])
    assert np.mean(hits[1]) > 0.88 and np.mean(hits[0]) > 0.99, (np.mean(hits[1]), np.mean(hits[0]))


def sentences(rng, n, share):
    """Abuse names one group more often than neutral text does, as collected labels do."""
    rows = []
    filler = ["today", "we", "saw", "many", "people", "near", "the", "river", "and", "they", "talked", "about", "music"]
    for _ in range(n):
        toxic = rng.random() < 0.4
        w = [rng.choice(filler) for _ in range(8)]
        if rng.random() < (share if toxic else 0.08):
            w.append("muslims")
        if rng.random() < 0.1:
            w.append(rng.choice(["christians", "jews", "hindus"]))
        if toxic and rng.random() < 0.8:
            w.append(rng.choice(["awfulslur", "vileword"]))
        rng.shuffle(w)
        text = " ".join(w)
        rows.append((text_features(text.encode()), swaps(text), int(toxic)))
    return rows


def test_penalty_reduces_false_positives_on_neutral_mentions():
    rows = sentences(random.Random(3), 3000, 0.9)

    def score(model, text):
        hashes, weights, b = model
        known = dict(zip(hashes.tolist(), weights))
        return 1 / (1 + np.exp(-(b + sum(known.get(f, 0) for f in text_features(text.encode()).tolist()))))

    plain, fair = train(rows, counterfactual=0.0), train(rows)
    neutral = "today we talked about music and the muslims"
    assert score(plain, neutral) > 0.5 > score(fair, neutral)
    change = lambda m: abs(score(m, neutral) - score(m, neutral.replace("muslims", "hindus")))
    assert change(fair) < change(plain) / 4
    assert score(fair, "the muslims awfulslur") > 0.5 and score(fair, "people awfulslur") > 0.5


def test_swaps_stay_in_their_sentence():
    got = swaps("Some women sang. Men danced!\nno one")
    assert [g for g, _ in got] == [b"women", b"women", b"men", b"men"]
    assert all(not c or c.decode() in IDENTITY_TERMS[0] for _, c in got)
    assert len(word_features(b"abcdef")) == 4


def test_fit_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(5) < 0.5) for _ in range(400)]
    y = np.array([float(0 in r) if rng.random() < 0.9 else 0.0 for r in rows])
    x, none = Sparse(rows, 5), Sparse([], 5, [])
    w, b = fit(x, y, none, np.ones(5), l2=0.01, rounds=800)
    share = np.where(y > 0, TOXIC_WEIGHT, 1.0)
    r = (1 / (1 + np.exp(-(x.dot(w) + b))) - y) * share / share.sum()
    assert np.abs(np.append(x.back(r) + 0.01 * w, r.sum())).max() < 1e-3


def test_edge_cases(spark):
    rows = [(i, ("you idiot " if i % 3 == 0 else "fine words ") + f"x{i}") for i in range(90)]
    rows += [(500, None), (501, ""), (None, "you idiot"), (3, "you idiot x3"), (502, "IDIOT " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "0 as toxic")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(1, 0), (None, 1), (9999, 1), (500, 1), (2, None)], "doc_id long, toxic int")
    got = {}
    for r in toxicity(docs, labels).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert got[500][0].score == got[501][0].score and got[None][0].held_out is False
    assert got[502][0].predicted == 1 and got[4][0].predicted == 0 and len(got[3]) == 2


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    [r] = toxicity(docs, none).collect()
    assert r.score < 1e-9 and r.predicted == 0
    assert toxicity(docs.where("doc_id = 2"), none).collect() == []
