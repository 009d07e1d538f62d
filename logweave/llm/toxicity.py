"""Toxicity: a logistic classifier whose scores may not follow identity terms.

Features are the presence of words (letters and non-ASCII runs, A-Z lower-cased) and of
their beginnings, so that inflected and compound forms count too, as far as they occur
in at least ``MIN_DOCS`` training texts, scaled by the log ratio of their shares in the
two classes, so that the many words of no consequence stay small. Training minimises
the mean log loss (label 1 counts ``TOXIC_WEIGHT`` times), plus L2, plus the counterfactual penalty: for every labelled sentence that names a
group, the sentence with the term swapped for another term of its set, and with the
term left out, should score the same; the squared change of the logit is added with
weight ``COUNTERFACTUAL``. Weights that the labels alone would give to the mention of
a group thus shrink, while abusive words keep theirs.

Training runs on at most ``TRAIN_DOCS`` labelled documents, taken by a hash of their
id (a documented bound; their hashed features are some 60 MB). Scoring runs over all whole
texts in the scan's own splits: no shuffle, no label, no source, language or id.

Defined results: a null or empty text scores by the intercept alone. Without labelled
rows, or with one class only, the score is the share of label 1 (0 without rows).
Rows are scored one by one; labels that repeat, are null or name unknown documents do
no harm. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow, sized, stage

TRAIN_DOCS, MIN_DOCS = 5_000, 5
PREFIXES = (3, 4, 5, 6, 7)  # bytes
KNOWN_WORDS = 400_000  # words whose features a task keeps
L2, COUNTERFACTUAL, ROUNDS, TOXIC_WEIGHT = 1e-3, 4.0, 300, 3.0
#: Terms that name groups; the terms of one set are swapped for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "lesbian", "bisexual", "queer", "straight"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young", "elderly"),
)
WORD = re.compile(rb"[a-z\x80-\xff]+")
SENTENCE = re.compile(r"[.!?\n]+")


def words(text: bytes) -> set[bytes]:
    return set(WORD.findall(text.lower()))


def word_features(word: bytes) -> list[int]:
    """Hashes of a word and its beginnings."""
    return [xxhash.xxh3_64_intdigest(word), *(xxhash.xxh3_64_intdigest(word[:k], k) for k in PREFIXES if len(word) > k)]


def text_features(text: bytes) -> np.ndarray:
    return np.array(sorted({f for w in words(text) for f in word_features(w)}), np.uint64)


def swaps(text: str, sets=IDENTITY_TERMS) -> list[tuple[bytes, bytes]]:
    """For each sentence with identity terms: (term, term in its place or nothing) of its counterfactuals."""
    group = {t.encode(): (i, j) for i, s in enumerate(sets) for j, t in enumerate(s)}
    out = []
    for sentence in SENTENCE.split(text):
        own = sorted(words(sentence.encode()) & group.keys())
        for term in own:
            i, j = group[term]
            others = [t.encode() for t in sets[i] if t.encode() not in own]
            if others:
                out.append((term, others[(zlib.crc32(sentence.encode()) + j) % len(others)]))
            out.append((term, b""))
    return out


class Sparse:
    """Rows of column numbers with values; just the two products that training needs."""

    def __init__(self, rows: list[np.ndarray], width: int, values: list[np.ndarray] | None = None):
        self.counts = np.array([len(r) for r in rows], np.int64)
        self.columns = np.concatenate(rows).astype(np.int32) if rows else np.empty(0, np.int32)
        self.values = np.concatenate(values) if values else 1.0
        self.owner, self.width = np.repeat(np.arange(len(rows), dtype=np.int32), self.counts), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, w[self.columns] * self.values, len(self.counts))

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, r[self.owner] * self.values, self.width)


def log_ratios(x: Sparse, y: np.ndarray) -> np.ndarray:
    """|log| of each feature's share in label 1 over its share in label 0, with half a document added."""
    a, b = x.back(y), x.back(1 - y)
    return np.abs(np.log(((a + 0.5) / (y.sum() + 1)) / ((b + 0.5) / ((1 - y).sum() + 1))))


def fit(x: Sparse, y: np.ndarray, changes: Sparse, scale: np.ndarray, l2: float = L2, counterfactual: float = COUNTERFACTUAL, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and intercept: Adam on the full batch, from zero, so that reruns agree. L2 holds on weights / ``scale``."""
    w = np.zeros(x.width + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    c = max(len(changes.counts), 1)
    share = np.where(y > 0, TOXIC_WEIGHT, 1.0)
    share /= max(share.sum(), 1)
    for t in range(1, rounds + 1):
        real = w[:-1] * scale
        r = (1 / (1 + np.exp(-np.clip(x.dot(real) + w[-1], -30, 30))) - y) * share
        g = np.append((x.back(r) + 2 * counterfactual * changes.back(changes.dot(real)) / c) * scale + l2 * w[:-1], r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1] * scale, float(w[-1])


def train(samples: list[tuple[np.ndarray, list[tuple[bytes, bytes]], int]], counterfactual: float = COUNTERFACTUAL, min_docs: int = MIN_DOCS) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted feature hashes, weights, intercept) from a bounded list of (features, swaps, label)."""
    labels = np.array([label for _, _, label in samples], float)
    none = np.empty(0, np.uint64)
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.0
        return none, np.empty(0), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12)))
    seen, docs = np.unique(np.concatenate([f for f, _, _ in samples]), return_counts=True)
    known = seen[docs >= min_docs]

    def columns(features: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, features)
        return at[known[np.minimum(at, len(known) - 1)] == features].astype(np.int32) if len(known) else np.empty(0, np.int32)

    rows = [columns(f) for f, _, _ in samples]
    pairs = [(columns(np.array(word_features(g), np.uint64)), columns(np.array(word_features(c) if c else [], np.uint64))) for _, swapped, _ in samples for g, c in swapped]
    pairs = [p for p in pairs if len(p[0]) or len(p[1])]
    changes = Sparse([np.concatenate(p) for p in pairs], len(known), [np.repeat([1.0, -1.0], [len(p[0]), len(p[1])]) for p in pairs])
    x = Sparse(rows, len(known))
    weights, intercept = fit(x, labels, changes, log_ratios(x, labels), counterfactual=counterfactual)
    return known, weights, intercept


def _samples(batches):
    """(text, toxic) -> (toxic, features, swaps)."""
    kind = pa.list_(pa.struct([("gone", pa.binary()), ("come", pa.binary())]))
    for batch in batches:
        texts = [t or b"" for t in batch.column(0).to_pylist()]
        swapped = [[{"gone": g, "come": c} for g, c in swaps(t.decode("utf-8", "replace"))] for t in texts]
        yield pa.record_batch([batch.column(1), pa.array([text_features(t).tobytes() for t in texts], pa.binary()), pa.array(swapped, kind)], names=["toxic", "features", "swaps"])


def _score(model):
    def run(batches):
        hashes, weights, intercept = model.value
        index = {h: i for i, h in enumerate(hashes.tolist())}
        known: dict[bytes, tuple[int, ...]] = {}

        def features(word: bytes) -> tuple[int, ...]:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            found = known[word] = tuple(index[f] for f in word_features(word) if f in index)
            return found

        for batch in batches:
            logits = []
            for text in batch.column(1):
                own = {f for w in words(text.as_py() or b"") for f in (known[w] if w in known else features(w))}
                logits.append(intercept + weights[np.fromiter(sorted(own), np.int64, len(own))].sum())
            score = 1 / (1 + np.exp(-np.clip(logits, -700, 700)))
            yield pa.record_batch([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    ``labels``: doc_id, toxic (0 or 1). Rows whose crc32(doc_id) is divisible by 5 are
    held out from training.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    known = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = stage(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs), "training-ids")
    rows = map_arrow(texts.join(sized(sample), "doc_id").select("text", "toxic"), _samples, "toxic int, features binary, swaps array<struct<gone: binary, come: binary>>")
    # Repeated ids can bring more rows than ids: the bound holds for the rows too. Sorted, so that reruns agree.
    rows = rows.orderBy(F.xxhash64("features"), "toxic").limit(train_docs).collect()
    model = train([(np.frombuffer(r.features, np.uint64), [(bytes(x.gone), bytes(x.come)) for x in r.swaps], r.toxic) for r in rows])
    model = docs.sparkSession.sparkContext.broadcast(model)
    scores = map_arrow(texts, _score(model), "doc_id long, score double")
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
