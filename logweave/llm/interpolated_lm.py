"""LM scoring by deleted interpolation: maximum-likelihood n-grams mixed by context frequency.

    P_k(w | context) = L_k(b) * count(context w) / count(context) + (1 - L_k(b)) * P_{k-1}(w | shorter context)

from P_0 = 1 / (V + 1), V known words and one for all others, up to ``order`` words. b is
the bucket of the context's frequency (powers of two; unseen contexts pass all weight
on). Contexts at a text's start are filled up with a start symbol; every text ends with
an end token, which is predicted like a word.

1. Texts become chunks of about ``CHUNK_TOKENS`` tokens, written once: word hashes and
   token numbers. Learned documents fall into a kept and a deleted (held-out) part.
2. A chunk sends each of its different n-grams once, with its counts in either part, to
   the shard of the gram's hash; sorted hashes travel as differences. A shard adds the
   chunks' counts and answers every chunk in the order it sent its grams. Frequent grams
   are one entry per chunk; shards grow in number, not in size, with the corpus.
3. Weights: kept counts predict the deleted documents. The ratio of the estimate to the
   shorter model's probability is all that expectation-maximisation needs, so its
   histogram by bucket (bounded by its bins) goes to the driver, order by order.
4. Scores: chunks meet the answers; counts of both parts and the weights give each
   token's probability and each document's sum.

Defined results: null and empty texts are the end token alone. A null doc_id is scored and
not learned from. Every row counts, repeated rows each for itself. Without any learned
document every probability is 1 / (V + 1) = 1 and scores are 0. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import GOLD, M2, WordHashes, map_arrow, mix, stage

ORDER = 2
CHUNK_TOKENS = 500_000  # bounds a task's memory (a longer text is a chunk by itself)
SHARD_KEYS = 2_000_000  # about so many entries of chunks meet in one shard
BINS = 64  # bins an octave of the ratio histograms
END, START = np.uint64(0x9D5C_0FB1_35A7_E24B), np.uint64(0x51F3_6E08_C2D9_7A41)  # hashes of the end token and the start symbol
NOT_LEARNED, KEPT, DELETED = 0, 1, 2
CHUNKS = "chunk long, deleted boolean, doc_ids array<long>, parts array<int>, lengths array<int>, words binary, tokens binary"
GRAMS = "level int, shard int, chunk long, n int, keys binary, kept binary, gone binary"
ANSWERS = "chunk long, level int, shard int, n int, kept binary, gone binary, bin int, types long, kept_tokens long, gone_tokens long"


_ZSTD = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()  # one state each for a worker's thousands of small pieces


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes: small values leave only zeros in the upper ones."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return _ZSTD[0].compress(np.ascontiguousarray(planes))


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_ZSTD[1].decompress(data, max_output_size=8 * n), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


def _chunks(batches):
    """(doc_id, part, text) -> chunks; documents of the deleted part have chunks of their own."""
    from pyspark import TaskContext

    known = WordHashes()
    held: dict[bool, list] = {False: [], True: []}
    sizes = {False: 0, True: 0}
    made = 0

    def out(deleted: bool) -> pa.RecordBatch:
        nonlocal made
        rows, held[deleted], sizes[deleted] = held[deleted], [], 0
        words, tokens = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
        made += 1
        return pa.record_batch([
            pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()), pa.array([deleted], pa.bool_()),
            pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[1] for r in rows]], pa.list_(pa.int32())),
            pa.array([[len(r[2]) for r in rows]], pa.list_(pa.int32())), pa.array([pack_sorted(words)], pa.binary()), pa.array([pack(tokens)], pa.binary()),
        ], names=["chunk", "deleted", "doc_ids", "parts", "lengths", "words", "tokens"])

    for batch in batches:
        for doc_id, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = (text.as_py() or b"").lower().split()  # lower() touches A-Z only; split() is at 0x20 and 0x09-0x0D
            ids = np.empty(len(words) + 1, np.uint64)
            ids[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            ids[-1] = END
            deleted = part == DELETED
            if held[deleted] and sizes[deleted] + len(ids) > CHUNK_TOKENS:
                yield out(deleted)
            held[deleted].append((doc_id, part, ids))
            sizes[deleted] += len(ids)
    for deleted in held:
        if held[deleted]:
            yield out(deleted)


class Chunk:
    """The tokens of a chunk's documents and the keys of the n-grams that end at them."""

    def __init__(self, row: dict):
        self.lengths = np.array(row["lengths"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        total = int(self.lengths.sum())
        tokens = unpack(row["tokens"], total).astype(np.int64)
        words = unpack_sorted(row["words"], int(tokens.max()) + 1)
        self.hashes = words[tokens]
        self.position = np.arange(total) - np.repeat(self.starts, self.lengths)
        self.doc_ids, self.parts = row["doc_ids"], np.array(row["parts"])

    def keys(self, order: int):
        """Keys of level 1, 2, ... ``order``, one array a level."""
        key = mix(self.hashes)
        yield key
        for back in range(1, order):
            before = np.full(len(key), START, np.uint64)
            before[back:] = np.where(self.position[back:] >= back, self.hashes[:-back], START)
            key = mix(key * GOLD + before * M2)
            yield key


def shard_ends(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where the shards (upper ``bits`` bits) of sorted keys begin, and the end."""
    firsts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, firsts), [len(keys)]]).astype(np.int64)


def _grams(order: int, bits: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row)
                part = np.repeat(chunk.parts.astype(np.int8), chunk.lengths)
                rows = []
                for level, keys in enumerate(chunk.keys(order), 1):
                    unique, at = np.unique(keys, return_inverse=True)
                    counts = [np.bincount(at[part == p], minlength=len(unique)).astype(np.uint32) for p in (KEPT, DELETED)]
                    ends = shard_ends(unique, bits)
                    for shard in np.flatnonzero(np.diff(ends)).tolist():
                        own = slice(ends[shard], ends[shard + 1])
                        rows.append((level, shard, row["chunk"], int(ends[shard + 1] - ends[shard]), pack_sorted(unique[own]), *[pack(c[own]) for c in counts]))
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["level", "shard", "chunk", "n", "keys", "kept", "gone"])

    return run


def ratio_bins(ratios: np.ndarray) -> np.ndarray:
    """Histogram bins of ratios above 0."""
    return np.floor(np.log2(ratios) * BINS).astype(np.int64)


NO_BIN = -(1 << 30)  # the bin of ratio 0


def _answers(table: pa.Table) -> pa.Table:
    """One shard: every chunk's entries with the counts over all chunks; for words, the histogram of kept counts too."""
    level, shard = table.column("level")[0].as_py(), table.column("shard")[0].as_py()
    chunks, sizes = table.column("chunk").to_pylist(), table.column("n").to_pylist()
    keys = np.concatenate([unpack_sorted(x.as_py(), n) for x, n in zip(table.column("keys"), sizes)])
    unique, at = np.unique(keys, return_inverse=True)
    totals = []
    for name in ("kept", "gone"):
        own = np.concatenate([unpack(x.as_py(), n) for x, n in zip(table.column(name), sizes)]).astype(np.int64)
        totals.append(np.bincount(at, own, len(unique)).astype(np.int64))  # exact below 2^53
    at = np.split(at, np.cumsum(sizes)[:-1])
    rows = [(c, level, shard, n, pack(totals[0][i]), pack(totals[1][i]), None, None, None, None) for c, n, i in zip(chunks, sizes, at)]
    if level == 1:
        bins = np.full(len(unique), NO_BIN)
        bins[totals[0] > 0] = ratio_bins(totals[0][totals[0] > 0])
        for b in np.unique(bins).tolist():
            mine = bins == b
            rows.append((None, level, shard, 0, None, None, b, int((totals[0] + totals[1] > 0)[mine].sum()), int(totals[0][mine].sum()), int(totals[1][mine].sum())))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["chunk", "level", "shard", "n", "kept", "gone", "bin", "types", "kept_tokens", "gone_tokens"])


def maximise(ratios: np.ndarray, weights: np.ndarray, rounds: int = 500) -> float:
    """Expectation-maximisation of one mixture weight from the ratios of both components' probabilities.

    One imagined token for either component keeps the weight inside (0, 1).
    """
    share = 0.5
    for _ in range(rounds):
        mixed = share * ratios
        new = (float((weights * (mixed / (mixed + 1 - share))).sum()) + 1) / (float(weights.sum()) + 2)
        if abs(new - share) < 1e-10:
            break
        share = new
    return new


def frequency_buckets(counts: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + floor(log2(count))."""
    return np.frexp(counts.astype(np.float64))[1]


class Model:
    """What the tasks need besides the counts: bounded by the number of frequency buckets."""

    def __init__(self, types: int, kept_tokens: int, gone_tokens: int, kept_texts: int, gone_texts: int):
        self.types, self.tokens, self.texts = types, (kept_tokens, gone_tokens), (kept_texts, gone_texts)
        self.weights: list[np.ndarray] = []  # by level: the weight of each frequency bucket

    def estimates(self, chunk: Chunk, counts: list[tuple[np.ndarray, np.ndarray]], whole: bool):
        """By level: (maximum-likelihood estimate, bucket) of every token, from kept counts or from all."""
        parts = 2 if whole else 1
        grams = [sum(c[:parts]) for c in counts]
        for level, gram in enumerate(grams):
            if level == 0:
                context = np.full(len(gram), sum(self.tokens[:parts]))
            else:
                context = np.empty(len(gram), np.int64)
                context[1:] = grams[level - 1][:-1]
                context[chunk.position == 0] = sum(self.texts[:parts])
            yield gram / np.maximum(context, 1), frequency_buckets(context)

    def probabilities(self, estimates) -> np.ndarray:
        p = None
        for (likely, bucket), weights in zip(estimates, self.weights):
            if p is None:
                p = np.full(len(likely), 1 / (self.types + 1))
            share = weights[np.minimum(bucket, len(weights) - 1)]
            p = share * likely + (1 - share) * p
        return p


def _counts_of(chunk: Chunk, answers: pa.Table, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By level: (kept, deleted) corpus counts of the gram that ends at each token."""
    out = []
    level, shard = (np.array(answers.column(c)) for c in ("level", "shard"))
    for k, keys in enumerate(chunk.keys(order), 1):
        mine = np.flatnonzero(level == k)
        mine = mine[np.argsort(shard[mine])].tolist()  # shards in the order of their keys
        at = np.unique(keys, return_inverse=True)[1]
        sizes = [answers.column("n")[i].as_py() for i in mine]
        out.append(tuple(np.concatenate([unpack(answers.column(c)[i].as_py(), n) for i, n in zip(mine, sizes)]).astype(np.int64)[at] for c in ("kept", "gone")))
    return out


def _ratios(model: Model, order: int):
    """Histogram (bucket, bin, n) of estimate / shorter model over the deleted documents, for the level after the model's last."""

    def run(key, chunks: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for row in chunks.to_pylist():
            chunk = Chunk(row)
            levels = list(model.estimates(chunk, _counts_of(chunk, answers, order), False))
            lower = model.probabilities(levels)
            likely, bucket = levels[len(model.weights)]
            bins = np.full(len(likely), NO_BIN)
            bins[likely > 0] = ratio_bins(likely[likely > 0] / lower[likely > 0])
            pairs, n = np.unique(np.stack([bucket, bins]), axis=1, return_counts=True)
            rows += zip(*pairs.tolist(), n.tolist())
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([], [], []), (pa.int32(), pa.int32(), pa.int64()))], names=["bucket", "bin", "n"])

    return run


def _scores(model: Model, order: int):
    def run(key, chunks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for row in chunks.to_pylist():
            chunk = Chunk(row)
            counts = _counts_of(chunk, answers, order)
            words = sum(counts[0])
            base = np.log10((words + 0.5) / (sum(model.tokens) + 0.5 * (model.types + 1)))
            own = np.log10(model.probabilities(model.estimates(chunk, counts, True)))
            sums = [np.add.reduceat(x, chunk.starts) for x in ((words > 0).astype(np.int64), base, own)]
            rows += zip(chunk.doc_ids, chunk.lengths.tolist(), *[x.tolist() for x in sums])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([],) * 5, kinds)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def _bucket_weights(histogram: list, top: int) -> np.ndarray:
    """The weight of every frequency bucket; bucket 0 (unseen contexts) has none, one without data that of the next lower."""
    weights = np.zeros(top + 1)
    by_bucket: dict[int, list] = {}
    for r in histogram:
        by_bucket.setdefault(r["bucket"], []).append((0.0 if r["bin"] == NO_BIN else 2.0 ** ((r["bin"] + 0.5) / BINS), r["n"]))
    for b in range(1, top + 1):
        weights[b] = maximise(*np.array(by_bucket[b], float).T) if b in by_bucket else weights[b - 1] or 0.5
    return weights


def train_and_score(docs: DataFrame, part: Column, order: int = ORDER) -> tuple[DataFrame, Model]:
    """(doc_id, n_tokens, n_known, base_score, score) of every row, and the model.

    ``part``: NOT_LEARNED, KEPT or DELETED for each document; ``order`` words make the longest n-gram.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.cast("int").alias("part"), F.col("text").cast("string").cast("binary").alias("text"))
    chunks = stage(map_arrow(rows, _chunks, CHUNKS), "lm-chunks")
    texts = chunks.select(F.explode(F.arrays_zip("parts", "lengths")).alias("x")).groupBy("x.parts").agg(F.count(F.lit(1)).alias("n"), F.sum("x.lengths").alias("tokens"))
    found = {r["parts"]: (r["n"], r["tokens"]) for r in texts.collect()}
    bits = max(0, (sum(t for _, t in found.values()) * order // SHARD_KEYS).bit_length())
    grams = map_arrow(chunks, _grams(order, bits), GRAMS)
    answers = stage(grams.groupBy("level", "shard").applyInArrow(_answers, ANSWERS), "lm-answers")

    words = answers.where("chunk is null").groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("types", "kept_tokens", "gone_tokens")]).collect()
    totals = [sum(r[c] for r in words) for c in ("types", "kept_tokens", "gone_tokens")]
    model = Model(*totals, *[found.get(p, (0, 0))[0] for p in (KEPT, DELETED)])
    top = 64
    # Level 1: the ratio of count / kept tokens to 1 / (V + 1), from the word counts themselves.
    bucket, scale = int(frequency_buckets(np.array([totals[1]]))[0]), (totals[0] + 1) / max(totals[1], 1)
    ratios = np.array([0.0 if r["bin"] == NO_BIN else 2.0 ** ((r["bin"] + 0.5) / BINS) * scale for r in words])
    share = maximise(ratios, np.array([r["gone_tokens"] for r in words], float)) if bucket else 0.0
    model.weights.append(np.where(np.arange(top + 1) > 0, share, 0.0))
    answered = answers.where("chunk is not null").select("chunk", "level", "shard", "n", "kept", "gone")
    for level in range(2, order + 1):
        met = chunks.where("deleted").groupBy("chunk").cogroup(answered.join(chunks.where("deleted").select("chunk"), "chunk", "left_semi").groupBy("chunk"))
        seen = met.applyInArrow(_ratios(model, level), "bucket int, bin int, n long").groupBy("bucket", "bin").agg(F.sum("n").alias("n"))
        model.weights.append(_bucket_weights(seen.collect(), top))
    met = chunks.groupBy("chunk").cogroup(answered.groupBy("chunk"))
    return met.applyInArrow(_scores(model, order), "doc_id long, n_tokens long, n_known long, base_score double, score double"), model


def lm_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The contract's scores: learned from documents whose crc32(doc_id) mod 5 is not 1; a tenth of these is the deleted part."""
    crc = F.crc32(F.col("doc_id").cast("long").cast("string"))
    learned = F.coalesce(crc % 5 != 1, F.lit(False))
    part = F.when(~learned, NOT_LEARNED).when(F.floor(crc / 5) % 10 == 0, DELETED).otherwise(KEPT)
    scores, model = train_and_score(docs, part, order)
    return scores.select("doc_id", F.coalesce(crc % 5 == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(sum(model.tokens)).cast("long").alias("train_tokens"), "base_score", "score")
