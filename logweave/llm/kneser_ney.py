"""Quality classifier: interpolated modified Kneser-Ney word n-grams, perplexity, quantile thresholds.

Words (A-Z lower-cased) and the end of a text are predicted from up to two words before;
a text's start counts as a word before. One model per language is trained on its trusted
documents; languages with fewer than ``MIN_TRUSTED`` learned documents use one that is
trained on all trusted text. One in ``HELD`` trusted documents, by a hash of its id, is
held out: not learned from, it gives the thresholds.

1. Chunks: the texts of one model are written once, about ``CHUNK_TOKENS`` words a chunk, as word
   hashes and word numbers, in buckets by chunk, so that later steps need not shuffle them.
2. Counts, longest grams first: a chunk sends each of its different grams once, with what
   its learned texts add, to the shard of the gram's hash. A shard sums and answers every
   chunk in the order it sent its grams, and names one of them the gram's owner. Owners
   send on what the gram gives to shorter ones: a left neighbour to the gram without its first word
   (continuation counts), and its count to the gram without its last word (a context's total
   and its numbers of grams with counts 1, 2 and more). Grams at a text's start keep raw counts, as they have no left side.
   Frequent grams are one entry a chunk; shards grow in number, not in size, with the corpus.
   The shards of each half of the hashes are asked one after the other.
3. Scores: discounts come from the counts of counts per model and order, a few numbers.
   A chunk meets its grams' answers and sums the log probabilities of each document.
4. Thresholds: per language, from a histogram sketch of the held-out documents'
   perplexities: the upper end of the bucket that holds the ``HIGH_PERMILLE`` quantile.
   A document above it is not kept.

Grams are known by ``SPARE_BITS`` more bits of their hashes than the number of words has: at most one in
2^``SPARE_BITS`` unseen grams is taken for a seen one.

Defined results: a document without words has perplexity null and is not kept. Null
language counts as a language of its own. A language with fewer than ``MIN_TRUSTED`` held-out
documents takes the threshold of all of them; without any, learned documents give it. Without
any trusted text perplexity is 1, as no word is known, and nothing is kept. Rows are scored one by
one; trusted ids may repeat or be unknown. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import GOLD, M2, WordHashes, map_arrow, mix, sized, stage, word_hashes
from logweave.llm.interpolated_lm import pack, pack_sorted, unpack, unpack_sorted
from logweave.plans.materialize import write_table

ORDER = 3
MIN_TRUSTED, HELD = 20, 5
HIGH_PERMILLE = 995
CHUNK_TOKENS = 2_000_000  # bounds a task's memory (a longer text is a chunk by itself)
HELD_TOKENS = 4_000_000  # of all models together, before a task writes the largest chunk
SHARD_KEYS = 2_000_000  # about so many entries of chunks meet in one shard
STEP_PLACES = 250_000  # scored at a time
SPARE_BITS, LEAST_BITS = 18, 40
WORD_BITS = 48  # of a word's hash, in chunks
ALL = "*"  # the model of all languages; other models are named "=" + language
START, END = np.uint64(0x93D2_0B7E_58A5), np.uint64(0x27E8_F160_9C0B)  # hashes of a text's start and end
NOT_LEARNED, LEARNED, HELD_OUT, COPY = 0, 1, 2, 3  # COPY: learned by the model of all languages, scored elsewhere
CHUNKS = "chunk long, model string, doc_ids array<long>, langs array<string>, parts array<int>, lengths array<int>, words binary, tokens binary"
ASKED = "shard int, chunk long, model string, n int, keys binary, counts binary"
ANSWERS = "level int, shard int, chunk long, model string, n int, counts binary, n1 long, n2 long, n3 long, n4 long, types long, total long"
SCORES = "doc_id long, lang string, part int, n_symbols long, logp double"
TOP, LOWER = 1, 5  # counts sent with a gram of ORDER words; with a shorter one, its count and its total, ones, twos and others as a context


def pack_counts(counts: np.ndarray) -> bytes:
    """Rows of counts; several rows as numbers of their different columns, small ones for frequent columns, and these."""
    if len(counts) == 1:
        return pack(counts[0])
    mark = np.zeros(counts.shape[1], np.uint64)
    for row in counts:
        mark = mark * GOLD + row.astype(np.uint64)
    _, at, n = np.unique(mark, return_inverse=True, return_counts=True)
    one = np.empty(len(n), np.int64)
    one[at] = np.arange(len(at))
    frequent = np.argsort(-n, kind="stable")
    number = np.empty(len(n), np.int64)
    number[frequent] = np.arange(len(n))
    numbers = pack(number[at])
    return struct.pack("<qq", len(n), len(numbers)) + numbers + pack(counts[:, one[frequent]].ravel())


def unpack_counts(data: bytes, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The different columns, and the number of each entry's column: far smaller than all columns. A single row is left as it is."""
    if rows == 1:
        return unpack(data, n).astype(np.int64)[None], np.arange(n, dtype=np.int32)
    different, end = struct.unpack_from("<qq", data)
    numbers = unpack(data[16 : 16 + end], n).astype(np.int32)
    return unpack(data[16 + end :], rows * different).reshape(rows, different).astype(np.int64), numbers


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in order, the number of each entry's key, and an entry of each key."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.empty(len(keys), np.int32)
    at[order] = np.cumsum(first, dtype=np.int32) - 1
    return ordered[first], at, order[first]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _chunks(batches):
    """(doc_id, lang, part, model, text) -> chunks, each of one model."""
    from pyspark import TaskContext

    known, held, sizes = WordHashes(), {}, Counter()
    made = 0

    def out(model: str) -> pa.RecordBatch:
        nonlocal made
        rows, _ = held.pop(model), sizes.pop(model)
        words, at, n = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True, return_counts=True)
        frequent = np.argsort(-n, kind="stable")  # small numbers for frequent words
        number = np.empty(len(words), np.int64)
        number[frequent] = np.arange(len(words))
        made += 1
        return pa.record_batch([
            pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()), pa.array([model], pa.string()),
            pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[1] for r in rows]], pa.list_(pa.string())),
            pa.array([[r[2] for r in rows]], pa.list_(pa.int32())), pa.array([[len(r[3]) for r in rows]], pa.list_(pa.int32())),
            pa.array([pack(words[frequent])], pa.binary()), pa.array([pack(number[at])], pa.binary()),
        ], names=_names(CHUNKS))

    for batch in batches:
        for *doc, model, text in zip(*[batch.column(i).to_pylist() for i in range(4)], batch.column(4)):
            words = (text.as_py() or b"").lower().split()  # lower() touches A-Z only; split() is at 0x20 and 0x09-0x0D
            ids = np.concatenate([[START], word_hashes(words, known) >> np.uint64(64 - WORD_BITS), [END]]) if words else np.empty(0, np.uint64)
            if held.get(model) and sizes[model] + len(ids) > CHUNK_TOKENS:
                yield out(model)
            elif sizes.total() + len(ids) > HELD_TOKENS and held:
                yield out(max(held, key=sizes.__getitem__))
            held.setdefault(model, []).append((*doc, ids))
            sizes[model] += len(ids)
    for model in list(held):
        yield out(model)


def _written_chunks(chunks: DataFrame) -> DataFrame:
    """The chunks as a table bucketed by chunk, as many buckets as shuffles have partitions."""
    spark = chunks.sparkSession
    name = f"kn_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_table(chunks, "llm-kn-chunks", lambda writer, path: writer.bucketBy(buckets, "chunk").option("path", path).saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay until cleanup; what is read is known by now
    return table


class Keys:
    """How grams' hashes are cut and dealt to shards."""

    def __init__(self, tokens: int):
        self.width = min(64, max(LEAST_BITS, tokens.bit_length() + SPARE_BITS))
        self.bits = (tokens // SHARD_KEYS).bit_length()

    def halves(self) -> list[int | None]:
        """The halves of the hashes, asked for one after the other, so that only one half's questions lie on the disk; a single shard is asked at once."""
        return [0, 1] if self.bits else [None]

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.width)

    def ends(self, keys: np.ndarray) -> np.ndarray:
        """Where the shards (upper bits) of sorted keys begin, and the end."""
        firsts = np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(self.width - self.bits)
        return np.concatenate([[0], np.searchsorted(keys, firsts), [len(keys)]]).astype(np.int64)


class Grams:
    """The different grams of one length in a chunk, by key."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray, keys: Keys):
        self.places = places  # where the grams end
        self.keys, at, one = _numbered(keys.cut(hashes[places]))
        self.at = np.full(len(hashes), -1, np.int32)  # the number of the gram that ends at each place
        self.at[places] = at
        self.one = places[one]  # a place of each


class Chunk:
    """The words of a chunk's documents, each with its start and end."""

    def __init__(self, row: dict, keys: Keys):
        self.chunk, self.model, self.doc_ids, self.langs, self.parts = (row[c] for c in ("chunk", "model", "doc_ids", "langs", "parts"))
        self.lengths = np.array(row["lengths"], np.int64)
        tokens = unpack(row["tokens"], int(self.lengths.sum())).astype(np.int32)
        self._words = unpack(row["words"], int(tokens.max(initial=-1)) + 1)[tokens] ^ np.uint64(xxhash.xxh3_64_intdigest(self.model))
        self.owner = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.position = np.arange(len(tokens), dtype=np.int32) - np.repeat((np.cumsum(self.lengths) - self.lengths).astype(np.int32), self.lengths)
        self.learned = np.isin(self.parts, (LEARNED, COPY))[self.owner]
        self._keys = keys

    def grams(self, level: int, half: int | None = None) -> Grams:
        """Hashes are made again for each length, as holding them costs more memory than time."""
        hashes = mix(self._words)
        for back in range(1, level):
            before = np.zeros_like(hashes)
            before[back:] = self._words[:-back]
            hashes = mix(hashes * GOLD + before * M2)
        there = self.position >= level - 1
        if half is not None:
            there &= hashes >> np.uint64(63) == half
        return Grams(hashes, np.flatnonzero(there).astype(np.int32), self._keys)


def _answered(answers: pa.Table, level: int) -> tuple[np.ndarray, np.ndarray]:
    """What the shards answered to a chunk's sorted grams of a length: different columns of owned (0 or 1) and the counts, and each gram's column."""
    mine = np.flatnonzero(np.array(answers.column("level")) == level)
    mine = mine[np.argsort(np.array(answers.column("shard"))[mine])].tolist()  # shards in the order of their keys
    width, n = TOP if level == ORDER else LOWER, 0
    columns, numbers = [np.empty((width, 0), np.int64)], [np.empty(0, np.int32)]
    for i in mine:
        different, at = unpack_counts(answers.column("counts")[i].as_py(), width, answers.column("n")[i].as_py())
        columns.append(different)
        numbers.append(at + np.int32(n))
        n += different.shape[1]
    counts = np.concatenate(columns, axis=1)
    return np.concatenate([counts[:1] & 1, counts[:1] >> 1, counts[1:]]), np.concatenate(numbers)


def _added(chunk: Chunk, level: int, answers: pa.Table | None, half: int | None) -> tuple[Grams, np.ndarray]:
    """A chunk's grams of a length, those of a half if asked for, and what it adds to their counts."""
    longer = None
    if level < ORDER:
        columns, number = _answered(answers, level + 1)
        gives = ((columns[0] > 0) & (columns[1] > 0))[number]
        longer, count = chunk.grams(level + 1).one[gives], columns[1][number[gives]]
    grams = chunk.grams(level, half)
    n, places = len(grams.keys), grams.places
    raw = chunk.learned[places] if level == ORDER else chunk.learned[places] & (chunk.position[places] == level - 1) & (level > 1)
    counts = [np.bincount(grams.at[places[raw]], minlength=n)]
    if longer is not None:
        shorter, context = grams.at[longer], grams.at[longer - 1]
        counts[0] = counts[0] + np.bincount(shorter[shorter >= 0], minlength=n)
        context, count = context[context >= 0], count[context >= 0]
        counts.append(np.bincount(context, count, n).astype(np.int64))  # exact below 2^53
        counts += [np.bincount(context[own], minlength=n) for own in (count == 1, count == 2, count > 2)]
    return grams, np.stack(counts)


def _asked(keys: Keys, level: int, half: int | None):
    def rows(chunk: Chunk, answers: pa.Table | None) -> pa.Table:
        grams, counts = _added(chunk, level, answers, half)
        ends = keys.ends(grams.keys)
        out = []
        for shard in np.flatnonzero(np.diff(ends)).tolist():
            own = slice(ends[shard], ends[shard + 1])
            out.append((shard, chunk.chunk, chunk.model, int(ends[shard + 1] - ends[shard]), pack_sorted(grams.keys[own]), pack_counts(counts[:, own])))
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out) if out else ([],) * 6, kinds)], names=_names(ASKED))

    def alone(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from rows(Chunk(batch.slice(i, 1).to_pylist()[0], keys), None).to_batches()

    def answered(key, chunks: pa.Table, answers: pa.Table) -> pa.Table:
        tables = [rows(Chunk(row, keys), answers) for row in chunks.to_pylist()]
        return pa.concat_tables(tables)

    return alone if level == ORDER else answered


def _answers(level: int):
    """One shard: every chunk's entries with the sums over all chunks, and the counts of counts by model."""
    width = TOP if level == ORDER else LOWER

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        chunks, names, sizes = (table.column(c).to_pylist() for c in ("chunk", "model", "n"))
        keys = np.concatenate([unpack_sorted(x.as_py(), n) for x, n in zip(table.column("keys"), sizes)])
        unique, at, one = _numbered(keys)
        owned = np.zeros(len(keys), bool)
        owned[one] = True  # the entry of each gram whose chunk owns it
        parts = [unpack_counts(x.as_py(), width, n) for x, n in zip(table.column("counts"), sizes)]
        sums = np.stack([np.bincount(at, np.concatenate([x[i][own] for x, own in parts]), len(unique)).astype(np.int64) for i in range(width)])

        def answer(own: slice) -> bytes:
            counts = sums[:, at[own]]
            counts[0] = 2 * counts[0] + owned[own]  # the last bit: owned
            return pack_counts(counts)

        ends = np.cumsum(sizes).tolist()
        rows = [(level, shard, c, None, n, answer(slice(e - n, e)), *[None] * 6) for c, n, e in zip(chunks, sizes, ends)]
        models, code = np.unique(names, return_inverse=True)
        of, count = np.repeat(code, sizes)[one], sums[0]
        kinds_of = [*[count == i for i in (1, 2, 3, 4)], count > 0]
        by = [np.bincount(of[k], minlength=len(models)) for k in kinds_of] + [np.bincount(of, count, len(models)).astype(np.int64)]
        rows += [(level, shard, None, str(m), 0, None, *x) for m, x in zip(models, zip(*[b.tolist() for b in by]))]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.binary(), *[pa.int64()] * 6)
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=_names(ANSWERS))

    return run


class Order:
    """One order of a model: discounts, and the empty context's numbers of grams."""

    def __init__(self, n1: int = 0, n2: int = 0, n3: int = 0, n4: int = 0, types: int = 0, total: int = 0):
        coc = (n1, n2, n3, n4)
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        d = [i - (i + 1) * y * coc[i] / coc[i - 1] if coc[i - 1] and n1 else i * 0.5 for i in (1, 2, 3)]
        self.discounts = np.array([0.0, *[max(0.05, min(i - 0.05, x)) for i, x in enumerate(d, 1)]])
        self.types, self.whole = types, (total, n1, n2, types - n1 - n2)


def _probabilities(chunk: Chunk, answers: pa.Table, orders: list[Order]) -> np.ndarray:
    """The probability of every word and end; 1 at the starts."""
    p = np.where(chunk.position > 0, 1 / (orders[0].types + 1), 1.0)
    shorter = None
    for level, order in enumerate(orders, 1):
        grams, (columns, number) = chunk.grams(level), _answered(answers, level)
        places, d = grams.places[chunk.position[grams.places] > 0], order.discounts
        for lo in range(0, len(places), STEP_PLACES):
            own = places[lo : lo + STEP_PLACES]
            if shorter is None:
                total, *n = order.whole
            else:
                context = shorter[2][shorter[0].at[own - 1]]
                total, *n = (x[context] for x in shorter[1][2:])
            count = columns[1][number[grams.at[own]]]
            cut = sum(x * y for x, y in zip(n, d[1:]))
            longer = (count - d[np.minimum(count, 3)] + cut * p[own]) / np.maximum(total, 1)
            p[own] = np.where(np.greater(total, 0), longer, p[own])
        shorter = grams, columns, number
    return p


def _scored(keys: Keys, models: dict[str, list[Order]]):
    def run(key, chunks: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for row in chunks.to_pylist():
            chunk = Chunk(row, keys)
            logs = np.log(_probabilities(chunk, answers, models.get(chunk.model) or [Order()] * ORDER))
            sums = np.bincount(chunk.owner, logs, len(chunk.lengths))
            symbols = np.maximum(chunk.lengths - 1, 0)
            rows += [x for x in zip(chunk.doc_ids, chunk.langs, chunk.parts, symbols.tolist(), sums.tolist()) if x[2] != COPY]
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64())
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([],) * 5, kinds)], names=_names(SCORES))

    return run


def scored(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, lang, part, n_symbols, logp) per row of ``docs`` (doc_id, lang, text)."""
    held = F.crc32(F.col("doc_id").cast("string")) % HELD == 0
    part = F.when(F.col("_t").isNull(), NOT_LEARNED).when(held, HELD_OUT).otherwise(LEARNED)
    texts = docs.join(sized(trusted), "doc_id", "left").withColumn("part", part)
    counts = texts.groupBy("lang").agg(F.count_if(F.col("part") == LEARNED).alias("n")).collect()  # a row a language
    own = ["=" + (r["lang"] if r["lang"] is not None else "\x00") for r in counts if r["n"] >= MIN_TRUSTED]
    name = F.concat(F.lit("="), F.coalesce("lang", F.lit("\x00")))
    rows = texts.select("doc_id", "lang", "part", F.when(name.isin(own), name).otherwise(F.lit(ALL)).alias("model"), F.col("text").cast("binary").alias("text"))
    if len(own) < len(counts):
        copies = rows.where((F.col("part") == LEARNED) & (F.col("model") != ALL))
        rows = rows.union(copies.withColumn("part", F.lit(COPY)).withColumn("model", F.lit(ALL)))
    chunks = _written_chunks(map_arrow(rows, _chunks, CHUNKS))
    keys = Keys(chunks.select(F.sum(F.expr("aggregate(lengths, 0L, (n, x) -> n + x)"))).first()[0] or 0)

    answers = None
    tables = []
    for level in range(ORDER, 0, -1):
        halves = []
        for half in keys.halves():
            if answers is None:
                asked = map_arrow(chunks, _asked(keys, level, half), ASKED)
            else:
                asked = chunks.groupBy("chunk").cogroup(answers.where("chunk is not null").groupBy("chunk")).applyInArrow(_asked(keys, level, half), ASKED)
            halves.append(stage(asked.groupBy("shard").applyInArrow(_answers(level), ANSWERS), f"kn-answers-{level}"))
        answers = reduce(DataFrame.union, halves)
        tables.append(answers)
    answers = reduce(DataFrame.union, tables)
    numbers = answers.where("chunk is null").groupBy("model", "level").agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "types", "total")])
    models: dict[str, list[Order]] = {}
    for model, level, *n in numbers.collect():  # a row a language and order
        models.setdefault(model, [Order()] * ORDER)[level - 1] = Order(*n)
    met = chunks.groupBy("chunk").cogroup(answers.where("chunk is not null").groupBy("chunk"))
    return met.applyInArrow(_scored(keys, models), SCORES)


def thresholds(scores: DataFrame) -> DataFrame:
    """(lang, threshold) from the held-out documents; a language with too few takes all languages'."""
    cents = F.floor(F.col("perplexity") * 100).cast("long")
    drop = "greatest(length(bin(v)) - 8, 0)"
    sketch = scores.where(F.col("part").isin(LEARNED, HELD_OUT) & F.col("perplexity").isNotNull()).select("lang", (F.col("part") == HELD_OUT).alias("held"), cents.alias("v"))
    sketch = sketch.select("lang", "held", F.expr(f"shiftleft(shiftright(v, {drop}), {drop})").alias("v")).groupBy("lang", "held", "v").agg(F.count(F.lit(1)).alias("n"))

    def limits(rows: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by)  # one row per bucket
        cum = rows.withColumn("upto", F.sum("n").over(w.orderBy("v"))).withColumn("all", F.sum("n").over(w))

        high = F.min(F.when(F.col("upto") * 1000 >= F.col("all") * HIGH_PERMILLE, F.col("v")))
        q = cum.groupBy(*by).agg(high.alias("v"), F.max("all").alias("docs"))
        return q.select(*by, (F.expr(f"v + shiftleft(1L, {drop})") / 100).alias("threshold"), "docs")

    sketch = stage(sketch, "perplexities")
    either = limits(sketch.groupBy("held", "v").agg(F.sum("n").alias("n")), ["held"])
    whole = either.agg(F.coalesce(F.max(F.when(F.col("held"), F.col("threshold"))), F.max("threshold")).alias("whole"))
    langs = scores.select("lang").distinct()
    own = limits(sketch.where("held"), ["lang"]).where(F.col("docs") >= MIN_TRUSTED).select(F.col("lang").alias("_lang"), "threshold")
    joined = langs.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").join(whole, F.lit(True), "left")
    return joined.select(F.col("lang").alias("_lang"), F.coalesce("threshold", "whole").alias("threshold"))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, lang, text): doc_id, n_symbols (words and the end), perplexity, threshold, kept.

    ``trusted``: doc_id of the documents that the model is trained on, but for the held-out ones.
    """
    trusted = stage(trusted.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("_t", F.lit(True)), "trusted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    value = F.when(F.col("n_symbols") > 0, F.exp(-F.col("logp") / F.col("n_symbols")))
    scores = stage(scored(texts, trusted).withColumn("perplexity", value), "scores")
    limits = stage(thresholds(scores), "limits")
    out = scores.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    return out.select("doc_id", "n_symbols", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))
