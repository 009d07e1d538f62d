"""Repeated passages: paragraph MinHash banding, exact Jaccard, one copy per cluster stays.

A text is cut into paragraphs: at every line end, and inside a line after one in sixteen
sentences, whose last characters hash to a multiple of 16. The cuts depend on the
neighbouring characters only. Paragraphs of at least ``MIN_WORDS`` words take part; sets
are their distinct five-word shingles with A-Z lower-cased.

Equal paragraphs collapse to one node by a 64-bit hash of their words. ``tune_bands``
picks the bands; nodes that share a band are candidates and links are confirmed by
exact Jaccard on the full sets (:mod:`logweave.llm.near_links`). Of each component the
occurrence with the smallest doc_id, then position, stays; the others are removals.

Runs find copies whatever stands around them. Of each ``WINDOW`` consecutive grams of
``RUN_WORDS`` words of a text, line ends being blanks, the one with the smallest hash is
taken (winnowing). ``LEAST`` = ``RUN_WORDS + WINDOW - 1`` = 50 equal words, in any two
places, thus have a gram that both places take, and the grams taken inside a longer copy
leave no word between them out. A place of a gram is only a repeat when ``LEAST`` equal
words around the gram stand in another place too: a gram carries one byte of the hash of
each of the ``WINDOW - 1`` words on either side, and its windows of ``LEAST`` words are
compared by these (a window that differs in one word passes with a chance of 1/256). Of
a gram's repeats the first place stays. A copy's outermost words, up to ``WINDOW - 1`` on
either side, may lie outside its grams and are then not removed.

Defined results: null and empty texts have no paragraphs. The same decisions hold for
rows equal in doc_id and text. A paragraph in a row without doc_id is removed when its
cluster has one with an id, but such rows' texts are not cut by ``remove_repeats``.
Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import BROADCAST_ROWS, GOLD, SHINGLE_WORDS, WordHashes, long_lists, longs, lower_words, map_arrow, mix, n_words, roll, sized, stage, steps, word_hashes
from logweave.llm.near_links import link_components
from logweave.plans.materialize import cleanup, written

PERCENT, MIN_WORDS, RECALL, MAX_BANDS = 75, 50, 0.99999, 14
BOUNDARY = re.compile(r"\n+|[.!?]+ +")
TAIL, CUT = 12, 16  # characters before a sentence end that decide whether it is a cut; one in CUT is
RUN_WORDS, WINDOW = 25, 26
HALVED_ROWS = 500_000  # keys from which on a broadcast goes in halves
LEAST, SIDE = RUN_WORDS + WINDOW - 1, WINDOW - 1  # words of the shortest run; words beside a gram that it carries
HALF = (SIDE + 1) // 2
#: Paragraphs have bands (empty where their task has banded an equal one), grams have ctx, lft and rgt.
FOUND = "doc_id long, mark long, start int, length int, n_words int, id long, bands array<long>, ctx binary, lft int, rgt int"
PLACE = ("doc_id", "mark", "start", "length")
OUT = ("doc_id", "mark", "start", "length", "n_words", "cluster_id", "keep_doc_id", "removed")


def tune_bands(similarity: float = PERCENT / 100, recall: float = RECALL, most: int = MAX_BANDS) -> tuple[int, int]:
    """(bands, rows): the most rows per band whose ``recall`` at ``similarity`` needs ``most`` bands at most."""
    for rows in range(8, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands <= most:
            return bands, rows
    return most, 1


def passages(text: str) -> list[tuple[int, int]]:
    """Consecutive spans that cover the text."""
    spans, start, sentence = [], 0, 0
    for m in BOUNDARY.finditer(text):
        end = m.end()
        if text[m.start()] == "\n" or not zlib.crc32(text[max(sentence, m.start() - TAIL) : m.start()].encode()) % CUT:
            spans.append((start, end))
            start = end
        sentence = end
    if start < len(text):
        spans.append((start, len(text)))
    return spans


class Words(NamedTuple):
    """The words of several texts one after the other."""

    ids: np.ndarray  # hashes
    begins: np.ndarray  # where they begin and end, in characters of the texts joined by one character
    ends: np.ndarray
    base: np.ndarray  # where each text begins there
    first: np.ndarray  # each text's first word, and the number of all


def _words_at(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets where the words of a text begin and end."""
    b = np.frombuffer(b" " + text + b" ", np.uint8)
    blank = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
    characters = np.cumsum((b & 0xC0) != 0x80) - 2  # the blank before the text is none of it
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    return characters[edge[::2]], characters[edge[1::2]]


def _words(texts: list[str], known: WordHashes) -> Words:
    raw = "\n".join(texts).encode()
    begins, ends = _words_at(raw)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(word_hashes(lower_words(raw), known), begins, ends, starts[:-1], np.searchsorted(begins, starts))


def _units(texts: list[str], words: Words, least: int):
    """Paragraphs of enough words: text number, start, end, number of words; and their words' hashes."""
    spans = np.array([(i, s, e) for i, t in enumerate(texts) for s, e in passages(t)], np.int64).reshape(-1, 3)
    lo, hi = (np.searchsorted(words.begins, words.base[spans[:, 0]] + spans[:, k]) for k in (1, 2))
    enough = hi - lo >= least
    spans, lo, counts = spans[enough], lo[enough], (hi - lo)[enough]
    at = np.arange(counts.sum()) + np.repeat(lo - (np.cumsum(counts) - counts), counts)
    return spans, counts, words.ids[at]


def _node_ids(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash of each passage's word sequence."""
    starts = np.cumsum(counts) - counts
    position = np.arange(len(ids)) - np.repeat(starts, counts)
    return mix(np.add.reduceat(mix(ids + position.astype(np.uint64) * GOLD), starts))


def _shingles(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all passages one after the other, and where each passage's begin."""
    ends = np.cumsum(counts)
    inside = np.ones(len(ids), bool)
    for k in range(1, SHINGLE_WORDS):
        inside[ends - k] = False
    kept = counts - SHINGLE_WORDS + 1
    return roll(ids, SHINGLE_WORDS)[inside[: len(ids) - SHINGLE_WORDS + 1]], np.cumsum(kept) - kept


def _band_keys(shingles: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(starts), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(starts), b + 1, np.uint64)
        for r in range(rows):
            seed = np.uint64((b * rows + r + 1) * int(GOLD) % 2**64)
            key = mix(key * GOLD + np.minimum.reduceat(mix(shingles ^ seed), starts))
        out[:, b] = key
    return out


def _chosen(ids: np.ndarray, counts: np.ndarray, these: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    these = np.array(these, bool)
    return ids[np.repeat(these, counts)], counts[these]


def _bytes(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _found(bands: int, rows: int, least: int, kinds: frozenset[str]):
    """One pass over (doc_id, mark, text): rows of ``FOUND``."""
    names = [c.split()[0] for c in FOUND.split(", ")]

    def paragraphs(texts, words, seen) -> tuple | None:
        spans, counts, ids = _units(texts, words, least)
        if not len(spans):
            return None
        nodes = _node_ids(ids, counts)
        new = []
        for node in nodes.tolist():  # a repeated paragraph is banded once a task
            new.append(node not in seen)
            seen.add(node)
        keys = iter(_band_keys(*_shingles(*_chosen(ids, counts, new)), bands, rows) if any(new) else ())
        none = np.empty(0, np.uint64)
        lists = long_lists([next(keys) if n else none for n in new])
        empty = [pa.nulls(len(spans), t) for t in (pa.binary(), pa.int32(), pa.int32())]
        return spans[:, 0], spans[:, 1], spans[:, 2], counts, nodes, lists, *empty

    def grams(texts, words, seen) -> tuple | None:
        counts = np.diff(words.first)
        at, hashes = run_starts(words.ids, counts)
        if not len(at):
            return None
        row = np.searchsorted(words.first, at, "right") - 1
        left, right = np.minimum(at - words.first[row], SIDE), np.minimum(words.first[row + 1] - at - RUN_WORDS, SIDE)
        step = np.concatenate([np.arange(-SIDE, 0), np.arange(SIDE)])
        beside = (words.ids >> np.uint64(56)).astype(np.uint8)[np.clip(at[:, None] + np.where(step < 0, step, step + RUN_WORDS), 0, len(words.ids) - 1)]
        beside[(step < -left[:, None]) | (step >= right[:, None])] = 0
        start, end = words.begins[at] - words.base[row], words.ends[at + RUN_WORDS - 1] - words.base[row]
        nulls = pa.nulls(len(at), pa.list_(pa.int64()))
        return row, start, end, np.full(len(at), RUN_WORDS), hashes, nulls, _bytes(beside), pa.array(left, pa.int32()), pa.array(right, pa.int32())

    def run(batches) -> Iterator[pa.RecordBatch]:
        known, seen = WordHashes(), set()  # seen: the paragraphs of this task's split
        makers = [f for name, f in (("passages", paragraphs), ("runs", grams)) if name in kinds]
        for batch in batches:
            docs, marks, texts = batch.column(0), batch.column(1), [t or "" for t in batch.column(2).to_pylist()]
            for lo, hi in steps([len(t) for t in texts]):
                words = _words(texts[lo:hi], known)
                for make in makers:
                    if made := make(texts[lo:hi], words, seen):
                        row, start, end, n, ids, *rest = made
                        at = pa.array(lo + row)
                        ints = [pa.array(x, pa.int32()) for x in (start, end - start, n)]
                        yield pa.record_batch([docs.take(at), marks.take(at), *ints, longs(ids), *rest], names=names)

    return run


def _sets(least: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            docs, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in steps([len(t) for t in texts]):
                spans, counts, ids = _units(texts[lo:hi], _words(texts[lo:hi], known), least)
                if not len(spans):
                    continue
                shingles, starts = _shingles(ids, counts)
                sets = [np.unique(x) for x in np.split(shingles, starts[1:])]
                yield pa.record_batch([docs.take(pa.array(lo + spans[:, 0])), longs(_node_ids(ids, counts)), long_lists(sets)], names=["doc_id", "id", "items"])

    return run


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def _read(docs: DataFrame, percent: int, min_words: int, *kinds: str) -> DataFrame:
    return stage(map_arrow(_marked(docs), _found(*tune_bands(percent / 100), min_words, frozenset(kinds)), FOUND), "found")


def repeated_passages(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Every occurrence of a paragraph that occurs more than once, exactly or nearly.

    doc_id, mark (xxhash64 of the text), start, length (characters), n_words,
    cluster_id, keep_doc_id (where the copy that stays is), removed. ``min_words``: five or more.
    """
    return _passage_rows(_read(docs, percent, min_words, "passages"), docs, percent, min_words)


def _passage_rows(found: DataFrame, docs: DataFrame, percent: int, min_words: int) -> DataFrame:
    found = found.where("bands is not null")
    occurrences = found.select(*PLACE, "n_words", "id")
    nodes = stage(found.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("min_doc")), "nodes")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = stage(nodes.join(sized(ids), "id", "left_semi").select("id", F.col("min_doc").alias("doc_id")), "wanted")
        holders = stage(wanted.where("doc_id is not null").select("doc_id").distinct(), "holders")
        plain = _marked(docs).select("doc_id", "text")
        sources = plain.join(sized(holders), "doc_id", "left_semi").union(plain.where("doc_id is null"))
        sets = map_arrow(sources, _sets(min_words), "doc_id long, id long, items array<long>").withColumnRenamed("doc_id", "d")
        own = sets.join(sized(wanted), "id").where(F.col("d").eqNullSafe(F.col("doc_id")))
        return own.groupBy("id").agg(F.first("items").alias("items"))

    bands = found.where(F.size("bands") > 0).select("id", "bands")
    _, comps = link_components(bands, sets_of, percent, bits=1024)
    labelled = nodes.join(sized(comps), "id", "left").where("n > 1 or comp is not null").select("id", F.coalesce("comp", "id").alias("cluster_id"), "n", "min_doc")
    labelled = stage(labelled, "clusters")
    keepers = labelled.groupBy("cluster_id").agg(F.sum("n").alias("n"), F.min("min_doc").alias("keep_doc_id")).where("n > 1")
    named = stage(labelled.select("id", "cluster_id").join(keepers.select("cluster_id", "keep_doc_id"), "cluster_id"), "keepers")
    rows = stage(occurrences.join(sized(named), "id"), "repeats")
    first = rows.where(F.col("doc_id").eqNullSafe(F.col("keep_doc_id"))).groupBy("cluster_id").agg(F.min("start").alias("keep_start"))
    first = stage(first, "first")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("start") == F.col("keep_start"))
    out = rows.join(sized(first), "cluster_id").withColumn("removed", ~stays)
    return out.select(*OUT)


def _sliding(f: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` over each ``width`` consecutive values."""
    n, done = len(x) - width + 1, 1
    if n <= 0:
        return x[:0]
    while 2 * done <= width:
        x, done = f(x[:-done], x[done:]), 2 * done
    return f(x[:n], x[width - done :][:n])


def run_starts(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers where the grams taken begin, and the grams' hashes; ``counts`` are words per text."""
    grams = roll(ids, RUN_WORDS)
    least = _sliding(np.minimum, grams, WINDOW)
    if not len(least):
        return np.empty(0, np.int64), grams[:0]
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(ids))  # words up to the text's end
    least[left[: len(least)] < RUN_WORDS + WINDOW - 1] = 0  # windows that reach into the next text
    around = np.zeros(len(grams) + WINDOW - 1, np.uint64)
    around[WINDOW - 1 :][: len(least)] = least
    at = np.flatnonzero((_sliding(np.maximum, around, WINDOW) == grams) & (grams > 0))
    return at, grams[at]


def _apart(low: str, high: str) -> Column:
    """The two places are in different texts or do not overlap; ``high`` is not before ``low``."""
    same = F.col(f"{high}doc_id").eqNullSafe(F.col(f"{low}doc_id")) & (F.col(f"{high}mark") == F.col(f"{low}mark"))
    return ~same | (F.col(f"{high}start") >= F.col(f"{low}start") + F.col(f"{low}length"))


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Every place of a gram taken that lies in ``LEAST`` words which stand in another place too; columns as of :func:`repeated_passages`.

    Places that overlap the one that stays are not repeats of it.
    """
    return _run_rows(_read(docs, PERCENT, MIN_WORDS, "runs"))


def _having(rows: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Staged: the rows with a hash ``key`` among the staged ``keys``; a large broadcast goes in halves, of which the driver holds one at a time."""
    n = keys.count()
    if not HALVED_ROWS < n <= BROADCAST_ROWS:
        return stage(rows.join(sized(keys, n), key, "left_semi"), name)
    low, high = (stage(rows.where(half).join(F.broadcast(keys.where(half)), key, "left_semi"), name) for half in (f"{key} < 0", f"{key} >= 0"))
    return low.unionByName(high)


def _with_open(rows: DataFrame, key: str) -> DataFrame:
    """Keys that several nodes share, one of them without a copy of its own."""
    counts = rows.groupBy(key).agg(F.min("node").alias("x"), F.max("node").alias("y"), F.bool_and("own").alias("own"))
    return counts.where("x <> y and not own").select(key)


def _run_rows(found: DataFrame, found_read: Callable[[], object] = lambda: None) -> DataFrame:
    """``found_read`` is called when ``found`` has been read for the last time."""
    spark, place = found.sparkSession, F.struct(F.col("doc_id").isNull().alias("unnamed"), *PLACE)
    node = F.xxhash64("id", "ctx", "lft", "rgt").alias("node")
    found = found.where(f"ctx is not null and lft + rgt >= {SIDE}")  # LEAST words around the gram are there
    ids = found.groupBy("id").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where(_apart("lo.", "hi.")).select("id")
    rows = _having(found.select(*PLACE, "id", "ctx", "lft", "rgt", node), stage(ids, "repeated-grams"), "id", "gram-places")
    found_read()

    # Equal surroundings are one node: a gram of exact copies has one, however many places it has.
    nodes = rows.groupBy("id", "node", "ctx", "lft", "rgt").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    nodes = stage(nodes.withColumn("own", _apart("lo.", "hi.")), "gram-nodes")
    since = written()
    mixed = nodes.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("own")).alias("open")).where("n > 1 and open > 0").select("id")
    mixed = _having(nodes.select("id", "node", "own", "ctx", "lft", "rgt"), stage(mixed, "mixed-grams"), "id", "mixed-nodes")

    # A window has HALF words before the gram or HALF behind it: only nodes that share such a half have windows to compare.
    halves = [(f"lft >= {HALF}", SIDE - HALF + 1), (f"rgt >= {HALF}", SIDE + 1)]
    keys = [F.when(F.expr(there), F.struct(F.lit(i).alias("half"), F.xxhash64("id", F.lit(i), F.expr(f"substring(ctx, {at}, {HALF})")).alias("key"))) for i, (there, at) in enumerate(halves)]
    sides = stage(mixed.withColumn("side", F.explode(F.array_compact(F.array(*keys)))).select("*", "side.*").drop("side"), "gram-sides")
    sides = sides.join(sized(stage(_with_open(sides, "key"), "shared-sides")), "key", "left_semi")
    counted = f"if(half = 0, sequence(greatest({HALF}, {SIDE} - rgt), lft), sequence({SIDE} - rgt, least({HALF - 1}, lft)))"
    part = F.expr(f"substring(ctx, {SIDE + 1} - k, {SIDE})")  # the window's words beside the gram, k of them before it
    windows = sides.withColumn("k", F.explode(F.expr(counted))).select("node", "own", F.xxhash64("id", "k", part).alias("window"))
    windows = stage(windows, "gram-windows")
    joined = windows.where("not own").join(sized(stage(_with_open(windows, "window"), "shared-windows")), "window", "left_semi").select("node")
    again = stage(nodes.where("own").select("node").union(joined).distinct(), "run-nodes")
    cleanup(spark, since, written() - 1)  # what led to these nodes

    kept = _having(nodes.select("id", "node", "lo", "hi"), again, "node", "kept-nodes").groupBy("id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where(_apart("lo.", "hi."))
    kept = kept.select("id", *[F.col(f"lo.{c}").alias(f"keep_{c}") for c in PLACE])
    out = _having(rows.drop("ctx", "lft", "rgt"), again, "node", "run-places").join(sized(stage(kept, "run-keepers")), "id")
    out = out.withColumn("removed", _apart("keep_", "")).withColumn("n_words", F.lit(RUN_WORDS)).withColumnRenamed("id", "cluster_id")
    stays = ~F.col("removed") & (F.col("start") == F.col("keep_start"))
    return out.where(F.col("removed") | stays).select(*OUT)


def repeated_text(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """:func:`repeated_passages` and :func:`repeated_runs` from one pass over the texts; their spans may overlap."""
    spark, since = docs.sparkSession, written()
    found = _read(docs, percent, min_words, "passages", "runs")
    passages = stage(_passage_rows(found, docs, percent, min_words), "passage-rows")  # apart from the runs, so that the driver does not hold both's broadcasts
    cleanup(spark, since + 1, written() - 1)  # what led to the passages
    return passages.unionByName(_run_rows(found, lambda: cleanup(spark, since, since + 1)))


def _merged(batches):
    """Sorted spans as spans that do not meet."""
    for batch in batches:
        out = []
        for spans in batch.column(2).to_pylist():
            own: list[dict] = []
            for s in spans:
                if own and s["start"] <= (end := own[-1]["start"] + own[-1]["length"]):
                    own[-1]["length"] += max(0, s["start"] + s["length"] - end)
                else:
                    own.append(s)
            out.append(own)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, batch.column(2).type)], names=["_id", "_mark", "_spans"])


def remove_repeats(docs: DataFrame, repeats: Callable[[DataFrame], DataFrame] = repeated_text) -> DataFrame:
    """``docs`` without the removed paragraphs and runs, or what else ``repeats`` says; all columns stay, n_chars follows the text.

    A document that loses all its words goes.
    """
    gone = repeats(docs).where("removed and doc_id is not null").select("doc_id", "mark", "start", "length").distinct()
    spans = gone.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("_spans"))
    spans = stage(map_arrow(spans, _merged, "_id long, _mark long, _spans array<struct<start: int, length: int>>"), "spans")
    rows = docs.join(spans, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_mark")), "left")
    # The text between the spans: from the end of span i - 1 to the start of span i.
    begin = "if(i = 0, 0, get(_spans, i - 1).start + get(_spans, i - 1).length)"
    left = F.expr(f"array_join(transform(sequence(0, size(_spans)), i -> substring(text, {begin} + 1, coalesce(get(_spans, i).start, length(text)) - {begin})), '')")
    out = rows.withColumn("text", F.when(F.col("_id").isNull(), F.col("text")).otherwise(left)).where(F.col("_id").isNull() | (n_words("text") > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_id").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
