"""Periodic runs of words, from branching tandem repeats of an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbour extends; it is
reported from ``MIN_LENGTH`` words and ``MIN_POWER`` periods on. Documents are worked on
one batch at a time inside each task; nothing is shuffled. Words of different documents
are different symbols, so that one array serves a whole batch of documents.

1. A run's words stand again one period further on: documents in which no five words
   (``MIN_LENGTH`` less the longest period of such a run) are repeated need no array.
2. Suffix array by prefix doubling that only sorts suffixes that are still tied; the
   LCP array from its irreducible values, compared word by word, and the rule
   ``plcp[i] = plcp[i - 1] - 1`` for all others.
3. Each LCP value belongs to the interval between the nearest smaller values on either
   side; the boundaries with equal value in it separate its children. For each suffix i
   of all children but the largest, at depth d, ``ISA[i + d]`` and ``ISA[i - d]`` are
   looked up in the interval: a hit is a square of period d, and a branching one if the
   word after the first half differs from the word after the second. No tree is built.
4. Branching squares end where their runs end. Per end the smallest period is rotated to
   the left as far as words agree; squares of its multiples inside that run are the
   same run and merge with it. Rounds go on with the next period of each end.

Defined results: null and empty texts have no runs and empty collapsed text. Every row is
worked on by itself, so repeated rows repeat their result; a null doc_id stays null.
Texts of any length are whole; memory grows with the longest single text.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow, mix, roll

MIN_LENGTH, MIN_POWER = 6, 4
STEP_WORDS = 400_000  # words of documents that share one array (a longer text has one of its own)
PART = 1 << 20  # suffixes of smaller children, and words of galloping comparisons, at a time
RUN = "struct<start: long, length: long, period: long>"
RUNS = f"doc_id long, n_words long, runs array<{RUN}>, top {RUN}, collapsed string"


class Numbers(dict):
    """word -> number, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def repeats_a_gram(ids: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Documents in which a gram of ``width`` words stands twice (equal hashes count as equal)."""
    grams = roll(ids.astype(np.uint64) + np.uint64(1), width)
    if not len(grams):
        return np.empty(0, doc.dtype)
    inside = doc[: len(grams)] == doc[width - 1 :]
    own = doc[: len(grams)][inside]
    keys = mix(grams[inside] ^ mix(own.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    again = keys[order[1:]] == keys[order[:-1]]
    return np.unique(own[order[1:][again]])


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, its inverse) of the symbols ``s``, by prefix doubling over tied suffixes."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    starts = np.concatenate([[True], s[sa[1:]] != s[sa[:-1]]])
    rank = np.empty(n + 1, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank[n] = -1
    at = np.arange(n)  # places of suffixes that are still tied
    h = 1
    while True:
        tied = ~(starts & np.concatenate([starts[1:], [True]]))
        at, starts = at[tied], starts[tied]
        if not len(at):
            return sa, rank[:n]
        mine = sa[at]
        key = rank[mine] * (n + 1) + rank[np.minimum(mine + h, n)] + 1
        order = np.argsort(key)
        mine, key = mine[order], key[order]
        sa[at] = mine
        starts = np.concatenate([[True], key[1:] != key[:-1]])
        rank[mine] = np.maximum.accumulate(np.where(starts, at, 0))
        h *= 2


def _agree(s: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on, to the right (step 1) or to the left (step -1)."""
    n = len(s)
    out = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    width = 1
    while len(active):
        width = max(1, min(width, PART // len(active)))
        x = a[active, None] + step * (out[active, None] + np.arange(width))
        y = b[active, None] + step * (out[active, None] + np.arange(width))
        inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < n)
        same = inside & (s[np.clip(x, 0, n - 1)] == s[np.clip(y, 0, n - 1)])
        good = np.where(same.all(1), width, same.argmin(1))
        out[active] += good
        active = active[good == width]
        width *= 2
    return out


def lcp_array(s: np.ndarray, sa: np.ndarray, isa: np.ndarray) -> np.ndarray:
    """lcp[k]: words that suffixes sa[k - 1] and sa[k] share (lcp[0] = 0)."""
    n = len(s)
    phi = np.full(n, -1)
    phi[sa[1:]] = sa[:-1]
    reducible = np.zeros(n, bool)
    at = np.arange(1, n)
    reducible[1:] = (phi[1:] > 0) & (s[at - 1] == s[np.maximum(phi[1:], 1) - 1])
    reducible[1:] &= phi[:-1] >= 0  # else the suffix before has no value to go by
    whole = np.flatnonzero(~reducible & (phi >= 0))
    plcp = np.zeros(n, np.int64)
    plcp[whole] = _agree(s, whole, phi[whole], 1)
    last = np.maximum.accumulate(np.where(reducible, 0, np.arange(n)))
    plcp = plcp[last] - (np.arange(n) - last)
    return plcp[sa]


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place of a value above 0, the nearest place before it with a smaller one (-1: none), by pointer jumps."""
    padded = np.concatenate([values, [-1]])  # place -1 is the last one: smaller than all
    near = np.arange(len(values)) - 1
    active = np.flatnonzero((values > 0) & (padded[near] >= values))
    while len(active):
        near[active] = near[near[active]]
        active = active[padded[near[active]] >= values[active]]
    return near


def smaller_children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """(from, to, depth, first, last) of every child interval but the largest of its parent.

    Children are ``from``..``to``-1, parents ``first``..``last``, all places of the suffix array.
    """
    n = len(lcp)
    before = _nearest_smaller(lcp)
    after = n - 1 - _nearest_smaller(lcp[::-1])[::-1]
    k = np.flatnonzero(lcp > 0)
    if not len(k):
        return k, k, k, k, k
    first, last = before[k], after[k] - 1
    order = np.argsort(first * np.int64(n + 1) + last, kind="stable")
    k, first, last = k[order], first[order], last[order]
    opens = np.concatenate([[True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])])
    heads = np.flatnonzero(opens)
    # Each interval: a first child that begins at ``first`` and one child per boundary.
    lo = np.insert(k, heads, first[heads])
    group = np.insert(np.cumsum(opens) - 1, heads, np.arange(len(heads)))
    begins = heads + np.arange(len(heads))
    hi = np.append(lo[1:], 0)
    ends = np.append(begins[1:], len(lo)) - 1
    hi[ends] = last[heads] + 1
    size = hi - lo
    top = np.flatnonzero(size == np.maximum.reduceat(size, begins)[group])
    keep = np.ones(len(lo), bool)
    keep[top[np.concatenate([[True], group[top][1:] != group[top][:-1]])]] = False
    lo, hi, parent = lo[keep], hi[keep], heads[group[keep]]
    return lo, hi, lcp[k][parent], first[parent], last[parent]


def branching_squares(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of every branching tandem repeat of ``s``, sorted and distinct."""
    n = len(s)
    sa, isa = suffix_array(s)
    lo, hi, depth, first, last = smaller_children(lcp_array(s, sa, isa))
    after = np.append(s, -1)  # the word after the last differs from every word
    sizes = np.cumsum(hi - lo)
    found = []
    at = 0
    while at < len(lo):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PART, "right")))
        count = hi[at:end] - lo[at:end]
        row = np.repeat(np.arange(at, end), count)
        i = sa[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[row]]
        d, f, t = depth[row], first[row], last[row]
        for left in (i, i - d):  # the square's first half begins at i, or its second half does
            right = left + d
            other = np.where(left == i, right, left)
            inside = (left >= 0) & (right < n)
            place = isa[np.clip(other, 0, n - 1)]
            hit = inside & (place >= f) & (place <= t)
            hit[hit] = after[np.minimum(right[hit] + d[hit], n)] != after[right[hit]]
            found.append(np.stack([right[hit] + d[hit], d[hit]], 1))
        at = end
    squares = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
    return squares[:, 0], squares[:, 1]


def runs_of(s: np.ndarray, length: int = MIN_LENGTH, power: int = MIN_POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``s`` of at least ``length`` words and ``power`` periods, sorted."""
    end, period = branching_squares(s)
    out = []
    while len(end):
        smallest = np.concatenate([[True], end[1:] != end[:-1]])  # sorted by end, then period
        e, q = end[smallest], period[smallest]
        start = e - q - _agree(s, e - q - 1, e - 1, -1)
        out.append(np.stack([start, e - start, q], 1))
        group = np.cumsum(smallest) - 1
        same = (period % q[group] == 0) & (end - 2 * period >= start[group])
        end, period = end[~(smallest | same)], period[~(smallest | same)]
    if not out:
        return []
    rows = np.concatenate(out)
    rows = rows[(rows[:, 1] >= length) & (rows[:, 1] >= power * rows[:, 2])]
    return sorted(map(tuple, rows.tolist()), key=lambda r: (r[0], r[2]))


def _found(words: list[list[bytes]], length: int, power: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each document of a batch."""
    numbers = Numbers()
    counts = np.array([len(w) for w in words])
    ids = np.fromiter((numbers[x] for w in words for x in w), np.int64, counts.sum())
    doc = np.repeat(np.arange(len(words)), counts)
    out: list[list] = [[] for _ in words]
    # A run of at least ``power`` periods and ``length`` words repeats length - length // power words or more.
    some = repeats_a_gram(ids, doc, max(1, length - length // power))
    if not len(some):
        return out
    kept = np.isin(doc, some)
    ids, doc = ids[kept], doc[kept]
    begins = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1])
    symbols = np.unique(doc * np.int64(len(numbers)) + ids, return_inverse=True)[1]
    for start, size, period in runs_of(symbols, length, power):
        i = np.searchsorted(begins, start, "right") - 1
        out[doc[begins[i]]].append((start - int(begins[i]), size, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that a run contains after its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, n in zip(words, np.cumsum(gone).tolist()) if not n]
    return b" ".join(words).decode()


def _runs(length: int, power: int):
    def emit(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
        runs = _found(words, length, power)
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        named = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
        top = [max(own, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None) for own in named]
        return pa.record_batch([
            pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), pa.array(named, pa.list_(kind)),
            pa.array(top, kind), pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.string()),
        ], names=["doc_id", "n_words", "runs", "top", "collapsed"])

    def run(batches):
        ids: list = []
        words: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = (text.as_py() or b"").split()  # bytes.split() splits at 0x20 and 0x09-0x0D
                if ids and held + len(own) > STEP_WORDS:
                    yield emit(ids, words)
                    ids, words, held = [], [], 0
                ids.append(doc_id)
                words.append(own)
                held += len(own)
        if ids:
            yield emit(ids, words)

    return run


def periodic_runs(docs: DataFrame, length: int = MIN_LENGTH, power: int = MIN_POWER) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (by start, then period), top (the run of the
    greatest length/period; ties: smallest start, then period) and the collapsed text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_arrow(texts, _runs(length, power), RUNS)


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """The contract's texts: where h = crc32 of the id ends in 0, the words from a on repeat with period p."""
    h = F.crc32(F.col("doc_id").cast("string"))
    blanks = " \t\n\x0b\x0c\r"
    words = F.array_remove(F.split(F.translate("text", blanks, " " * len(blanks)), " "), "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("h"))
    # Only the texts to be rewritten are split into words here.
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(sequence(0, cast(n - 1 as int)), i -> get(words, if(i < a, i, cast(a + (i - a) % p as int)))), ' ')")
    return rows.select("doc_id", F.when(F.col("words").isNotNull() & (F.col("n") > 0), again).otherwise(F.col("text")).alias("text"))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def runs_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts, the greatest run and digests of all runs and of the collapsed text."""
    rows = periodic_runs(_with_planted_periods(docs))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        _digest(F.array_join(lines, "")).alias("runs_sha256"), _digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
