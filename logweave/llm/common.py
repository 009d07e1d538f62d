"""Helpers shared by the training-data operators: words and their hashes, Arrow
passes over a table, staged tables and size-checked broadcasts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.plans.materialize import materialize
from logweave.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"  # what the contracts call a word
WORD_BYTES = re.compile(WORD.encode())
SHINGLE_WORDS = 5
#: Text bytes that one vectorised step works on at a time (a single longer text is one step).
STEP_BYTES = 4 << 20
#: Rows and bytes up to which a key table may be broadcast; above them the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 32 << 20

M1, M2, GOLD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> S33)) * M1
    x = (x ^ (x >> S33)) * M2
    return x ^ (x >> S33)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; emptied when it holds ``limit`` words, so memory is bounded."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased (``bytes.lower`` touches ASCII letters only)."""
    return WORD_BYTES.findall(text.lower()) if text else []


def roll(ids: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` consecutive ids (none when there are fewer)."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = ids[:n].copy()
    for k in range(1, width):
        h = h * GOLD + ids[k : n + k]
    return mix(h + np.uint64(width))


def shingle_set(ids: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter sequence is one shingle; no words: empty."""
    return np.unique(roll(ids, min(width, len(ids)))) if len(ids) else np.empty(0, np.uint64)


def steps(sizes: list[int], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit`` at most."""
    lo = total = 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def longs(values: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs (the same 64 bits)."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def long_lists(rows: list[np.ndarray]) -> pa.Array:
    """One list<int64> per row."""
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), longs(flat.astype(np.uint64, copy=False)))


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the executors first."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table under ``spark.checkpoint.dir`` and read it back: it is computed
    once, and a lost executor rereads files instead of recomputing the plan."""
    return materialize(df, f"llm-{name}")


def sized(keys: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a staged key table of checked size; a larger one is joined by shuffling.

    ``keys`` must have a few fixed-width columns, eight bytes each at most, and be staged, as it is counted.
    """
    limit = min(limit, BROADCAST_BYTES // (8 * len(keys.columns)))
    return F.broadcast(keys) if (keys.count() if rows is None else rows) <= limit else keys


def n_words(text: str) -> Column:
    """Number of words of a text column (null: 0), as a long."""
    blanks = " \t\n\x0b\x0c\r"
    spaced = F.translate(F.coalesce(text, F.lit("")), blanks, " " * len(blanks))
    return F.size(F.array_remove(F.split(spaced, " "), "")).cast("long")


def drop_repeated_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with one of the rows that are equal in doc_id and text.

    Counts narrow keys; only documents that have repeated rows are shuffled with their text.
    """
    mark = F.xxhash64("text").alias("_mark")
    again = docs.groupBy("doc_id", mark).count().where("count > 1").select(F.col("doc_id").alias("_id"), "_mark")
    again = sized(stage(again, "repeated"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_mark"))
    return docs.join(again, same, "left_anti").unionByName(docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
