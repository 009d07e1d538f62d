"""Packing token sequences: bounded-space online best fit.

Each partition keeps at most ``OPEN`` open windows. A document (its ids and the end
id) first fills whole windows; what is left goes to the open window with the least
room that takes it. When none does and all windows are in use, the fullest is topped
up with the head of the piece and emitted, so an emitted window has no padding. The
windows that are still open at the end (at most ``OPEN`` a partition) are merged:
their pieces are laid end to end by a prefix sum over partitions and cut at every
window, so only the very last sequence of a table is padded.

Ids are those of ``tokenizers`` with the given vocabulary file; see :class:`Encoder`.
The packed pieces are written once to the shared folder, so sequence ids stay the
same when an executor is lost.

Defined results: null and empty text are the end id alone. Every input row is packed,
repeated rows each for itself; null doc_id stays null. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow, stage

SEQUENCE, OPEN, END_ID = 1024, 32, 0
VOCABULARY = "byte_bpe_50k"
FLUSH_PIECES = 2000
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, part long, window long, offset long, open boolean"
#: Sequences of merged windows are numbered from here; those of partition p from p << 32.
MERGED = 1 << 62


class Encoder:
    """Ids of ``<vocabulary>.json`` (tokenizers), a word at a time with known words kept.

    Pre-tokens never cross a blank that stands between two non-blanks, or a line end
    between two non-blanks, so such texts are encoded word by word. New words go
    through tiktoken with the same vocabulary's ranks: equal ids at a fifth of the
    time (the tests compare whole tables). Texts with two blanks in a row or with a
    special token's string go through tokenizers as they are.
    """

    limit = 600_000  # known words, some 150 MB; emptied when full

    def __init__(self, vocabulary: str = VOCABULARY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        special = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([r"\s\s", "\x00", *special]))
        self.dtype = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}

    def _new(self, word: str) -> bytes:
        """``word``: a word after a blank; a line end; after a NUL, a word at the start of a line."""
        text = word if word == "\n" else word[1:] if word[:1] == "\x00" else " " + word
        if len(self.known) >= self.limit:
            self.known.clear()
        ids = self.known[word] = np.array(self.words.encode_ordinary(text), self.dtype).tobytes()
        return ids

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if self.odd.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        get, new = self.known.get, self._new
        words = ("\x00" + text.replace("\n", " \n \x00")).split(" ")
        return np.frombuffer(b"".join([get(w) or new(w) for w in words]), self.dtype).astype(np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """One encoder per worker process: its known words serve later tasks too."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


class Packer:
    """Best fit into at most ``limit`` open windows of ``size`` tokens.

    A piece is (doc_id, start, ids, doc_tokens). ``done`` collects the pieces of
    emitted windows as (piece, window, offset).
    """

    def __init__(self, size: int = SEQUENCE, limit: int = OPEN):
        self.size, self.limit = size, limit
        self.room: list[tuple[int, int]] = []  # (free tokens, window) of open windows, sorted
        self.pieces: dict[int, list] = {}
        self.windows = 0
        self.done: list = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.size:
            self._put(self._open(), (doc_id, at, ids[at : at + self.size], total), self.size)
            at += self.size
        while at < total:
            at = self._place(doc_id, ids, at, total)

    def _open(self) -> int:
        self.windows += 1
        self.pieces[self.windows - 1] = []
        return self.windows - 1

    def _put(self, window: int, piece: tuple, free: int) -> None:
        self.pieces[window].append((piece, self.size - free))
        free -= len(piece[2])
        if free:
            bisect.insort(self.room, (free, window))
        else:
            self.done += [(p, window, offset) for p, offset in self.pieces.pop(window)]

    def _place(self, doc_id, ids, at: int, total: int) -> int:
        i = bisect.bisect_left(self.room, (total - at, -1))
        if i < len(self.room):  # the least room that takes it
            free, window = self.room.pop(i)
        elif len(self.room) < self.limit:
            free, window = self.size, self._open()
        else:  # none fits: top up the fullest, which is then emitted
            free, window = self.room.pop(0)
        end = min(total, at + free)
        self._put(window, (doc_id, at, ids[at:end], total), free)
        return end

    def left(self) -> list:
        return [(p, window, offset) for _, window in self.room for p, offset in self.pieces[window]]


def _pack(vocabulary: str, size: int, limit: int, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, packer, end = encoder(vocabulary), Packer(size, limit), np.array([end_id], np.uint32)

        def rows(placed: list, is_open: bool) -> pa.RecordBatch:
            n = len(placed)
            return pa.record_batch([
                pa.array([p[0] for p, _, _ in placed], pa.int64()), pa.array([p[1] for p, _, _ in placed], pa.int64()),
                pa.array([len(p[2]) for p, _, _ in placed], pa.int64()), pa.array([p[2].tobytes() for p, _, _ in placed], pa.binary()),
                pa.array([p[3] for p, _, _ in placed], pa.int64()), pa.array([part] * n, pa.int64()),
                pa.array([w for _, w, _ in placed], pa.int64()), pa.array([o for _, _, o in placed], pa.int64()), pa.array([is_open] * n, pa.bool_()),
            ], names=["doc_id", "start", "length", "ids", "doc_tokens", "part", "window", "offset", "open"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, np.concatenate([encode(text.as_py()), end]))
                if len(packer.done) >= FLUSH_PIECES:
                    yield rows(packer.done, False)
                    packer.done = []
        for placed, is_open in ((packer.done, False), (packer.left(), True)):
            if placed:
                yield rows(placed, is_open)

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, size: int = SEQUENCE, limit: int = OPEN, end_id: int = END_ID) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stage(map_arrow(texts, _pack(vocabulary, size, limit, end_id), PIECES), "pieces")
    full = pieces.where("not open").withColumn("sequence_id", F.expr("shiftleft(part, 32) + window"))

    # Merge: end to end over partitions. The second window has one row per partition.
    rest = pieces.where("open")
    before = Window.partitionBy("part").orderBy("window", "offset").rowsBetween(Window.unboundedPreceding, -1)
    totals = rest.groupBy("part").agg(F.sum("length").alias("t"))
    starts = totals.select("part", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    laid = rest.withColumn("at", F.coalesce(F.sum("length").over(before), F.lit(0))).join(starts, "part").withColumn("at", F.col("at") + F.col("base"))
    cut = laid.withColumn("w", F.explode(F.expr(f"sequence(at div {size}, (at + length - 1) div {size})")))
    cut = cut.withColumn("lo", F.greatest(F.col("at"), F.col("w") * size)).withColumn("hi", F.least(F.col("at") + F.col("length"), (F.col("w") + 1) * size))
    merged = cut.select(
        "doc_id", (F.col("start") + F.col("lo") - F.col("at")).alias("start"), (F.col("hi") - F.col("lo")).alias("length"),
        F.expr("substring(ids, cast(4 * (lo - at) + 1 as int), cast(4 * (hi - lo) as int))").alias("ids"), "doc_tokens",
        (F.lit(MERGED) + F.col("w")).alias("sequence_id"), (F.col("lo") - F.col("w") * size).alias("offset"),
    )
    return full.select(*merged.columns).union(merged)


def packed_digest(docs: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
