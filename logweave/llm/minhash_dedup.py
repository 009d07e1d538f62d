"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

Method (Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching", FOCS 2017).
A sketch has ``t`` bins. In round i < t every shingle is hashed to a bin and a
value in [i, i + 1); a bin keeps its smallest value, so a later round only fills
bins that are still empty. In round t + j every shingle falls into bin j, so after
2t rounds at the latest every coordinate is filled. Most documents need one or two
rounds, so the cost is near one hash per shingle instead of ``t``, and the share of
equal coordinates keeps the concentration of independent ones.

Bands of the sketch give candidates; links are confirmed on the full shingle sets
(:mod:`logweave.llm.near_links`). With 32 bands of 4 a pair at similarity 0.75 is
missed with probability (1 - 0.75**4)**32 < 6e-6.

Defined results: a document without words (null or empty text) has the empty set
and is linked with nothing. Fewer than five words are one shingle. Rows with equal
sets are collapsed before banding, so exact copies cost one row. Rows that share a
doc_id are one node. A row without doc_id takes part in links, but cannot name a
component: component_id is the smallest id of the others, or null. Other columns
of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import GOLD, WordHashes, drop_repeated_rows, long_lists, lower_words, map_arrow, mix, shingle_set, sized, stage, steps, word_hashes
from logweave.llm.near_links import link_components
from logweave.llm.sketch import similarity_sketch

BINS, BANDS, PERCENT = 128, 32, 75
#: Stand-in ids of sets that occur only in rows without doc_id lie above this.
NO_ID = 1 << 62


def band_keys(sketch: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(rows, bands) keys; keys of different bands differ."""
    rows, bins = sketch.shape
    parts = sketch.reshape(rows, bands, bins // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLD, (rows, bands)).copy()
    for j in range(bins // bands):
        key = mix(key * GOLD + parts[:, :, j])
    return key


def _sketch(batches):
    known = WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for lo, hi in steps([len(t or b"") for t in texts]):
            sets = [shingle_set(word_hashes(lower_words(t), known)) for t in texts[lo:hi]]
            keys = band_keys(similarity_sketch(sets))
            yield pa.record_batch([
                ids.slice(lo, hi - lo), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()), long_lists(list(keys)),
            ], names=["doc_id", "fp", "n", "bands"])


def _sets(batches):
    known = WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for lo, hi in steps([len(t or b"") for t in texts]):
            sets = [shingle_set(word_hashes(lower_words(t), known)) for t in texts[lo:hi]]
            yield pa.record_batch([ids.slice(lo, hi - lo), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), long_lists(sets)], names=["doc_id", "fp", "items"])


def _node() -> F.Column:
    return F.coalesce("doc_id", F.lit(NO_ID) + F.xxhash64("fp").bitwiseAND(F.lit((1 << 61) - 1)))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id long, text): doc_id, n_shingles, component_id, kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = stage(map_arrow(texts, _sketch, "doc_id long, fp binary, n long, bands array<long>").withColumn("node", _node()), "sketches")
    full = rows.where("n > 0")
    nodes = stage(full.groupBy("fp").agg(F.min("node").alias("id")), "nodes")
    bands = stage(full.join(nodes.withColumnRenamed("id", "node"), ["fp", "node"]).select(F.col("node").alias("id"), "bands"), "bands")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = texts.join(sized(ids).withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").union(texts.where("doc_id is null"))
        sets = map_arrow(wanted, _sets, "doc_id long, fp binary, items array<long>").withColumn("id", _node())
        return sets.join(sized(ids), "id", "left_semi").select("id", "items")

    _, comps = link_components(bands, sets_of, percent)
    named = nodes.join(comps, "id", "left").select("fp", F.coalesce("comp", "id").alias("comp"))
    named = stage(named, "named")
    out = rows.select("doc_id", "fp", "n").join(named, "fp", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("comp") < NO_ID, F.col("comp"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one document of each group left; all columns stay.

    Rows without doc_id stay. Of rows with equal doc_id and equal text one stays.
    """
    marks = stage(near_duplicates(docs), "marks")
    gone = stage(marks.where("not kept and doc_id is not null").select("doc_id").distinct(), "gone")
    return drop_repeated_rows(docs.join(sized(gone), "doc_id", "left_anti"))
