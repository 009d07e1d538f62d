"""From LSH bands to exact components of a similarity graph, without all pairs of a bucket.

1. ``bucket_members``: rows that share a band with another row, with the bucket's
   smallest id as its centre. One aggregation finds the buckets with two ids; only
   their rows are kept.
2. ``link_components``: every member is compared with its centre on the full sets.
   Members that are then in one component need no more comparing. In buckets with
   several components, members are compared with ``CENTRES`` more centres, drawn by
   hash, which joins most of a group of copies that the first centre is not part of.
   What is still apart is compared to the end: members outside their bucket's largest
   component meet all members of other components.

   In the later steps a pair is only passed on when its sketches of ``bits`` bits agree
   as far as similar sets do: the limit lies 4.5 standard deviations below the share
   that is expected at the wanted similarity (a chance of 4e-6 to miss such a link,
   like op6's bands; op4's 14 bands of 2 miss a pair at 0.75 with 9e-6). Heavily edited copies of one text, which are not similar to
   each other, thus cost a comparison of bits and no row.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow, sized, stage
from logweave.llm.graph import connected_components
from logweave.llm.sketch import sketch_bits

STEP_SETS, CENTRES = 256, 3


def bucket_members(bands: DataFrame) -> DataFrame:
    """(bkey, center, id) for rows that share a band key with a different id.

    ``bands``: id long, bands array<long> (keys already differ by band).
    """
    rows = bands.select("id", F.explode("bands").alias("bkey"))
    buckets = rows.groupBy("bkey").agg(F.min("id").alias("center"), F.max("id").alias("other")).where("center < other")
    buckets = stage(buckets.select("bkey", "center"), "buckets")
    return stage(rows.join(sized(buckets), "bkey").select("bkey", "center", "id").distinct(), "members")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * |A and B| >= percent * |A or B|, on the full sets (id, items array<long>)."""
    a = sets.select(F.col("id").alias("a"), F.col("items").alias("xa"))
    b = sets.select(F.col("id").alias("b"), F.col("items").alias("xb"))
    both = pairs.join(b, "b").join(a, "a").withColumn("common", F.size(F.array_intersect("xa", "xb")).cast("long"))
    total = F.size("xa") + F.size("xb") - F.col("common")
    return both.where(F.col("common") * 100 >= total * percent).select("a", "b")


def _bits(bits: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            for lo in range(0, batch.num_rows, STEP_SETS):
                part = lists.slice(lo, STEP_SETS)
                sets = [np.asarray(x.values).view(np.uint64) for x in part]
                words = sketch_bits(sets, bits)
                yield pa.record_batch([batch.column(0).slice(lo, STEP_SETS), pa.array([len(x) for x in sets], pa.int64()), *(pa.array(w) for w in words.T)], names=["id", "n", *(f"s{i}" for i in range(words.shape[1]))])

    return run


def agreement_limit(percent: int, bits: int) -> int:
    """Bits that may differ at most."""
    p = (1 + percent / 100) / 2
    return int(bits * (1 - p) + 4.5 * (bits * p * (1 - p)) ** 0.5)


def fitting_pairs(left: DataFrame, right: DataFrame, more: Column, percent: int, bits: int) -> DataFrame:
    """Pairs (a, b) of rows of one bucket, in different components, whose sketches agree and ``more`` holds.

    Rows: bkey, id, comp, n, bands and the sketch words; ``l`` and ``r`` name the sides.
    """

    def both(name: str) -> tuple[Column, Column]:
        return F.col(f"l.{name}"), F.col(f"r.{name}")

    (ln, rn), (lb, rb) = both("n"), both("bands")
    differ = reduce(add, [F.bit_count(x.bitwiseXOR(y)) for x, y in (both(f"s{i}") for i in range(bits // 64))])
    fits = (F.col("l.bkey") == F.col("r.bkey")) & (F.col("l.comp") != F.col("r.comp")) & more
    fits = fits & (F.least(ln, rn) * 100 >= F.greatest(ln, rn) * percent) & (differ <= agreement_limit(percent, bits))
    fits = fits & (F.array_min(F.array_intersect(lb, rb)) == F.col("l.bkey"))  # in one of their common buckets only
    pairs = left.alias("l").join(right.alias("r"), fits)
    return stage(pairs.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct(), "pairs")


def labelled_open(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` of buckets with several components, with ``comp`` and the bucket's largest component ``cc``."""
    labelled = rows.join(sized(comps), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    labelled = stage(labelled, "labelled")
    sizes = labelled.groupBy("bkey", "comp").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("bkey").agg(F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    return labelled.join(sized(stage(largest.select("bkey", F.col("top.comp").alias("cc")), "open")), "bkey")


def link_components(bands: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, bits: int = 2048) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) found, and (id, comp) of the linked ids.

    ``bands``: staged (id, bands), one row an id. ``sets_of(ids)`` gives the full sets
    (id, items) of a table of ids. ``bits`` of the later steps' sketches: a power of two.
    """
    members = bucket_members(bands)
    first = members.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    first = stage(first, "pairs")
    ids = stage(members.select("id").distinct(), "ids")
    sets = stage(sets_of(ids), "sets")
    links = stage(verified(first, sets, percent), "links-1")
    comps = connected_components(links)

    rest = stage(labelled_open(members.select("bkey", "id"), comps).select("bkey", "id"), "open-rows")
    ids = stage(rest.select("id").distinct(), "open-ids")
    words = ", ".join(["id long", "n long", *(f"s{i} long" for i in range(bits // 64))])
    sketches = map_arrow(sets.join(sized(ids), "id", "left_semi").select("id", "items"), _bits(bits), words)
    rest = stage(rest.join(sketches.join(bands, "id"), "id"), "open-members")

    rows = stage(labelled_open(rest, comps), "open-labelled")
    drawn = rows.groupBy("bkey").agg(*[F.min_by("id", F.xxhash64(F.lit(i), "id")).alias(f"c{i}") for i in range(CENTRES)])
    drawn = stage(drawn.select("bkey", F.explode(F.array_distinct(F.array(*[f"c{i}" for i in range(CENTRES)]))).alias("id")), "centres")
    pairs = fitting_pairs(rows.join(drawn, ["bkey", "id"]), rows, F.lit(True), percent, bits)
    links = stage(links.union(verified(pairs, sets, percent)), "links-2")
    comps = connected_components(links)

    rows = stage(labelled_open(rest, comps), "open-labelled")
    apart = (F.col("r.comp") == F.col("r.cc")) | (F.col("l.id") < F.col("r.id"))
    pairs = fitting_pairs(rows.where("comp <> cc"), rows, apart, percent, bits)
    more = stage(verified(pairs, sets, percent), "links-3")
    if not more.limit(1).count():
        return links, comps
    links = links.union(more)
    return links, connected_components(links)
