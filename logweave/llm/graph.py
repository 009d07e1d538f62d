"""Connected components as joins and aggregates (no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logweave.llm.common import stage


def _staged_with_count(df: DataFrame, name: str, counted: Column) -> tuple[DataFrame, int]:
    """A staged table and the number of its rows for which ``counted`` holds, counted while writing."""
    seen = Observation()
    table = stage(df.observe(seen, F.count_if(counted).alias("n")), name)
    return table, seen.get["n"]


def _flat(parents: DataFrame) -> DataFrame:
    """Pointer jumping: every id of a forest (id, p) with its root, in log(depth) rounds."""
    while True:
        up = parents.select(F.col("id").alias("p"), F.col("p").alias("top"))
        jumped = parents.join(up, "p").select("id", F.col("top").alias("p"), (F.col("top") != F.col("p")).alias("moved"))
        jumped, moved = _staged_with_count(jumped, "parents", F.col("moved"))
        parents = jumped.select("id", "p")
        if not moved:
            return parents


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every node of ``edges`` (long columns ``a``, ``b``): comp is the smallest id reachable.

    Rounds of contraction: every node hooks to its smallest neighbour if that is
    smaller, the forest is flattened, and the links are redrawn between its roots,
    whose number falls fast; the rounds' maps are then composed. Every table is
    written to the shared folder. A hub with many neighbours is one row of an
    aggregation that combines map-side, and the joins read written tables on both
    sides, so that AQE can split a hot key. Null ends and loops are dropped; no edges
    give no rows.
    """
    links = edges.where("a is not null and b is not null and a <> b")
    links, left = _staged_with_count(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", F.lit(True))
    labels = None
    while left or labels is None:
        both = links.union(links.select("b", "a")).toDF("id", "to")
        roots = _flat(stage(both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("p")), "hooks"))
        if labels is None:
            labels = roots
        else:
            labels = stage(labels.join(roots.toDF("p", "top"), "p", "left").select("id", F.coalesce("top", "p").alias("p")), "labels")
        ends = links.join(roots.toDF("a", "x"), "a").join(roots.toDF("b", "y"), "b").where("x <> y")
        links, left = _staged_with_count(ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links", F.lit(True))
    return labels.toDF("id", "comp")
