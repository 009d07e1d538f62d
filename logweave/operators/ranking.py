"""Exact positions within groups without putting a group into one task.

``row_number() OVER (PARTITION BY k ORDER BY o)`` sends every row of a key to one
task, and without ``PARTITION BY`` every row of the table to one task. Here the
rows are range-partitioned on ``(k, o)`` instead (Spark samples the keys, so a hot
key is spread over many partitions), numbered inside each partition, and the
counts of a key that spills over from earlier partitions are added back. The
offset table has at most one row per partition; Spark broadcasts it when its measured
size allows.

The partitioned, numbered rows are written once as a table in the session's
``spark.checkpoint.dir`` (partition id, row index and local sum are stored
columns): the offset aggregate and the final join read the same numbering, and a
lost executor re-reads files instead of recomputing the range shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.plans.materialize import materialize
from logweave.session import ship_package


def _same_as_previous(arrays: list[pa.Array], prev: list | None, n: int) -> np.ndarray:
    """Boolean mask: row i has the same key as row i-1 (row 0 compared with ``prev``)."""
    same = np.ones(n, dtype=bool)
    for j, arr in enumerate(arrays):
        if n > 1:
            a, b = arr.slice(1), arr.slice(0, n - 1)
            eq = pc.or_kleene(pc.equal(a, b), pc.and_(pc.is_null(a), pc.is_null(b)))
            same[1:] &= pc.fill_null(eq, False).to_numpy(zero_copy_only=False)
        if n:
            same[0] &= prev is not None and arr[0].as_py() == prev[j]
    if n and not arrays:
        same[0] = prev is not None
    return same


def _numbering(by: Sequence[str], weight: str | None):
    """Per partition (rows sorted by key, then order): inclusive running sum of the
    weight (1 per row when ``weight`` is None) that restarts at every key change."""

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        prev_key: list | None = None
        carry = 0
        row0 = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys = [batch.column(k) for k in by]
            same = _same_as_previous(keys, prev_key, n)
            if weight is None:
                w = np.ones(n, dtype=np.int64)
            else:
                w = pc.fill_null(batch.column(weight), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            csum = np.cumsum(w)
            idx = np.arange(n, dtype=np.int64)
            last_start = np.maximum.accumulate(np.where(~same, idx, -1))
            before_start = np.where(last_start > 0, csum[np.maximum(last_start - 1, 0)], 0)
            pos = np.where(last_start >= 0, csum - before_start, carry + csum)
            carry = int(pos[-1])
            prev_key = [k[n - 1].as_py() for k in keys]
            yield (
                batch.append_column("_pid", pa.array(np.full(n, pid, dtype=np.int32)))
                .append_column("_lidx", pa.array(idx + row0))
                .append_column("_lpos", pa.array(pos))
            )
            row0 += n

    return run


def rank_within(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    name: str = "pos",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based position of each row inside its ``by`` group, in ``order``.

    ``order`` must make the order total within a group (add a tie-break column);
    ``by=[]`` numbers the whole DataFrame. Equal to ``row_number()`` over the same
    window, but no task holds more than its range partition.
    """
    return running_sum_within(df, by, order, None, name, num_partitions)


def running_sum_within(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    weight: str | None,
    name: str = "running",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = inclusive running sum of integer column ``weight`` within ``by``, in ``order``.

    Same as ``sum(weight) OVER (PARTITION BY by ORDER BY order ROWS UNBOUNDED
    PRECEDING)``; ``order`` must be total within a group.
    """
    by = list(by)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    sort_cols = [F.col(b) for b in by] + order_cols
    out_schema = T.StructType(
        df.schema.fields
        + [
            T.StructField("_pid", T.IntegerType(), False),
            T.StructField("_lidx", T.LongType(), False),
            T.StructField("_lpos", T.LongType(), False),
        ]
    )
    # Without an explicit count AQE may coalesce small range partitions; it merges
    # adjacent ones only, so partition ids still follow the key order.
    ranged = df.repartitionByRange(num_partitions, *sort_cols) if num_partitions else df.repartitionByRange(*sort_cols)
    ship_package(df.sparkSession)
    local = (
        ranged.sortWithinPartitions(*sort_cols)
        .mapInArrow(_numbering(by, weight), out_schema)
    )
    local = materialize(local, "ranked")
    key = F.struct(*[F.col(b) for b in by]) if by else F.lit(0)
    stats = local.groupBy("_pid").agg(
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.max_by("_lpos", "_lidx").alias("last_cnt"),
    )
    w_key = Window.partitionBy("last_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.orderBy("_pid")  # one row per partition: bounded by the partition count
    offsets = (
        stats.withColumn("carried", F.sum("last_cnt").over(w_key))
        .withColumn("prev_last_key", F.lag("last_key").over(w_all))
        .withColumn("prev_carried", F.lag("carried").over(w_all))
        .select(
            "_pid", "first_key",
            F.when(F.col("prev_last_key").eqNullSafe(F.col("first_key")), F.col("prev_carried")).otherwise(F.lit(0)).alias("offset"),
        )
        .where(F.col("offset") > 0)
    )
    joined = local.join(offsets, "_pid", "left")
    pos = F.col("_lpos") + F.when(key.eqNullSafe(F.col("first_key")), F.col("offset")).otherwise(F.lit(0))
    return joined.select(*df.columns, pos.cast("bigint").alias(name))
