"""Exact top-k inner products: a Voronoi join of queries and data.

1. Vectors become integers, floor(scale * x). ``PIVOTS`` of them, drawn by hash, are
   the pivots (a bounded sample; any choice gives the same result, only more or less
   pruning). Every vector goes to the cell of its nearest pivot.
2. Summaries per cell: how many vectors, their largest distance to the pivot, and the
   ``k`` smallest distances. They are at most PIVOTS * (k + 2) numbers.
3. Bounds per group of queries: for a query q and a vector x of cell c at distance d
   from its pivot p, q.p - |q| d <= q.x <= q.p + |q| d. The k best lower bounds over all
   cells give a score that the k-th neighbour reaches, so a cell is needed by a group
   only if the upper bound of one of its queries reaches that query's score.
4. Only needed cells are replicated to a group of queries; cells are dealt in blocks of
   rows, so one cell of any size is many tasks' work. Each task multiplies blocks and
   keeps the k best of a query; a last window takes the k best of these.

Scores are exact: with |values| small enough products run in float64, whose integers
below 2**53 are exact, else in int64. Distances are widened by a relative 1e-9 against
rounding, so pruning never loses a neighbour.

Defined results: vectors that are null or hold null or non-finite components take no
part, as query or as data. Shorter vectors count as padded with zeros. Values beyond
+-(2**31 - 1) are cut there. Ties go to the smaller vec_id. Rows without vec_id take no
part; rows equal in vec_id and vector count once; rows of one vec_id with several
vectors are each a candidate, but never for a query of that id. Other columns are not
read. Fewer candidates than k give all; none give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow, stage

SCALE, TOP, PIVOTS = 256, 5, 64
GROUP_ROWS, BLOCK_ROWS = 512, 4096
#: Query groups whose best a task holds before it passes them on.
OPEN_GROUPS = 256
SLACK = 1e-9


def _vectors(table: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v array<long>): the vectors that take part, as integers."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    limit = float((1 << 31) - 1)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * scale))).cast("long"))
    kept = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of int64, padded with zeros to ``width``."""
    lengths = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten())
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _cells(pivots: np.ndarray):
    """Adds cell and distance of the nearest pivot."""
    squares = (pivots**2).sum(axis=1)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), pivots.shape[1]).astype(np.float64)
            cell = (squares - 2 * (x @ pivots.T)).argmin(axis=1)
            distance = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield batch.append_column("cell", pa.array(cell, pa.int32())).append_column("d", pa.array(distance * (1 + SLACK)))

    return run


def _needed(pivots: np.ndarray, cells: np.ndarray, radius: np.ndarray, near_cell: np.ndarray, near: np.ndarray, sure: int):
    """Per group of queries: the cells that one of them needs."""

    def run(batches):
        for batch in batches:
            groups = batch.column(0).to_pylist()
            out: dict[int, np.ndarray] = {}
            q = _matrix(batch.column(1), pivots.shape[1]).astype(np.float64)
            norm = np.sqrt((q**2).sum(axis=1)) * (1 + SLACK)
            to_pivot = q @ pivots.T
            lower = to_pivot[:, near_cell] - norm[:, None] * near
            # ``sure`` rows reach this score: k neighbours, and as many rows as the query's own id may have.
            reached = np.partition(lower, -sure, axis=1)[:, -sure] if lower.shape[1] >= sure else np.full(len(q), -np.inf)
            upper = to_pivot[:, cells] + norm[:, None] * radius
            need = upper >= (reached - SLACK * np.abs(reached))[:, None]
            for g, row in zip(groups, need):
                out[g] = out[g] | row if g in out else row
            pairs = [(g, int(c)) for g, row in out.items() for c in cells[row]]
            yield pa.record_batch([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int32())], names=["g", "cell"])

    return run


def _blocks(width: int, size: int, key: str):
    """Rows (key, vec_id, v), sorted by key -> packed blocks of ``size`` rows of one key: (key, ids, values)."""

    def pack(k, ids, rows):
        return pa.record_batch([pa.array([k], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([rows.astype(np.int32).tobytes()], pa.binary())], names=[key, "ids", "rows"])

    def run(batches):
        at, ids, rows = None, [], []
        for batch in batches:
            keys = np.asarray(batch.column(0))
            x, v = np.asarray(batch.column(1)), _matrix(batch.column(2), width).astype(np.int64)
            changes = np.flatnonzero(np.diff(keys)) + 1
            for lo, hi in zip([0, *changes], [*changes, len(keys)]):
                if lo == hi:
                    continue
                if at is not None and keys[lo] != at and ids:
                    yield pack(at, np.concatenate(ids), np.concatenate(rows))
                    ids, rows = [], []
                at = int(keys[lo])
                ids.append(x[lo:hi])
                rows.append(v[lo:hi])
                while sum(map(len, ids)) >= size:
                    i, r = np.concatenate(ids), np.concatenate(rows)
                    yield pack(at, i[:size], r[:size])
                    ids, rows = ([i[size:]], [r[size:]]) if len(i) > size else ([], [])
        if ids:
            yield pack(at, np.concatenate(ids), np.concatenate(rows))

    return run


def _best(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int):
    """The k best (query, vector, score) of each query: highest score, then smallest id."""
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    top = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
    return q[top], v[top], s[top]


def _solve(width: int, k: int, exact_float: bool):
    """Rows (query ids, query rows, ids, rows) -> the k best of each query, merged over the blocks a task sees."""
    none = np.iinfo(np.int64).min

    def products(q_ids, q_rows, ids, rows):
        mine, v = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
        q, x = np.frombuffer(q_rows, np.int32).reshape(-1, width), np.frombuffer(rows, np.int32).reshape(-1, width)
        kind = np.float64 if exact_float else np.int64
        score = (q.astype(kind) @ x.astype(kind).T).astype(np.int64)
        score[mine[:, None] == v[None, :]] = none
        low = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(mine), none)
        row, column = np.nonzero((score >= low[:, None]) & (score > none))  # with all ties of the k-th
        return _best(mine[row], v[column], score[row, column], k)

    def run(batches):
        found: dict[bytes, tuple] = {}

        def out():
            q, v, s = (np.concatenate(x) for x in zip(*found.values()))
            found.clear()
            return pa.record_batch([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for q_ids, q_rows, ids, rows in zip(*(batch.column(i).to_pylist() for i in range(4))):
                new = products(q_ids, q_rows, ids, rows)
                if q_ids in found:
                    new = _best(*(np.concatenate(x) for x in zip(found[q_ids], new)), k)
                found[q_ids] = new
                if len(found) > OPEN_GROUPS:
                    yield out()
        if found:
            yield out()

    return run


def top_inner_products(data: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query row the ``k`` highest inner products with other rows.

    ``data``: vec_id, embedding; ``is_query`` says which rows are queries.
    """
    spark = data.sparkSession
    vectors = stage(_vectors(data, scale), "vectors")
    copies = vectors.groupBy("vec_id").count().agg(F.max("count")).collect()[0][0]
    if copies is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if copies > 1:
        vectors = stage(vectors.distinct(), "vectors")
    shape = vectors.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).collect()[0]
    width, exact_float = int(shape[0]), int(shape[1]) ** 2 * int(shape[0]) < 1 << 52
    sample = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(PIVOTS).select("v").collect()
    pivots = np.unique(np.array([list(r[0]) + [0] * (width - len(r[0])) for r in sample], np.float64), axis=0)

    placed = stage(map_arrow(vectors, _cells(pivots), "vec_id long, v array<long>, cell int, d double"), "cells")
    near = placed.withColumn("i", F.row_number().over(Window.partitionBy("cell").orderBy("d"))).where(F.col("i") <= k + copies)
    nearest = near.select("cell", "d").collect()  # k + copies rows a pivot
    summary = placed.groupBy("cell").agg(F.max("d")).orderBy("cell").collect()  # a row a pivot
    cells, radius = np.array([r[0] for r in summary]), np.array([r[1] for r in summary])
    near_cell, near_d = np.array([r[0] for r in nearest]), np.array([r[1] for r in nearest])

    # Groups of some GROUP_ROWS queries; small cells share one, large ones are dealt by hash.
    queries = placed.where(is_query).select("cell", "vec_id", "v")
    counts = {r[0]: r[1] for r in queries.groupBy("cell").count().collect()}  # a row a pivot
    ends = np.cumsum([counts.get(c, 0) for c in range(len(pivots))])
    base = F.element_at(F.array(*[F.lit(int(e - counts.get(c, 0))) for c, e in enumerate(ends)]), F.col("cell") + 1)
    size = F.element_at(F.array(*[F.lit(max(1, counts.get(c, 0))) for c in range(len(pivots))]), F.col("cell") + 1)
    q_key = F.expr(f"x div {GROUP_ROWS}").alias("g")
    grouped = stage(queries.withColumn("x", base + F.pmod(F.xxhash64("vec_id"), size)).select(q_key, "vec_id", "v"), "queries")
    needed = map_arrow(grouped.select("g", "v"), _needed(pivots, cells, radius, near_cell, near_d, k + copies), "g long, cell int").distinct()
    q_blocks = map_arrow(grouped.repartition("g").sortWithinPartitions("g", "vec_id"), _blocks(width, GROUP_ROWS, "g"), "g long, ids binary, rows binary")
    q_blocks = stage(q_blocks.select("g", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows")), "query-blocks")

    # Cells are cut by salt, so that a hot cell is many blocks in many tasks.
    total = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("salts"))
    parts = stage(total, "salts")
    salted = placed.join(F.broadcast(parts), "cell").select((F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("vec_id"), F.col("salts"))).alias("b"), "vec_id", "v")
    d_blocks = stage(map_arrow(salted.repartition("b").sortWithinPartitions("b", "vec_id"), _blocks(width, BLOCK_ROWS, "b"), "b long, ids binary, rows binary"), "data-blocks")

    wanted = needed.join(F.broadcast(parts), "cell").select("g", F.explode(F.expr("transform(sequence(0L, salts - 1), s -> cell * 4294967296L + s)")).alias("b"))
    work = wanted.join(q_blocks, "g").join(d_blocks, "b").select("q_ids", "q_rows", "ids", "rows")
    partial = map_arrow(work, _solve(width, k, exact_float), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
