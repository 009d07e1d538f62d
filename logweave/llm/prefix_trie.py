"""Conversation prefix trie: a z-fast trie that is built by batches of insertions.

A conversation is a sequence of turns. The hash of its first d turns, ``(d, a, b)``, is a
sum of salted turn hashes in two lanes of ``LANE`` bits, so it is a running sum that needs
no conversation in one row; blocks of ``BLOCK`` turns keep a very long conversation spread
over tasks. The trie is compacted: its nodes are the points where paths part or
conversations end, and an edge (p, e] names one conversation that runs along it.

1. Every edge is entered in a hash table under its handle, the hash of the first f turns,
   f being the two-fattest number of (p, e] (the one with the most trailing zero bits).
2. Locating: a fat binary search narrows (lo, hi]; each step looks the two-fattest prefix
   up and compares the extent of the node it finds. The exit edge is then the child in
   the direction of the next turn, and the turns shared along it are counted.
3. Inserting in batches: of all conversations that leave the trie at one point by the same
   turn, one drawn by hash is inserted, edges are cut where conversations leave them, and
   the others are located anew from that point. Half of the others part from the drawn
   one before the next round, so rounds grow with the logarithm of the conversations.
4. Counts below a node are sums over its subtree, by pointer doubling over the compacted
   parents. Edges are expanded into a node per turn; its counts follow from its edge's.

Hot first turns, copies and long edges are keys of aggregations that combine map-side, or
unique on one side of a join. Every round's tables are written to the shared folder.

Defined results: rows without conv_id take no part. Turns are ordered by turn (null first),
then role, then text; null role or text are empty. No conversations give no nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow, stage
from logweave.operators.ranking import rank_within

LANE, BLOCK, PIECE = 52, 1024, 64
BROADCAST_BYTES = 16 << 20  # of eight-byte columns; larger tables are joined by shuffling
CHUNK_IDS = 8192  # conversation ids that one text piece of a node's members holds
KEY = ["d", "a", "b"]


def prefix_points(turns: DataFrame) -> DataFrame:
    """(conv, d, a, b, size, total): the hash of each prefix, its last turn's bytes and the bytes of all its turns.

    ``turns``: conv, d (1, 2, ... per conversation), k1, k2 (hashes of the turn), size.
    """
    lane = [F.expr(f"shiftrightunsigned(xxhash64({i}, d, k1, k2), {64 - LANE})").alias(c) for i, c in enumerate("ab")]
    rows = turns.select("conv", "d", F.floor(F.col("d") / BLOCK).alias("block"), *lane, "size")
    inside = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(*[F.sum(c).alias(c) for c in ("a", "b", "size")])
    ahead = [F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")).over(before), F.lit(0)) for c in ("a", "b", "size")]
    blocks = blocks.select("conv", "block", *[F.pmod(x, F.lit(1 << LANE)).cast("long").alias(f"{c}0") for c, x in zip("ab", ahead)], ahead[2].cast("long").alias("size0"))
    sums = rows.select("conv", "block", "d", "size", *[F.sum(c).over(inside).alias(n) for c, n in (("a", "a"), ("b", "b"), ("size", "total"))])
    whole = sums.join(blocks, ["conv", "block"])
    return whole.select(
        "conv", "d", *[F.pmod(F.col(c) + F.col(f"{c}0"), F.lit(1 << LANE)).alias(c) for c in "ab"], "size", (F.col("total") + F.col("size0")).alias("total")
    )


def two_fattest(lo: Column, hi: Column) -> Column:
    """The number of (lo, hi] with the most trailing zero bits."""
    low_bits = F.length(F.bin(lo.bitwiseXOR(hi))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", hi, low_bits), low_bits)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` broadcast if its ``rows`` (a count or a proven bound) are few; else joins with it shuffle."""
    return F.broadcast(df) if rows * 8 * len(df.columns) <= BROADCAST_BYTES else df


def _at(rows: DataFrame, points: DataFrame, depth: str, prefix: str, n_rows: int) -> DataFrame:
    """``rows`` (conv, ...), at most ``n_rows``, with the hash of conv's first ``depth`` turns, which it must have, as prefix + a, b."""
    own = points.select("conv", F.col("d").alias(depth), F.col("a").alias(f"{prefix}a"), F.col("b").alias(f"{prefix}b"))
    return own.join(small(rows, n_rows), ["conv", depth])


def _edges(cuts: DataFrame, points: DataFrame, n_cuts: int) -> DataFrame:
    """Edges (conv, p, e) with the hashes of their parent, first turn, handle and extent, and bytes up to p and e."""
    rows = cuts.withColumn("f", two_fattest(F.col("p"), F.col("e")))
    depths = rows.select("conv", "p", "e", "f", F.explode(F.array_distinct(F.array("p", F.col("p") + 1, "f", "e"))).alias("d")).where("d > 0")
    found = points.join(small(depths, 4 * n_cuts), ["conv", "d"])

    def pick(depth: Column, name: str, *columns: str) -> list[Column]:
        return [F.max(F.when(F.col("d") == depth, F.col(c))).alias(f"{name}{c}") for c in columns]

    out = found.groupBy("conv", "p", "e", "f").agg(
        *pick(F.col("p"), "p", "a", "b", "total"), *pick(F.col("p") + 1, "n", "a", "b"), *pick(F.col("f"), "f", "a", "b"), *pick(F.col("e"), "e", "a", "b", "total")
    )
    return out.fillna(0, ["pa", "pb", "ptotal"])  # the root


def _locate(pending: DataFrame, n_pending: int, edges: DataFrame, n_edges: int, points: DataFrame) -> DataFrame:
    """``pending`` (conv, n, lo) with ``lo`` = depth of the deepest node that its path runs through.

    A step of the search is a written table, so plans stay short; paths whose search is over
    are set aside. There are at most as many steps as the longest path's length has bits.
    """
    table = edges.select(F.col("f").alias("hf"), F.col("fa").alias("ha"), F.col("fb").alias("hb"), F.col("p").alias("hp"), F.col("e").alias("he"), F.col("ea").alias("hea"), F.col("eb").alias("heb"))
    rows = pending.select("conv", "n", "lo", F.col("n").alias("hi"))
    closed = rows.where("lo >= hi")
    rows = rows.where("lo < hi")
    while True:
        probes = _at(rows.withColumn("f", two_fattest(F.col("lo"), F.col("hi"))), points, "f", "x", n_pending)
        hit = (F.col("f") == F.col("hf")) & (F.col("xa") == F.col("ha")) & (F.col("xb") == F.col("hb"))
        # Where a node is found its extent is compared, as far down as the path goes; else the last known depth is looked up in vain.
        found = probes.join(small(table, n_edges), hit, "left").withColumn("to", F.coalesce(F.least("he", "n"), "f"))
        found = _at(found, points, "to", "y", n_pending)
        node = F.col("hf").isNotNull()
        through = node & (F.col("to") == F.col("he")) & (F.col("ya") == F.col("hea")) & (F.col("yb") == F.col("heb"))
        lo = F.when(through, F.col("he")).when(node, F.col("hp")).otherwise(F.col("lo"))
        hi = F.when(through, F.col("hi")).when(node, F.col("hp")).otherwise(F.col("f") - 1)
        seen = Observation()
        step = found.select("conv", "n", lo.alias("lo"), hi.alias("hi")).observe(seen, F.count_if(F.col("lo") < F.col("hi")).alias("open"))
        step = stage(step, "trie-search")
        closed, rows, n_pending = closed.union(step.where("lo >= hi")), step.where("lo < hi"), seen.get["open"]
        if not n_pending:
            return closed.select("conv", "n", "lo")


def _leave(located: DataFrame, n_located: int, edges: DataFrame, n_edges: int, points: DataFrame) -> DataFrame:
    """Where each path leaves the trie: (conv, n, at, on, p, e); ``on``, ``p``, ``e`` are of the edge that it leaves inside, if any.

    Paths that end at a node that is there leave it nowhere and have no row.
    """
    rows = _at(located.where("lo < n").withColumn("next", F.col("lo") + 1), points, "next", "x", n_located)
    first = edges.select(F.col("conv").alias("on"), "p", "e", F.col("na").alias("xa"), F.col("nb").alias("xb"), F.col("p").alias("lo"))
    rows = rows.join(small(first, n_edges), ["lo", "xa", "xb"], "left").select("conv", "n", "lo", "on", "p", "e")
    rows = stage(rows, "trie-exit-edges")
    along = rows.where("on is not null").select("conv", "on", "lo", F.least("n", "e").alias("up"))
    along = points.select("conv", *KEY).join(small(along, n_located), "conv").where("d > lo and d <= up")
    shared = along.join(points.select(F.col("conv").alias("on"), *KEY), ["on", *KEY]).groupBy("conv").agg(F.count(F.lit(1)).alias("shared"))
    rows = rows.join(small(shared, n_located), "conv", "left").withColumn("at", F.col("lo") + F.coalesce("shared", F.lit(0)))
    inside = (F.col("at") > F.col("p")) & (F.col("at") < F.col("e"))
    return rows.select("conv", "n", "at", *[F.when(inside, F.col(c)).alias(c) for c in ("on", "p", "e")])


def build_trie(points: DataFrame, ends: DataFrame) -> tuple[DataFrame, int]:
    """The compacted trie of the different sequences: edges as of :func:`_edges`, and their number.

    ``points``: staged prefix points of these sequences; ``ends``: staged (conv, d, a, b), a conversation per different sequence.
    """
    pending = ends.where("d > 0").select("conv", F.col("d").alias("n"), F.lit(0).cast("long").alias("lo"))
    n_pending = pending.count()
    edges, n_edges = None, 0
    while True:
        if edges is None:
            left = pending.select("conv", "n", F.col("lo").alias("at"), *[F.lit(None).cast("long").alias(c) for c in ("on", "p", "e")])
        else:
            left = stage(_leave(_locate(pending, n_pending, edges, n_edges, points), n_pending, edges, n_edges, points), "trie-exits")
        # A batch: of the paths that leave at one point by one turn, one becomes a leaf.
        waiting = stage(_at(left.where("at < n").withColumn("next", F.col("at") + 1), points, "next", "x", n_pending), "trie-waiting")
        drawn = waiting.groupBy("next", "xa", "xb").agg(F.min_by(F.struct("conv", "n"), F.struct(F.xxhash64("conv"), "conv")).alias("r"), F.count(F.lit(1)).alias("k"))
        seen = Observation()
        drawn = drawn.observe(seen, F.coalesce(F.sum("k"), F.lit(0)).alias("all"), F.count(F.lit(1)).alias("drawn"))
        drawn = stage(drawn.select(F.col("r.conv").alias("conv"), (F.col("next") - 1).alias("p"), F.col("r.n").alias("e")), "trie-batch")
        n_all, n_drawn = seen.get["all"], seen.get["drawn"]
        if edges is None:
            edges = _edges(drawn, points, n_drawn)
        else:
            split = left.where("on is not null").select(F.col("on").alias("conv"), "p", "e", "at").distinct()
            whole = split.select("conv", "p", "e").distinct()
            pieces = split.union(whole.select("conv", "p", "e", F.col("e")))
            order = Window.partitionBy("conv", "p").orderBy("at")
            pieces = pieces.select("conv", F.coalesce(F.lag("at").over(order), "p").alias("p"), F.col("at").alias("e"))
            cuts = stage(drawn.unionByName(pieces), "trie-cuts")  # at most a leaf and two pieces per path
            kept = edges.join(small(whole, n_pending), ["conv", "p", "e"], "left_anti").select(*edges.columns)
            edges = kept.unionByName(_edges(cuts, points, 3 * n_pending))
        seen = Observation()
        edges = stage(edges.observe(seen, F.count(F.lit(1)).alias("n")), "trie-edges")
        n_edges = seen.get["n"]
        if n_all == n_drawn:
            return edges, n_edges
        pending = stage(waiting.join(small(drawn.select("conv"), n_drawn), "conv", "left_anti").select("conv", "n", F.col("at").alias("lo")), "trie-pending")
        n_pending = n_all - n_drawn


SUMS = ["n_convs", "n_leaves", "path_bytes", "edge_bytes"]


def subtree_sums(nodes: DataFrame, n_nodes: int) -> DataFrame:
    """``nodes`` (d, a, b, pd, pa, pb, first, *SUMS), at most ``n_nodes``, with ``first`` and the sums taken over each node's subtree.

    Pointer doubling: after k rounds a node holds what lies less than 2^k levels below it.
    """
    values = nodes.select(*KEY, "first", *SUMS)
    up = stage(nodes.where("pd is not null").select(*KEY, F.col("pd").alias("ud"), F.col("pa").alias("ua"), F.col("pb").alias("ub")), "trie-up")
    while True:
        given = values.join(small(up, n_nodes), KEY).groupBy("ud", "ua", "ub").agg(F.min("first").alias("first_"), *[F.sum(c).alias(f"{c}_") for c in SUMS])
        given = given.toDF(*KEY, "first_", *[f"{c}_" for c in SUMS])
        added = [(F.col(c) + F.coalesce(f"{c}_", F.lit(0))).alias(c) for c in SUMS]
        values = stage(values.join(small(given, n_nodes), KEY, "left").select(*KEY, F.least("first", "first_").alias("first"), *added), "trie-sums")
        above = up.toDF("ud", "ua", "ub", "vd", "va", "vb")
        up = stage(up.join(small(above, n_nodes), ["ud", "ua", "ub"]).select(*KEY, F.col("vd").alias("ud"), F.col("va").alias("ua"), F.col("vb").alias("ub")), "trie-up")
        if up.isEmpty():
            return values


def _chunks(limit: int):
    """Sorted (d, a, b, conv) -> the ids of a node in comma-joined pieces of at most ``limit``, in order."""

    def batch_of(rows):
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])], names=[*KEY, "first", "ids"])

    def run(batches):
        key, ids, rows = None, [], []
        for batch in batches:
            for *own, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key or len(ids) >= limit:
                    if ids:
                        rows.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = own, []
                ids.append(conv)
            if len(rows) >= 1000:
                yield batch_of(rows)
                rows = []
        if ids:
            rows.append((*key, ids[0], ",".join(map(str, ids))))
        if rows:
            yield batch_of(rows)

    return run


def _hashed(batches):
    """Pieces by node and order -> (d, a, b, sha256): pieces stream through one hash state."""
    key, state, rows = None, None, []

    def batch_of(rows):
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], names=[*KEY, "ends_sha256"])

    for batch in batches:
        for *own, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if own != key:
                if state:
                    rows.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(rows) >= 1000:
            yield batch_of(rows)
            rows = []
    if state:
        rows.append((*key, state.hexdigest()))
    if rows:
        yield batch_of(rows)


def member_digests(ends: DataFrame) -> DataFrame:
    """(d, a, b, ends_sha256) of the conversations (conv, d, a, b) that end at each node.

    Ids are sorted and joined in pieces by range partitions, which a hot node's ids share;
    then one task streams the node's few pieces through its hash.
    """
    ranged = ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    pieces = map_arrow(ranged, _chunks(CHUNK_IDS), "d long, a long, b long, first long, ids string")
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return map_arrow(pieces, _hashed, "d long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node, the root and the nodes inside compacted edges included.

    ``turns``: conv, d, k1, k2, size as for :func:`prefix_points`; ``convs``: conv, every conversation
    once, those without turns too. Returns conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (summed over the subtree: (members - 1) * bytes of the last turn)
    and ends_sha256 (of the members that end there, ascending and comma-joined).
    """
    points = stage(prefix_points(turns), "trie-prefixes")
    n_convs = convs.count()
    last = points.groupBy("conv").agg(F.max(F.struct(*KEY)).alias("k")).select("conv", "k.*")
    ends = convs.join(small(last, n_convs), "conv", "left").select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in KEY])
    ends = stage(ends, "trie-ends")
    sequences = stage(ends.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")), "trie-sequences")
    points = stage(points.join(small(sequences.select("conv"), n_convs), "conv", "left_semi"), "trie-points")
    edges, n_edges = build_trie(points, sequences.select("conv", *KEY))
    n_nodes = n_edges + 1

    keys = edges.select(F.col("e").alias("d"), F.col("ea").alias("a"), F.col("eb").alias("b"), F.col("p").alias("pd"), "pa", "pb", (F.col("etotal") - F.col("ptotal")).alias("edge_bytes"), F.col("etotal").alias("total"))
    root = [F.lit(0).cast("long").alias(c) for c in KEY]
    top = convs.limit(1).select(*root, *[F.lit(None).cast("long").alias(c) for c in ("pd", "pa", "pb")], *[F.lit(0).cast("long").alias(c) for c in ("edge_bytes", "total")])
    children = keys.groupBy("pd", "pa", "pb").agg(F.count(F.lit(1)).alias("n_children")).toDF(*KEY, "n_children")
    own = sequences.select(*KEY, F.col("conv").alias("first"), F.col("n").alias("n_convs"))
    nodes = keys.union(top).join(small(own, n_convs), KEY, "left").join(small(children, n_nodes), KEY, "left").fillna(0, ["n_convs", "n_children"])
    nodes = nodes.withColumn("path_bytes", F.col("n_convs") * F.col("total")).withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
    nodes = stage(nodes, "trie-nodes")
    sums = subtree_sums(nodes, n_nodes)

    # Expansion: a node per turn of each edge. Edges and points meet by pieces of PIECE turns.
    piece = F.expr(f"explode(sequence(p div {PIECE}, (e - 1) div {PIECE}))")
    spans = edges.select("conv", "p", "e", F.col("ea").alias("a"), F.col("eb").alias("b"), "pa", "pb", "ptotal", piece.alias("piece"))
    along = points.select("conv", "d", "size", "total", F.expr(f"(d - 1) div {PIECE}").alias("piece"))
    rows = along.join(spans, ["conv", "piece"]).where("d > p and d <= e").drop("conv", "piece")
    rows = rows.join(small(sums.withColumnRenamed("d", "e"), n_nodes), ["e", "a", "b"])
    above = sums.select(F.col("d").alias("p"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("first").alias("parent"))
    rows = rows.join(small(above, n_nodes), ["p", "pa", "pb"])
    before = F.col("total") - F.col("size")  # bytes up to the turn before
    saved = F.col("path_bytes") - F.col("n_convs") * before - (F.col("edge_bytes") - (before - F.col("ptotal")))
    rows = rows.select(
        "d", F.when(F.col("d") == F.col("e"), F.col("a")).alias("a"), F.when(F.col("d") == F.col("e"), F.col("b")).alias("b"), "first",
        F.when(F.col("d") == F.col("p") + 1, F.col("parent")).otherwise(F.col("first")).alias("parent"), "n_convs", "n_leaves", saved.alias("saved"),
    )
    base = sums.where("d = 0").select(*KEY, "first", F.lit(None).cast("long").alias("parent"), "n_convs", "n_leaves", (F.col("path_bytes") - F.col("edge_bytes")).alias("saved"))
    inner = rows.where("a is null").select("d", "first", "parent", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends_sha256"))
    outer = rows.where("a is not null").union(base).join(small(children, n_nodes), KEY, "left").join(member_digests(ends), KEY, "left")
    outer = outer.select("d", "first", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved", "ends_sha256")
    nothing = hashlib.sha256(b"").hexdigest()
    return inner.union(outer).select(
        F.col("first").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def own_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, k1, k2, size): the turns of each conversation in order, hashed."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    ranked = rank_within(rows, ["conv"], ["turn", "role", "text"], "pos")
    return ranked.select("conv", "pos", F.xxhash64(F.lit(1), "role", "text").alias("k1"), F.xxhash64(F.lit(2), "text", "role").alias("k2"), F.octet_length("text").cast("long").alias("size"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The contract's trie: conversation c is the first h turns of conversation c - c % 5, then its own after its first h."""
    own = stage(own_turns(conversations), "trie-turns")
    convs = stage(own.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "trie-convs")
    h = F.crc32(F.col("conv").cast("string")) % 9
    plan = convs.select("conv", (F.col("conv") - F.col("conv") % 5).alias("base"), h.alias("h"))
    n_convs = convs.count()
    plan = plan.join(small(convs.toDF("base", "n"), n_convs), "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken"))
    plan = small(stage(plan, "trie-plan"), n_convs)
    heads = own.where("pos <= 8").withColumnRenamed("conv", "base").join(plan, "base").where("pos <= taken").select("conv", F.col("pos").alias("d"), "k1", "k2", "size")
    tails = own.join(plan, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("d"), "k1", "k2", "size")
    return prefix_trie(heads.union(tails), convs.select("conv"))
