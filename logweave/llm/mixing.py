"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks.

1. Targets: sources share ``RATIO`` times all words by weight; a target stops at
   ``MAX_PASSES`` times its source, and the excess is shared again by weight.
2. Each source's documents are laid in a line in the order of a hash of doc_id and
   cut into blocks of ``BLOCK`` words. Offsets are prefix sums over hash prefixes of
   growing length, so no window holds more than 256 prefixes or the documents of one
   four-digit prefix, however large a source is.
3. Schedule: slot k takes the k-th van der Corput point (k's bits reversed) through
   the sources' cumulative share of the slots. Ranks per source are prefix counts
   over runs of slots. Every prefix of the schedule has each source near its share.
   A source's slots beyond its quota are left out and missing ones follow at the end
   (the discrepancy bounds both by the logarithm of the slots), so the words taken
   equal the target to the word. The last slot of a source may be shorter.
4. The slots are joined with the blocks of the documents: slot r of a source takes
   its block r modulo the number of blocks, so no word is taken a second time before
   every word of its source was taken once.

Defined results: null text has no words; a document without words takes part with
size 0 and taken 0. Null source is a source of its own, last in order. Rows with
equal doc_id are told apart by size; equal rows are interchangeable. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import drop_repeated_rows, n_words, sized, stage

RATIO_PERCENT, MAX_PASSES, WEIGHTS = 150, 2, (3, 1, 2)
BLOCK = 256
BITS, CELL_BITS = 44, 12  # points are integers below 2**BITS; the guide table has 2**CELL_BITS cells
RUN, LONG_RUN = 1 << 10, 1 << 20
ORDER = "md5(coalesce(cast(doc_id as string), ''))"


def sized_documents(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, source, s, size, h, more): the words of each row and its place in the shuffled order."""
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("z"))
    return docs.select("doc_id", "source", key.alias("s"), n_words("text").alias("size"), F.expr(ORDER).alias("h"), *more)


def source_targets(sizes: DataFrame) -> DataFrame:
    """(s, source_size, target, take) per source; the windows hold one row per source."""
    totals = sizes.groupBy("s", "source").agg(F.sum("size").alias("size"))
    w = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), F.expr(f"cast((rank - 1) % {len(WEIGHTS)} as int) + 1")).cast("long")
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("w", w)
    # In the order in which rising water reaches the caps; all sums in integers (hundredths of words).
    cap = F.lit(MAX_PASSES * 100) * F.col("size")
    order = Window.orderBy((cap / F.col("w")).asc(), "rank")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    poured = ranked.select(
        "*", cap.alias("cap"), F.row_number().over(order).alias("i"),
        (F.sum("size").over(everything) * RATIO_PERCENT - F.coalesce(F.sum(cap).over(before), F.lit(0))).alias("left"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_left"),
    )
    level = F.min(F.when(F.col("cap") * F.col("w_left") >= F.col("w") * F.col("left"), F.struct("i", "left", "w_left"))).over(everything)
    target = F.when(F.col("i") < F.col("level.i"), F.col("cap") / F.lit(100.0)).otherwise(
        (F.col("w") * F.col("level.left")).cast("double") / (F.col("level.w_left") * 100).cast("double")
    )
    return poured.withColumn("level", level).select("s", F.col("size").alias("source_size"), target.alias("target"), F.floor(target + 0.5).cast("long").alias("take"))


def with_offsets(sizes: DataFrame) -> DataFrame:
    """Adds ``off``: the words of the source's line before the document."""
    cut = sizes.withColumn("p2", F.substring("h", 1, 2)).withColumn("p4", F.substring("h", 1, 4))
    fine = cut.groupBy("s", "p2", "p4").agg(F.sum("size").alias("t"))

    def before(by: list[str], order: list[str], value: str) -> Column:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(w), F.lit(0).cast("long"))

    coarse = fine.groupBy("s", "p2").agg(F.sum("t").alias("t")).select("s", "p2", before(["s"], ["p2"], "t").alias("o2"))
    fine = fine.select("s", "p2", "p4", before(["s", "p2"], ["p4"], "t").alias("o4"))
    starts = coarse.join(fine, ["s", "p2"]).select("s", "p4", (F.col("o2") + F.col("o4")).alias("start"))
    local = cut.withColumn("_in", before(["s", "p4"], ["h", "size"], "size"))
    return local.join(starts, ["s", "p4"]).withColumn("off", F.col("start") + F.col("_in")).drop("p2", "p4", "start", "_in")


def quotas(targets: DataFrame) -> DataFrame:
    """(s, n_blocks, quota, last_words): a source's blocks, its slots, and the words of its last slot."""
    full, rest = F.expr("take div source_size"), F.expr("take % source_size")
    cut = targets.where("source_size > 0 and take > 0").select("s", F.expr(f"(source_size + {BLOCK - 1}) div {BLOCK}").alias("n_blocks"), full.alias("full"), rest.alias("rest"))
    whole = F.when(F.col("rest") > 0, F.expr(f"(rest - 1) % {BLOCK} + 1")).otherwise(F.lit(BLOCK)).cast("long")
    return cut.select("s", "n_blocks", F.expr(f"full * n_blocks + (rest + {BLOCK - 1}) div {BLOCK}").alias("quota"), whole.alias("last_words"))


def schedule(quota: DataFrame) -> DataFrame:
    """(slot, s, r): the order of the mix; r is the rank of the slot among those of its source."""
    spark = quota.sparkSession
    slots = int(quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).collect()[0][0])
    ends = quota.select("s", "quota", F.sum("quota").over(Window.orderBy("s")).alias("upto"))  # one row per source
    scale = F.lit(float(1 << BITS)) / F.lit(float(max(slots, 1)))
    parts = ends.select("s", F.floor((F.col("upto") - F.col("quota")) * scale).cast("long").alias("lo"), F.floor(F.col("upto") * scale).cast("long").alias("hi")).where("lo < hi")
    cell = 1 << (BITS - CELL_BITS)
    guide = parts.select("s", "lo", "hi", F.explode(F.expr(f"sequence(lo div {cell}, (hi - 1) div {cell})")).alias("cell"))
    points = spark.range(0, slots, 1, max(spark.sparkContext.defaultParallelism, slots // 1_000_000)).select(
        F.col("id").alias("slot"), F.expr(f"cast(conv(reverse(lpad(bin(id), {BITS}, '0')), 2, 10) as bigint)").alias("x")
    )
    drawn = points.withColumn("cell", F.expr(f"x div {cell}")).join(guide, "cell").where("x >= lo and x < hi").select("slot", "s", F.expr(f"slot div {RUN}").alias("run"))
    runs = drawn.groupBy("s", "run").agg(F.count(F.lit(1)).alias("n")).withColumn("long_run", F.expr(f"run div {LONG_RUN // RUN}"))
    longer = runs.groupBy("s", "long_run").agg(F.sum("n").alias("n"))

    def before(by: list[str], order: str) -> Column:
        return F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))

    longer = longer.select("s", "long_run", before(["s"], "long_run").alias("b2"))
    runs = runs.withColumn("b1", before(["s", "long_run"], "run")).join(longer, ["s", "long_run"]).select("s", "run", (F.col("b1") + F.col("b2")).alias("base"))
    rank = F.row_number().over(Window.partitionBy("s", "run").orderBy("slot"))
    ranked = drawn.withColumn("_r", rank).join(runs, ["s", "run"]).select("slot", "s", (F.col("base") + F.col("_r") - 1).alias("r"))
    kept = ranked.join(quota.select("s", "quota"), "s").where("r < quota").select("slot", "s", "r")
    counts = drawn.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    short = quota.join(counts, "s", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long"))).where("n < quota")
    added = short.select("s", F.explode(F.expr("sequence(n, quota - 1)")).alias("r"))
    # Missing slots follow the drawn ones; (slot, s) is their order.
    return kept.union(added.select((F.lit(slots) + F.col("r")).alias("slot"), "s", "r"))


def mix(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """The mix in order: (slot, s, off, pass, words), one row per slot and document in it.

    ``lines``: documents with ``s, off, size`` (:func:`with_offsets`). ``off`` names
    the document in its source; ``words`` of it lie in the slot.
    """
    quota = stage(quotas(targets), "quotas")
    slots = schedule(quota).join(quota, "s").select(
        "slot", "s", F.expr("r % n_blocks").alias("block"), F.expr("r div n_blocks").alias("pass"),
        F.when(F.col("r") == F.col("quota") - 1, F.col("last_words")).otherwise(F.lit(BLOCK).cast("long")).alias("length"),
    )
    blocks = F.explode(F.expr(f"sequence(off div {BLOCK}, (off + size - 1) div {BLOCK})"))
    pieces = lines.where("size > 0").select("s", "off", "size", blocks.alias("block"))
    start = F.col("block") * BLOCK
    words = F.least(F.col("off") + F.col("size"), start + F.col("length")) - F.greatest(F.col("off"), start)
    return slots.join(pieces, ["s", "block"]).select("slot", "s", "off", "pass", words.alias("words")).where("words > 0")


def _laid_out(docs: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    sizes = stage(sized_documents(docs, *more), "sizes")
    return stage(with_offsets(sizes), "lines"), stage(source_targets(sizes), "targets")


def mixed_words(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken."""
    lines, targets = _laid_out(docs)
    taken = mix(lines, targets).groupBy("s", "off").agg(F.sum("words").alias("n"))
    # A document without words shares its offset with the next one.
    key = lines.withColumn("_off", F.when(F.col("size") > 0, F.col("off")))
    out = key.join(taken.withColumnRenamed("off", "_off"), ["s", "_off"], "left").join(sized(targets), "s")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("n", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows of ``docs``: one row per document and pass, with the words that the pass takes.

    Only the last document of a source's pass can be cut; n_chars, if there, follows
    its text. Rows equal in doc_id and text count once.
    """
    docs = drop_repeated_rows(docs)
    mark = F.xxhash64("text")
    lines, targets = _laid_out(docs, mark.alias("mark"))
    taken = mix(lines, targets).groupBy("s", "off", "pass").agg(F.sum("words").alias("_n"))
    picks = lines.where("size > 0").join(taken, ["s", "off"]).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("size").alias("_size"), "_n")
    rows = docs.withColumn("_m", mark).join(picks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_m") == F.col("_mark")))
    parts = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("_n") < F.col("_size"), F.array_join(F.slice(parts, F.lit(1), F.col("_n").cast("int")), "")).otherwise(F.col("text"))
    out = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
