"""Quality rules with thresholds learned from mergeable quantile sketches.

Every document gets integer measures. For each language and source a log-linear
histogram of each measure (exact below 64, then 6 significant bits: values within
1/32) is counted; such sketches merge by adding counts, so partial aggregation
does the work before the shuffle and a language's sketch is the sum of its
sources'. The quartiles of a sketch give its thresholds: a measure is an outlier
beyond ``q75 + FENCE * spread`` (the word length also below ``q25 - FENCE * spread``),
where the spread is the interquartile range, but at least the rule's resolution.
A source with fewer than ``MIN_DOCS`` documents uses its language's sketch, a
language with fewer the whole table's. The small threshold table is then joined to
the documents. DataFrame functions only; the counts are exact, so reruns agree.

Defined results: null or empty text has no words and fails the base rule. Null
language or source is a group of its own. Rows are judged one by one, so repeated
rows and null ids need no care. Columns of the input that clash with the measures
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import stage

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
FENCE, MIN_DOCS = 4, 100
#: measure -> least spread (thousandths; word length in hundredths of a character)
RULES = {"symbols": 5, "dup_lines": 100, "repeats": 100, "capitals": 20, "word_length": 50}
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, "")).cast("long")


def with_measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus the base counts, base_failed and the rules' measures (``m_<rule>``)."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        *keep,
        text.alias("_t"),
        F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "").alias("_w"),
        F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0).alias("_l"),
    )
    # Each three-word window as (hash, position), sorted: equal windows stand side by side.
    windows = F.transform("_w", lambda w, i: F.struct(F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")))
    counted = split.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        _without(F.col("_t"), BLANKS).alias("word_chars"),
        (F.length("_t") - _without(F.col("_t"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("_t") - _without(F.col("_t"), CAPITALS)).cast("long").alias("_capitals"),
        F.size("_l").cast("long").alias("_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") > 2, F.array_sort(F.slice(windows, F.lit(1), F.size("_w") - 2))).alias("_s"),
    )
    again = F.filter("_s", lambda x, i: (x.h == F.get("_s", i - 1).h) | (x.h == F.get("_s", i + 1).h))
    found = counted.select("*", F.array_sort(F.transform(again, lambda x: x.i)).alias("_p")).drop("_s")
    # Words covered by windows of three that start at the sorted positions.
    covered = F.aggregate(
        F.col("_p"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc.n + F.least(F.lit(3), p - acc.last)).alias("n"), p.alias("last")),
    )
    based = found.select("*", F.coalesce(covered.n, F.lit(0).cast("long")).alias("n_repeat_words")).drop("_p")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)

    def share(part: str, of: str, scale: int) -> Column:
        return F.expr(f"{part} * {scale} div greatest({of}, 1)")

    return based.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        share("n_symbols", "word_chars", 1000).alias("m_symbols"),
        share("n_dup_lines", "_lines", 1000).alias("m_dup_lines"),
        share("n_repeat_words", "n_words", 1000).alias("m_repeats"),
        share("_capitals", "word_chars", 1000).alias("m_capitals"),
        share("word_chars", "n_words", 100).alias("m_word_length"),
    )


def sketch(measured: DataFrame) -> DataFrame:
    """Mergeable quantile sketches: (lang, source, rule, bucket, n) of the documents that pass the base rules.

    ``bucket`` is the least value of its bucket.
    """
    pairs = ", ".join(f"'{r}', if(base_failed, null, m_{r})" for r in RULES)
    values = measured.select("lang", "source", F.expr(f"stack({len(RULES)}, {pairs}) as (rule, v)")).where("v is not null")
    drop_bits = "greatest(length(bin(v)) - 6, 0)"
    return values.groupBy("lang", "source", "rule", F.expr(f"shiftleft(shiftright(v, {drop_bits}), {drop_bits})").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, rule, docs, q25, q75) of the sketches merged to the groups ``by``."""
    merged = sketches.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "rule")  # one row per bucket: some hundreds at most
    cum = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("docs", F.sum("n").over(group))

    def at(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("docs") * percent, F.col("bucket")))

    return cum.groupBy(*by, "rule").agg(F.max("docs").alias("docs"), at(25).alias("q25"), at(75).alias("q75"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source): ``lo_<rule>`` and ``hi_<rule>``."""
    source = quartiles(sketches, ["lang", "source"]).alias("s")
    lang, whole = quartiles(sketches, ["lang"]).alias("l"), quartiles(sketches, []).alias("w")
    joined = source.join(lang, (F.col("s.rule") == F.col("l.rule")) & F.col("s.lang").eqNullSafe(F.col("l.lang"))).join(whole, F.col("s.rule") == F.col("w.rule"))

    def pick(c: str) -> Column:
        return F.when(F.col("s.docs") >= MIN_DOCS, F.col(f"s.{c}")).when(F.col("l.docs") >= MIN_DOCS, F.col(f"l.{c}")).otherwise(F.col(f"w.{c}"))

    q = joined.select("s.lang", "s.source", "s.rule", pick("q25").alias("q25"), pick("q75").alias("q75"))
    floor = F.element_at(F.create_map(*[F.lit(x) for kv in RULES.items() for x in kv]), F.col("rule"))
    spread = FENCE * F.greatest(F.col("q75") - F.col("q25"), floor)
    fences = q.select("lang", "source", "rule", (F.col("q25") - spread).alias("lo"), (F.col("q75") + spread).alias("hi"))
    return fences.groupBy("lang", "source").pivot("rule", list(RULES)).agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` joined with its group's thresholds, plus ``kept``."""
    t = limits.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    joined = measured.join(t, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    fine = F.col("m_word_length") >= F.col("word_length_lo")
    for rule in RULES:
        fine = fine & (F.col(f"m_{rule}") <= F.col(f"{rule}_hi"))
    return joined.withColumn("kept", F.coalesce(~F.col("base_failed") & fine, F.lit(False)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, base_failed, kept."""
    measured = stage(with_measures(docs, ["doc_id", "lang", "source"]), "measures")
    limits = stage(thresholds(sketch(measured)), "thresholds")
    return judged(measured, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that pass the rules; all columns stay. Measures twice and moves no text."""
    limits = stage(thresholds(sketch(with_measures(docs, ["lang", "source"]))), "thresholds")
    rows = with_measures(docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang", "source"), ["_row", "lang", "source"])
    return judged(rows, limits).where("kept").select("_row.*")
