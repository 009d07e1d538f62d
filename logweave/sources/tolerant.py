"""Reading a log folder of which some files cannot be read to their end.

One damaged file must not stop the others: its error is reported, the lines before the
damage arrive, and all other files are read whole. A folder without damage is read once,
as :func:`logweave.sources.logfiles.read_logs` reads it. Only when that read fails are the
files told apart: groups of files are probed side by side, every failed probe names a file,
which is set aside with its error, and the rest of its group is probed again.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.plans.materialize import materialize
from logweave.sources.logfiles import lines_of

#: Groups of files that are probed at the same time.
PROBES = 8
READ_ERRORS = (PySparkException, Py4JJavaError)  # a failed task arrives as either
LINES = "raw string, line_bytes int, source_file string"


def list_log_files(spark: SparkSession, path: str, pattern: str = "*.log") -> DataFrame:
    """(file, length) of every file with content that :func:`read_logs` reads; contents are not touched.

    Raises ``PATH_NOT_FOUND`` when there is none.
    """
    found = spark.read.format("binaryFile").load(path.rstrip("/") + "/" + pattern)
    return found.select(F.col("path").alias("file"), "length")


def _reason(error: Exception) -> str:
    """The innermost cause of a failed read, on one line."""
    text = str(error)
    causes = re.findall(r"Caused by: (.*)", text)
    return (causes[-1] if causes else text).split("\n")[0].strip()[:500]


def _named(error: Exception, files: list[str]) -> list[str]:
    """The files that the error's text names (the longest names first, so that no name hides in another)."""
    text, found = str(error), []
    for name in sorted(files, key=len, reverse=True):
        shown = {name, name.replace("file:///", "file:/"), name.replace("file:/", "file:///")}
        if any(re.search(re.escape(s) + r"(?![\w.-]*\w)", text) for s in shown):
            found.append(name)
    return found


def _probe(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """file -> error of those of ``files`` that cannot be read to their end."""
    bad: dict[str, str] = {}
    groups = [list(files)]
    while groups:
        group = [f for f in groups.pop() if f not in bad]
        if not group:
            continue
        try:
            lines_of(spark, group).agg(F.sum("line_bytes")).collect()
        except READ_ERRORS as error:
            named = _named(error, group) if len(group) > 1 else group
            if named:
                bad.update({f: _reason(error) for f in named[:1]})
                groups.append(group)
            else:  # the error names no file: halve the group
                groups += [group[: len(group) // 2], group[len(group) // 2 :]]
    return bad


def unreadable_files(spark: SparkSession, path: str, pattern: str = "*.log") -> dict[str, str]:
    """file -> error of every file of a folder that cannot be read to its end."""
    files = [r.file for r in list_log_files(spark, path, pattern).select("file").collect()]
    groups = [files[k::PROBES] for k in range(PROBES) if files[k::PROBES]]
    with ThreadPoolExecutor(len(groups)) as pool:
        return {f: e for found in pool.map(lambda g: _probe(spark, g), groups) for f, e in found.items()}


def readable_lines(spark: SparkSession, path: str, bad: dict[str, str], pattern: str = "*.log") -> DataFrame:
    """Lines (``LINES``) of all files but ``bad``, and of ``bad`` what stands before the damage."""
    files = [r.file for r in list_log_files(spark, path, pattern).select("file").collect() if r.file not in bad]
    out = lines_of(spark, files, with_source_file=True) if files else spark.createDataFrame([], LINES)
    for name in sorted(bad):
        head = lines_of(spark, [name], with_source_file=True, ignoreCorruptFiles="true", ignoreMissingFiles="true")
        try:
            out = out.unionByName(materialize(head, "damaged-file"))
        except READ_ERRORS:  # not even its first bytes (no permission, gone)
            continue
    return out


def read_logs_tolerant(spark: SparkSession, path: str, pattern: str = "*.log") -> tuple[DataFrame, DataFrame]:
    """``(lines, outcomes)``: all lines that can be read, and per file its length, lines read and error (null: read whole).

    The lines are written once to ``spark.checkpoint.dir``: whether a file can be read is
    known only after it was read. Spark's listing leaves out empty files, so they have no outcome.
    """
    listed = list_log_files(spark, path, pattern)
    try:
        bad: dict[str, str] = {}
        lines = materialize(lines_of(spark, [path.rstrip("/") + "/" + pattern], with_source_file=True), "log-lines")
    except READ_ERRORS:
        bad = unreadable_files(spark, path, pattern)
        if not bad:
            raise
        lines = materialize(readable_lines(spark, path, bad, pattern), "log-lines")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731  both spellings of a local path
    counts = lines.groupBy(plain(F.col("source_file")).alias("key")).agg(F.count(F.lit(1)).alias("n_lines"))
    errors = spark.createDataFrame(list(bad.items()), "bad string, error string")
    outcomes = listed.withColumn("key", plain(F.col("file"))).join(counts, "key", "left").join(errors, F.col("file") == F.col("bad"), "left")
    return lines, outcomes.select("file", "length", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "error")
