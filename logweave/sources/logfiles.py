"""Log-file sources (batch and streaming).

A log directory holds ``*.log`` text files, one entry per line. Lines are split at
``\\n`` only (Spark's default reader would also split at a lone ``\\r``), one
trailing ``\\r`` is stripped and empty lines are dropped; whitespace-only lines
are kept and rejected later by the parser. Files in sub-directories are not read.
Like any Spark file source, names starting with ``.`` or ``_`` are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _shape(lines: DataFrame, with_source_file: bool) -> DataFrame:
    v = F.col("value")
    cols = [
        F.when(v.endswith("\r"), F.left(v, F.length(v) - 1)).otherwise(v).alias("raw"),
        F.octet_length("value").alias("line_bytes"),
    ]
    if with_source_file:
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    return lines.select(*cols).where(F.col("raw") != "")


def lines_of(spark: SparkSession, paths: list[str], with_source_file: bool = False, **options: str) -> DataFrame:
    """Lines of the given files or globs; ``options`` go to Spark's text reader."""
    return _shape(spark.read.options(lineSep="\n", **options).text(paths), with_source_file)


def read_logs(spark: SparkSession, path: str, pattern: str = "*.log", with_source_file: bool = False) -> DataFrame:
    """Read every ``pattern`` file directly inside ``path``.

    Returns ``raw, line_bytes`` (+ ``source_file`` on request: it makes the scan
    read the file metadata). Raises ``PATH_NOT_FOUND`` when no file matches.
    Large files are split across tasks by Spark. A file that cannot be read fails the job;
    see :mod:`logweave.sources.tolerant`.
    """
    return lines_of(spark, [path.rstrip("/") + "/" + pattern], with_source_file)


def stream_logs(
    spark: SparkSession, path: str, pattern: str = "*.log", max_files_per_trigger: int | None = None, with_source_file: bool = False
) -> DataFrame:
    """Streaming form of :func:`read_logs` over a directory that receives new files."""
    reader = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _shape(reader.schema(T.StructType([T.StructField("value", T.StringType())])).text(path), with_source_file)
