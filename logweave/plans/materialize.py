"""Write a derived table once to the session's shared checkpoint folder and read it back.

A written table cuts lineage (a lost executor re-reads files instead of
recomputing the plan) and computes the plan once, where an RDD checkpoint
computes it for the action and again for the write. Tables stay until
:func:`cleanup`, or until the end of the :func:`scratch` block that wrote them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from logweave.session import ensure_checkpoint_dir

#: Tables that this process has written and not yet removed.
_WRITTEN: list[str] = []


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its path object (works on any store Spark reads)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``, removed by :func:`cleanup`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that start inside the block go when the query ends; the setting is put back after it."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_table(df: DataFrame, name: str, write: Callable[[DataFrameWriter, str], None] = DataFrameWriter.parquet) -> str:
    """Write ``df`` as parquet to a new folder under ``spark.checkpoint.dir``; return its path.

    The written table stands for the plan, whose shuffle files nobody reads again.
    """
    path = new_folder(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession):
        write(df.write.format("parquet").option("compression", "zstd"), path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Persist ``df`` with :func:`write_table` and return the written table."""
    path = write_table(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # known schema: no inference, empty tables too


def written() -> int:
    """How many tables this process has written and not yet removed."""
    return len(_WRITTEN)


def cleanup(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Remove the tables written so far (from the ``since``-th on, up to the ``until``-th if given); returns how many.

    DataFrames that still read them fail afterwards, so call it when results are stored.
    """
    gone = _WRITTEN[since:until]
    del _WRITTEN[since:until]
    for path in gone:
        fs, p = file_system(spark, path)
        fs.delete(p, True)
    return len(gone)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside the block are removed at its end; store results before that."""
    since = len(_WRITTEN)
    try:
        yield
    finally:
        cleanup(spark, since)
