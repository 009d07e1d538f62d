"""Correlation: drop repeated lines, group entries by request id, order them.

Scale notes
-----------
* ``dedup_entries`` hashes on ``(request_id, raw)``: a request id holding a third
  of all lines is still spread over all shuffle partitions.
* Group bounds are partial aggregates (map-side combine), so a hot request id
  contributes one row per map task to the shuffle.
* Entry order inside a group and the order of groups use ``rank_within``
  (range partitioning), never a window that puts one group into one task. The
  nested "group with all its entries" value is not built: it would put an
  unbounded list into one row. Bounded nested lists exist where the feature
  bounds them (the prompt keeps at most ``prompt_max_entries`` lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.operators.parse import ENTRY_COLUMNS
from logweave.operators.ranking import rank_within

ENTRY_ORDER = ["ts", "ts_nanos", "raw"]


def dedup_entries(entries: DataFrame) -> DataFrame:
    """Keep one entry per ``(request_id, raw)``: a repeated line counts once.

    Every entry column is a deterministic function of ``raw``, so this is a
    ``DISTINCT`` over the entry columns: a hash aggregate (partial, map-side)
    instead of the sort-based aggregate ``dropDuplicates`` needs for string
    columns. Columns outside the entry schema (e.g. ``source_file``) are dropped:
    copies of one line from two files are one entry.
    """
    return entries.select(*ENTRY_COLUMNS).distinct()


def group_bounds(entries: DataFrame) -> DataFrame:
    """Per request: first and last entry instant (with offset) and entry count.

    Expects deduplicated entries when ``n_entries`` is used; start and end are
    the same with or without repeats.
    """
    first = F.min(F.struct("ts", "ts_nanos", "raw", "tz_offset"))
    last = F.max(F.struct("ts", "ts_nanos", "raw", "tz_offset"))
    return (
        entries.groupBy("request_id")
        .agg(first.alias("_first"), last.alias("_last"), F.count(F.lit(1)).alias("n_entries"))
        .select(
            "request_id",
            F.col("_first.ts").alias("start_ts"),
            F.col("_first.ts_nanos").alias("start_nanos"),
            F.col("_first.tz_offset").alias("start_tz"),
            F.col("_last.ts").alias("end_ts"),
            F.col("_last.ts_nanos").alias("end_nanos"),
            F.col("_last.tz_offset").alias("end_tz"),
            "n_entries",
        )
    )


def correlate(entries: DataFrame) -> DataFrame:
    """Deduplicated entries with ``entry_pos``: 1-based chronological position in the request."""
    return rank_within(dedup_entries(entries), ["request_id"], ENTRY_ORDER, name="entry_pos")


def group_order(bounds: DataFrame) -> DataFrame:
    """Add ``group_pos``: position of the request by start time (ties by request id)."""
    return rank_within(bounds, [], ["start_ts", "start_nanos", "request_id"], name="group_pos")


def correlation_stats(entries: DataFrame) -> DataFrame:
    """Entries read (before dedup) and request groups: one row."""
    return entries.agg(
        F.count(F.lit(1)).alias("entries_read"),
        F.count_distinct("request_id").alias("request_groups"),
    )
