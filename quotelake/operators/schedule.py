"""Snapshot schedules, templates and the grid of expected cells.

A schedule has ``trade_date [, term], idx, time, sysid, prev_sysid``; ``idx``
counts from 0 within a date (and term), ``prev_sysid`` of the first entry is
the start marker of the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.times import pad_time, time_to_int


def schedule_keys(schedule: DataFrame) -> list[str]:
    return [k for k in ("trade_date", "term") if k in schedule.columns]


def number_schedule(times: DataFrame, marker: DataFrame) -> DataFrame:
    """Add ``idx`` and ``prev_sysid`` to ``(keys, time, sysid)``.

    ``marker`` holds ``initial_sysid`` per date (and term).
    """
    keys = schedule_keys(times)
    order = Window.partitionBy(*keys).orderBy("sysid", "time")
    on = [k for k in keys if k in marker.columns]
    return (
        times.join(marker.select(*on, "initial_sysid"), on, "left")
        .withColumns(
            {
                "idx": F.row_number().over(order) - 1,
                "prev_sysid": F.coalesce(
                    F.lag("sysid").over(order), F.col("initial_sysid"), F.lit(0)
                ),
            }
        )
        .select(*keys, "idx", "time", "sysid", "prev_sysid")
    )


def snapshot_schedule(official: DataFrame) -> DataFrame:
    """First sequence number seen per distinct time of the official rows."""
    keys = schedule_keys(official)
    order = "line_no" if "line_no" in official.columns else "snapshot_sysid"
    return (
        official.where(F.col("strike").isNotNull())
        .groupBy(*keys, pad_time(F.col("time")).alias("time"))
        .agg(F.min_by("snapshot_sysid", order).alias("sysid"))
    )


def snapshot_schedule_last(official: DataFrame, marker: DataFrame) -> DataFrame:
    """Variant: last sequence number per time, with the start row as first entry."""
    keys = schedule_keys(official)
    order = "line_no" if "line_no" in official.columns else "snapshot_sysid"
    times = (
        official.where(F.col("strike").isNotNull())
        .groupBy(*keys, pad_time(F.col("time")).alias("time"))
        .agg(F.max_by("snapshot_sysid", order).alias("sysid"))
    )
    start = marker.select(*keys, "time", F.col("initial_sysid").alias("sysid"))
    return times.unionByName(start)


def template_strikes(official: DataFrame) -> DataFrame:
    """Distinct strikes of the first time of a date (and term)."""
    keys = schedule_keys(official)
    rows = official.where(F.col("strike").isNotNull()).select(
        *keys, "strike", time_to_int(F.col("time")).alias("clock")
    )
    first = rows.groupBy(*keys).agg(F.min("clock").alias("clock"))
    return rows.join(first, [*keys, "clock"], "left_semi").select(*keys, "strike").distinct()


def schedule_entries(schedule: DataFrame, with_start: bool = False) -> DataFrame:
    """One row per date (and term) holding the ordered list of its snapshots.

    The list is as long as a day has snapshots. ``with_start`` puts the start
    marker before them as entry -1.
    """
    keys = schedule_keys(schedule)
    entry = F.struct("idx", "time", F.col("sysid"), F.col("prev_sysid"))
    grouped = schedule.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    if not with_start:
        return grouped
    first = F.col("entries")[0]
    start = F.struct(
        F.lit(-1).alias("idx"),
        F.lit(None).cast("string").alias("time"),
        first["prev_sysid"].alias("sysid"),
        F.lit(None).cast("bigint").alias("prev_sysid"),
    )
    return grouped.withColumn("entries", F.concat(F.array(start), F.col("entries")))


def strike_grid(schedule: DataFrame, strikes: DataFrame, with_start: bool = False) -> DataFrame:
    """Every snapshot of every template strike: an equi-join, then one explode.

    The rows that are joined are one per strike and one per day; the grid
    itself unfolds on the tasks that own the strikes.
    """
    entries = schedule_entries(schedule, with_start)
    on = schedule_keys(schedule)
    return strikes.join(entries, on, "inner").select(
        *strikes.columns, F.inline("entries")
    )


def grid_template(schedule: DataFrame, strikes: DataFrame) -> DataFrame:
    """The full template ``snapshot x strike x {Call, Put}``."""
    sides = F.explode(F.array(F.lit("Call"), F.lit("Put"))).alias("cp")
    return strike_grid(schedule, strikes).select("*", sides)
