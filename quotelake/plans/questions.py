"""Interactive questions put together from several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.operators.exploration import last_min_tags, tick_snapshot_interleave
from quotelake.operators.filtering import filtered_to_long
from quotelake.operators.intervals import assign_intervals
from quotelake.operators.schedule import schedule_keys
from quotelake.session import bounded_broadcast, small_table


def tick_stream(
    term_ticks: DataFrame,
    schedule: DataFrame,
    filtered_book: DataFrame,
    series: dict | None = None,
    window: DataFrame | None = None,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Ticks and snapshots of every series in order, with tags and verdicts.

    ``series`` narrows to given values of term, strike or cp. ``window`` has
    ``trade_date, range_start, range_end`` (see ``interval_window``) and narrows to
    what lies in one of its ranges. Both narrow ticks before anything is shuffled:
    of each date only the intervals that a range touches are looked at, whole, as tags
    depend on all their ticks. Ticks before the start marker belong to the first
    interval here.
    """
    verdicts = filtered_to_long(filtered_book)
    for column, wanted in (series or {}).items():
        term_ticks = term_ticks.where(F.col(column) == wanted)
        verdicts = verdicts.where(F.col(column) == wanted)
    if window is not None:
        schedule, term_ticks, verdicts = _touched(window, schedule, term_ticks, verdicts, cfg)
    placed = assign_intervals(term_ticks, schedule, cfg).withColumn(
        "idx", F.greatest("idx", F.lit(0))
    )
    found = tick_snapshot_interleave(last_min_tags(placed), schedule, verdicts, cfg)
    if window is None:
        return found
    ranges = window.select(
        F.col("trade_date").alias("range_date"), "range_start", "range_end"
    )
    inside = (
        (F.col("trade_date") == F.col("range_date"))
        & (F.col("seqno") > F.col("range_start"))
        & (F.col("seqno") <= F.col("range_end"))
    )
    return found.join(ranges, inside, "left_semi")


def _touched(
    window: DataFrame, schedule: DataFrame, ticks: DataFrame, verdicts: DataFrame, cfg: EngineConfig
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshots whose intervals lie within the bounds of a date's ranges, the ticks of these
    intervals, and the verdicts that a row of theirs can show.

    One row a date carries the bounds. A snapshot row at the lower end of a range is out
    of it, so the last verdict wanted is that of the interval before.
    """
    keys = schedule_keys(schedule)
    asked = window.groupBy("trade_date").agg(
        F.min("range_start").alias("start"), F.max("range_end").alias("end")
    )
    first = F.min("idx").over(Window.partitionBy(*keys))
    near = small_table(
        schedule.withColumn("first", first)
        .join(bounded_broadcast(asked, cfg.broadcast_bytes), "trade_date")
        .where("sysid > start and (prev_sysid < end or idx = first)")
    )
    # The first interval takes all ticks before it.
    low = F.min(F.when(F.col("idx") > F.col("first"), F.col("prev_sysid")).otherwise(F.lit(-(2**63))))
    bounds = near.groupBy(*keys).agg(low.alias("low"), F.max("sysid").alias("high"), F.min("idx").alias("from_idx"), F.max("idx").alias("to_idx"))
    bounds = bounded_broadcast(small_table(bounds), cfg.broadcast_bytes)
    inside = ticks.join(bounds, keys).where("seqno > low and seqno <= high").select(*ticks.columns)
    shown = verdicts.join(bounds, keys).where("idx >= from_idx - 1 and idx <= to_idx").select(*verdicts.columns)
    return near.select(*schedule.columns), inside, shown
