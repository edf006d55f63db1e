"""Assigning ticks to the snapshot interval ``(prev_sysid, sysid]``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.operators.schedule import schedule_keys
from quotelake.session import bounded_broadcast


def _bucket(seqno: str, width: int):
    return F.floor(F.col(seqno) / F.lit(width)).cast("bigint")


def bucketed_ranges(ranges: DataFrame, width: int) -> DataFrame:
    """One row per sequence-number bucket that ``(low, high]`` touches."""
    spread = F.explode(F.sequence(_bucket("low", width), _bucket("high", width)))
    return ranges.where("high > low").select("*", spread.alias("bucket"))


def range_join(
    ticks: DataFrame,
    ranges: DataFrame,
    keys: list[str],
    how: str = "inner",
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Ticks with the ranges ``low < seqno <= high`` of the same keys.

    The range condition becomes an equi-join on sequence-number buckets.
    Sequence numbers are unique, so no bucket can be hot, however the ticks
    spread over products. With ranges of proven size no tick is shuffled;
    above the bound both sides meet by hash of keys and bucket.
    """
    tagged = ticks.withColumn("bucket", _bucket("seqno", cfg.seqno_bucket)).alias("t")
    spread = bucketed_ranges(ranges, cfg.seqno_bucket)
    r = bounded_broadcast(spread, cfg.broadcast_bytes).alias("r")
    condition = (F.col("t.seqno") > F.col("r.low")) & (F.col("t.seqno") <= F.col("r.high"))
    for k in [*keys, "bucket"]:
        condition = condition & (F.col(f"t.{k}") == F.col(f"r.{k}"))
    payload = [F.col(f"r.{c}") for c in ranges.columns if c not in keys]
    return tagged.join(r, condition, how).select(
        *[F.col(f"t.{c}") for c in ticks.columns], *payload
    )


def _placed(ticks: DataFrame, schedule: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Ticks with ``idx`` (null outside), ``low``, ``high`` and the bounds of the day."""
    keys = schedule_keys(schedule)
    bounds = schedule.groupBy(*keys).agg(
        F.min("prev_sysid").alias("first_bound"),
        F.max("sysid").alias("last_bound"),
        F.max("idx").alias("last_idx"),
    )
    ranges = schedule.select(
        *keys, "idx", F.col("prev_sysid").alias("low"), F.col("sysid").alias("high")
    )
    inside = ticks.join(bounded_broadcast(bounds, cfg.broadcast_bytes), keys, "inner")
    return range_join(inside, ranges, keys, "left", cfg)


def assign_intervals(
    ticks: DataFrame, schedule: DataFrame, cfg: EngineConfig = DEFAULT
) -> DataFrame:
    """Add ``idx`` of the interval ``(prev_sysid, sysid]`` a tick falls into.

    Ticks up to the start marker get -1, ticks after the last snapshot are
    dropped.
    """
    return (
        _placed(ticks, schedule, cfg)
        .where("idx is not null or seqno <= first_bound")
        .withColumn("idx", F.coalesce("idx", F.lit(-1)))
        .drop("low", "high", "first_bound", "last_bound", "last_idx")
    )


def interval_join(
    ticks: DataFrame, schedule: DataFrame, cfg: EngineConfig = DEFAULT
) -> DataFrame:
    """Ticks with time and bounds of their interval; others drop out."""
    keys = schedule_keys(schedule)
    ranges = schedule.select(
        *keys, "idx", "time", F.col("prev_sysid").alias("low"), F.col("sysid").alias("high")
    )
    return range_join(ticks, ranges, keys, "inner", cfg)


def nearest_snapshot(
    ticks: DataFrame, schedule: DataFrame, cfg: EngineConfig = DEFAULT
) -> DataFrame:
    """Add ``nearest_idx``: the snapshot closest to a tick, the earlier one on a tie.

    Only the two snapshots around a tick can be the closest.
    """
    to_next = F.col("high") - F.col("seqno")
    to_prev = F.col("seqno") - F.col("low")
    nearest = (
        F.when(F.col("idx").isNull() & (F.col("seqno") > F.col("first_bound")), F.col("last_idx"))
        .when(F.coalesce("idx", F.lit(0)) == 0, F.lit(0))
        .when(to_prev <= to_next, F.col("idx") - 1)
        .otherwise(F.col("idx"))
    )
    return _placed(ticks, schedule, cfg).withColumn("nearest_idx", nearest).drop(
        "idx", "low", "high", "first_bound", "last_bound", "last_idx"
    )
