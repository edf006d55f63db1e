"""Volatility index from forwards, contributions and the publish filter.

Every frame is keyed by ``trade_date, time``; dates are independent and run in
parallel. A date has one row per snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.index_math import (
    index_interpolate,
    round_publish,
    variance_term,
    variance_type,
)
from quotelake.functions.times import time_to_int

POINT = ["trade_date", "time"]
TERMS = {"near": "Near", "next": "Next"}


def contrib_sum(contrib: DataFrame) -> DataFrame:
    """Sum of contributions (nulls skipped) and rows (nulls counted) per time and term."""
    return contrib.groupBy(*POINT, "term").agg(
        F.sum("contrib").alias("contrib_sum"), F.count(F.lit(1)).alias("contrib_rows")
    )


def _wide_by_term(rows: DataFrame, measures: list[str]) -> DataFrame:
    return rows.groupBy(*POINT).agg(
        *[
            F.max(F.when(F.col("term") == term, F.col(m))).alias(f"{name}_{m}")
            for name, term in TERMS.items()
            for m in measures
        ]
    )


def spine_lookup(spine: DataFrame, forward: DataFrame, contrib: DataFrame) -> DataFrame:
    """Inputs of every index time: terms, weights, forwards and contribution sums.

    ``spine`` is ``trade_date, time, near_t, near_w, next_t, next_w``. All
    three sides meet on the same key, so they share one partitioning.
    """
    forwards = _wide_by_term(forward, ["tw_fwd", "k0"])
    sums = contrib.groupBy(*POINT).agg(
        *[
            agg
            for name, term in TERMS.items()
            for agg in (
                F.sum(F.when(F.col("term") == term, F.col("contrib"))).alias(
                    f"{name}_contrib_sum"
                ),
                F.count_if(F.col("term") == term).alias(f"{name}_contrib_rows"),
            )
        ]
    )
    joined = spine.join(forwards, POINT, "left").join(sums, POINT, "left")
    return joined.fillna(0, subset=[f"{name}_contrib_rows" for name in TERMS])


def with_variances(inputs: DataFrame) -> DataFrame:
    """Add ``*_sigma2`` and ``*_type`` of both terms."""
    variances = {
        f"{name}_sigma2": variance_term(
            F.col(f"{name}_t"),
            F.col(f"{name}_contrib_sum"),
            F.col(f"{name}_contrib_rows"),
            F.col(f"{name}_tw_fwd"),
            F.col(f"{name}_k0"),
        )
        for name in TERMS
    }
    types = {
        f"{name}_type": variance_type(F.col(f"{name}_sigma2"), F.col(f"{name}_contrib_rows"))
        for name in TERMS
    }
    return inputs.withColumns(variances).withColumns(types)


def with_computed_index(variances: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    return variances.withColumn(
        "computed",
        index_interpolate(
            *[F.col(f"{n}_{m}") for n in TERMS for m in ("t", "w", "sigma2")], cfg=cfg
        ),
    )


def day_close(index: DataFrame) -> DataFrame:
    """Last published index of each date, else last original one, else null."""
    positive = lambda c: F.max_by(
        F.col(c), F.when(F.col(c) > 0, time_to_int(F.col("time")))
    )
    return index.groupBy("trade_date").agg(
        F.coalesce(positive("published"), positive("original")).alias("close")
    )


def prior_date(dates: DataFrame) -> DataFrame:
    """Largest available date before each date."""
    days = dates.select("trade_date").distinct()
    # One row per trading day, a few thousand in total.
    order = Window.partitionBy(F.lit(0)).orderBy("trade_date")
    return days.select("trade_date", F.lag("trade_date").over(order).alias("prior_date"))


def prior_close(index: DataFrame, seed_close: float | None = None) -> DataFrame:
    """Close of the previous date; ``seed_close`` serves the first date."""
    closes = day_close(index)
    previous = closes.select(
        F.col("trade_date").alias("prior_date"), F.col("close").alias("prior_close")
    )
    joined = prior_date(closes).join(previous, "prior_date", "left")
    seeded = F.when(
        F.col("prior_date").isNull(), F.lit(seed_close).cast("double")
    ).otherwise(F.col("prior_close"))
    return joined.select("trade_date", "prior_date", seeded.alias("prior_close"))


def index_locf(computed: DataFrame) -> DataFrame:
    """Add ``original``: computed, else the last computed of the day, else prior close."""
    so_far = (
        Window.partitionBy("trade_date")
        .orderBy("time")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return computed.withColumn(
        "original",
        F.coalesce(
            F.last("computed", ignorenulls=True).over(so_far), F.col("prior_close")
        ),
    )


def _publish_step(acc: Column, row: Column, cfg: EngineConfig) -> Column:
    """One step of the publish filter over ``(prev, jumps, opened, out)``."""
    original = row["original"]
    usable = F.coalesce(original > 0, F.lit(False))
    rounded = round_publish(original)
    before_open = row["time"] < cfg.session_open
    opening = ~before_open & ~acc["opened"]
    has_prev = F.coalesce(acc["prev"] >= 0, F.lit(False))
    jump = has_prev & F.coalesce(
        F.try_divide(F.abs(original - acc["prev"]), acc["prev"]) > cfg.jump_ratio, F.lit(False)
    )
    forced = jump & (acc["jumps"] + 1 >= cfg.jump_limit)
    regular = ~before_open & ~opening
    held = regular & usable & jump & ~forced
    accept = (opening & usable) | (regular & usable & ~held)
    keep_last = F.when(acc["prev"] > 0, acc["prev"]).otherwise(F.lit(-1.0))
    published = (
        F.when(accept, rounded)
        .when(held, acc["prev"])
        .when(regular & ~usable, keep_last)
        .otherwise(F.lit(-1.0))
    )
    jumps = (
        F.when(held, acc["jumps"] + 1).when(regular & ~usable, acc["jumps"]).otherwise(F.lit(0))
    )
    return F.struct(
        F.when(accept, rounded).otherwise(acc["prev"]).alias("prev"),
        jumps.alias("jumps"),
        (acc["opened"] | ~before_open).alias("opened"),
        F.array_append(acc["out"], published).alias("out"),
    )


def publish_filter(series: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Add ``published`` to ``(trade_date, time, original, prior_close, ...)``.

    Nothing is published before the open, the first point after it is; later
    points that jump by more than the ratio are held back until the limit of
    consecutive jumps. The state runs along one date, whose list is as long as
    the day has snapshots.
    """
    others = [c for c in series.columns if c not in ("trade_date", "prior_close")]
    row = F.struct("time", *[c for c in others if c != "time"])
    days = series.groupBy("trade_date").agg(
        F.sort_array(F.collect_list(row)).alias("rows"),
        F.first("prior_close").alias("prior_close"),
    )
    start = F.struct(
        F.col("prior_close").cast("double").alias("prev"),
        F.lit(0).alias("jumps"),
        F.lit(False).alias("opened"),
        F.array().cast("array<double>").alias("out"),
    )
    folded = F.aggregate(
        "rows", start, lambda acc, r: _publish_step(acc, r, cfg), lambda acc: acc["out"]
    )
    paired = F.arrays_zip(F.col("rows").alias("r"), folded.alias("published"))
    return (
        days.select("trade_date", "prior_close", F.explode(paired).alias("z"))
        .select("trade_date", "prior_close", "z.r.*", "z.published")
    )


def index_series(
    spine: DataFrame,
    forward: DataFrame,
    contrib: DataFrame,
    official_index: DataFrame,
    seed_close: float | None = None,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """The whole index of every date."""
    computed = with_computed_index(with_variances(spine_lookup(spine, forward, contrib)), cfg)
    closes = prior_close(official_index, seed_close).select("trade_date", "prior_close")
    original = index_locf(computed.join(closes, "trade_date", "left"))
    published = publish_filter(original, cfg)
    return published.select(
        *POINT,
        *[f"{n}_{m}" for n in TERMS for m in ("t", "w", "sigma2", "type")],
        "published",
        F.when(F.col("original") > 0, F.col("original")).otherwise(-1.0).alias("original"),
        *[f"{n}_contrib_rows" for n in TERMS],
    )


def contrib_share(contrib: DataFrame) -> DataFrame:
    """Contribution in percent of the largest of its snapshot, between 1 and 100."""
    number = F.coalesce(F.col("contrib"), F.lit(0.0))
    largest = F.max(number).over(Window.partitionBy(*POINT, "term"))
    share = F.least(F.lit(100.0), F.greatest(F.lit(1.0), number / largest * 100))
    return contrib.withColumn(
        "share", F.when((largest > 0) & (number > 0), share).otherwise(0.0)
    )


def contrib_snapshot(contrib: DataFrame) -> DataFrame:
    """Contributions with the at-the-money strike flagged, marker rows removed.

    A row without contribution marks the at-the-money strike of its snapshot.
    """
    marker = F.col("contrib").isNull()
    whole = Window.partitionBy(*POINT, "term")
    return (
        contrib.withColumn("atm_strike", F.min(F.when(marker, F.col("strike"))).over(whole))
        .where(~marker)
        .withColumn("is_atm", F.coalesce(F.col("strike") == F.col("atm_strike"), F.lit(False)))
    )
