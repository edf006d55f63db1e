"""Questions about ticks and snapshots around a point in time.

Each works for every requested point at once. Tags of single ticks are found
by aggregation and put back by sequence number, which no product can skew.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.compare import float_diff
from quotelake.functions.quotes import tick_error_codes
from quotelake.functions.times import prev_time, seconds_of_day, tick_clock, time_to_int
from quotelake.operators.intervals import range_join
from quotelake.operators.schedule import schedule_keys
from quotelake.operators.snapshots import SERIES
from quotelake.schemas import SIDE_PREFIX
from quotelake.session import bounded_broadcast, written_once

SIDE_SERIES = [*SERIES, "cp"]


def adjacent_time(schedule: DataFrame) -> DataFrame:
    """Previous and next snapshot time of every snapshot."""
    order = Window.partitionBy(*schedule_keys(schedule)).orderBy("idx")
    return schedule.withColumns(
        {"prev_time": F.lag("time").over(order), "next_time": F.lead("time").over(order)}
    )


def interval_window(
    schedule: DataFrame, requests: DataFrame, lookback: int = 1, lookforward: int = 1
) -> DataFrame:
    """Range of snapshots for each request ``(trade_date, mode, wanted_sysid)``.

    ``center`` takes intervals around the exact or closest snapshot; ``prepend``
    ends at the last snapshot not after the wanted one, ``append`` starts at
    the first not before it, both as long as the other two together.
    """
    keys = schedule_keys(schedule)
    on = [k for k in keys if k in requests.columns]
    request = [*on, "mode", "wanted_sysid"]
    gap = F.abs(F.col("sysid") - F.col("wanted_sysid"))
    anchors = (
        requests.join(schedule, on)
        .groupBy(*request)
        .agg(
            F.min(F.struct(gap, F.col("idx"))).alias("closest"),
            F.max(F.when(F.col("sysid") <= F.col("wanted_sysid"), F.col("idx"))).alias("not_after"),
            F.min(F.when(F.col("sysid") >= F.col("wanted_sysid"), F.col("idx"))).alias("not_before"),
            F.max("idx").alias("last_idx"),
        )
    )
    span = lookback + lookforward
    end = F.coalesce("not_after", F.lit(0))
    start = F.coalesce("not_before", "last_idx")
    center = F.col("closest.idx")
    by_mode = lambda c, p, a: (
        F.when(F.col("mode") == "center", c).when(F.col("mode") == "prepend", p).otherwise(a)
    )
    placed = anchors.select(
        *request,
        F.greatest(F.lit(0), by_mode(center - lookback, end - span, start)).alias("start_idx"),
        F.least("last_idx", by_mode(center + lookforward, end, start + span)).alias("end_idx"),
    )
    sysid_at = lambda idx, name: schedule.select(
        *on, F.col("idx").alias(idx), F.col("sysid").alias(name)
    )
    return (
        placed.withColumn("before_idx", F.col("start_idx") - 1)
        .join(sysid_at("before_idx", "range_start"), [*on, "before_idx"], "left")
        .join(sysid_at("end_idx", "range_end"), [*on, "end_idx"], "left")
        .fillna(0, subset=["range_start"])
        .select(*request, "start_idx", "end_idx", "range_start", "range_end")
    )


def neighbour_intervals(
    placed: DataFrame,
    schedule: DataFrame,
    before: int = 1,
    after: int = 1,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Ticks of the intervals around every snapshot.

    Each tick is handed to the few centres that see it, and an equi-join on
    the snapshot number keeps the ones that exist.
    """
    keys = schedule_keys(schedule)
    centres = schedule.select(
        *keys, F.col("idx").alias("centre_idx"), F.col("time").alias("centre_time")
    )
    spread = placed.where("idx >= 0").withColumn(
        "centre_idx", F.explode(F.sequence(F.col("idx") - after, F.col("idx") + before))
    )
    return spread.join(bounded_broadcast(centres, cfg.broadcast_bytes), [*keys, "centre_idx"], "inner")


def with_validity(ticks: DataFrame) -> DataFrame:
    """Add ``is_valid`` and ``error_codes``; a missing price counts as 0."""
    codes = tick_error_codes(F.col("bid"), F.col("ask"))
    return ticks.withColumn("error_codes", codes).withColumn(
        "is_valid", F.size("error_codes") == 0
    )


def last_min_tags(placed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Add ``tags``: LAST on the newest valid tick of an interval, MIN on the
    oldest one with the smallest spread."""
    group = Window.partitionBy(*(keys or [*SIDE_SERIES, "idx"]))
    ticks = with_validity(placed)
    seqno = F.when(F.col("is_valid"), F.col("seqno"))
    spread = F.coalesce("ask", F.lit(0.0)) - F.coalesce("bid", F.lit(0.0))
    least = F.min(F.when(F.col("is_valid"), F.struct(spread, "seqno"))).over(group)
    tags = F.array_compact(
        F.array(
            F.when(seqno == F.max(seqno).over(group), F.lit("LAST")),
            F.when(seqno == least["seqno"], F.lit("MIN")),
        )
    )
    return ticks.withColumn("tags", tags)


def tick_window(
    ticks: DataFrame, schedule: DataFrame, before: int = 500, cfg: EngineConfig = DEFAULT
) -> DataFrame:
    """Ticks of every snapshot's interval ``current`` and of the one before it.

    The part before starts ``before`` sequence numbers ahead of the previous
    snapshot; bounds given in ``schedule`` as ``curr_start, curr_end,
    prev_start, prev_end`` override the defaults.
    """
    keys = schedule_keys(schedule)
    given = lambda name, default: (
        F.coalesce(F.col(name), default) if name in schedule.columns else default
    )
    prev, sysid = F.col("prev_sysid"), F.col("sysid")
    ranges = schedule.select(
        *keys,
        F.col("idx").alias("snapshot_idx"),
        F.inline(
            F.array(
                F.struct(
                    F.lit("current").alias("part"),
                    given("curr_start", prev).alias("low"),
                    given("curr_end", sysid).alias("high"),
                ),
                F.struct(
                    F.lit("prev").alias("part"),
                    given("prev_start", prev - before).alias("low"),
                    given("prev_end", prev).alias("high"),
                ),
            )
        ),
    )
    return range_join(ticks, ranges, keys, "inner", cfg)


def tick_snapshot_interleave(
    tagged: DataFrame, schedule: DataFrame, verdicts: DataFrame, cfg: EngineConfig = DEFAULT
) -> DataFrame:
    """Ticks and snapshot rows of each series in one order of sequence numbers.

    A snapshot row comes before a tick with the same number. A tagged tick
    shows the verdict of the snapshot last passed at that point, LAST the code
    of the last quote and MIN the code of the smallest-spread quote.
    ``verdicts`` has ``idx, source, last_outlier, min_outlier`` per series; it is
    one row per snapshot and is written once, as both kinds of rows need it. Order
    the result by ``seqno, place``.
    """
    keys = schedule_keys(schedule)
    verdicts = written_once(
        verdicts.select(
            *SIDE_SERIES, "idx", "snapshot_sysid", "source", "last_outlier", "min_outlier"
        )
    )
    bounds = schedule.select(*keys, "idx", "sysid")
    passed = F.when(F.col("seqno") == F.col("sysid"), F.col("idx")).otherwise(F.col("idx") - 1)
    # Most ticks have no tag and show no verdict. A number of their own that no
    # snapshot has spreads them over the join instead of gathering them.
    own = F.lit(-2) - F.col("seqno")
    bounds = bounded_broadcast(bounds, cfg.broadcast_bytes)
    ticks = tagged.join(bounds, [*keys, "idx"], "left").withColumn(
        "verdict_idx", F.when(F.size("tags") > 0, passed.cast("bigint")).otherwise(own)
    )
    codes = verdicts.select(
        *SIDE_SERIES,
        F.col("idx").cast("bigint").alias("verdict_idx"),
        "last_outlier",
        "min_outlier",
    )
    has = lambda tag: F.array_contains("tags", tag)
    shown = ticks.join(codes, [*SIDE_SERIES, "verdict_idx"], "left").select(
        *SIDE_SERIES,
        "seqno",
        F.lit(1).alias("place"),
        F.lit("tick").alias("kind"),
        "tick_time",
        "bid",
        "ask",
        "is_valid",
        F.array_join("error_codes", ",").alias("error_codes"),
        F.array_join("tags", ",").alias("tags"),
        F.lit(None).cast("string").alias("source"),
        F.when(has("LAST"), F.col("last_outlier")).alias("last_outlier"),
        F.when(has("MIN"), F.col("min_outlier")).alias("min_outlier"),
    )
    marks = verdicts.select(
        *SIDE_SERIES,
        F.col("snapshot_sysid").alias("seqno"),
        F.lit(0).alias("place"),
        F.lit("snapshot").alias("kind"),
        F.lit(None).cast("string").alias("tick_time"),
        F.lit(None).cast("double").alias("bid"),
        F.lit(None).cast("double").alias("ask"),
        F.lit(None).cast("boolean").alias("is_valid"),
        F.lit("").alias("error_codes"),
        F.lit("").alias("tags"),
        "source",
        "last_outlier",
        "min_outlier",
    )
    return shown.unionByName(marks)


def audit_window(
    placed: DataFrame,
    schedule: DataFrame,
    lookback: int = 20,
    window: int = 15,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Ticks in the last seconds before every snapshot and which ones it selects.

    A tick is handed to the snapshots that can still see it, ``lookback`` over
    the step of the schedule. ``is_last`` marks the newest tick of a series,
    ``is_min`` the newest with the smallest spread inside ``window``.
    """
    keys = schedule_keys(schedule)
    reach = ceil(lookback / cfg.step_seconds)
    snapshots = schedule.select(
        *keys, F.col("idx").alias("snapshot_idx"), F.col("time").alias("snapshot_time")
    )
    own = F.greatest(F.col("idx"), F.lit(0))
    clock = tick_clock(F.col("tick_time"))
    second = F.lit(1_000_000).cast("bigint")
    micros = seconds_of_day(clock) * second + F.substring(clock, 7, 6).try_cast("int")
    since = micros - seconds_of_day(F.col("snapshot_time")) * second
    seen = (
        placed.withColumn(
            "snapshot_idx", F.explode(F.sequence(own, own + reach))
        )
        .join(bounded_broadcast(snapshots, cfg.broadcast_bytes), [*keys, "snapshot_idx"], "inner")
        .withColumn("since", since)
        .where(F.col("since") >= -lookback * 1_000_000)
        .withColumn("in_window", F.col("since") >= -window * 1_000_000)
        .withColumn("spread", F.col("ask") - F.col("bid"))
    )
    group = Window.partitionBy(*SIDE_SERIES, "snapshot_idx")
    newest_least = F.struct("spread", (-F.col("seqno")).alias("age"))
    least = F.min(F.when(F.col("in_window"), newest_least)).over(group)
    return seen.withColumns(
        {
            "is_last": F.col("seqno") == F.max("seqno").over(group),
            "is_min": F.coalesce(
                F.col("in_window") & (F.col("seqno") == -least["age"]), F.lit(False)
            ),
        }
    ).drop("since")


def next_prev_diff(diffs: DataFrame, series: list[str]) -> DataFrame:
    """Previous and next time with a difference for every series and time."""
    times = diffs.select(*series, "time").distinct()
    order = Window.partitionBy(*series).orderBy("time")
    return times.withColumns(
        {"prev_diff": F.lag("time").over(order), "next_diff": F.lead("time").over(order)}
    )


def calc_trace(
    ours: DataFrame, official: DataFrame, step: int = DEFAULT.step_seconds,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Inputs of each EMA step: previous average, both quotes, official value."""
    cell = [*SERIES, "time"]
    measures = ["ema", "bid", "ask", "source", "last_bid", "last_ask", "min_bid", "min_ask"]
    sides = list(SIDE_PREFIX.values())
    ahead = prev_time(F.col("time"), step)
    earlier = Window.partitionBy(*SERIES).orderBy("time")
    whole = earlier.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def step_before(value: str) -> Column:
        """The row before in time, if it is one step before; at midnight the last one."""
        before = F.when(F.lag("time").over(earlier) == ahead, F.lag(value).over(earlier))
        return before.when(F.last("time").over(whole) == ahead, F.last(value).over(whole))

    theirs = official.select(
        *cell, *[F.col(f"{p}_ema").alias(f"{p}_ema_official") for p in SIDE_PREFIX.values()]
    )
    mine = ours.select(
        *cell, "snapshot_sysid",
        *[f"{p}_{m}" for p in sides for m in measures],
        ahead.alias("prev_time"),
        *[step_before(f"{p}_ema").alias(f"{p}_ema_prev") for p in sides],
    )
    joined = mine.join(theirs, cell, "left")
    return joined.withColumns(
        {
            f"{p}_ema_differs": float_diff(F.col(f"{p}_ema"), F.col(f"{p}_ema_official"))
            for p in SIDE_PREFIX.values()
        }
    )


def same_tick_code(wide: DataFrame, prefix: str = "c") -> DataFrame:
    """Rows whose smallest-spread code is a number although both quotes are one tick."""
    code = F.col(f"{prefix}_min_outlier")
    return wide.where(
        code.isNotNull()
        & ~code.isin("-", "V")
        & (F.col(f"{prefix}_min_sysid") == F.col(f"{prefix}_last_sysid"))
    )


def first_time_without_quote(wide: DataFrame, prefix: str = "c") -> DataFrame:
    """Rows of the first time of a day whose last quote is zero on both sides."""
    of_day = Window.partitionBy("trade_date", "term")
    clock = time_to_int(F.col("time"))
    zero = (F.col(f"{prefix}_last_bid") == 0) & (F.col(f"{prefix}_last_ask") == 0)
    timed = wide.withColumn("first_clock", F.min(clock).over(of_day))
    return timed.where(zero & (clock == F.col("first_clock"))).drop("first_clock")


def index_trend(index: DataFrame, rounded, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Published and original index from the open on; nothing below zero is shown."""
    positive: Column = F.when(F.col("published") > 0, rounded(F.col("published")))
    return valid_hours(index, cfg).select(
        "trade_date",
        "time",
        positive.alias("published"),
        rounded(F.col("original")).alias("original"),
    )


def valid_hours(index: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    return index.where(F.col("time") >= cfg.session_open)
