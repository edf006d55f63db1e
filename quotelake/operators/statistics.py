"""Counts and rates over quotes and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.quotes import valid_quote
from quotelake.functions.times import pad_time, time_to_int

VERDICTS = ("Passed", "Mismatch", "Skipped")


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def dropped_by_date(ticks: DataFrame) -> DataFrame:
    """Rows kept and dropped per ``file`` when only its ``target_date`` is wanted."""
    same = F.trim("file_date") == F.col("target_date")
    return ticks.groupBy("file").agg(
        F.count_if(same).alias("kept"), F.count_if(~same).alias("dropped")
    )


def diff_summary(diffs: DataFrame, compared: DataFrame, columns: list[str]) -> DataFrame:
    """Differences per term and column; columns without any show the compared rows.

    ``compared`` counts the compared rows per term in ``total``.
    """
    listed = compared.select(
        "term", "total", F.explode(F.array(*[F.lit(c) for c in columns])).alias("column")
    )
    counted = diffs.groupBy("term", "column").agg(F.count(F.lit(1)).alias("diffs"))
    return (
        listed.join(counted, ["term", "column"], "left")
        .fillna(0, subset=["diffs"])
        .withColumn("no_diff_rows", F.when(F.col("diffs") == 0, F.col("total")))
    )


def match_rate(matched: DataFrame, tolerances: dict[str, float]) -> DataFrame:
    """Matched, total and percent per column; a missing value counts as a match."""
    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(
                    F.abs(F.col(f"{c}_ours") - F.col(f"{c}_official")) <= tol, F.lit(True)
                ).alias("match"),
            )
            for c, tol in tolerances.items()
        ]
    )
    return _rate(matched.select(F.inline(checks)))


def _rate(checks: DataFrame) -> DataFrame:
    return (
        checks.groupBy("column")
        .agg(F.count_if("match").alias("matched"), F.count(F.lit(1)).alias("total"))
        .withColumn("match_percent", percent(F.col("matched"), F.col("total")))
    )


def outlier_match_rate(matched: DataFrame, columns: list[str]) -> DataFrame:
    """Outlier codes that are equal, or both decided."""
    def agree(c: str) -> Column:
        a = F.coalesce(F.col(f"{c}_ours"), F.lit("-"))
        b = F.coalesce(F.col(f"{c}_official"), F.lit("-"))
        return (a == b) | ((a != "-") & (b != "-"))

    checks = F.array(
        *[F.struct(F.lit(c).alias("column"), agree(c).alias("match")) for c in columns]
    )
    return _rate(matched.select(F.inline(checks)))


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distribution of each column, nulls included, as texts."""
    values = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return rows.select(F.inline(values)).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )


def diff_profile(diffs: DataFrame) -> DataFrame:
    """Spread of the differences per term and column.

    Distinct times and strikes are counted after a grouping on them, so a
    column with most of the differences does not fill one task with rows.
    """
    gap = F.col("ours") - F.col("official")
    return (
        diffs.withColumn("gap", gap)
        .groupBy("term", "column")
        .agg(
            F.count(F.lit(1)).alias("diffs"),
            F.countDistinct("time").alias("times"),
            F.countDistinct("strike").alias("strikes"),
            F.count_if(F.col("ours").isNull()).alias("ours_missing"),
            F.avg("gap").alias("mean_gap"),
            F.min("gap").alias("min_gap"),
            F.max("gap").alias("max_gap"),
        )
    )


def diff_peaks(diffs: DataFrame) -> DataFrame:
    """Mean and largest number of differences per time, and when it is reached."""
    per_time = diffs.groupBy("term", "column", "trade_date", "time").agg(
        F.count(F.lit(1)).alias("n")
    )
    moment = F.struct((-F.col("n")).alias("n"), "trade_date", "time")
    return (
        per_time.groupBy("term", "column")
        .agg(F.avg("n").alias("mean_per_time"), F.max("n").alias("max_per_time"),
             F.min(moment).alias("peak"))
        .select("term", "column", "mean_per_time", "max_per_time",
                F.col("peak.trade_date").alias("peak_date"),
                F.col("peak.time").alias("peak_time"))
    )


def validity_stats(long: DataFrame) -> DataFrame:
    """Totals and valid percent of the last and the smallest-spread quote per term."""
    last = valid_quote(F.col("last_bid"), F.col("last_ask"))
    least = valid_quote(F.col("min_bid"), F.col("min_ask"))
    return (
        long.groupBy("trade_date", "term")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(last).alias("last_valid"),
            F.count_if(least).alias("min_valid"),
        )
        .withColumns(
            {
                "last_percent": percent(F.col("last_valid"), F.col("total")),
                "min_percent": percent(F.col("min_valid"), F.col("total")),
            }
        )
    )


def daily_verdict(calendar: DataFrame, available: DataFrame, diffs: DataFrame) -> DataFrame:
    """Passed, Mismatch or Skipped for every date of a calendar."""
    counted = diffs.groupBy("trade_date").agg(F.count(F.lit(1)).alias("diffs"))
    present = available.select("trade_date").distinct().withColumn("present", F.lit(True))
    verdict = (
        F.when(F.col("present").isNull(), "Skipped")
        .when(F.coalesce(F.col("diffs"), F.lit(0)) == 0, "Passed")
        .otherwise("Mismatch")
    )
    return (
        calendar.join(present, "trade_date", "left")
        .join(counted, "trade_date", "left")
        .select(
            "trade_date",
            verdict.alias("status"),
            F.coalesce(F.col("diffs"), F.lit(0)).alias("diffs"),
        )
    )


def grid_reconcile(quotes: DataFrame) -> DataFrame:
    """Whether times x strikes equals the rows of each date and term.

    Cells are made distinct first; both counts then run over small groups.
    """
    cells = quotes.select("trade_date", "term", "time", "strike")
    return (
        cells.groupBy("trade_date", "term")
        .agg(
            F.count_distinct("time").alias("times"),
            F.count_distinct("strike").alias("strikes"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumn("complete", F.col("times") * F.col("strikes") == F.col("rows"))
    )


SIDE_SERIES = ["trade_date", "term", "strike", "cp"]


def _first_source(quotes: DataFrame) -> DataFrame:
    own = F.when(F.col("source").isNotNull(), time_to_int(F.col("time")))
    return quotes.groupBy(*SIDE_SERIES).agg(
        F.min(own).alias("first"), F.count_if(F.col("source").isNull()).alias("times_without")
    )


def _too_early() -> Column:
    """Whether a time is before its series' first source; always, where it has none."""
    return F.coalesce(F.col("clock") < F.col("first"), F.lit(True))


def diffs_by_time(quotes: DataFrame, diffs: DataFrame) -> DataFrame:
    """Number of differences of each side of a strike at each time that has any, beside the
    first time that side has a source.

    ``before_first`` marks times before it. Differences are counted on the map side; a
    series of one side only in ``diffs`` has no first time.
    """
    counted = diffs.groupBy(*SIDE_SERIES, time_to_int(F.col("time")).alias("clock")).agg(
        F.count(F.lit(1)).alias("diffs")
    )
    return counted.join(_first_source(quotes), SIDE_SERIES, "left").select(
        *SIDE_SERIES,
        pad_time(F.col("clock")).alias("time"),
        "diffs",
        pad_time(F.col("first")).alias("first_time"),
        _too_early().alias("before_first"),
    )


def first_seen(quotes: DataFrame, diffs: DataFrame | None = None) -> DataFrame:
    """First time each side of a strike has a source, and how often it has none.

    With ``diffs`` also how many differences the series has, and how many of them at
    times before its first source. One row a series, quotes and differences folded
    before they meet.
    """
    found = _first_source(quotes)
    if diffs is not None:
        times = diffs_by_time(quotes, diffs)
        early = F.when(F.col("before_first"), F.col("diffs"))
        totals = times.groupBy(*SIDE_SERIES).agg(
            F.sum("diffs").alias("diffs"), F.sum(early).alias("diffs_before")
        )
        found = found.join(totals, SIDE_SERIES, "left").fillna(0, ["diffs", "diffs_before"])
    return found.withColumn("first_time", pad_time(F.col("first"))).drop("first")
