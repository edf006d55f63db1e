"""Reconciling computed quotes and indices with an official result set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.compare import float_diff, text_or_number_diff
from quotelake.operators.reshape import SIDE_MEASURES

CELL = ["trade_date", "term", "time", "strike", "cp"]
INDEX_VALUES = ["near_sigma2", "next_sigma2", "published", "original"]
SIGMA_TOLERANCE = 1e-6
INDEX_TOLERANCE = 0.01


def int_key(text: Column) -> Column:
    """Numeric text as an integer key; anything else is key 0."""
    return F.coalesce(text.cast("string").try_cast("double"), F.lit(0.0)).cast("int")


def prev_sysid(official_long: DataFrame, keys: list[str], sysid: str = "last_sysid") -> DataFrame:
    """Add the sequence number one time earlier in the series; 0 for the first."""
    order = Window.partitionBy(*keys).orderBy("time")
    return official_long.withColumn(
        "prev_sysid", F.lag(F.coalesce(F.col(sysid), F.lit(0)), 1, 0).over(order)
    )


def match_inner(ours: DataFrame, official: DataFrame, keys: list[str]) -> DataFrame:
    """Pair our rows with official rows; other columns get a suffix."""
    rename = lambda df, tail: df.select(
        *keys, *[F.col(c).alias(f"{c}_{tail}") for c in df.columns if c not in keys]
    )
    return rename(ours, "ours").join(rename(official, "official"), keys, "inner")


def match_outer(ours: DataFrame, official: DataFrame, keys: list[str]) -> DataFrame:
    rename = lambda df, tail: df.select(
        *keys, *[F.col(c).alias(f"{c}_{tail}") for c in df.columns if c not in keys]
    )
    return rename(ours, "ours").join(rename(official, "official"), keys, "full_outer")


def melt_diffs(
    matched: DataFrame,
    keys: list[str],
    checks: dict[str, str],
    extra: list[str] | None = None,
    tolerance: float = DEFAULT.diff_tolerance,
) -> DataFrame:
    """One row per differing (key, column) with both values.

    ``checks`` maps a measure to its report name. One pass over the pairs:
    the checks become an array that is filtered before it is exploded.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(label).alias("column"),
                F.col(f"{m}_ours").alias("ours"),
                F.col(f"{m}_official").alias("official"),
            )
            for m, label in checks.items()
        ]
    )
    differing = F.filter(entries, lambda e: float_diff(e["ours"], e["official"], tolerance))
    return matched.select(*keys, *(extra or []), F.inline(differing))


def quote_diffs(matched: DataFrame, keys: list[str], extra: list[str] | None = None) -> DataFrame:
    return melt_diffs(matched, keys, SIDE_MEASURES, extra)


def diff_report(
    ours_long: DataFrame,
    official_long: DataFrame,
    series: list[str],
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Differences of the eight compared columns with both sequence numbers."""
    official = prev_sysid(official_long, series)
    keep = [*CELL, *SIDE_MEASURES]
    matched = match_inner(
        ours_long.select(*keep),
        official.select(*keep, F.col("last_sysid").alias("sysid"), "prev_sysid"),
        CELL,
    )
    return melt_diffs(
        matched,
        CELL,
        SIDE_MEASURES,
        [F.col("sysid_official").alias("sysid"), F.col("prev_sysid_official").alias("prev_sysid")],
        cfg.diff_tolerance,
    )


def differing_columns(
    matched: DataFrame, columns: list[str], tolerance: float = 1e-5
) -> Column:
    """Names of the columns that differ in a matched row, in the given order."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    text_or_number_diff(
                        F.col(f"{c}_ours"), F.col(f"{c}_official"), tolerance
                    ),
                    F.lit(c),
                )
                for c in columns
            ]
        )
    )


def gamma_diff_list(matched: DataFrame, keys: list[str], tolerance: float = 0.01) -> DataFrame:
    """Gamma differences by side from a matched wide frame."""
    sides = F.array(
        *[
            F.struct(
                F.lit(cp).alias("cp"),
                F.col(f"{p}_gamma_ours").alias("ours"),
                F.col(f"{p}_gamma_official").alias("official"),
            )
            for cp, p in (("Call", "c"), ("Put", "p"))
        ]
    )
    over = F.filter(
        sides,
        lambda s: F.coalesce(F.abs(s["ours"] - s["official"]) > tolerance, F.lit(False)),
    )
    return matched.select(*keys, F.inline(over))


def index_diff(ours: DataFrame, official: DataFrame) -> DataFrame:
    """Ours minus official for variances and indices, with a flag per row."""
    pairs = match_outer(ours, official, ["trade_date", "time"])
    diffs = {
        f"{c}_diff": F.col(f"{c}_ours") - F.col(f"{c}_official") for c in INDEX_VALUES
    }
    over = F.lit(False)
    for c in INDEX_VALUES:
        limit = SIGMA_TOLERANCE if c.endswith("sigma2") else INDEX_TOLERANCE
        over = over | F.coalesce(F.abs(F.col(f"{c}_diff")) > limit, F.lit(False))
    for c in ("near_type", "next_type"):
        over = over | ~F.col(f"{c}_ours").eqNullSafe(F.col(f"{c}_official"))
    return pairs.withColumns(diffs).withColumn("differs", over)


def error_profile(
    ours: DataFrame, official: DataFrame, tolerance: float = DEFAULT.diff_tolerance
) -> DataFrame:
    """Largest absolute difference and count above tolerance per index column."""
    pairs = match_outer(ours, official, ["trade_date", "time"])
    gaps = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.abs(F.col(f"{c}_ours") - F.col(f"{c}_official")).alias("gap"),
            )
            for c in INDEX_VALUES
        ]
    )
    return (
        pairs.select(F.inline(gaps))
        .groupBy("column")
        .agg(
            F.max("gap").alias("max_gap"),
            F.count_if(F.col("gap") > tolerance).alias("over_tolerance"),
        )
    )


def index_verify(
    ours: DataFrame, official: DataFrame, tolerance: float = DEFAULT.diff_tolerance
) -> DataFrame:
    """Pass or fail per date; missing values do not count."""
    pairs = match_outer(ours, official, ["trade_date", "time"])
    failed = F.lit(False)
    for c in INDEX_VALUES:
        gap = F.abs(F.col(f"{c}_ours") - F.col(f"{c}_official"))
        failed = failed | F.coalesce(gap > tolerance, F.lit(False))
    return pairs.groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(failed).alias("failed_points"),
        (~F.bool_or(failed)).alias("passed"),
    )


def official_snapshots(wide: DataFrame) -> DataFrame:
    """Bid and ask of the official ``snapshot_*`` columns, one row per side."""
    sides = F.array(
        *[
            F.struct(
                F.lit(cp).alias("cp"),
                F.col(f"snapshot_{side}_bid").alias("bid"),
                F.col(f"snapshot_{side}_ask").alias("ask"),
            )
            for side, cp in (("call", "Call"), ("put", "Put"))
        ]
    )
    keys = [c for c in CELL if c != "cp"]
    return wide.select(*keys, F.explode(sides).alias("side")).select(*keys, "side.*")


def snapshot_compare(ours_long: DataFrame, official_wide: DataFrame) -> DataFrame:
    """Our last quotes against the official snapshot ones, per date, term and side.

    A missing value is a mismatch, also where both are missing.
    """
    ours = ours_long.select(*CELL, F.col("last_bid").alias("bid"), F.col("last_ask").alias("ask"))
    matched = match_inner(ours, official_snapshots(official_wide), CELL)
    differs = F.lit(False)
    for value in ("bid", "ask"):
        same = F.col(f"{value}_ours") == F.col(f"{value}_official")
        differs = differs | ~F.coalesce(same, F.lit(False))
    return matched.groupBy("trade_date", "term", "cp").agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(differs).alias("mismatches")
    )


def diff_mark(full: DataFrame, diffs: DataFrame) -> DataFrame:
    """Mark rows of the full data that have differences, with the column list.

    The list per cell has at most one entry per compared column.
    """
    listed = diff_columns_list(diffs)
    return (
        full.join(listed, CELL, "left")
        .withColumn("has_diff", F.col("diff_cols").isNotNull())
        .fillna("", subset=["diff_cols"])
    )


def diff_columns_list(diffs: DataFrame) -> DataFrame:
    return diffs.groupBy(*CELL).agg(
        F.array_join(F.array_sort(F.collect_set("column")), ",").alias("diff_cols")
    )


def diff_semi(ours: DataFrame, diffs: DataFrame) -> DataFrame:
    """Our rows whose strike appears in the differences of that time."""
    return ours.join(
        diffs.select("trade_date", "term", "time", "strike"),
        ["trade_date", "term", "time", "strike"],
        "left_semi",
    )


def strike_set_difference(ours: DataFrame, official: DataFrame) -> DataFrame:
    """Strikes only one of both has, per date, term and time."""
    keys = ["trade_date", "term", "time", "strike"]
    only = lambda a, b, side: (
        a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti")
        .withColumn("only_in", F.lit(side))
    )
    return only(official, ours, "official").unionByName(only(ours, official, "ours"))
