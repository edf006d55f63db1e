"""Comparing wide quote tables with the official ones over many dates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quotelake.config import DEFAULT, EngineConfig
from quotelake.operators import comparison, reshape

KEYS = ["trade_date", "term", "time", "strike"]


def long_measures(wide: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Compared columns of a wide table as Call and Put rows."""
    measures = [*reshape.SIDE_MEASURES, "last_sysid"]
    return reshape.unpivot_quotes(wide, keys or KEYS, measures)


def diff_report(
    ours: DataFrame,
    official: DataFrame,
    series: list[str] | None = None,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Every differing value of every date, with the sequence numbers around it."""
    series = series or ["trade_date", "term", "strike", "cp"]
    return comparison.diff_report(long_measures(ours), long_measures(official), series, cfg)


def full_data_view(
    ours: DataFrame, diffs: DataFrame, cp: str | None = None,
    strike: int | None = None, time: str | None = None,
) -> DataFrame:
    """All rows long with their difference mark, optionally filtered.

    Filters come before the join, so they reach both scans.
    """
    rows = reshape.unpivot_quotes(ours, KEYS, reshape.SIDE_MEASURES)
    for column, wanted in (("cp", cp), ("strike", strike), ("time", time)):
        if wanted is not None:
            rows = rows.where(rows[column] == wanted)
            diffs = diffs.where(diffs[column] == wanted)
    return comparison.diff_mark(rows, diffs)
