"""Whole quote processing: from raw ticks to the wide table of filtered quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.products import parse_product
from quotelake.operators.filtering import filter_book, filtered_to_long, with_outlier_codes
from quotelake.operators.reshape import fill_defaults, order_wide
from quotelake.operators.snapshots import SERIES, snapshot_book
from quotelake.operators.terms import near_next_terms, split_terms
from quotelake.session import small_table


def prepare(ticks: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Parsed ticks of the two nearest terms of every date.

    The terms need a pass over dates and product ids only; their result is a
    handful of rows per date and is written once.
    """
    parsed = parse_product(ticks, product=cfg.product)
    return split_terms(parsed, small_table(near_next_terms(parsed)), cfg)


def snapshots(
    ticks: DataFrame,
    schedule: DataFrame,
    strikes: DataFrame | None = None,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Book of every date; strikes default to the quoted ones of each term."""
    return snapshot_book(prepare(ticks, cfg), schedule, strikes, cfg)


def filtered(book: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Filtered quotes with outlier codes, wide."""
    return with_outlier_codes(filter_book(book, cfg))


def filtered_long(book: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    return filtered_to_long(filtered(book, cfg))


def wide_table(filtered_book: DataFrame, fill: bool = True, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Output table, one row per time and strike.

    The fold keeps both sides of a strike in one row, so no pivot is needed.
    """
    wide = order_wide(filtered_book, [*SERIES, "time"], cfg)
    return fill_defaults(wide) if fill else wide


def quote_pipeline(
    ticks: DataFrame,
    schedule: DataFrame,
    strikes: DataFrame | None = None,
    fill: bool = True,
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Everything from raw ticks to the wide table, all dates in one job.

    Schedule and template are derived from the official files and used several
    times, so they are written once here.
    """
    schedule = small_table(schedule)
    strikes = None if strikes is None else small_table(strikes)
    return wide_table(filtered(snapshots(ticks, schedule, strikes, cfg), cfg), fill, cfg)
