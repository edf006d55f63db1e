"""Column formulas of the volatility index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.quotes import is_true


def variance_term(
    t: Column, contrib_sum: Column, rows: Column, forward: Column, k0: Column
) -> Column:
    """Variance of one term; -1 if it cannot be used, NULL without a forward."""
    bend = F.try_divide(forward, k0) - 1.0
    value = (
        F.try_divide(F.lit(2.0), t) * F.coalesce(contrib_sum, F.lit(0.0))
        - F.try_divide(F.lit(1.0), t) * (bend * bend)
    )
    return (
        F.when((t <= 0) | (F.coalesce(rows, F.lit(0)) == 0), F.lit(-1.0))
        .when(value <= 0, F.lit(-1.0))
        .otherwise(value)
    )


def index_interpolate(
    near_t: Column, near_w: Column, near_sigma2: Column,
    next_t: Column, next_w: Column, next_sigma2: Column,
    cfg: EngineConfig = DEFAULT,
) -> Column:
    """30-day index from both terms, from the near term alone, or NULL."""
    blended = near_t * near_sigma2 * near_w + next_t * next_sigma2 * next_w
    inside = blended * (cfg.year_seconds / cfg.month_seconds)
    near_ok = is_true(near_sigma2 > 0)
    both = near_ok & is_true(next_sigma2 > 0) & is_true(near_w < 1)
    return (
        F.when(both & (inside >= 0), F.sqrt(inside) * 100)
        .when(both, F.lit(None).cast("double"))
        .when(near_ok, F.sqrt(near_sigma2) * 100)
    )


def variance_type(sigma2: Column, rows: Column) -> Column:
    return (
        F.when(sigma2.isNull() | (sigma2 <= 0), "E")
        .when(F.coalesce(rows, F.lit(0)) < 2, "E,I")
        .otherwise("A")
    )


def round_publish(value: Column) -> Column:
    """Two decimals, halves to even."""
    return F.rint(value * 100) / 100


def round_half_up(value: Column) -> Column:
    return F.floor(value * 100 + 0.5) / 100


def change_ratio(current: Column, previous: Column) -> Column:
    return F.when(previous > 0, (current - previous) / previous)
