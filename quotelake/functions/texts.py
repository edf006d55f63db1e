"""Explanations of single steps, as texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig


def _six(value: Column) -> Column:
    """Halves round up, as in every other output."""
    return F.round(value, 6)


def ema_trace_text(
    prev_ema: Column, spread: Column, ema: Column, cfg: EngineConfig = DEFAULT
) -> Column:
    return (
        F.when(prev_ema.isNull() & spread.isNull(), "EMA = null")
        .when(prev_ema.isNull(), F.format_string("EMA = spread = %.6f", _six(ema)))
        .when(spread.isNull(), F.format_string("EMA = previous EMA = %.6f", _six(ema)))
        .otherwise(
            F.format_string(
                f"EMA = {cfg.alpha:.2f} * %.6f + {1 - cfg.alpha:.2f} * %.6f = %.6f",
                _six(prev_ema), _six(spread), _six(ema),
            )
        )
    )


def gamma_reason(
    bid: Column, mid: Column, prev_mid: Column, cfg: EngineConfig = DEFAULT
) -> Column:
    return (
        F.when(bid.isNull(), f"bid missing: gamma {cfg.gamma_zero}")
        .when(bid == 0, f"bid zero: gamma {cfg.gamma_zero}")
        .when(mid.isNull(), f"mid missing: gamma {cfg.gamma_zero}")
        .when(prev_mid.isNull(), f"no previous mid: gamma {cfg.gamma_up}")
        .when(
            mid <= prev_mid + cfg.mid_tolerance,
            F.format_string(f"mid %.6f not above %.6f: gamma {cfg.gamma_down}", _six(mid), _six(prev_mid)),
        )
        .otherwise(F.format_string(f"mid %.6f above %.6f: gamma {cfg.gamma_up}", _six(mid), _six(prev_mid)))
    )


def outlier_reason(test: Column) -> Column:
    """Text for the struct made by ``outlier_test``."""
    passed = F.array_join(
        F.array_compact(
            F.array(*[F.when(test[f"cond_{i}"], F.lit(str(i))) for i in range(1, 5)])
        ),
        ",",
    )
    return (
        F.when(test["cond_5"], "first record: no outlier")
        .when(test["cond_6"], "no previous EMA: no outlier")
        .when(test["is_outlier"].isNull(), "no quote")
        .when(test["is_outlier"], "no condition passed: outlier")
        .otherwise(F.concat(F.lit("condition "), passed, F.lit(" passed: no outlier")))
    )
