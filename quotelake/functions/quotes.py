"""Column rules of a single quote: validity, spread, gamma and outlier test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.config import DEFAULT, EngineConfig

# Reason texts of the validity report.
REASON_MISSING = "缺少報價"
REASON_NEGATIVE_BID = "買價為負"
REASON_ASK_NOT_POSITIVE = "賣價須大於0"
REASON_ASK_NOT_ABOVE_BID = "賣價須大於買價"
REASON_ONE_SIDED = "單邊報價(Bid=0或Ask=0)"

# Names of the quote a filtered quote was taken from.
SOURCE_LAST = "Q_Last_Valid"
SOURCE_MIN = "Q_Min_Valid"
SOURCE_HELD = "Replacement"


def is_true(condition: Column) -> Column:
    """A condition with unknown counted as false."""
    return F.coalesce(condition, F.lit(False))


def valid_quote(bid: Column, ask: Column) -> Column:
    return is_true((bid >= 0) & (ask > 0) & (ask > bid))


def valid_quote_reason(bid: Column, ask: Column) -> Column:
    """Why a quote is invalid; empty text if it is valid."""
    return (
        F.when(valid_quote(bid, ask), "")
        .when(is_true(bid == 0) | is_true(ask == 0), REASON_ONE_SIDED)
        .when(bid.isNull() | ask.isNull(), REASON_MISSING)
        .when(bid < 0, REASON_NEGATIVE_BID)
        .when(ask <= 0, REASON_ASK_NOT_POSITIVE)
        .otherwise(REASON_ASK_NOT_ABOVE_BID)
    )


def tick_error_codes(bid: Column, ask: Column) -> Column:
    """Error codes of a raw tick; the empty array marks a valid one."""
    bid, ask = F.coalesce(bid, F.lit(0.0)), F.coalesce(ask, F.lit(0.0))
    return F.array_compact(
        F.array(F.when(bid < 0, F.lit("E1")), F.when(ask <= bid, F.lit("E2")))
    )


def derive_spread(bid: Column, ask: Column) -> Column:
    return F.when(valid_quote(bid, ask), ask - bid)


def derive_mid(bid: Column, ask: Column) -> Column:
    return F.when(valid_quote(bid, ask), (bid + ask) / 2)


def text_to_price(text: Column) -> Column:
    """Numeric text to DOUBLE; blank, ``null``, ``nan`` and anything else to NULL."""
    number = F.trim(text).try_cast("double")
    return F.when(~F.isnan(number), number)


def two_sided(bid: Column, ask: Column) -> Column:
    return bid.isNotNull() & ask.isNotNull()


def gamma_select(
    bid: Column, mid: Column, prev_mid: Column, cfg: EngineConfig = DEFAULT
) -> Column:
    """Tolerance factor of a quote given the filtered mid one step before."""
    return (
        F.when(bid.isNull() | (bid == 0) | mid.isNull(), F.lit(cfg.gamma_zero))
        .when(prev_mid.isNull(), F.lit(cfg.gamma_up))
        .when(mid <= prev_mid + cfg.mid_tolerance, F.lit(cfg.gamma_down))
        .otherwise(F.lit(cfg.gamma_up))
    )


def outlier_test(
    spread: Column,
    bid: Column,
    ask: Column,
    ema: Column,
    prev_ema: Column,
    gamma: Column,
    prev_mid: Column,
    restart: Column,
    cfg: EngineConfig = DEFAULT,
) -> Column:
    """Struct ``(is_outlier, cond_1 .. cond_6)``; ``is_outlier`` NULL means no quote."""
    no_history = ~restart & prev_ema.isNull()
    decided = ~restart & ~no_history
    no_quote = spread.isNull() & bid.isNull() & ask.isNull()
    tested = decided & ~no_quote
    cond = [
        tested & is_true(spread <= gamma * ema),
        tested & is_true(spread <= cfg.spread_limit),
        tested & is_true(bid > prev_mid),
        tested & is_true((ask < prev_mid) & (bid > 0)),
        restart,
        no_history,
    ]
    passed = cond[0]
    for other in cond[1:]:
        passed = passed | other
    flag = F.when(decided & no_quote, F.lit(None).cast("boolean")).otherwise(~passed)
    return F.struct(
        flag.alias("is_outlier"),
        *[c.alias(f"cond_{i}") for i, c in enumerate(cond, start=1)],
    )


def _numbers(conditions: list[Column]) -> Column:
    listed = F.array_join(
        F.array_compact(
            F.array(*[F.when(c, F.lit(str(i))) for i, c in enumerate(conditions, 1)])
        ),
        ",",
    )
    return F.when(listed == "", "-").otherwise(listed)


def outlier_code_last(is_outlier: Column, conditions: list[Column]) -> Column:
    """``-`` without a quote, ``V`` for an outlier, else the numbers of what passed."""
    return (
        F.when(is_outlier.isNull(), "-")
        .when(is_outlier, "V")
        .otherwise(_numbers(conditions))
    )


def outlier_code_min(
    is_outlier: Column, conditions: list[Column], min_sysid: Column, last_sysid: Column
) -> Column:
    """As for the last quote, but ``-`` if both are the same tick; no 5 and 6."""
    min_id = F.coalesce(min_sysid, F.lit(0))
    last_id = F.coalesce(last_sysid, F.lit(0))
    return (
        F.when(is_outlier.isNull(), "-")
        .when(is_outlier, "V")
        .when((min_id == last_id) & (min_id != 0), "-")
        .otherwise(_numbers(conditions[:4]))
    )


def outlier_code_to_flag(code: Column) -> Column:
    text = F.trim(code)
    return (
        F.when(text == "V", True)
        .when(text.isNull() | text.isin("-", "nan", ""), F.lit(None).cast("boolean"))
        .otherwise(False)
    )


def source_select(
    last: Column, last_flag: Column, least: Column, min_flag: Column, held: Column
) -> Column:
    """Filtered quote of one step from structs with ``bid, ask, mid`` fields.

    The last valid quote if it is two-sided and no outlier, else the
    smallest-spread quote under the same test, else the quote held before.
    """
    chosen = lambda q, name: F.struct(
        q["bid"].alias("bid"), q["ask"].alias("ask"), q["mid"].alias("mid"),
        F.lit(name).alias("source"),
    )
    usable = lambda q, flag: two_sided(q["bid"], q["ask"]) & ~is_true(flag)
    return (
        F.when(usable(last, last_flag), chosen(last, SOURCE_LAST))
        .when(usable(least, min_flag), chosen(least, SOURCE_MIN))
        .otherwise(chosen(held, SOURCE_HELD))
    )


def reported_gamma(
    source: Column, gamma_last: Column, gamma_min: Column, min_bid: Column
) -> Column:
    return (
        F.when(source == SOURCE_LAST, gamma_last)
        .when((source == SOURCE_MIN) | min_bid.isNotNull(), gamma_min)
        .otherwise(gamma_last)
    )
