"""Whole quote processing against a plain sequential calculation.

Random days with missing, crossed and one-sided quotes, a product that holds a
third of all ticks, and every physical variant of the plan.
"""

import datetime as dt
import random

import pytest

from quotelake.config import EngineConfig
from quotelake.operators.filtering import filtered_to_long
from quotelake.operators.snapshots import book_to_long, long_to_book, snapshot_book
from quotelake.plans.quotes import filtered

TICK_SCHEMA = (
    "trade_date date, term string, strike int, cp string, yyyymm int, seqno bigint, "
    "tick_time string, prod_id string, bid double, ask double"
)
STRIKES = [20000, 20100, 20200]


def make_day(day, seed):
    rng = random.Random(seed)
    ticks, seq = [], 0
    for _ in range(900):
        seq += rng.choice([1, 1, 2, 7])
        hot = rng.random() < 0.33
        strike = 20000 if hot else rng.choice(STRIKES)
        cp = "Call" if hot else rng.choice(["Call", "Put"])
        if (strike, cp) == (20200, "Put"):
            continue
        base = 100 + 30 * rng.random() + (60 if rng.random() < 0.05 else 0)
        bid = rng.choice([None, -1.0, 0.0] + [round(base, 1)] * 12)
        ask = rng.choice([None, 0.0] + [round(base + rng.choice([0, 2, 5, 9, 14, 30, 80]), 1)] * 12)
        ticks.append((day, "Near", strike, cp, 202512, seq, "084500000000", "X", bid, ask))
    times = [f"{8 + (45 + m) // 60:02d}{(45 + m) % 60:02d}00" for m in range(0, 45)]
    bounds = sorted(rng.sample(range(40, seq), len(times) - 1)) + [seq]
    schedule, prev = [], 30
    for idx, (time, sysid) in enumerate(zip(times, bounds, strict=True)):
        schedule.append((day, idx, time, sysid, prev))
        prev = sysid
    return ticks, schedule


def is_valid(bid, ask):
    return bid is not None and ask is not None and bid >= 0 and ask > 0 and ask > bid


def sequential(ticks, schedule):
    """Expected rows by walking every series in time order."""
    expected = {}
    for strike in STRIKES:
        for cp in ("Call", "Put"):
            mine = sorted(
                (t[5], t[8], t[9]) for t in ticks if t[2] == strike and t[3] == cp
            )
            state = {"ema": None, "quote": None}
            for day, idx, time, sysid, prev in schedule:
                upto = [t for t in mine if t[0] <= sysid]
                good = [t for t in upto if is_valid(t[1], t[2])]
                last = good[-1] if good else None
                pool = [t for t in good if t[0] > prev]
                carried = [t for t in upto if t[0] <= prev]
                if carried and is_valid(carried[-1][1], carried[-1][2]):
                    pool.append(carried[-1])
                least = min(pool, key=lambda t: (round(t[2] - t[1], 8), -t[0]), default=None)
                restart = idx == 0 or time == "090000"
                if restart:
                    state = {"ema": None, "quote": None}
                expected[(day, strike, cp, idx)] = step(state, restart, last, least)
    return expected


def step(state, restart, last, least):
    before, held = state["ema"], state["quote"]
    ema = before
    if least is not None:
        spread = least[2] - least[1]
        ema = spread if before is None else 0.95 * before + (1 - 0.95) * spread
    held_mid = None if held is None else (held[0] + held[1]) / 2

    def judge(quote):
        """Gamma and code of one candidate."""
        if quote is None or quote[1] == 0:
            gamma = 1.2
        elif held_mid is None:
            gamma = 2.0
        else:
            gamma = 1.5 if (quote[1] + quote[2]) / 2 <= held_mid + 1e-9 else 2.0
        if restart:
            return gamma, "5"
        if before is None:
            return gamma, "6"
        if quote is None:
            return gamma, "-"
        bid, ask = quote[1:]
        passed = []
        if ask - bid <= gamma * ema:
            passed.append("1")
        if ask - bid <= 15:
            passed.append("2")
        if held_mid is not None and bid > held_mid:
            passed.append("3")
        if held_mid is not None and ask < held_mid and bid > 0:
            passed.append("4")
        return gamma, ",".join(passed) or "V"

    gamma_last, code_last = judge(last)
    gamma_min, code_min = judge(least)
    if last is not None and code_last != "V":
        chosen, source, gamma = last[1:], "Q_Last_Valid", gamma_last
    elif least is not None and code_min != "V":
        chosen, source, gamma = least[1:], "Q_Min_Valid", gamma_min
    else:
        chosen, source = held, "Replacement"
        gamma = gamma_last if least is None else gamma_min
    state["ema"], state["quote"] = ema, chosen
    shown_min = code_min
    if code_min != "V" and code_min != "-":
        same = last is not None and least is not None and last[0] == least[0]
        shown_min = "-" if same or code_min in ("5", "6") else code_min
    return (
        last[0] if last else None, least[0] if least else None, ema, code_last, shown_min,
        chosen[0] if chosen else None, chosen[1] if chosen else None, source, gamma,
    )


@pytest.fixture(scope="module")
def days(spark):
    made = [make_day(dt.date(2025, 12, d), d) for d in (1, 2, 3)]
    ticks = [t for day in made for t in day[0]]
    schedule = [s for day in made for s in day[1]]
    expected = {}
    for day_ticks, day_schedule in made:
        expected |= sequential(day_ticks, day_schedule)
    strikes = [(dt.date(2025, 12, d), "Near", s) for d in (1, 2, 3) for s in STRIKES]
    return (
        spark.createDataFrame(ticks, TICK_SCHEMA).repartition(5),
        spark.createDataFrame(
            schedule, "trade_date date, idx int, time string, sysid bigint, prev_sysid bigint"
        ),
        spark.createDataFrame(strikes, "trade_date date, term string, strike int"),
        expected,
    )


def result_of(book, cfg):
    rows = filtered_to_long(filtered(book, cfg)).collect()
    return {
        (r["trade_date"], r["strike"], r["cp"], r["idx"]): (
            r["last_sysid"], r["min_sysid"], r["ema"], r["last_outlier"], r["min_outlier"],
            r["bid"], r["ask"], r["source"], r["gamma"],
        )
        for r in rows
    }


@pytest.mark.parametrize("with_template", [True, False], ids=["template", "quoted"])
@pytest.mark.parametrize(
    "cfg",
    [
        EngineConfig(),
        EngineConfig(seqno_bucket=16, fold_rows=1),
        EngineConfig(broadcast_bytes=0, fold_rows=7),
        EngineConfig(seqno_bucket=100_000, fold_rows=60),
    ],
    ids=["default", "narrow-buckets", "nothing-broadcast", "one-bucket"],
)
def test_same_as_sequential(spark, days, cfg, with_template):
    ticks, schedule, strikes, expected = days
    strikes = strikes if with_template else None
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = result_of(snapshot_book(ticks, schedule, strikes, cfg), cfg)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected


def test_long_form_goes_back_to_a_book(spark, days):
    ticks, schedule, strikes, expected = days
    book = snapshot_book(ticks, schedule, strikes)
    again = long_to_book(book_to_long(book))
    assert result_of(again, EngineConfig()) == expected


def test_a_filtered_quote_is_never_an_outlier_of_its_step(days):
    *_, expected = days
    sources = set()
    for _, _, _, code_last, code_min, _, _, source, _ in expected.values():
        sources.add(source)
        assert not (source == "Q_Last_Valid" and code_last == "V")
        assert not (source == "Q_Min_Valid" and code_min == "V")
    assert sources == {"Q_Last_Valid", "Q_Min_Valid", "Replacement"}
