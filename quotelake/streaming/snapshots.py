"""Snapshots on a fixed step from a stream of ticks.

Two operators follow on one another. A window folds the ticks of a series and a step
to one row, which leaves when the watermark passes the step's end. A state by series and
day then carries quotes forward: it holds the newest and the newest valid quote, and
an event-time timer at the end of the next step. Where the watermark passes that end
and the window has nothing for it, the timer writes the silent step's row.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.quotes import valid_quote
from quotelake.operators.snapshots import fold_ticks

KEYS = ["trade_date", "prod_id", "strike", "cp"]
QUOTE = "{0}_bid double, {0}_ask double, {0}_seqno bigint"
KINDS = ("raw", "valid", "least")
SHOWN = ("raw", "carry", "valid", "least")
FIELDS = [*KEYS, "start_ms", "end_ms", *(f"{kind}_{n}" for kind in SHOWN for n in ("bid", "ask", "seqno"))]


def _quote(row: Row, kind: str) -> tuple | None:
    found = tuple(row[f"{kind}_{n}"] for n in ("bid", "ask", "seqno"))
    return None if found[2] is None else found


class CarriedQuotes(StatefulProcessor):
    """The steps of one series and day, from its first tick on, none left out.

    ``step``, ``opens`` and ``closes`` are milliseconds, the latter two after midnight.
    Steps up to ``opens`` are carried in but not written; after ``closes`` the state goes.
    """

    #: End of the last step done, midnight, newest and newest valid quote.
    STATE = f"done bigint, midnight bigint, {QUOTE.format('raw')}, {QUOTE.format('valid')}"
    NOTHING = (None, None, None)

    def __init__(self, step: int, opens: int, closes: int):
        self.step, self.opens, self.closes = step, opens, closes

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("quotes", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.state.get()
        if held is not None:
            self.handle.deleteTimer(held[0] + self.step)
        for row in sorted(rows, key=lambda r: r["end_ms"]):
            if held is None:
                held = (row["end_ms"] - self.step, row["midnight"], *self.NOTHING, *self.NOTHING)
            while held[0] + self.step < row["end_ms"]:
                held, shown = self._advance(key, held, {})
                yield from shown
            held, shown = self._advance(key, held, {k: _quote(row, k) for k in KINDS})
            yield from shown
        self._keep(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.state.get()
        last = min(timerValues.getCurrentWatermarkInMs(), held[1] + self.closes)
        while held[0] + self.step <= last:
            held, shown = self._advance(key, held, {})
            yield from shown
        self._keep(held)

    def _advance(self, key: tuple, held: tuple, found: dict) -> tuple[tuple, list[Row]]:
        """State after one more step, and the step's row if it is written."""
        end, carry = held[0] + self.step, held[2:5]
        raw = found.get("raw") or carry
        valid = found.get("valid") or held[5:8]
        least = found.get("least") or self.NOTHING
        inside = self.opens < end - held[1] <= self.closes
        values = (*key, end - self.step, end, *raw, *carry, *valid, *least)
        shown = [Row(**dict(zip(FIELDS, values, strict=True)))] if inside else []
        return (end, held[1], *raw, *valid), shown

    def _keep(self, held: tuple | None) -> None:
        if held is None or held[0] >= held[1] + self.closes:
            self.state.clear()
        else:
            self.state.update(held)
            self.handle.registerTimer(held[0] + self.step)

    def close(self) -> None:
        pass


def _clock_ms(clock: str) -> int:
    return 1000 * (int(clock[:2]) * 3600 + int(clock[2:4]) * 60 + int(clock[4:6]))


def _milliseconds(step: str, spark) -> int:
    seconds = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {step}"))
    return spark.range(1).select(seconds).first()[0] // 1000


def heartbeat(ticks: DataFrame, ts: Column) -> DataFrame:
    """Rows like ``ticks`` without a product at ``ts``: they move the watermark only.

    They are joined to parsed ticks, as parsing drops rows without a product.
    """
    return ticks.select(
        *[(ts if c == "ts" else F.lit(None)).cast(t).alias(c) for c, t in ticks.dtypes]
    )


def stream_snapshot(
    parsed: DataFrame,
    step: str = "15 seconds",
    delay: str = "1 minute",
    opens: str = "000000",
    closes: str = "240000",
    cfg: EngineConfig = DEFAULT,
) -> DataFrame:
    """Newest, newest valid, carried-in and smallest-spread quote per series and step.

    ``parsed`` are parsed ticks with an event time ``ts``. A series has a row for every
    step from its first tick of a day to ``closes``, also where nothing is quoted, with
    what the batch snapshots have at the end of that step. Steps up to ``opens`` are not
    written, as those before the batch's start marker. Ticks later than ``delay`` are
    dropped. A step is written when the watermark passes its end, so the last ones of
    a day wait for a later row: a tick, or a :func:`heartbeat` row without prod_id.
    """
    timed = parsed.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    # A filter that reads ``ts`` stays behind the watermark, which so sees every row.
    real = F.when(F.col("prod_id").isNotNull(), F.col("ts")).isNotNull()
    windowed = timed.where(real).withColumn("step", F.window("ts", step))
    folded = fold_ticks(windowed, ["step", *KEYS[1:]], cfg)
    start = F.col("step.start")
    flat = folded.select(
        F.to_date(start).alias("trade_date"),
        *KEYS[1:],
        F.window_time("step").alias("event_time"),
        F.unix_millis("step.end").alias("end_ms"),
        F.unix_millis(F.date_trunc("day", start)).alias("midnight"),
        *[f"{kind}_{n}" for kind in KINDS for n in ("bid", "ask", "seqno")],
    )
    kinds = dict(flat.dtypes)
    shape = ", ".join(
        [*(f"{k} {kinds[k]}" for k in KEYS), "start_ms bigint, end_ms bigint"]
        + [QUOTE.format(kind) for kind in SHOWN]
    )
    processor = CarriedQuotes(_milliseconds(step, parsed.sparkSession), _clock_ms(opens), _clock_ms(closes))
    steps = flat.groupBy(*KEYS).transformWithState(processor, shape, "append", "EventTime")
    fresh = F.col("least_seqno").isNotNull()
    spread = lambda q: F.round(F.col(f"{q}_ask") - F.col(f"{q}_bid"), cfg.spread_digits)
    carried = valid_quote(F.col("carry_bid"), F.col("carry_ask")) & (
        ~fresh | (spread("carry") < spread("least"))
    )
    least = lambda n: F.when(carried, F.col(f"carry_{n}")).otherwise(F.col(f"least_{n}"))
    return steps.select(
        *KEYS,
        F.timestamp_millis("start_ms").alias("step_start"),
        F.timestamp_millis("end_ms").alias("step_end"),
        "raw_bid",
        "raw_ask",
        F.col("raw_seqno").alias("raw_sysid"),
        "carry_bid",
        "carry_ask",
        F.col("carry_seqno").alias("carry_sysid"),
        F.col("valid_bid").alias("last_bid"),
        F.col("valid_ask").alias("last_ask"),
        F.col("valid_seqno").alias("last_sysid"),
        least("bid").alias("min_bid"),
        least("ask").alias("min_ask"),
        least("seqno").alias("min_sysid"),
    )
