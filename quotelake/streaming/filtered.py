"""Quote filter over a stream of snapshots, with its state per series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.times import seconds_of_day
from quotelake.operators.filtering import SIDE_INPUTS, SIDE_OUTPUTS, STATE, SideFold, _side_columns
from quotelake.operators.snapshots import SERIES, SIDES

DAY_MS = 24 * 60 * 60 * 1000
PREFIXES = [side[0] for side in SIDES]


class QuoteFilter(StatefulProcessor):
    """One series: a value for each side's average and filtered quote, and one timer.

    The timer stands ``idle`` milliseconds after the newest row. Every row puts it
    off; when the watermark passes it, the state goes and a later row starts anew.
    """

    def __init__(self, output: list[str], idle: int, cfg: EngineConfig):
        self.output, self.idle, self.cfg = output, idle, cfg

    def init(self, handle) -> None:
        names = [f"{p}_{name}" for p in PREFIXES for name in STATE]
        self.handle = handle
        self.sides = handle.getValueState("sides", ", ".join(f"{n} double" for n in names))
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values("idx", ignore_index=True)
        restart = (found["time"] == self.cfg.session_open).to_numpy(dtype=bool, na_value=False)
        folds, held = {p: SideFold(self.cfg) for p in PREFIXES}, self.sides.get()
        if held is None:
            restart[0] = True
        else:
            known = iter(held)
            for fold in folds.values():
                fold.carry = {n: np.nan if (v := next(known)) is None else v for n in STATE}
        found["restart"] = restart
        for p, fold in folds.items():
            quotes = {
                n: found[f"{p}_{n}"].to_numpy(dtype=np.float64, na_value=np.nan)
                for n in SIDE_INPUTS
            }
            for name, values in _side_columns(fold.block(restart, quotes)).items():
                found[f"{p}_{name}"] = values.to_pandas()
        self.sides.update(tuple(float(f.carry[n]) for f in folds.values() for n in STATE))
        self._put_off(int(found["event_time"].max().timestamp() * 1000) + self.idle)
        yield found[self.output]

    def _put_off(self, at: int) -> None:
        held = self.timer.get()
        if held is not None:
            self.handle.deleteTimer(held[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.sides.clear()
        self.timer.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_filtered_quote(
    book: DataFrame, delay: str = "1 day", idle_ms: int = DAY_MS, cfg: EngineConfig = DEFAULT
) -> DataFrame:
    """Filtered quotes of both sides from a stream of book rows.

    Rows of a series must arrive in the order of their snapshots across
    micro-batches; inside one they are sorted. Rows older than the watermark,
    ``delay`` behind the newest snapshot, are dropped. The state of a series is
    one quote and one average per side; it clears at the session open and
    expires once the watermark is ``idle_ms`` past the last row of the series.
    """
    inputs = [*SIDE_INPUTS, "last_sysid", "min_sysid"]
    flat = book.select(
        *SERIES, "idx", "time", "snapshot_sysid",
        F.timestamp_seconds(
            F.unix_date("trade_date") * F.lit(86400).cast("bigint") + seconds_of_day(F.col("time"))
        ).alias("event_time"),
        *[F.col(side)[n].alias(f"{side[0]}_{n}") for side in SIDES for n in inputs],
    ).withWatermark("event_time", delay)
    output = T.StructType(
        flat.schema.fields
        + [T.StructField("restart", T.BooleanType())]
        + [
            T.StructField(f"{p}_{name}", kind)
            for p in PREFIXES
            for name, kind in SIDE_OUTPUTS.items()
        ]
    )
    return flat.groupBy(*SERIES).transformWithStateInPandas(
        QuoteFilter(output.names, idle_ms, cfg), output, "append", "EventTime"
    )
