"""Spread average, gamma, outlier test and the filtered quote per series.

The filtered quote feeds back into its own test one step later, so no window
expresses it and it is folded in time order: Spark clusters and sorts the
series, and each task streams its sorted rows through a kernel that advances
many series at once. A task never holds more than a block of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.config import DEFAULT, EngineConfig
from quotelake.functions.quotes import (
    SOURCE_HELD,
    SOURCE_LAST,
    SOURCE_MIN,
    outlier_code_last,
    outlier_code_min,
)
from quotelake.operators.snapshots import SERIES, SIDES

SIDE_INPUTS = ["last_bid", "last_ask", "min_bid", "min_ask"]
STATE = ["ema", "bid", "ask", "mid"]
SOURCES = [SOURCE_LAST, SOURCE_MIN, SOURCE_HELD]
NO_DATA = -1

SIDE_OUTPUTS = {
    "ema": T.DoubleType(),
    "last_gamma": T.DoubleType(),
    "min_gamma": T.DoubleType(),
    "last_flag": T.BooleanType(),
    "min_flag": T.BooleanType(),
    "last_passed": T.IntegerType(),
    "min_passed": T.IntegerType(),
    "bid": T.DoubleType(),
    "ask": T.DoubleType(),
    "mid": T.DoubleType(),
    "source": T.StringType(),
    "gamma": T.DoubleType(),
}


def session_restart(
    keys: list[str], order: str, time: Column, cfg: EngineConfig = DEFAULT
) -> Column:
    """First row of a series, or the session open."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return (rank == 1) | F.coalesce(time == cfg.session_open, F.lit(False))


class Runs:
    """Rows between one restart and the next, to be advanced side by side.

    ``at(step)`` gives the row of each run that is at least that long; runs are
    ordered by length, so these are always the first ones. A run that began in
    an earlier block is ``open``.
    """

    def __init__(self, restart: np.ndarray):
        starts = np.flatnonzero(restart)
        if not restart[0]:
            starts = np.concatenate(([0], starts))
        lengths = np.diff(np.append(starts, len(restart)))
        by_length = np.argsort(-lengths, kind="stable")
        self.starts, lengths = starts[by_length], lengths[by_length]
        self.alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        self.open = None if restart[0] else int(np.flatnonzero(self.starts == 0)[0])

    def initial(self, carried: float) -> np.ndarray:
        state = np.full(len(self.starts), np.nan)
        if self.open is not None:
            state[self.open] = carried
        return state

    def __iter__(self) -> Iterator[np.ndarray]:
        for step, active in enumerate(self.alive):
            yield self.starts[:active] + step


def _next_ema(prev: np.ndarray, spread: np.ndarray, cfg: EngineConfig) -> np.ndarray:
    """The first spread starts the average, a missing one keeps it."""
    moved = np.where(np.isnan(prev), spread, cfg.alpha * prev + (1 - cfg.alpha) * spread)
    return np.where(np.isnan(spread), prev, moved)


def _gamma(bid, mid, prev_mid, cfg):
    basic = np.isnan(bid) | (bid == 0) | np.isnan(mid)
    falling = mid <= prev_mid + cfg.mid_tolerance
    moved = np.where(~np.isnan(prev_mid) & falling, cfg.gamma_down, cfg.gamma_up)
    return np.where(basic, cfg.gamma_zero, moved)


def _passed(spread, bid, ask, ema, prev_ema, gamma, prev_mid, restart, cfg):
    """Bit mask of the conditions met; 0 is an outlier, -1 is no quote."""
    mask = (
        (spread <= gamma * ema) * 1
        + (spread <= cfg.spread_limit) * 2
        + (bid > prev_mid) * 4
        + ((ask < prev_mid) & (bid > 0)) * 8
    )
    mask = np.where(np.isnan(bid), NO_DATA, mask)
    return np.where(restart, 16, np.where(np.isnan(prev_ema), 32, mask))


class SideFold:
    """State machine of one side over a block of rows in series order."""

    def __init__(self, cfg: EngineConfig):
        self.cfg = cfg
        self.carry = {name: np.nan for name in STATE}

    def block(self, restart: np.ndarray, quotes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        cfg = self.cfg
        size = len(restart)
        runs = Runs(restart)
        state = {name: runs.initial(self.carry[name]) for name in STATE}

        lb, la = quotes["last_bid"], quotes["last_ask"]
        mb, ma = quotes["min_bid"], quotes["min_ask"]
        ls, lm = la - lb, (lb + la) / 2
        ms, mm = ma - mb, (mb + ma) / 2
        out = {
            name: np.empty(size)
            for name in ("ema", "last_gamma", "min_gamma", "bid", "ask", "mid", "gamma")
        }
        out |= {name: np.empty(size, dtype=np.int32) for name in ("last_passed", "min_passed")}
        out["pick"] = np.empty(size, dtype=np.int8)

        for at in runs:
            active = len(at)
            prev = {name: state[name][:active] for name in STATE}
            first = restart[at]
            ema = _next_ema(prev["ema"], ms[at], cfg)
            g_last = _gamma(lb[at], lm[at], prev["mid"], cfg)
            g_min = _gamma(mb[at], mm[at], prev["mid"], cfg)
            p_last = _passed(
                ls[at], lb[at], la[at], ema, prev["ema"], g_last, prev["mid"], first, cfg
            )
            p_min = _passed(
                ms[at], mb[at], ma[at], ema, prev["ema"], g_min, prev["mid"], first, cfg
            )
            use_last = ~np.isnan(lb[at]) & (p_last != 0)
            use_min = ~use_last & ~np.isnan(mb[at]) & (p_min != 0)
            pick = np.where(use_last, 0, np.where(use_min, 1, 2))
            bid = np.where(use_last, lb[at], np.where(use_min, mb[at], prev["bid"]))
            ask = np.where(use_last, la[at], np.where(use_min, ma[at], prev["ask"]))
            mid = np.where(use_last, lm[at], np.where(use_min, mm[at], prev["mid"]))
            from_min = use_min | ((pick == 2) & ~np.isnan(mb[at]))

            out["ema"][at], out["bid"][at], out["ask"][at], out["mid"][at] = ema, bid, ask, mid
            out["last_gamma"][at], out["min_gamma"][at] = g_last, g_min
            out["gamma"][at] = np.where(from_min, g_min, g_last)
            out["last_passed"][at], out["min_passed"][at] = p_last, p_min
            out["pick"][at] = pick
            for name, value in zip(STATE, (ema, bid, ask, mid), strict=True):
                state[name][:active] = value

        for name in STATE:
            self.carry[name] = out[name][size - 1]
        return out


def _floats(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.float64, copy=False)


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, type=pa.float64(), mask=np.isnan(values))


def _flag(passed: np.ndarray) -> pa.Array:
    return pa.array(passed == 0, type=pa.bool_(), mask=passed == NO_DATA)


def _side_columns(out: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    names = pa.array(SOURCES)
    return {
        "ema": _nullable(out["ema"]),
        "last_gamma": _nullable(out["last_gamma"]),
        "min_gamma": _nullable(out["min_gamma"]),
        "last_flag": _flag(out["last_passed"]),
        "min_flag": _flag(out["min_passed"]),
        "last_passed": pa.array(np.maximum(out["last_passed"], 0), type=pa.int32()),
        "min_passed": pa.array(np.maximum(out["min_passed"], 0), type=pa.int32()),
        "bid": _nullable(out["bid"]),
        "ask": _nullable(out["ask"]),
        "mid": _nullable(out["mid"]),
        "source": names.take(pa.array(out["pick"])),
        "gamma": _nullable(out["gamma"]),
    }


def stream_blocks(
    batches: Iterator[pa.RecordBatch],
    block: Callable[[np.ndarray, pa.Table], dict[str, pa.Array]],
    limit: int,
) -> Iterator[pa.RecordBatch]:
    """Hand sorted rows to ``block``, at most about ``limit`` at a time.

    A series may span any number of blocks: the folds carry its state over.
    """

    def flush(pending):
        table = pa.Table.from_batches(pending).combine_chunks()
        restart = table.column("restart").to_numpy().astype(bool)
        for name, values in block(restart, table).items():
            table = table.append_column(name, values)
        yield from table.to_batches()

    pending, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            pending.append(batch)
            rows += batch.num_rows
        if rows >= limit:
            yield from flush(pending)
            pending, rows = [], 0
    if pending:
        yield from flush(pending)


def fold_quotes(
    batches: Iterator[pa.RecordBatch], prefixes: list[str], cfg: EngineConfig
) -> Iterator[pa.RecordBatch]:
    folds = {p: SideFold(cfg) for p in prefixes}

    def block(restart, table):
        columns = {}
        for p, fold in folds.items():
            quotes = {name: _floats(table.column(f"{p}_{name}")) for name in SIDE_INPUTS}
            side = _side_columns(fold.block(restart, quotes))
            columns |= {f"{p}_{name}": values for name, values in side.items()}
        return columns

    return stream_blocks(batches, block, cfg.fold_rows)


#: Rows of a session that are folded as one array.
EMA_BLOCK = 64


def ema_spread(
    rows: DataFrame,
    keys: list[str],
    order: str,
    spread: str = "min_spread",
    time: str = "time",
    cfg: EngineConfig = DEFAULT,
    block: int = EMA_BLOCK,
) -> DataFrame:
    """Add ``ema``, the exponential average of the spread within each session.

    A step of the recurrence is an affine map ``x -> a x + b``: the identity where the
    spread is missing, a constant at the session's first spread. A scan in segments:
    sessions are cut into blocks of bounded length, each block's maps are composed into
    one, a window over the blocks composes those before a block into its start value,
    and from there the block's own rows take the recurrence as it is defined. All of
    it stays in the rows' one partitioning by series, with no Python. Sums run in another
    order than one long fold, so values agree with it but for the last digits.
    """
    series = Window.partitionBy(*keys).orderBy(order)
    session = Window.partitionBy(*keys, "__session").orderBy(order)
    row = F.struct(*rows.columns)
    numbered = (
        rows.select(*keys, order, row.alias("__row"), F.col(spread).cast("double").alias("__spread"),
                    session_restart(keys, order, F.col(time), cfg).alias("__restart"))
        .withColumn("__session", F.sum(F.col("__restart").cast("int")).over(series))
        .withColumn("__n", F.row_number().over(session))
        .withColumn("__known", F.count("__spread").over(session))
    )
    element = F.struct(
        F.col("__n").alias("n"), F.col("__spread").alias("spread"),
        (F.col("__known") == 1).alias("first"), F.col("__row").alias("row"),
    )
    in_order = F.array_sort(F.collect_list(element), lambda x, y: x["n"] - y["n"])
    number = F.floor((F.col("__n") - 1) / block).alias("__block")
    blocks = numbered.groupBy(*keys, "__session", number).agg(in_order.alias("__rows"))

    alpha, rest = F.lit(cfg.alpha), F.lit(1 - cfg.alpha)
    missing = lambda r: r["spread"].isNull()
    compose = lambda m, r: F.struct(
        F.when(missing(r), m["a"]).when(r["first"], 0.0).otherwise(alpha * m["a"]).alias("a"),
        F.when(missing(r), m["b"]).when(r["first"], r["spread"])
        .otherwise(alpha * m["b"] + rest * r["spread"]).alias("b"),
    )
    identity = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))
    nothing = F.lit(None).cast("double")
    before = Window.partitionBy(*keys, "__session").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    # A constant map has a value also where nothing came before it.
    start = F.aggregate("__maps", nothing, lambda x, m: F.when(m["a"] == 0, m["b"]).otherwise(m["a"] * x + m["b"]))
    step = lambda x, r: (
        F.when(missing(r), x).when(r["first"], r["spread"]).otherwise(alpha * x + rest * r["spread"])
    )
    run = F.aggregate(
        "__rows",
        F.struct(start.alias("x"), F.array().cast("array<double>").alias("out")),
        lambda s, r: F.struct(step(s["x"], r).alias("x"), F.concat(s["out"], F.array(step(s["x"], r))).alias("out")),
        lambda s: s["out"],
    )
    return (
        blocks.withColumn("__map", F.aggregate("__rows", identity, compose))
        .withColumn("__maps", F.collect_list("__map").over(before))
        .withColumn("__out", run)
        .select("__out", F.posexplode("__rows").alias("__at", "__element"))
        .select("__element.row.*", F.element_at("__out", F.col("__at") + 1).alias("ema"))
    )


def filter_book(book: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Filtered quotes of both sides from a snapshot book, still wide.

    The restart flag is a window over the series, so the rows reach the fold
    clustered by series; they are sorted once per partition and may spill.
    The columns of a side are named ``c_*`` and ``p_*``.
    """
    prefixes = [side[0] for side in SIDES]
    quotes = [*SIDE_INPUTS, "last_sysid", "min_sysid"]
    flat = book.select(
        *SERIES,
        "idx",
        "time",
        "snapshot_sysid",
        session_restart(SERIES, "idx", F.col("time"), cfg).alias("restart"),
        *[
            F.col(side)[name].alias(f"{side[0]}_{name}")
            for side in SIDES
            for name in quotes
        ],
    ).sortWithinPartitions(*SERIES, "idx")
    schema = T.StructType(
        flat.schema.fields
        + [
            T.StructField(f"{p}_{name}", kind)
            for p in prefixes
            for name, kind in SIDE_OUTPUTS.items()
        ]
    )
    return flat.mapInArrow(lambda it: fold_quotes(it, prefixes, cfg), schema)


def conditions(passed: Column) -> list[Column]:
    return [passed.bitwiseAND(F.lit(1 << i)) > 0 for i in range(6)]


def with_outlier_codes(filtered: DataFrame) -> DataFrame:
    """Add ``*_last_outlier`` and ``*_min_outlier`` codes to a filtered book."""
    codes = {}
    for side in SIDES:
        p = side[0]
        codes[f"{p}_last_outlier"] = outlier_code_last(
            F.col(f"{p}_last_flag"), conditions(F.col(f"{p}_last_passed"))
        )
        codes[f"{p}_min_outlier"] = outlier_code_min(
            F.col(f"{p}_min_flag"),
            conditions(F.col(f"{p}_min_passed")),
            F.col(f"{p}_min_sysid"),
            F.col(f"{p}_last_sysid"),
        )
    return filtered.withColumns(codes)


def filtered_to_long(filtered: DataFrame) -> DataFrame:
    """Call and Put of a filtered book as rows."""
    shared = [*SERIES, "idx", "time", "snapshot_sysid", "restart"]
    names = [c[2:] for c in filtered.columns if c.startswith("c_")]
    sides = F.array(
        *[
            F.struct(
                F.lit(cp).alias("cp"), *[F.col(f"{side[0]}_{n}").alias(n) for n in names]
            )
            for side, cp in SIDES.items()
        ]
    )
    return filtered.select(*shared, F.inline(sides))
