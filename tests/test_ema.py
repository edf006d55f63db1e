"""The spread average as a scan in segments, against the recurrence row by row."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quotelake.config import DEFAULT
from quotelake.operators.filtering import ema_spread


def fold(rows):
    """``(series, idx, time, spread)`` in order -> average of each row."""
    found, series, state = {}, None, None
    for key, idx, time, spread in rows:
        if key != series or time == DEFAULT.session_open:
            series, state = key, None
        if spread is not None:
            state = spread if state is None else DEFAULT.alpha * state + (1 - DEFAULT.alpha) * spread
        found[key, idx] = state
    return found


def sessions(seed, series, length):
    rng, rows = random.Random(seed), []
    for key in range(series):
        opens = {rng.randrange(length), rng.randrange(length)}
        silent = rng.choice([0.0, 0.3, 0.9, 1.0])
        for idx in range(length):
            time = DEFAULT.session_open if idx in opens else f"{100000 + idx}"
            rows.append((key, idx, time, None if rng.random() < silent else rng.uniform(0.1, 50)))
    return rows


@pytest.mark.parametrize("length,block", [(1200, 64), (130, 1), (70, 7), (1, 64)])
def test_average_equals_the_fold(spark, length, block):
    rows = sessions(length, 12, length)
    frame = spark.createDataFrame(rows, "series int, idx int, time string, spread double").repartition(5)
    found = ema_spread(frame.withColumn("block", F.lit("x")), ["series"], "idx", "spread", block=block)
    assert found.columns == ["series", "idx", "time", "spread", "block", "ema"]
    got = {(r["series"], r["idx"]): r["ema"] for r in found.collect()}
    expected = fold(rows)
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert (got[key] is None) == (value is None)
        assert value is None or math.isclose(got[key], value, rel_tol=1e-9)


def test_no_python_and_one_shuffle(spark):
    frame = spark.createDataFrame(sessions(1, 2, 5), "series int, idx int, time string, spread double")
    plan = ema_spread(frame, ["series"], "idx", "spread")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
