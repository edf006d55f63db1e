"""Order-insensitive comparison of a Spark and a DuckDB result."""

from __future__ import annotations

import math


def plain(value):
    if value is None:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return None if math.isnan(value) else float(value)
    return None if str(value) in ("NaT", "<NA>") else value


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    order = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    return list(frame.columns), sorted(rows, key=order)
