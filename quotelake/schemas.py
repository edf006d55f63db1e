"""Explicit schemas of every file format; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw tick files and what they are called here.
TICK_COLUMNS = {
    "svel_i081_yymmdd": "file_date",
    "svel_i081_prod_id": "prod_id",
    "svel_i081_time": "tick_time",
    "svel_i081_best_buy_price1": "bid",
    "svel_i081_best_sell_price1": "ask",
    "svel_i081_seqno": "seqno",
}

# Columns used of the official wide quote file, found by name.
OFFICIAL_QUOTE_COLUMNS = [
    "date", "time", "strike",
    "c.bid", "c.ask", "p.bid", "p.ask",
    "c.source", "p.source", "c.sysID", "p.sysID",
    "c.last_bid", "c.last_ask", "c.last_sysID", "c.last_outlier",
    "p.last_bid", "p.last_ask", "p.last_sysID", "p.last_outlier",
    "c.min_bid", "c.min_ask", "c.min_sysID", "c.min_outlier",
    "p.min_bid", "p.min_ask", "p.min_sysID", "p.min_outlier",
    "c.ema", "p.ema", "c.gamma", "p.gamma",
    "snapshot_call_bid", "snapshot_call_ask",
    "snapshot_put_bid", "snapshot_put_ask", "snapshot_sysID",
]

# Columns of the computed wide quote file after the date.
WIDE_QUOTE_COLUMNS = [
    "time", "strike",
    "c.bid", "c.ask", "p.bid", "p.ask", "c.source", "p.source",
    "c.last_bid", "c.last_ask", "c.last_sysID", "c.last_outlier",
    "p.last_bid", "p.last_ask", "p.last_sysID", "p.last_outlier",
    "c.min_bid", "c.min_ask", "c.min_sysID", "c.min_outlier",
    "p.min_bid", "p.min_ask", "p.min_sysID", "p.min_outlier",
    "c.ema", "p.ema", "c.gamma", "p.gamma", "snapshot_sysID",
]

SIDE_PREFIX = {"Call": "c", "Put": "p"}


def column_name(file_name: str) -> str:
    """``c.last_sysID`` -> ``c_last_sysid``; dots need no quoting this way."""
    return file_name.replace(".", "_").lower()


def file_column(name: str) -> str:
    """Inverse of :func:`column_name` for the wide quote columns."""
    known = {column_name(c): c for c in OFFICIAL_QUOTE_COLUMNS}
    return known.get(name, name)


# Columns of the index files.
SIGMA_COLUMNS = {
    "date": "file_date",
    "time": "time",
    "nearT": "near_t",
    "nearW": "near_w",
    "nearSigma2": "near_sigma2",
    "nearType": "near_type",
    "nextT": "next_t",
    "nextW": "next_w",
    "nextSigma2": "next_sigma2",
    "nextType": "next_type",
    "vix": "published",
    "ori_vix": "original",
}
FORWARD_COLUMNS = {"time": "time", "tw_fwd": "tw_fwd", "k0": "k0"}
RATE_COLUMNS = {"near_r": "near_r", "next_r": "next_r"}
CONTRIB_COLUMNS = {
    "time": "time", "strike": "strike",
    "c.bid": "c_bid", "c.ask": "c_ask", "p.bid": "p_bid", "p.ask": "p_ask",
    "mid": "mid", "contrib": "contrib",
}

# Columns of the difference report.
DIFF_COLUMNS = [
    "Date", "Time", "Term", "Strike", "CP", "Column",
    "Ours", "PROD", "SysID", "Prev_SysID",
]


def text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
