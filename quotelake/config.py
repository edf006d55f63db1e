"""Parameters of the quote filter, the index and the physical layout."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    # Fixed values of the published filter and index rules.
    product: str = "TXO"
    alpha: float = 0.95
    gamma_zero: float = 1.2
    gamma_down: float = 1.5
    gamma_up: float = 2.0
    spread_limit: float = 15.0
    mid_tolerance: float = 1e-9
    session_open: str = "090000"
    year_seconds: float = 31536000.0
    month_seconds: float = 2592000.0
    jump_ratio: float = 0.025
    jump_limit: int = 4
    step_seconds: int = 15
    diff_tolerance: float = 1e-4

    # Spreads that agree to this many decimals count as a tie.
    spread_digits: int = 8
    # Width of a sequence-number bucket in the interval join.
    seqno_bucket: int = 4096
    # A side is broadcast only if its rows and their width prove it is no larger.
    broadcast_bytes: int = 64 << 20
    # Rows the quote-filter fold holds in one Python worker at a time.
    fold_rows: int = 262_144


DEFAULT = EngineConfig()
