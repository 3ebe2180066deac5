"""Operator settings as frozen dataclasses (plan-time constants)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Ordering:
    """How an ordered series is keyed and laid out over the cluster.

    ``keys`` name one series (an instrument), ``order`` orders its rows and
    must be unique within a key. ``chunk_rows=None`` windows by key alone,
    which is right when there are many keys of modest size. With a number,
    every key is cut into position chunks of that many rows and bounded frames
    get a halo from their neighbours, so one hot key spreads over many tasks.
    ``bucket`` is the time width used to count rows when positions are built; a burst
    within one bucket is spread by ``cuts``. ``partitions`` deals the chunks over that many
    shuffle partitions, as many as the engine finds right without it.
    """

    keys: tuple[str, ...] = ("symbol",)
    order: tuple[str, ...] = ("ts", "seq")
    chunk_rows: int | None = None
    bucket: str = "1 hour"
    partitions: int | None = None
    # Cuts of over-full buckets, a table a level, made by ``operators.cells.even_cells``.
    cuts: object = field(default=None, compare=False, hash=False, repr=False)


@dataclass(frozen=True)
class FeatureConfig:
    # The reference's extractor defaults.
    ofi_levels: int = 5
    ofi_window: int = 10
    spread_window: int = 20
    depth_levels: int = 5
    depth_window: int = 10
    imbalance_levels: int = 5
    imbalance_window: int = 10
    vwap_window: int = 20
    return_windows: tuple[int, ...] = (1, 5, 10, 20)
    microprice_window: int = 10
    # Offer the volume-weighted form the reference documents but does not use.
    vwap_volume: bool = False
    # Leave out statistics whose window is below their minimum size
    # (std needs 2, skew 3, kurtosis 4): these columns are always null.
    model_ready: bool = False

    def lookback(self) -> int:
        """Rows before the current one any feature reads (halo depth)."""
        return max(
            self.ofi_window, self.spread_window + 1, self.depth_window,
            self.imbalance_window, self.vwap_window, self.microprice_window,
            max(self.return_windows) + 1,
        )

    def lookahead(self) -> int:
        return max(self.return_windows)


@dataclass(frozen=True)
class LabelConfig:
    horizon: int = 1
    threshold: float = 0.001
    method: str = "ternary"

    def __post_init__(self):
        if self.method not in ("ternary", "binary"):
            raise ValueError(f"Unknown labeling method: {self.method}")


@dataclass(frozen=True)
class SignalConfig:
    long_threshold: float = 0.6
    short_threshold: float = 0.4
    position_sizing: str = "fixed"
    position_size: float = 1.0
    kelly_fraction: float = 0.25
    max_position: float = 10.0


@dataclass(frozen=True)
class ExecutionConfig:
    transaction_cost: float = 0.001
    slippage: float = 0.0005
    max_position: float = 10.0
    min_trade_size: float = 0.1
    execution_delay: int = 1
    # "reference": ledger columns only on trade rows, pnl restarts after a
    # row without a trade; "mtm": marked-to-market accounting.
    mode: str = "reference"
    carry_position: bool = False
    # Sizes may change by less than min_trade_size from row to row: such targets are
    # not traded, and the position is followed as the recurrence that makes it.
    dead_band: bool = False

    def __post_init__(self):
        if self.dead_band and not self.min_trade_size > 0:
            raise ValueError("a dead band needs min_trade_size above 0")


@dataclass(frozen=True)
class MetricsConfig:
    risk_free_rate: float = 0.02
    benchmark_return: float = 0.0
    trading_days: int = 252


@dataclass(frozen=True)
class ModelConfig:
    model_type: str = "logistic_regression"
    params: dict = field(default_factory=dict, hash=False)
    seed: int = 42
