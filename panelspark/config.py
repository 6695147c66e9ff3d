"""Typed configuration surface (N10): defaults, partial update, dump to a dict."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field

# Fixed values that must equal the reference defaults.
DEFAULT_FEATURES = ("r_1d", "lag", "sma", "vix", "rsi", "macd", "boll", "range", "gap")
DEFAULT_TICKERS = ("AAPL", "MSFT", "NVDA", "GOOGL", "AMZN", "META", "TSLA", "AVGO",
                   "TSM", "ORCL", "WMT", "JPM", "INTC", "UNH", "HD")


@dataclass(frozen=True)
class PanelConfig:
    features: tuple = DEFAULT_FEATURES
    add_int_features: bool = True
    horizon: int = 5
    threshold: float = 0.01
    ticker_list: tuple = DEFAULT_TICKERS
    train_cutoff: str = "2019-01-01"
    validate_cutoff: str = "2022-01-01"  # start of the final test
    fold_len: str = "365D"
    fold_mode: str = "expanding"  # or "sliding"
    sliding_train_years: int | None = None
    embargo_days: int | None = None  # None: use horizon
    # "reference": reproduce which feature groups the reference pipeline really emits
    # (its lag / volatility switches never fire); "full": every requested group.
    profile: str = "reference"
    align: str = "ordinal"  # fold alignment across tickers: "ordinal" or "calendar"
    processed_path: str | None = None
    raw_path: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.fold_mode not in ("expanding", "sliding"):
            raise ValueError(f"unknown fold mode {self.fold_mode!r}")
        if self.fold_mode == "sliding" and not self.sliding_train_years:
            raise ValueError("sliding mode needs sliding_train_years")
        if self.profile not in ("reference", "full"):
            raise ValueError("profile must be 'reference' or 'full'")
        if self.align not in ("ordinal", "calendar"):
            raise ValueError("align must be 'ordinal' or 'calendar'")
        if isinstance(self.features, str):
            object.__setattr__(self, "features",
                               tuple(f.strip() for f in self.features.split(",") if f.strip()))

    @property
    def embargo(self) -> int:
        return int(self.embargo_days) if self.embargo_days is not None else int(self.horizon)

    def updated(self, **changes) -> "PanelConfig":
        return dataclasses.replace(self, **{k: v for k, v in changes.items() if v is not None})

    def to_dict(self) -> dict:
        return dataclasses.asdict(self)
