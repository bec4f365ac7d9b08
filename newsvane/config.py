"""Job settings. Everything a job needs is passed in; nothing is read from the environment."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Thresholds:
    """Label cut points. A score on the cut point takes the label."""

    polarity_positive: float = 0.1
    polarity_negative: float = -0.1
    compound_positive: float = 0.05
    compound_negative: float = -0.05
    subjective: float = 0.5


@dataclass(frozen=True)
class SignalSettings:
    """Fixed values of the trading rule."""

    window_rows: int = 20
    z_threshold: float = 1.5
    initial_cash: float = 10_000.0
    lot_size: int = 20
    fee_rate: float = 0.001
    min_bars: int = 5


@dataclass(frozen=True)
class TopicSettings:
    """Fixed values of the topic models."""

    max_topics: int = 10
    iterations: int = 20
    keywords: int = 5
    vocabulary: int = 5_000
    min_documents: int = 5
    seed: int = 42


@dataclass(frozen=True)
class Settings:
    raw_zone: str
    database: str = "processed_zone"
    table_format: str = "parquet"
    report_root: str = "reports"
    thresholds: Thresholds = field(default_factory=Thresholds)
    signals: SignalSettings = field(default_factory=SignalSettings)
    topics: TopicSettings = field(default_factory=TopicSettings)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"
