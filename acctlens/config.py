"""Analyzer parameters (window cadences, anomaly threshold, model settings)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class AnalyzerConfig:
    """Cadences are in seconds.  Sliding windows are ``2 * slide`` long.

    Defaults are the reference deployment values; ``SCALED_CONFIG`` below is
    the same shape stretched to the 30-day test tables.
    """

    # fixed values: reference defaults
    bras_agg1_seconds: int = 5
    bras_agg2_seconds: int = 30
    term_cause_agg1_seconds: int = 60
    bras_std_dev_anomaly: float = 4
    lookback_seconds: int = 150
    kmeans_k: int = 2
    kmeans_seed: int = 1
    outlier_sigmas: float = 2.0
    alive_watermark_seconds: int = 3
    agg_watermark_seconds: int = 5
    stop_watermark_seconds: int = 10

    def __post_init__(self) -> None:
        if self.bras_agg1_seconds <= 0 or self.bras_agg2_seconds <= 0:
            raise ValueError("window slides must be positive")
        if self.bras_agg2_seconds % self.bras_agg1_seconds != 0:
            raise ValueError("bras_agg2_seconds is not a multiple of bras_agg1_seconds")

    @property
    def sample_size(self) -> int:
        """Number of stage-1 counts expected inside one stage-2 window."""
        return 2 * self.bras_agg2_seconds // self.bras_agg1_seconds

    @staticmethod
    def interval(seconds: int) -> str:
        return f"{int(seconds)} seconds"


HOUR = 3600

# The driver's event tables span 30 days, so the reference cadences are
# stretched keeping every ratio: slide ratio 6 (sampleSize 12), lookback of
# five stage-2 slides, watermark/slide ratios 3/5, 5/30 and 10/60.
SCALED_CONFIG = AnalyzerConfig(
    bras_agg1_seconds=6 * HOUR,
    bras_agg2_seconds=36 * HOUR,
    term_cause_agg1_seconds=24 * HOUR,
    bras_std_dev_anomaly=2,
    lookback_seconds=180 * HOUR,
    alive_watermark_seconds=6 * HOUR * 3 // 5,
    agg_watermark_seconds=36 * HOUR * 5 // 30,
    stop_watermark_seconds=24 * HOUR * 10 // 60,
)
