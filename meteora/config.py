"""Pipeline parameters.

The defaults are the fixed values the results must match (thresholds,
history floors, horizons, seeds); every job takes a ``PipelineConfig`` so
tests and small fixtures can override them without touching code.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class PipelineConfig:
    # --- fixed values (must equal the published pipeline's) -------------
    time_format: str = "yyyy-MM-dd'T'HH:mm"
    zscore_threshold: float = 2.5
    severity_extreme: float = 3.5
    severity_high: float = 2.5
    min_history_days: int = 30
    forecast_days: int = 7
    min_training_rows: int = 60
    interval_width: float = 0.80
    changepoint_prior_scale: float = 0.05
    k_min: int = 3
    k_max: int = 8
    kmeans_seed: int = 42
    silhouette_digits: int = 4
    quality_min_rows: int = 1_000_000
    retry_attempts: int = 2
    preview_rows: int = 20
    # --- ours ------------------------------------------------------------
    # Wall-clock stamp for ingested_at / detected_at / generated_at. None
    # means current_timestamp(); tests pass a constant.
    now: _dt.datetime | None = None
    # Rows to a partition of one-row-per-station frames (features). Hash
    # layout on the key keeps K-Means input identical across runs.
    stations_per_partition: int = 200_000
    # Hash buckets of the stations in a day of a state table (fixed when the
    # table is made).
    state_buckets: int = 32
    # Reporting precision of unrounded statistics (means, sigmas, z).
    stat_digits: int = 6
    cluster_labels: dict = field(
        default_factory=lambda: {0: "Humid & Mild", 1: "Dry", 2: "Warm & Humid"}
    )

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)


DEFAULT = PipelineConfig()
