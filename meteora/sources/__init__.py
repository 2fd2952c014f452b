"""Sources: table scans, test-table adapters, payload landing."""

from meteora.sources.tables import load_table
from meteora.sources.adapters import events_observations, lineitem_observations, station_dim

__all__ = ["load_table", "events_observations", "lineitem_observations", "station_dim"]
