"""Column-expression functions: each returns a ``Column`` and stays inside
Catalyst / whole-stage codegen (no Python UDFs)."""

from meteora.functions.numerics import round_half_up, safe_div, stamp
from meteora.functions.weather import (
    anomaly_type,
    condition_label,
    feels_like,
    lookup_label,
    severity,
    zscore,
)

__all__ = [
    "round_half_up", "safe_div", "stamp", "feels_like", "condition_label",
    "zscore", "anomaly_type", "severity", "lookup_label",
]
