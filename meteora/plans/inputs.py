"""Stage builders over a directory of driver tables (lazy, no actions)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from meteora.config import PipelineConfig
from meteora.operators.gold import gold_daily
from meteora.operators.silver import to_silver
from meteora.sources.adapters import load_events_observations, load_lineitem_observations
from meteora.sources.tables import load_table

# Query-time configuration: a fixed clock so lineage stamps are constant.
QCFG = PipelineConfig(now=_dt.datetime(2026, 1, 1, 0, 0, 0))
# Adapter A has 21-30 days per station: its history floor is a parameter.
QCFG_A = QCFG.with_(min_history_days=20)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return load_table(spark, root, name)


def obs_a(spark, root, hour_grain=False, cfg=QCFG) -> DataFrame:
    return load_events_observations(spark, root, cfg, hour_grain)


def obs_b(spark, root, cfg=QCFG) -> DataFrame:
    return load_lineitem_observations(spark, root, cfg)


def silver_a(spark, root, cfg=QCFG) -> DataFrame:
    return to_silver(obs_a(spark, root, cfg=cfg), cfg)


def silver_b(spark, root, cfg=QCFG) -> DataFrame:
    return to_silver(obs_b(spark, root, cfg), cfg)


def daily_a(spark, root, cfg=QCFG) -> DataFrame:
    return gold_daily(silver_a(spark, root, cfg))


def daily_b(spark, root, cfg=QCFG) -> DataFrame:
    return gold_daily(silver_b(spark, root, cfg))
