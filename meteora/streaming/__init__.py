"""Incremental forms of the hourly rebuild (Structured Streaming)."""

from meteora.streaming.incremental import daily_stream, silver_stream, start_silver_and_daily

__all__ = ["silver_stream", "daily_stream", "start_silver_and_daily"]
