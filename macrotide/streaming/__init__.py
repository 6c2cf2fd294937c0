"""Incremental forms of the bronze-to-silver steps (Structured Streaming)."""
from macrotide.streaming.ingest import run_available, run_merged, stream_bronze, stream_dedupe, stream_silver_prices, stream_windows

__all__ = ["run_available", "run_merged", "stream_bronze", "stream_dedupe", "stream_silver_prices", "stream_windows"]
from macrotide.streaming.routes import run_routed, routed_network, routed_table, stream_documents  # noqa: F401
