"""Structured Streaming forms of the pipeline stages."""

from tierone.streaming.incremental import incremental_silver_financials

__all__ = ["incremental_silver_financials"]
