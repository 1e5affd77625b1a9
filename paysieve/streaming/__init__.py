"""Streaming ingestion and counts (our extension)."""

from paysieve.streaming.counts import corrected, current, stream_counts, trailing_counts
from paysieve.streaming.ingest import (
    merge_silver,
    parse_values,
    remove_merged,
    stream_to_bronze,
    stream_to_updates,
    without_repeats,
)

__all__ = [
    "corrected",
    "current",
    "merge_silver",
    "parse_values",
    "remove_merged",
    "stream_counts",
    "stream_to_bronze",
    "stream_to_updates",
    "trailing_counts",
    "without_repeats",
]
