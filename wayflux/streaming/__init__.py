"""Streaming jobs of the layers, and the record of what their batches did."""

from wayflux.streaming.jobs import (
    refresh_star, rewrite_star, star_of, start_bronze, start_gold, start_silver, switch_star)
from wayflux.streaming.progress import ProgressLog

__all__ = ["ProgressLog", "refresh_star", "rewrite_star", "star_of", "start_bronze", "start_gold",
           "start_silver", "switch_star"]
