"""Generic DataFrame operators: deduplication, star joins, breakdowns and data checks."""

from wayflux.operators.breakdown import (
    Measure, average, breakdown, count_of, is_rollup, roll_up, rows, rows_where, share, star_breakdown)
from wayflux.operators.dedup import dedup_stream, keep_first, thin_copies
from wayflux.operators.joins import Link, enrich, orphans

__all__ = ["Link", "Measure", "average", "breakdown", "count_of", "dedup_stream", "enrich",
           "is_rollup", "keep_first", "orphans", "roll_up", "rows", "rows_where", "share", "star_breakdown", "thin_copies"]
