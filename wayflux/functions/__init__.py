"""Column functions: casts that never throw, rule columns and surrogate keys."""

from wayflux.functions.casts import lenient_int, lenient_timestamp, whole_number
from wayflux.functions.keys import surrogate_key
from wayflux.functions.rules import band, clip, first_match, flag, half_even, lookup

__all__ = ["band", "clip", "first_match", "flag", "half_even", "lenient_int", "lenient_timestamp",
           "lookup", "surrogate_key", "whole_number"]
