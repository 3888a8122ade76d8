"""Silver: events judged, typed, deduplicated and enriched.

The same steps serve a stored bronze table and a bronze stream; only deduplication differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux import schemas
from wayflux.domain import DQ_OK, SILVER_RULES, SilverRules
from wayflux.functions import band, first_match, flag, lenient_int, lenient_timestamp
from wayflux.operators import dedup_stream, keep_first

# Verdict columns hold these values in every clean row, so they need not travel in a shuffle.
_CLEAN_VERDICT = {"dq_flag": DQ_OK, "speed_valid": 1, "time_valid": 1}


def judge(bronze: DataFrame, as_of: Column | None = None,
          rules: SilverRules = SILVER_RULES) -> DataFrame:
    """Bronze plus the record flag, typed speed and time, and their validity.

    ``as_of`` replaces the clock, which makes batch results repeatable.
    """
    now = F.current_timestamp() if as_of is None else as_of
    latest = now + F.expr(f"INTERVAL {rules.future_tolerance}")
    typed = bronze.withColumns({
        "dq_flag": first_match([(name, F.expr(sql)) for name, sql in rules.dq_rules], DQ_OK),
        "speed_int": lenient_int(F.col("speed")),
        "event_ts": lenient_timestamp(F.col("event_time")),
    })
    return typed.withColumns({
        "speed_valid": flag(F.col("speed_int").between(*rules.speed_range)),
        "time_valid": flag(F.col("event_ts") <= latest),
    })


def keep_clean(judged: DataFrame) -> DataFrame:
    """Rows that passed every check, without the verdict columns."""
    passed = [F.col(name) == F.lit(value) for name, value in _CLEAN_VERDICT.items()]
    for condition in passed:
        judged = judged.where(condition)
    return judged.drop(*_CLEAN_VERDICT)


def add_features(clean: DataFrame, rules: SilverRules = SILVER_RULES) -> DataFrame:
    """Hour, peak flag and speed band; columns in contract order."""
    hour = F.hour("event_ts")
    featured = clean.withColumns({
        **{name: F.lit(value) for name, value in _CLEAN_VERDICT.items()},
        "hour": hour,
        "peak_flag": flag(hour.between(*rules.peak_hours)),
        "speed_band": band(F.col("speed_int"), rules.speed_bands, rules.top_band),
    })
    return featured.select(*schemas.SILVER.names)


def silver(bronze: DataFrame, as_of: Column | None = None,
           rules: SilverRules = SILVER_RULES) -> DataFrame:
    """Batch form.  Of repeated readings the one that arrived first stays."""
    clean = keep_clean(judge(bronze, as_of, rules))
    unique = keep_first(clean, rules.event_key, ("kafka_timestamp", "raw_json"))
    return add_features(unique, rules)


def silver_stream(bronze: DataFrame, as_of: Column | None = None,
                  rules: SilverRules = SILVER_RULES, thin: bool = True) -> DataFrame:
    """Streaming form.  The watermark follows clean rows only, as bad clocks must not move it."""
    clean = keep_clean(judge(bronze, as_of, rules))
    unique = dedup_stream(clean, rules.event_key, "event_ts", rules.lateness, thin)
    return add_features(unique, rules)


def with_event_date(silver_rows: DataFrame) -> DataFrame:
    """Add the column stored silver is partitioned by."""
    return silver_rows.withColumn(schemas.EVENT_DATE, F.to_date("event_ts"))
