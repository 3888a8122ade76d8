"""Small builders and comparisons used by the tests."""

import contextlib
import io
import json
from datetime import datetime

from wayflux import schemas


def ts(text):
    return datetime.fromisoformat(text)


def bronze_rows(spark, rows):
    """Bronze from dicts; raw_json and kafka_timestamp get defaults."""
    full = [{"raw_json": json.dumps(r, default=str), "kafka_timestamp": ts("2024-01-01 00:00:00"),
             **{name: None for name in schemas.EVENT.names}, **r} for r in rows]
    return spark.createDataFrame([[r[n] for n in schemas.BRONZE.names] for r in full],
                                 schemas.BRONZE)


def envelope(spark, payloads, when="2024-01-01 00:00:00"):
    """Messages from texts or dicts."""
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    return spark.createDataFrame([(bytearray(t, "utf8"), ts(when)) for t in texts],
                                 schemas.ENVELOPE)


def event(vehicle="V1", at="2024-01-01 10:00:00", **changes):
    return {"vehicle_id": vehicle, "road_id": "R100", "city_zone": "CBD", "speed": "50",
            "congestion_level": 3, "weather": "CLEAR", "event_time": at, **changes}


def files(df):
    """The stored files the rows come from."""
    return {r.file_path for r in df.select("_metadata.file_path").distinct().collect()}


def values(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def physical_plan(df, mode="simple"):
    """Text of explain()."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()
