"""Column contracts of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, DATE = T.StringType(), T.IntegerType(), T.DateType()
INSTANT, WALL_CLOCK = T.TimestampType(), T.TimestampNTZType()


def _columns(**types: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name, data_type in types.items()]


# Payload of one message.  speed and event_time stay text: bad values are flagged later, not lost.
EVENT = T.StructType(_columns(
    vehicle_id=TEXT, road_id=TEXT, city_zone=TEXT, speed=TEXT, congestion_level=INT, weather=TEXT,
    event_time=TEXT))

# What a message log delivers.
ENVELOPE = T.StructType(_columns(value=T.BinaryType(), timestamp=INSTANT))

BRONZE = T.StructType(_columns(raw_json=TEXT, kafka_timestamp=INSTANT) + EVENT.fields)

SILVER = T.StructType(BRONZE.fields + _columns(
    dq_flag=TEXT, speed_int=INT, event_ts=INSTANT, speed_valid=INT, time_valid=INT, hour=INT,
    peak_flag=INT, speed_band=TEXT))

# Stored silver carries its partition column behind the contract columns.
EVENT_DATE = "event_date"
SILVER_STORED = T.StructType(SILVER.fields + _columns(**{EVENT_DATE: DATE}))

DIM_ZONE = T.StructType(_columns(city_zone=TEXT, zone_type=TEXT, traffic_risk=TEXT))
ZONE_POSITION = T.StructType(_columns(city_zone=TEXT, lat=T.DoubleType(), lon=T.DoubleType()))
DIM_ROAD = T.StructType(_columns(road_id=TEXT, road_type=TEXT, speed_limit=INT))


def _fact(event_ts: T.DataType) -> T.StructType:
    return T.StructType(_columns(
        vehicle_id=TEXT, road_id=TEXT, city_zone=TEXT, speed_int=INT, congestion_level=INT,
        event_ts=event_ts, peak_flag=INT, speed_band=TEXT, hour=INT, weather=TEXT, date=DATE))


FACT = _fact(INSTANT)
# Staging keeps wall-clock timestamps: the warehouse column has no zone.
STAGED_FACT = _fact(WALL_CLOCK)

# Partial sums of the events mart, for reports that show no single event.
TRAFFIC_DAILY = T.StructType(_columns(
    date=DATE, hour=INT, city_zone=TEXT, road_id=TEXT, weather=TEXT, speed_band=TEXT, peak_flag=INT,
    rows_n=T.LongType(), vehicle_id_n=T.LongType(), speed_int_n=T.LongType(),
    congestion_level_n=T.LongType(), speed_int_sum=T.LongType(), congestion_level_sum=T.LongType()))

# What a day adds to the data checks, and what was found and loaded in each run.
CHECK_PARTS = T.StructType(_columns(
    model=TEXT, column_name=TEXT, test=TEXT, value=TEXT, rows=T.LongType(), date=DATE))
CHECK_HISTORY = T.StructType(_columns(
    model=TEXT, column_name=TEXT, test=TEXT, failures=T.LongType(), status=TEXT, checked_at=INSTANT,
    run=TEXT))
STREAM_PROGRESS = T.StructType(_columns(
    query_id=TEXT, run_id=TEXT, query_name=TEXT, batch_id=T.LongType(), at=INSTANT,
    input_rows=T.LongType(), late_rows=T.LongType(), state_rows=T.LongType(),
    removed_rows=T.LongType(), watermark=INSTANT))
LOAD_HISTORY = T.StructType(_columns(table=TEXT, rows=T.LongType(), loaded_at=INSTANT, run=TEXT))

DIM_LOCATIONS = T.StructType(_columns(location_id=TEXT) + DIM_ZONE.fields + DIM_ROAD.fields)
FCT_EVENTS = T.StructType(_columns(event_id=TEXT, location_id=TEXT) + STAGED_FACT.fields)
