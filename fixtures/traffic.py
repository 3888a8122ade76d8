"""Traffic messages derived from the ``events`` table, clean and broken ones alike.

``events`` is read once: repeated rows come from an explode, not from a second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-25 00:00:00"
FIELDS = ("vehicle_id", "road_id", "city_zone", "speed", "congestion_level", "weather",
          "event_time")

# Every so many events the message is malformed in one of these ways.
NO_JSON, WRAPPED, BARE_SPEED = 101, 103, 107
WRAPPER = '{"raw":"###CORRUPTED_EVENT###"}'

# The number inside props, in either engine.
SPARK_K = "cast(get_json_object(props, '$.k') as int)"
DUCKDB_K = "cast(json_extract_string(props, '$.k') as int)"


def raw_columns(k: str, gaps: bool = False) -> dict[str, str]:
    """Message fields as SQL that Spark and DuckDB both read.

    With ``gaps`` some zones, roads and weathers are missing or unheard of.
    """
    road = (f"case {k} % 4 when 0 then 'R100' when 1 then 'R200' when 2 then 'R300'"
            " else 'R400' end")
    zone = ("case event_type when 'click' then 'CBD' when 'error' then 'AIRPORT'"
            " when 'purchase' then 'TECHPARK' when 'signup' then 'SUBURB'"
            " else 'TRAINSTATION' end")
    weather = ("case event_id % 4 when 0 then 'CLEAR' when 1 then 'RAIN' when 2 then 'FOG'"
               " else 'STORM' end")
    if gaps:
        road = f"case when event_id % 73 = 0 then null else {road} end"
        zone = f"case when event_id % 71 = 0 then null else {zone} end"
        weather = ("case when event_id % 79 = 0 then null when event_id % 83 = 0 then 'HAIL'"
                   f" else {weather} end")
    return {
        "event_id": "event_id",
        "ts": "ts",
        "vehicle_id": "case when event_id % 97 = 0 then null"
                      " else 'V' || cast(user_id as varchar(20)) end",
        "road_id": road,
        "city_zone": zone,
        "speed": "case when event_id % 53 = 0 then 'FAST' when event_id % 59 = 0 then null"
                 " when event_id % 61 = 0 then '-40'"
                 " else cast(cast(floor(value * 4) as bigint) as varchar(20)) end",
        "congestion_level": f"cast(1 + ({k} % 5) as int)",
        "weather": weather,
        "event_time": "case when event_id % 89 = 0 then null else cast(ts as varchar(30)) end",
        "note": "case when event_id % 41 = 0 then '###CORRUPTED_EVENT###' end",
        "road_condition": "case when event_id % 43 = 0 then 'GOOD' end",
    }


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def traffic_raw(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Fields of every message, every 31st message twice."""
    events = table(spark, sf_dir, "events")
    columns = raw_columns(SPARK_K, gaps)
    fields = events.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    copies = F.when(F.col("event_id") % 31 == 0, twice).otherwise(once)
    return fields.withColumn("copy", F.explode(copies)).drop("copy")


def envelope(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """The messages as a log delivers them: JSON bytes and a broker time.

    Some lines are no JSON, some wrap an event that was lost, some have their speed as a number.
    """
    payload = F.to_json(F.struct(*FIELDS, "note", "road_condition"))
    number = F.col("event_id")
    payload = (F.when(number % NO_JSON == 0, F.concat(F.lit("broken line "), number.cast("string")))
               .when(number % WRAPPED == 0, F.lit(WRAPPER))
               .when(number % BARE_SPEED == 0, F.regexp_replace(payload, r'"speed":"(-?[0-9]+)"', '"speed":$1'))
               .otherwise(payload))
    return traffic_raw(spark, sf_dir, gaps).select(
        payload.cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")
