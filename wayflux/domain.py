"""The traffic domain: the values that configure the generic operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# ---- Fixed values: results must equal the known ones, so these are stated as they are. ----------

# Record flags in the order they are tried, each with its SQL condition; the rest is OK.
DQ_RULES = (
    ("MISSING_VEHICLE", "vehicle_id IS NULL"),
    ("MISSING_TIME", "event_time IS NULL"),
    ("CORRUPTED_JSON", "contains(raw_json, 'CORRUPTED')"),
)
DQ_OK = "OK"

SPEED_RANGE = (0, 160)
FUTURE_TOLERANCE = "10 minutes"
LATENESS = "15 minutes"
PEAK_HOURS = (17, 20)
SPEED_BANDS = ((30, "LOW"), (70, "MEDIUM"))
TOP_SPEED_BAND = "HIGH"

ZONE_TYPES = {
    "CBD": "Commercial",
    "TECHPARK": "IT HUB",
    "AIRPORT": "TRANSIT HUB",
    "TRAINSTATION": "TRANSIT HUB",
}
OTHER_ZONE_TYPE = "Residential"

ZONE_RISKS = {"CBD": "HIGH", "AIRPORT": "HIGH", "TECHPARK": "MEDIUM"}
OTHER_ZONE_RISK = "LOW"

ROAD_TYPES = {"R100": "Highway", "R200": "Highway"}
OTHER_ROAD_TYPE = "City Road"

SPEED_LIMITS = {"R100": 100, "R200": 100}
OTHER_SPEED_LIMIT = 60

# zone, latitude, longitude
ZONE_POSITIONS = (
    ("CBD", 51.5076, -0.1278),
    ("TECHPARK", 51.5158, -0.0987),
    ("AIRPORT", 51.4700, -0.4543),
    ("TRAINSTATION", 51.5319, -0.1233),
    ("SUBURB", 51.5484, -0.1982),
)

ZONES = ("CBD", "AIRPORT", "TECHPARK", "SUBURB", "TRAINSTATION")
RISKS = ("HIGH", "MEDIUM", "LOW")
ROADS = ("R100", "R200", "R300", "R400")
BANDS = ("LOW", "MEDIUM", "HIGH")
WEATHERS = ("CLEAR", "RAIN", "FOG", "STORM")

PEAK_LABELS = {1: "Peak", 0: "Off-Peak"}
OTHER_PEAK_LABEL = "Unknown"
UNKNOWN = "UNKNOWN"

# Map marker: radius per event, and the (slope, low, high) of the colour channels.
MARKER_RADIUS = 350
MARKER_RED = (42, 0, 255)
MARKER_GREEN = (220, 25, 50, 220)
MARKER_BLUE = 105

# -------------------------------------------------------------------------------------------------

# A reading is one vehicle at one moment.
EVENT_KEY = ("vehicle_id", "event_ts")


@dataclass(frozen=True)
class SilverRules:
    """How raw events are judged and enriched."""

    dq_rules: tuple[tuple[str, str], ...] = DQ_RULES
    speed_range: tuple[int, int] = SPEED_RANGE
    future_tolerance: str = FUTURE_TOLERANCE
    lateness: str = LATENESS
    peak_hours: tuple[int, int] = PEAK_HOURS
    speed_bands: tuple[tuple[int, str], ...] = SPEED_BANDS
    top_band: str = TOP_SPEED_BAND
    event_key: tuple[str, ...] = EVENT_KEY


@dataclass(frozen=True)
class MemberRule:
    """One dimension attribute: known members and the value of all others."""

    known: Mapping[str, str | int]
    otherwise: str | int


@dataclass(frozen=True)
class StarRules:
    """How dimension attributes follow from the member."""

    zone: Mapping[str, MemberRule] = field(default_factory=lambda: {
        "zone_type": MemberRule(ZONE_TYPES, OTHER_ZONE_TYPE),
        "traffic_risk": MemberRule(ZONE_RISKS, OTHER_ZONE_RISK),
    })
    road: Mapping[str, MemberRule] = field(default_factory=lambda: {
        "road_type": MemberRule(ROAD_TYPES, OTHER_ROAD_TYPE),
        "speed_limit": MemberRule(SPEED_LIMITS, OTHER_SPEED_LIMIT),
    })
    event_key: tuple[str, ...] = EVENT_KEY


SILVER_RULES = SilverRules()
STAR_RULES = StarRules()
