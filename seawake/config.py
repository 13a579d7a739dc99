"""Thresholds and fixed values of the event definitions."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------

# Registries whose public authorizations are evaluated.
WHITELISTED_RFMOS = ("ICCAT", "IOTC", "WCPFC", "IATTC", "CCSBT", "SPRFMO", "NPFC")

# Region layers, in the order of the published schema.
REGION_LAYERS = (
    "eez",
    "mpa",
    "mpa_no_take",
    "mpa_no_take_partial",
    "high_seas",
    "rfmo",
    "fao",
    "major_fao",
    "eez12nm",
    "hsp",
    "protectedseas",
    "duke_paa",
    "fra_gfcm_fao",
)

# Priority of the parts of a port visit when its anchorage is chosen.
PORT_EVENT_PRIORITY = ("PORT_STOP_BEGIN", "PORT_STOP_END", "PORT_GAP_BEGIN", "PORT_GAP_END")

# Authorization statuses.
STATUS_AUTHORIZED = "publicly_authorized"
STATUS_UNMATCHED = "not_matching_relevant_public_authorization"
STATUS_PENDING = "pending_info"
STATUS_PARTIAL = "partially_matched"

# Score columns an incremental load can read.
SCORE_FIELDS = ("nnet_score", "night_loitering")

SQUID_JIGGER = "squid_jigger"
# A voyage that starts on this date has no known start port.
UNKNOWN_TRIP_START = "1979-01-01"
HASHED_SSVID_LENGTH = 64
NULL_KEY = "NULL"
KM_PER_NAUTICAL_MILE = 1.852
EARTH_RADIUS_M = 6371010.0
S2_LEVEL = 10
# Levels of a covering; each boundary cell is divided into the cells of the next one.
COVERING_LEVELS = (6, 8, S2_LEVEL)

# --- thresholds -------------------------------------------------------------


@dataclass(frozen=True)
class SessionRules:
    """How scored messages become runs, and runs become events."""

    max_gap_hours: float = 2
    max_jump_m: float = 10_000
    fuse_seconds: int = 3_600
    fuse_distance_m: float = 2_000
    # Segments are processed in slices of this length.  A segment has at most
    # one message per second, so a slice holds at most this many rows.
    slice_seconds: int = 86_400


@dataclass(frozen=True)
class EventRules:
    """Which summarized fishing events are kept."""

    min_duration_s: int = 1_200
    min_messages: int = 5
    max_avg_speed_knots: float = 10
    min_distance_m: float = 500
    min_squid_distance_m: float = 50
    min_segment_positions: int = 10


@dataclass(frozen=True)
class EncounterRules:
    min_duration_s: int = 7_200
    max_median_speed_knots: float = 2


@dataclass(frozen=True)
class PortVisitRules:
    min_confidence: int = 2
