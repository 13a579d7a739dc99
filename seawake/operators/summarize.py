"""Event-tagged messages to one row per fishing event.

Only two things depend on single messages: sums that combine in any order,
and the geometry.  The sums are taken first, with map-side combining and with
no vessel data on the messages; identity is joined to their result.  Geometry
is built for the events that pass the thresholds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.config import SQUID_JIGGER, EventRules, SessionRules
from seawake.functions.cells import s2_cell
from seawake.functions.geo import anti_lon, dateline_bbox, point, unit_vector, vector_lat, vector_lon
from seawake.functions.scalars import event_id, float_text, seconds_between
from seawake.operators.identity import (
    best_segment_vessel,
    fishing_vessels,
    good_segments,
    is_fishing_gear,
    vessel_attributes,
    with_identity,
)
from seawake.operators.joins import join_null_safe, semi
from seawake.operators.slices import time_slice
from seawake.sources.schemas import FILTERED_SCHEMA, conform

PART_KEYS = ["ssvid", "seg_id", "event_start", "year"]
EVENT_KEYS = [
    "ssvid",
    "seg_id",
    "vessel_id",
    "main_vessel_shipname",
    "main_vessel_flag",
    "best_best_vessel_class",
    "event_start",
]
# event_id stands for vessel_id and event_start
ROW_KEYS = ["event_id", *[k for k in EVENT_KEYS if k not in ("vessel_id", "event_start")]]


def after_first(column: str) -> Column:
    """The column, but null on the event's first message: it measures from outside the event."""
    return F.when(F.col("event_start") != F.col("timestamp"), F.col(column))


def summarize(messages: DataFrame) -> DataFrame:
    """Combinable sums per event and message year."""
    averaged = {
        "speed_knots": F.col("speed_knots"),
        "implied_speed_knots": after_first("implied_speed_knots"),
        "meters_to_prev": after_first("meters_to_prev"),
        "hours": after_first("hours"),
    }
    sums = [F.sum(value).alias(f"{name}_sum") for name, value in averaged.items()]
    counts = [F.count(value).alias(f"{name}_count") for name, value in averaged.items()]
    opposite = anti_lon(F.col("lon"))
    return messages.groupBy(*PART_KEYS).agg(
        F.max("timestamp").alias("event_end"),
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
        F.min(opposite).alias("anti_lon_min"),
        F.max(opposite).alias("anti_lon_max"),
        F.count(F.lit(1)).alias("message_count"),
        *sums,
        *counts,
    )


def combine_parts(parts: DataFrame) -> DataFrame:
    """Parts with equal vessel attributes become one event."""

    def average(name: str) -> Column:
        return F.sum(f"{name}_sum") / F.sum(f"{name}_count")

    return parts.groupBy(*EVENT_KEYS).agg(
        F.max("event_end").alias("event_end"),
        F.min("lat_min").alias("lat_min"),
        F.max("lat_max").alias("lat_max"),
        F.min("lon_min").alias("lon_min"),
        F.max("lon_max").alias("lon_max"),
        F.min("anti_lon_min").alias("anti_lon_min"),
        F.max("anti_lon_max").alias("anti_lon_max"),
        F.sum("message_count").alias("message_count"),
        average("speed_knots").alias("avg_speed_knots"),
        average("implied_speed_knots").alias("avg_implied_speed_knots"),
        average("meters_to_prev").alias("avg_meters_to_prev"),
        F.sum("meters_to_prev_sum").alias("event_distance_m"),
        average("hours").alias("avg_hours"),
        # which messages the event consists of; a year counts once per joined vessel row
        F.collect_list("year").alias("years"),
    )


def event_thresholds(events: DataFrame, rules: EventRules = EventRules()) -> DataFrame:
    return events.filter(
        (seconds_between(F.col("event_start"), F.col("event_end")) > rules.min_duration_s)
        & (F.col("message_count") > rules.min_messages)
        & (F.col("avg_speed_knots") < rules.max_avg_speed_knots)
    )


def class_filter(events: DataFrame, score_field: str, rules: EventRules = EventRules()) -> DataFrame:
    """Squid jiggers belong to one score, all others to the other; unknown classes to none."""
    squid = F.col("best_best_vessel_class") == SQUID_JIGGER
    if score_field == "nnet_score":
        return events.filter(~squid & (F.col("event_distance_m") > rules.min_distance_m))
    return events.filter(squid & (F.col("event_distance_m") > rules.min_squid_distance_m))


def identified_parts(
    parts: DataFrame,
    segments: DataFrame,
    segment_vessel: DataFrame,
    vessels: DataFrame,
    prefix: str,
    is_fishing: Callable[[Column], Column] = is_fishing_gear,
    rules: EventRules = EventRules(),
) -> DataFrame:
    """Parts on good segments, with the attributes of the segment's vessel that year."""
    on_good = semi(parts, good_segments(segments, rules.min_segment_positions))
    with_vessel = on_good.join(best_segment_vessel(segment_vessel), "seg_id").withColumnRenamed(
        "vessel_id", "segment_vessel_id"
    )
    attributes = vessel_attributes(fishing_vessels(vessels, is_fishing), prefix).withColumnsRenamed(
        {
            "prod_geartype": "best_best_vessel_class",
            "mmsi_flag": "main_vessel_flag",
            "shipname": "main_vessel_shipname",
        }
    )
    keyed = with_vessel.withColumn("vessel_id", F.col("segment_vessel_id"))
    # a vessel that is no fishing vessel keeps its messages but has no attributes
    return with_identity(keyed, attributes, "left").drop("segment_vessel_id", "vessel_ssvid", "prod_shiptype")


def summarize_scalars(
    messages: DataFrame,
    segments: DataFrame,
    segment_vessel: DataFrame,
    vessels: DataFrame,
    score_field: str,
    prefix: str,
    is_fishing: Callable[[Column], Column] = is_fishing_gear,
    rules: EventRules = EventRules(),
) -> DataFrame:
    """Kept events with all columns but the centroid and the point lists."""
    parts = identified_parts(
        summarize(messages), segments, segment_vessel, vessels, prefix, is_fishing, rules
    )
    kept = class_filter(event_thresholds(combine_parts(parts), rules), score_field, rules)
    west, east = dateline_bbox(*[F.col(c) for c in ("lon_min", "lon_max", "anti_lon_min", "anti_lon_max")])
    return (
        kept.withColumns({"lon_min": west, "lon_max": east})
        .withColumn(
            "event_id",
            event_id("fishing", F.col("vessel_id"), F.col("event_start"), F.col("event_end")),
        )
        .withColumn("event_end_date", F.to_date("event_end"))
        .drop("anti_lon_min", "anti_lon_max")
    )


def event_positions(messages: DataFrame, events: DataFrame) -> DataFrame:
    """The messages of kept events: row keys, timestamp, lon, lat."""
    more = [k for k in ROW_KEYS if k not in PART_KEYS]
    owners = events.select("*", F.explode("years").alias("year")).select(*PART_KEYS, *more)
    narrow = messages.select(*PART_KEYS, "timestamp", "lon", "lat")
    return join_null_safe(narrow, owners, PART_KEYS).select(*ROW_KEYS, "timestamp", "lon", "lat")


def centroids(positions: DataFrame) -> DataFrame:
    """Mean direction of the distinct points of each event."""
    x, y, z = unit_vector(F.col("lon"), F.col("lat"))
    return (
        positions.select(*ROW_KEYS, "lon", "lat")
        .distinct()
        .groupBy(*ROW_KEYS)
        .agg(F.sum(x).alias("x"), F.sum(y).alias("y"), F.sum(z).alias("z"))
        .select(
            *ROW_KEYS,
            vector_lat(F.col("x"), F.col("y"), F.col("z")).alias("lat_mean"),
            vector_lon(F.col("x"), F.col("y")).alias("lon_mean"),
        )
    )


def point_lists(positions: DataFrame, slice_seconds: int = SessionRules.slice_seconds) -> DataFrame:
    """Per event the ordered point text and the list of points with cells.

    The result holds a whole event in one row, as the stored layout asks.  It
    is gathered in two steps, so that sorting and formatting are spread over
    the slices of a long event.
    """
    text = F.concat(float_text(F.col("lon")), F.lit(" "), float_text(F.col("lat")))
    located = positions.select(
        *ROW_KEYS,
        time_slice(F.col("timestamp"), slice_seconds).alias("part"),
        F.struct(
            "timestamp",
            text.alias("text"),
            F.struct(
                point(F.col("lon"), F.col("lat")).alias("point"),
                s2_cell(F.col("lon"), F.col("lat")).alias("s2_cell"),
            ).alias("geo"),
        ).alias("stop"),
    )
    stops = F.sort_array(F.collect_list("stop"))
    slices = located.groupBy(*ROW_KEYS, "part").agg(stops.alias("stops")).select(
        *ROW_KEYS,
        F.struct(
            "part",
            F.array_join(F.transform("stops", lambda s: s["text"]), ", ").alias("text"),
            F.transform("stops", lambda s: s["geo"]).alias("geo"),
        ).alias("slice"),
    )
    return (
        slices.groupBy(*ROW_KEYS)
        .agg(F.sort_array(F.collect_list("slice")).alias("slices"))
        .select(
            *ROW_KEYS,
            F.array_join(F.transform("slices", lambda s: s["text"]), ", ").alias("points_wkt"),
            F.flatten(F.transform("slices", lambda s: s["geo"])).alias("geo_info"),
        )
    )


def summarize_events(
    messages: DataFrame,
    segments: DataFrame,
    segment_vessel: DataFrame,
    vessels: DataFrame,
    score_field: str,
    prefix: str,
    is_fishing: Callable[[Column], Column] = is_fishing_gear,
    rules: EventRules = EventRules(),
    lists: bool = True,
) -> DataFrame:
    """Filtered fishing events in the stored layout.

    Without ``lists`` the two columns that hold all points of an event are
    left out; ``event_positions`` has the same points one per row.
    """
    events = summarize_scalars(
        messages, segments, segment_vessel, vessels, score_field, prefix, is_fishing, rules
    )
    positions = event_positions(messages, events)
    out = join_null_safe(events.drop("years"), centroids(positions), ROW_KEYS)
    if not lists:
        return out.select(*[c for c in FILTERED_SCHEMA.names if c not in ("geo_info", "points_wkt")])
    return conform(join_null_safe(out, point_lists(positions), ROW_KEYS), FILTERED_SCHEMA)
