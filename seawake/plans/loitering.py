"""Loitering events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.functions.documents import json_text
from seawake.functions.scalars import event_id, filter_invalid_ssvid, nm_to_km
from seawake.operators.identity import good_segments, vessel_attributes, with_identity
from seawake.operators.regions import with_distances
from seawake.operators.sessionize import as_instant
from seawake.operators.voyages import destination_port, destination_struct, next_voyage
from seawake.plans.port_visits import with_mean_regions


def offshore_loitering(df: DataFrame, start: str | date, min_nm: float) -> DataFrame:
    """Loitering since start, far enough from shore on average."""
    return df.filter(
        (F.col("loitering_start_timestamp") >= as_instant(start)) & (F.col("avg_distance_from_shore_nm") >= min_nm)
    )


def with_segment_vessel(loitering: DataFrame, segment_info: DataFrame, vessels: DataFrame, prefix: str) -> DataFrame:
    """The segment's vessel, and its attributes in the year of the start."""
    dated = loitering.withColumn("year", F.year("loitering_start_timestamp").cast("long"))
    owned = dated.join(segment_info.select("seg_id", "vessel_id"), "seg_id")
    return with_identity(owned, vessel_attributes(vessels, prefix), "inner")


def loitering_events(
    loitering: DataFrame,
    segment_info: DataFrame,
    segments: DataFrame,
    vessels: DataFrame,
    voyages: DataFrame,
    port_events: DataFrame,
    measures: DataFrame,
    regions: DataFrame,
    start: str | date,
    min_nm: float,
    prefix: str,
    edges: str = "spherical",
) -> DataFrame:
    """``port_events`` are published port-visit events."""
    far = offshore_loitering(loitering, start, min_nm)
    # a segment listed twice counts twice
    clean = far.join(good_segments(segments), "seg_id")
    owned = with_segment_vessel(clean, segment_info, vessels, prefix)
    # narrow lookups first, texts last
    owned = with_distances(owned, measures, F.col("start_lon"), F.col("start_lat"), "start")
    owned = with_distances(owned, measures, F.col("end_lon"), F.col("end_lat"), "end")
    bound = destination_port(
        next_voyage(owned, voyages, "vessel_id", "loitering_start_timestamp", "loitering_end_timestamp"),
        port_events,
    )
    info = F.struct(
        "loitering_hours",
        nm_to_km(F.col("tot_distance_nm")).alias("total_distance_km"),
        nm_to_km(F.col("avg_distance_from_shore_nm")).alias("avg_distance_from_shore_km"),
        "avg_speed_knots",
        F.col("prod_shiptype").alias("vessel_class"),
        destination_struct().alias("main_vessel_destination_port"),
    )
    vessel = F.struct(
        F.col("vessel_id").alias("id"),
        filter_invalid_ssvid(F.col("ssvid")).alias("ssvid"),
        F.col("shipname").alias("name"),
        "seg_id",
        F.col("prod_shiptype").alias("type"),
        F.col("mmsi_flag").alias("flag"),
    )
    events = bound.select(
        event_id(
            "loitering",
            F.col("vessel_id"),
            F.col("loitering_start_timestamp"),
            F.col("loitering_end_timestamp"),
        ).alias("event_id"),
        F.lit("loitering").alias("event_type"),
        "vessel_id",
        "seg_id",
        F.col("loitering_start_timestamp").alias("event_start"),
        F.col("loitering_end_timestamp").alias("event_end"),
        ((F.col("start_lat") + F.col("end_lat")) / 2).alias("lat_mean"),
        ((F.col("start_lon") + F.col("end_lon")) / 2).alias("lon_mean"),
        # the bounds hold the positions at start and end
        F.col("start_lat").alias("lat_min"),
        F.col("end_lat").alias("lat_max"),
        F.col("start_lon").alias("lon_min"),
        F.col("end_lon").alias("lon_max"),
        "start_distance_from_shore_km",
        "end_distance_from_shore_km",
        "start_distance_from_port_km",
        "end_distance_from_port_km",
        json_text(info).alias("event_info"),
        json_text(F.array(vessel)).alias("event_vessels"),
    )
    return with_mean_regions(events, regions, edges)
