"""Port-visit events, placed at the visit's intermediate anchorage."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.config import PortVisitRules
from seawake.functions.documents import json_text
from seawake.functions.scalars import event_id, filter_invalid_ssvid, m_to_km, nfc, port_event_rank, port_id
from seawake.operators.authorization import attach
from seawake.operators.identity import vessel_attributes, with_identity
from seawake.operators.joins import semi
from seawake.operators.regions import match_regions_of_places, regions_struct, with_distances
from seawake.session import materialized
from seawake.sources.schemas import EVENTS_SCHEMA, conform

ANCHORAGE_FIELDS = (
    "anchorage_id",
    "id",
    "flag",
    "name",
    "top_destination",
    "distance_from_shore_km",
    "at_dock",
    "lat",
    "lon",
)


def confident_visits(visits: DataFrame, end: str | date, min_confidence: int = PortVisitRules.min_confidence) -> DataFrame:
    """Visits of enough confidence that ended on or before the end date."""
    last = date.fromisoformat(end) if isinstance(end, str) else end
    after = F.lit(str(last + timedelta(days=1))).cast("timestamp")
    return visits.filter((F.col("confidence") >= min_confidence) & (F.col("end_timestamp") < after))


def distinct_seg_ids(visits: DataFrame) -> DataFrame:
    """Segments seen during each visit; visits without nested events have no row."""
    return (
        visits.select("visit_id", F.explode("events.seg_id").alias("seg_id"))
        .groupBy("visit_id")
        # wrapped, because a set of plain values would lose null
        .agg(F.sort_array(F.collect_set(F.struct("seg_id"))).alias("seen"))
        .select("visit_id", F.col("seen.seg_id").alias("seg_ids"))
    )


def ranked_in_row(visits: DataFrame, *kept: str) -> DataFrame:
    """``best``: the nested event of best rank, then the earliest, of each row; the events stay behind.

    Unknown event types have no rank and come first.
    """
    candidates = F.transform(
        F.when(F.size("events") > 0, F.col("events")).otherwise(F.array(F.lit(None))),
        lambda e: F.struct(
            port_event_rank(e["event_type"]).alias("event_rank"),
            e["timestamp"].alias("event_timestamp"),
            e["anchorage_id"].alias("event_anchorage_id"),
        ),
    )
    return visits.select("visit_id", *kept, F.array_min(candidates).alias("best"))


def first_of_visit(ranked: DataFrame) -> DataFrame:
    """The best event between the rows of a visit."""
    return ranked.groupBy("visit_id").agg(F.min("best").alias("best")).select("visit_id", "best.*")


def first_ranked(visits: DataFrame) -> DataFrame:
    """The nested event that gives a visit its anchorage, chosen inside each row, then between the rows of a visit."""
    return first_of_visit(ranked_in_row(visits))


def described_anchorages(anchorages: DataFrame) -> DataFrame:
    """Anchorages as they appear in event_info; the anchorage table is the only input of a Python function."""
    label = F.col("label")
    unnamed = F.coalesce(F.col("label_source") == "top_destination", F.lit(False))
    described = anchorages.withColumn("normal_label", nfc(label)).select(
        F.col("s2id").alias("anchorage_id"),
        port_id(F.col("iso3"), F.col("normal_label")).alias("id"),
        F.col("iso3").alias("flag"),
        F.when(~unnamed, label).alias("name"),
        "top_destination",
        m_to_km(F.col("distance_from_shore_m")).alias("distance_from_shore_km"),
        "at_dock",
        "lat",
        "lon",
    )
    return described.select(F.struct(*ANCHORAGE_FIELDS).alias("anchorage"))


def with_anchorage(visits: DataFrame, described: DataFrame, side: str, how: str) -> DataFrame:
    """Add struct ``<side>_anchorage`` for the visit's ``<side>_anchorage_id``."""
    named = described.withColumnRenamed("anchorage", f"{side}_anchorage")
    return visits.join(named, F.col(f"{side}_anchorage_id") == F.col(f"{side}_anchorage.anchorage_id"), how)


def _or_nulls(anchorage: Column) -> Column:
    """A missing anchorage is written with all of its fields, each null."""
    return F.struct(*[anchorage[f].alias(f) for f in ANCHORAGE_FIELDS])


def port_visit_events(
    visits: DataFrame,
    vessels: DataFrame,
    measures: DataFrame,
    regions: DataFrame,
    anchorages: DataFrame,
    end: str | date,
    prefix: str,
    edges: str = "spherical",
) -> DataFrame:
    source = confident_visits(visits, end)
    described = materialized(described_anchorages(anchorages))
    # the choice inside each row comes first: nested events do not travel
    known = semi(ranked_in_row(source, "vessel_id"), vessels.select("vessel_id"))
    chosen = with_anchorage(
        first_of_visit(known).withColumnRenamed("event_anchorage_id", "intermediate_anchorage_id"),
        described,
        "intermediate",
        "inner",
    ).select("visit_id", "intermediate_anchorage")

    # visits meet what is known by visit first, before attributes make them wide
    full = source.drop("events", "ssvid").withColumn("year", F.year("start_timestamp").cast("long"))
    full = full.join(distinct_seg_ids(source), "visit_id").join(chosen, "visit_id", "left")
    full = with_identity(full, vessel_attributes(vessels, prefix), "inner")
    full = with_anchorage(with_anchorage(full, described, "start", "inner"), described, "end", "inner")
    full = with_distances(full, measures, F.col("start_lon"), F.col("start_lat"), "start")
    full = with_distances(full, measures, F.col("end_lon"), F.col("end_lat"), "end")

    info = F.struct(
        "duration_hrs",
        "visit_id",
        "confidence",
        "start_anchorage",
        "end_anchorage",
        _or_nulls(F.col("intermediate_anchorage")).alias("intermediate_anchorage"),
        "seg_ids",
    )
    vessel = F.struct(
        F.col("vessel_id").alias("id"),
        filter_invalid_ssvid(F.col("vessel_ssvid")).alias("ssvid"),
        F.col("shipname").alias("name"),
        F.col("prod_shiptype").alias("type"),
        F.col("mmsi_flag").alias("flag"),
    )
    events = full.select(
        event_id("port_visit", F.col("vessel_id"), F.col("start_timestamp"), F.col("end_timestamp")).alias("event_id"),
        F.lit("port_visit").alias("event_type"),
        "vessel_id",
        F.lit(None).cast("string").alias("seg_id"),
        F.col("start_timestamp").alias("event_start"),
        F.col("end_timestamp").alias("event_end"),
        F.col("intermediate_anchorage.lat").alias("lat_mean"),
        F.col("intermediate_anchorage.lon").alias("lon_mean"),
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


def with_mean_regions(events: DataFrame, regions: DataFrame, edges: str) -> DataFrame:
    """Regions at the mean position (boundary included); null where there are none.

    The events are computed once; of them, only distinct positions take the
    way through the region join (the anchorages, for port visits).
    """
    events = materialized(events)
    points = events.select("event_id", F.col("lon_mean").alias("lon"), F.col("lat_mean").alias("lat"))
    places = regions_struct(match_regions_of_places(points, regions, "intersects", edges))
    return conform(attach(events, places, "left"), EVENTS_SCHEMA)
