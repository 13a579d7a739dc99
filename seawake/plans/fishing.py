"""Published fishing events: authorization, regions, and the restrictive subset."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.functions.documents import first_vessel_field, json_text
from seawake.functions.scalars import filter_invalid_ssvid, m_to_km
from seawake.operators.authorization import (
    STATUS_GROUP,
    attach,
    authorization_join,
    authorization_status,
    authorized_text,
    event_report,
    identity_authorizations,
    last_scrape,
    potential_risk,
    region_authorizations,
    region_rows,
    repeat_copies,
    vessel_authorizations,
    with_last_scrape,
)
from seawake.operators.identity import fishing_vessels, is_fishing_gear, vessel_attributes, with_identity
from seawake.operators.regions import match_regions, regions_struct, with_distances
from seawake.session import materialized
from seawake.sources.schemas import EVENTS_SCHEMA, conform
from seawake.sources.tables import publish_versioned


def union_events(nnet: DataFrame, night: DataFrame) -> DataFrame:
    """Events of both scores; a vessel class belongs to one of them only."""
    return nnet.unionByName(night)


def points_of(events: DataFrame) -> DataFrame:
    """All points of the events, one per row, from the stored lists."""
    return events.select("event_id", F.explode("geo_info").alias("geo")).select(
        "event_id", "geo.point.lon", "geo.point.lat", F.col("geo.s2_cell").alias("cell")
    )


def fishing_authorizations(events: DataFrame, regions: DataFrame, identities: DataFrame, scrapes: DataFrame) -> DataFrame:
    """Status and region list per event, eez and side of the last scrape."""
    facts = ["event_id", "vessel_id", "event_start", "event_end"]
    grants = vessel_authorizations(events, identities, "ssvid", "event_start", "vessel_id")
    rows = with_last_scrape(region_rows(events.select(*facts).distinct(), regions), scrapes, "event_start")
    judged = authorization_join(rows, grants, "vessel_id", "event_start", "event_end", "authorized")
    return judged.groupBy(*STATUS_GROUP).agg(
        authorization_status(F.col("authorized")).alias("vessel_public_authorization_status"),
        region_authorizations(authorized_text(F.col("authorized"))).alias("public_authorizations"),
    )


def authorize_events(
    nnet: DataFrame,
    night: DataFrame,
    core: DataFrame,
    authorizations: DataFrame,
    measures: DataFrame,
    regions: DataFrame,
    vessels: DataFrame,
    prefix: str,
    is_fishing: Callable[[Column], Column] = is_fishing_gear,
    edges: str = "spherical",
    points: DataFrame | None = None,
) -> DataFrame:
    """Fishing events of both scores in the published layout.

    ``points`` gives the events' positions (event_id, lon, lat, cell) one per
    row; without it they are taken from ``geo_info``.
    """
    events = union_events(nnet, night)
    points = points_of(events) if points is None else points
    events = events.drop("geo_info", "points_wkt")

    places = materialized(regions_struct(match_regions(points, regions, "within", edges)))
    identities = identity_authorizations(core, authorizations)
    groups = fishing_authorizations(events, places, identities, last_scrape(authorizations))
    status, lists = "vessel_public_authorization_status", "public_authorizations"
    report = event_report(events, places, groups, [status], [lists])

    full = repeat_copies(attach(events, report))
    # the corners of the bounding box stand for the event's start and end
    full = with_distances(full, measures, F.col("lon_min"), F.col("lat_min"), "start")
    full = with_distances(full, measures, F.col("lon_max"), F.col("lat_max"), "end")
    owners = vessel_attributes(fishing_vessels(vessels, is_fishing), prefix)
    full = with_identity(full.withColumn("year", F.year("event_start").cast("long")), owners, "inner")

    info = F.struct(
        "message_count",
        F.col("avg_hours").alias("avg_duration_hrs"),
        m_to_km(F.col("event_distance_m")).alias("distance_km"),
        "avg_speed_knots",
        potential_risk(F.col(status), F.col("eez_event")).alias("potential_risk"),
        status,
    )
    vessel = F.struct(
        F.col("vessel_id").alias("id"),
        filter_invalid_ssvid(F.col("ssvid")).alias("ssvid"),
        F.col("shipname").alias("name"),
        F.col("mmsi_flag").alias("flag"),
        F.col("prod_shiptype").alias("type"),
        "seg_id",
        lists,
    )
    return conform(
        full.withColumns(
            {
                "event_type": F.lit("fishing"),
                "event_info": json_text(info),
                "event_vessels": json_text(F.array(vessel)),
            }
        ),
        EVENTS_SCHEMA,
    )


def restrict_events(events: DataFrame) -> DataFrame:
    """Events whose first vessel is a fishing vessel."""
    return events.filter(first_vessel_field(F.col("event_vessels"), "type") == "fishing")


def publish_fishing(events: DataFrame, name: str, day: str | date, view: str) -> str:
    """Write the dated table and move its view; older dated tables stay."""
    return publish_versioned(events, name, day, view=view, drop_previous=False)
