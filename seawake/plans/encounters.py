"""Encounter events: one row for each of the two vessels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.config import EncounterRules
from seawake.functions.documents import json_text
from seawake.functions.scalars import filter_invalid_ssvid, mirrored_id, seconds_between
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
from seawake.operators.identity import vessel_attributes
from seawake.operators.regions import match_regions_of_places, regions_struct, with_distances
from seawake.operators.voyages import destination_port, destination_struct, next_voyage
from seawake.session import materialized
from seawake.sources.schemas import EVENTS_SCHEMA, conform

SIDES = ("main_vessel", "encountered_vessel")
STATUSES = [f"{side}_public_authorization_status" for side in SIDES]
LISTS = [f"{side}_region_authorizations" for side in SIDES]


def quality_encounters(encounters: DataFrame, rules: EncounterRules = EncounterRules()) -> DataFrame:
    return encounters.filter(
        (seconds_between(F.col("start_time"), F.col("end_time")) > rules.min_duration_s)
        & (F.col("median_speed_knots") < rules.max_median_speed_knots)
    )


def mirror_encounters(encounters: DataFrame) -> DataFrame:
    """Each encounter as seen by its first and by its second vessel, in one scan."""

    def seen_by(one: int, other: int) -> Column:
        return F.struct(
            F.col(f"vessel_{one}_id").alias("vessel_id"),
            F.col(f"vessel_{other}_id").alias("encountered_vessel_id"),
            mirrored_id(F.col("encounter_id"), one).alias("event_id"),
            F.col(f"vessel_{one}_seg_ids").alias("seg_ids"),
            F.col(f"vessel_{other}_seg_ids").alias("encountered_seg_ids"),
            F.col(f"vessel_{one}_point_count").alias("vessel_point_count"),
            F.col(f"vessel_{other}_point_count").alias("encountered_point_count"),
        )

    shared = [
        "encounter_id",
        "start_time",
        "end_time",
        "mean_latitude",
        "mean_longitude",
        "median_speed_knots",
        "median_distance_km",
    ]
    return encounters.select(*shared, F.explode(F.array(seen_by(1, 2), seen_by(2, 1))).alias("side")).select(
        *shared, "side.*"
    )


def with_vessel(encounters: DataFrame, attributes: DataFrame, vessel: str, side: str) -> DataFrame:
    """Attributes of one vessel as ``<side>_*``, in the encounter's year or without a year.

    Several matching rows repeat the encounter.
    """
    known = attributes.select(
        F.col("vessel_id").alias(f"{side}_id"),
        F.col("year").alias("__year"),
        F.col("shipname").alias(f"{side}_shipname"),
        F.col("vessel_ssvid").alias(f"{side}_ssvid"),
        F.col("prod_shiptype").alias(f"{side}_class"),
        F.col("mmsi_flag").alias(f"{side}_flag"),
    )
    same = (F.col(vessel) == F.col(f"{side}_id")) & (
        F.col("__year").isNull() | (F.year("start_time") == F.col("__year"))
    )
    return encounters.join(known, same, "left").drop("__year")


def with_two_identities(encounters: DataFrame, vessels: DataFrame, prefix: str) -> DataFrame:
    attributes = vessel_attributes(vessels, prefix)
    main = with_vessel(encounters, attributes, "vessel_id", "main_vessel")
    other = with_vessel(main, attributes, "encountered_vessel_id", "other_vessel")
    names = {f"other_vessel_{c}": f"encountered_vessel_{c}" for c in ("shipname", "ssvid", "class", "flag")}
    return other.drop("other_vessel_id").withColumnsRenamed(names)


def all_vessels(encounters: DataFrame) -> DataFrame:
    """Main and encountered vessels of all encounters, with ssvid and start."""
    main = encounters.select(F.col("main_vessel_id").alias("vessel_id"), F.col("main_vessel_ssvid").alias("ssvid"), "start_time")
    other = encounters.select(
        F.col("encountered_vessel_id").alias("vessel_id"), F.col("encountered_vessel_ssvid").alias("ssvid"), "start_time"
    )
    return main.unionByName(other)


def encounter_authorizations(encounters: DataFrame, regions: DataFrame, identities: DataFrame, scrapes: DataFrame) -> DataFrame:
    """Statuses of both vessels and of the pair, per event, eez and side of the last scrape."""
    grants = vessel_authorizations(all_vessels(encounters), identities, "ssvid", "start_time", "vessel_id")
    facts = ["event_id", "main_vessel_id", "encountered_vessel_id", "start_time", "end_time"]
    rows = with_last_scrape(region_rows(encounters.select(*facts).distinct(), regions), scrapes, "start_time")
    judged = authorization_join(rows, grants, "main_vessel_id", "start_time", "end_time", "main")
    judged = authorization_join(judged, grants, "encountered_vessel_id", "start_time", "end_time", "other")
    judged = judged.select(*STATUS_GROUP, "rfmo", "listed_by_then", "main", "other").distinct()
    main, other = F.col("main"), F.col("other")
    return judged.groupBy(*STATUS_GROUP).agg(
        authorization_status(main).alias(STATUSES[0]),
        authorization_status(other).alias(STATUSES[1]),
        authorization_status(main & other).alias("joint_vessel_authorization_status"),
        region_authorizations(authorized_text(main)).alias(LISTS[0]),
        region_authorizations(authorized_text(other)).alias(LISTS[1]),
        region_authorizations(main & other).alias("joint_vessel_region_authorizations"),
    )


def encounter_events(
    encounters: DataFrame,
    vessels: DataFrame,
    voyages: DataFrame,
    port_events: DataFrame,
    core: DataFrame,
    authorizations: DataFrame,
    measures: DataFrame,
    regions: DataFrame,
    prefix: str,
    edges: str = "spherical",
) -> DataFrame:
    """``port_events`` are published port-visit events."""
    # each is read several times below
    pairs = materialized(with_two_identities(mirror_encounters(quality_encounters(encounters)), vessels, prefix))
    complete = materialized(
        destination_port(next_voyage(pairs, voyages, "main_vessel_id", "start_time", "end_time"), port_events)
    )
    # the two rows of an encounter share their position
    points = pairs.select("event_id", F.col("mean_longitude").alias("lon"), F.col("mean_latitude").alias("lat")).distinct()
    places = materialized(regions_struct(match_regions_of_places(points, regions, "intersects", edges)))
    groups = encounter_authorizations(
        pairs, places, identity_authorizations(core, authorizations), last_scrape(authorizations)
    )
    report = event_report(
        complete, places, groups, [*STATUSES, "joint_vessel_authorization_status"], LISTS
    )
    full = repeat_copies(attach(complete, report, "left"))
    full = with_distances(full, measures, F.col("mean_longitude"), F.col("mean_latitude"), "start")

    joint = F.col("joint_vessel_authorization_status")
    info = F.struct(
        F.round("median_distance_km", 3).alias("median_distance_km"),
        F.round("median_speed_knots", 3).alias("median_speed_knots"),
        "encountered_vessel_id",
        F.concat(
            F.coalesce("main_vessel_class", F.lit("")), F.lit("-"), F.coalesce("encountered_vessel_class", F.lit(""))
        ).alias("vessel_classes"),
        potential_risk(joint, F.col("eez_event")).alias("potential_risk"),
        *STATUSES,
        destination_struct().alias("main_vessel_destination_port"),
    )

    def vessel(vessel_id: str, side: str, points: str, segments: str, lists: str) -> Column:
        return F.struct(
            F.col(vessel_id).alias("id"),
            filter_invalid_ssvid(F.col(f"{side}_ssvid")).alias("ssvid"),
            F.col(f"{side}_shipname").alias("name"),
            F.col(points).alias("point_count"),
            F.col(f"{side}_class").alias("type"),
            F.col(f"{side}_flag").alias("flag"),
            F.col(segments).alias("seg_ids"),
            F.col(lists).alias("public_authorizations"),
        )

    both = F.array(
        vessel("vessel_id", "main_vessel", "vessel_point_count", "seg_ids", LISTS[0]),
        vessel("encountered_vessel_id", "encountered_vessel", "encountered_point_count", "encountered_seg_ids", LISTS[1]),
    )
    published = full.select(
        "event_id",
        F.lit("encounter").alias("event_type"),
        "vessel_id",
        F.col("start_time").alias("event_start"),
        F.col("end_time").alias("event_end"),
        *[F.col("mean_latitude").alias(f"lat_{part}") for part in ("mean", "min", "max")],
        *[F.col("mean_longitude").alias(f"lon_{part}") for part in ("mean", "min", "max")],
        "regions_mean_position",
        "start_distance_from_shore_km",
        F.col("start_distance_from_shore_km").alias("end_distance_from_shore_km"),
        "start_distance_from_port_km",
        F.col("start_distance_from_port_km").alias("end_distance_from_port_km"),
        json_text(info).alias("event_info"),
        json_text(both).alias("event_vessels"),
    )
    return conform(published, EVENTS_SCHEMA, optional=("seg_id",))
