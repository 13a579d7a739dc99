"""Voyages and the port an event's vessel sails to next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.config import UNKNOWN_TRIP_START
from seawake.functions.documents import json_scalar, json_string_or_null
from seawake.operators.joins import range_join


def known_voyages(voyages: DataFrame) -> DataFrame:
    start = F.col("trip_start")
    unknown = F.lit(UNKNOWN_TRIP_START).cast("timestamp")
    return voyages.filter(start.isNull() | (start != unknown))


def next_voyage(events: DataFrame, voyages: DataFrame, vessel: str, start: str, end: str) -> DataFrame:
    """Visit that ends the voyage during which the event happened, or null.

    An event inside several voyages of its vessel is repeated.
    """
    trips = known_voyages(voyages).select(
        F.col("vessel_id").alias("__vessel"), "trip_start", "trip_end", "trip_end_visit_id"
    ).filter(F.col("trip_end").isNotNull())
    during = (F.col("r.trip_start").isNull() | (F.col("r.trip_start") < F.col(f"l.{start}"))) & (
        F.col("r.trip_end") > F.col(f"l.{end}")
    )
    placed = events.withColumn("__vessel", F.col(vessel))
    return range_join(
        placed, trips, ["__vessel"], start, "trip_start", "trip_end", during, "left"
    ).drop("__vessel", "trip_start", "trip_end")


def destination_port(events: DataFrame, port_events: DataFrame) -> DataFrame:
    """Port event of ``trip_end_visit_id``: its id, and port id, flag and name."""
    info = F.col("event_info")
    ports = port_events.select(
        json_scalar(info, "$.visit_id").alias("trip_end_visit_id"),
        F.col("event_id").alias("port_event_id"),
        *[
            json_string_or_null(info, f"$.intermediate_anchorage.{field}").alias(f"port_{field}")
            for field in ("id", "flag", "name")
        ],
    )
    # most events have no visit; keys that meet no visit spread them over all tasks
    plain = [F.col(c) for c, kind in events.dtypes if not kind.startswith(("map", "array", "struct"))]
    nowhere = F.concat(F.lit("\0"), F.xxhash64(*plain).cast("string"))
    keyed = events.withColumn("__visit", F.coalesce(F.col("trip_end_visit_id").cast("string"), nowhere))
    ports = ports.withColumn("__port_visit", F.col("trip_end_visit_id").cast("string")).drop("trip_end_visit_id")
    joined = keyed.join(ports, F.col("__visit") == F.col("__port_visit"), "left").drop("__visit", "__port_visit")
    return joined.select("trip_end_visit_id", *[c for c in joined.columns if c != "trip_end_visit_id"])


def destination_struct():
    return F.struct(
        F.col("port_event_id").alias("event_id"),
        F.col("port_id").alias("id"),
        F.col("port_flag").alias("flag"),
        F.col("port_name").alias("name"),
    )
