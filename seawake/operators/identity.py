"""Segments, vessels and their attributes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registry gear types taken for fishing gear unless the caller says otherwise.
FISHING_GEARS = (
    "fishing",
    "trawlers",
    "seiners",
    "purse_seines",
    "tuna_purse_seines",
    "other_purse_seines",
    "other_seines",
    "drifting_longlines",
    "set_longlines",
    "set_gillnets",
    "driftnets",
    "pots_and_traps",
    "fixed_gear",
    "pole_and_line",
    "trollers",
    "squid_jigger",
    "dredge_fishing",
)


def is_fishing_gear(gear: Column) -> Column:
    return gear.isin(*FISHING_GEARS)


def good_segments(segments: DataFrame, min_positions: int | None = None) -> DataFrame:
    """seg_id of segments without noise; of more than min_positions positions, if given."""
    good = F.col("good_seg") & ~F.col("overlapping_and_short")
    if min_positions is not None:
        good = good & (F.col("positions") > min_positions)
    return segments.filter(good).select("seg_id")


def best_segment_vessel(segment_vessel: DataFrame) -> DataFrame:
    """One vessel per segment: latest last_date, then smallest vessel_id."""
    age = F.coalesce(-F.datediff("last_date", F.lit("1970-01-01")), F.lit(2**31 - 1))
    return (
        segment_vessel.groupBy("seg_id")
        .agg(F.min(F.struct(age.alias("age"), "vessel_id")).alias("best"))
        .select("seg_id", "best.vessel_id")
    )


def fishing_vessels(
    vessels: DataFrame, is_fishing: Callable[[Column], Column] = is_fishing_gear
) -> DataFrame:
    listed = F.coalesce(is_fishing(F.col("registry_geartype")), F.lit(False)) | F.col("on_fishing_list_nn")
    return vessels.filter(
        (F.col("prod_shiptype") == "fishing") | (listed & ~F.col("shipname_indicates_likely_gear"))
    )


def vessel_attributes(vessels: DataFrame, prefix: str) -> DataFrame:
    """The attributes events carry; prefix chooses the source of name and flag."""
    return vessels.select(
        "vessel_id",
        "year",
        F.col("ssvid").alias("vessel_ssvid"),
        "prod_shiptype",
        "prod_geartype",
        F.col(f"{prefix}shipname").alias("shipname"),
        F.col(f"{prefix}mmsi_flag").alias("mmsi_flag"),
    )


def with_identity(events: DataFrame, attributes: DataFrame, how: str) -> DataFrame:
    """Vessel attributes by (vessel_id, year)."""
    return events.join(attributes, ["vessel_id", "year"], how)
