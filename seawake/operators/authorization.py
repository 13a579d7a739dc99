"""Public authorizations of vessels in the regions of their events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.config import (
    STATUS_AUTHORIZED,
    STATUS_PARTIAL,
    STATUS_PENDING,
    STATUS_UNMATCHED,
)
from seawake.functions.scalars import is_true, is_whitelisted_rfmo, null_key, overlaps
from seawake.operators.joins import range_join

IDENTITY_KEYS = ["ssvid", "n_shipname", "n_callsign", "imo", "flag"]
GRANT = ["registry_rfmo", "registry_authorized_from", "registry_authorized_to"]


def identity_authorizations(core: DataFrame, authorizations: DataFrame) -> DataFrame:
    """Whitelisted authorizations of each identity that overlap its activity."""

    def keyed(df: DataFrame, *columns: str) -> DataFrame:
        return df.select("vessel_record_id", *[null_key(F.col(k)).alias(k) for k in IDENTITY_KEYS], *columns)

    return (
        keyed(core, "first_timestamp", "last_timestamp")
        .join(
            keyed(
                authorizations.filter(is_whitelisted_rfmo(F.col("source_code"))),
                "authorized_from",
                "authorized_to",
                "source_code",
            ),
            ["vessel_record_id", *IDENTITY_KEYS],
        )
        .filter(
            overlaps(
                F.col("authorized_from"),
                F.col("authorized_to"),
                F.col("first_timestamp"),
                F.col("last_timestamp"),
            )
        )
        .select(
            "ssvid",
            F.col("first_timestamp").alias("activity_first_timestamp"),
            F.col("last_timestamp").alias("activity_last_timestamp"),
            F.col("authorized_from").alias("registry_authorized_from"),
            F.col("authorized_to").alias("registry_authorized_to"),
            F.col("source_code").alias("registry_rfmo"),
        )
        .distinct()
    )


def last_scrape(authorizations: DataFrame) -> DataFrame:
    """Latest end of authorization per whitelisted registry: at most one row for each."""
    return (
        authorizations.filter(is_whitelisted_rfmo(F.col("source_code")))
        .groupBy(F.col("source_code").alias("registry_rfmo"))
        .agg(F.max("authorized_to").alias("last_scrape"))
    )


def activity_join(events: DataFrame, identities: DataFrame, ssvid: str, ts: str, how: str = "left") -> DataFrame:
    """Registry entries of identities that used the ssvid when the event began.

    Time buckets keep an ssvid that many vessels share from being compared
    all with all; an identity without both bounds is never active.
    """
    first, last = "activity_first_timestamp", "activity_last_timestamp"
    known = identities.withColumnRenamed("ssvid", "__ssvid").filter(F.col(first).isNotNull() & F.col(last).isNotNull())
    placed = events.withColumn("__ssvid", F.col(ssvid))
    return range_join(placed, known, ["__ssvid"], ts, first, last, how=how).drop("__ssvid", first, last)


def vessel_authorizations(events: DataFrame, identities: DataFrame, ssvid: str, ts: str, vessel: str) -> DataFrame:
    """Distinct authorizations of a vessel, found through any of its events.

    What one event finds holds for all events of the vessel, so equal starts
    are looked up once.
    """
    starts = events.select(F.col(vessel).alias("vessel_id"), F.col(ssvid).alias("ssvid"), F.col(ts).alias("start"))
    return (
        activity_join(starts.distinct(), identities, "ssvid", "start", "inner")
        .filter(F.col("registry_authorized_from").isNotNull() & F.col("registry_authorized_to").isNotNull())
        .select("vessel_id", *GRANT)
        .distinct()
    )


def region_rows(events: DataFrame, regions: DataFrame) -> DataFrame:
    """Events (event_id and whatever else is given) once per whitelisted rfmo region they touch."""
    place = F.col("regions_mean_position")
    return (
        events.join(regions, "event_id")
        .withColumn("rfmo", F.explode(place["rfmo"]))
        .filter(is_whitelisted_rfmo(F.col("rfmo")))
        .withColumn("eez_event", F.size(place["eez"]) > 0)
        .drop("regions_mean_position")
    )


def grant_intervals(authorizations: DataFrame) -> DataFrame:
    """One row per vessel and registry: its grants as sorted intervals that do not overlap.

    ``begins`` and ``ends`` have the merged intervals, ``backward`` the grants
    that end before they begin, which no merging may touch.  Grants that only
    touch stay apart, as a moment between the two is in neither.
    """
    key = ["__vessel", "__rfmo"]
    grants = authorizations.select(
        F.col("vessel_id").alias("__vessel"),
        F.col("registry_rfmo").alias("__rfmo"),
        F.col("registry_authorized_from").alias("begin"),
        F.col("registry_authorized_to").alias("end"),
    )
    order = Window.partitionBy(*key, F.col("begin") > F.col("end")).orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = grants.withColumn("starts", (reached.isNull() | (F.col("begin") >= reached) | (F.col("begin") > F.col("end"))).cast("int"))
    parts = parts.withColumn("island", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = parts.groupBy(*key, (F.col("begin") > F.col("end")).alias("back"), "island").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    span = F.struct("begin", "end")
    lists = islands.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.when(~F.col("back"), span))).alias("spans"), F.collect_list(F.when(F.col("back"), span)).alias("backward")
    )
    return lists.select(*key, F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"), "backward")


def _any_granted(start: Column, end: Column) -> Column:
    """Does an event that does not end before it starts meet one of the intervals?

    Of the intervals that begin before the event's end, the last one ends last.
    """

    def halved(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        before = F.coalesce(F.get("begins", middle) < end, F.lit(False))
        searching = acc["low"] < acc["high"]
        return F.struct(
            F.when(searching & before, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(searching & ~before, middle).otherwise(acc["high"]).alias("high"),
        )

    bounds = F.struct(F.lit(0).alias("low"), F.size("begins").alias("high"))
    count = F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size("begins")))), bounds, halved, lambda acc: acc["low"])
    merged = F.coalesce(F.get("ends", count - 1) > start, F.lit(False))
    return merged | F.exists("backward", lambda g: is_true(overlaps(start, end, g["begin"], g["end"])))


def authorization_join(rows: DataFrame, authorizations: DataFrame, vessel: str, start: str, end: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: is the vessel authorized by the region's registry during the event?

    Each row meets one list of intervals at most, however many grants a vessel has.
    """
    match = (F.col(vessel) == F.col("__vessel")) & (F.col("rfmo") == F.col("__rfmo"))
    granted = F.col("__rfmo").isNotNull() & _any_granted(F.col(start), F.col(end))
    return rows.join(grant_intervals(authorizations), match, "left").select(*rows.columns, F.coalesce(granted, F.lit(False)).alias(flag))


def with_last_scrape(rows: DataFrame, scrapes: DataFrame, start: str) -> DataFrame:
    """Add ``event_after_last_scrape`` and ``listed_by_then`` (event not after the last scrape).

    scrapes has one row per whitelisted registry, so it is always small enough to broadcast.
    """
    when = scrapes.withColumnRenamed("registry_rfmo", "rfmo")
    return (
        rows.join(F.broadcast(when), "rfmo", "left")
        .withColumn("event_after_last_scrape", F.col(start) >= F.col("last_scrape"))
        .withColumn("listed_by_then", is_true(F.col(start) <= F.col("last_scrape")))
        .drop("last_scrape")
    )


def authorized_text(flag: Column) -> Column:
    """true, false, or pending when the registry was not read since."""
    return F.when(flag, "true").when(F.col("listed_by_then"), "false").otherwise("pending")


def authorization_status(authorized: Column) -> Column:
    """Status aggregate over the regions of an event; ``authorized`` is a boolean column.

    An aggregate over nulls only is null, hence no match.
    """
    after = F.col("event_after_last_scrape")
    return (
        F.when(is_true(F.every(authorized)), STATUS_AUTHORIZED)
        .when(is_true(F.every(~after & ~authorized)), STATUS_UNMATCHED)
        .when(is_true(F.every(after & ~authorized)), STATUS_PENDING)
        .otherwise(STATUS_PARTIAL)
    )


def region_authorizations(authorized: Column) -> Column:
    """Sorted aggregate of ``{rfmo, has_publicly_listed_authorization}``."""
    entry = F.struct("rfmo", authorized.alias("has_publicly_listed_authorization"))
    return F.sort_array(F.collect_list(entry))


# Status groups of an event: its regions are judged separately inside and outside an
# eez, and before and after the last scrape of their registries.
STATUS_GROUP = ["event_id", "eez_event", "event_after_last_scrape"]


def outside_any_region() -> Column:
    """The authorization list of an event that touches no whitelisted region."""
    return F.array(
        F.struct(
            F.lit(None).cast("string").alias("rfmo"),
            F.lit(None).cast("string").alias("has_publicly_listed_authorization"),
        )
    )


def potential_risk(status: Column, eez: Column) -> Column:
    return (status == STATUS_UNMATCHED) & ~eez


def attach(events: DataFrame, part: DataFrame, how: str = "inner") -> DataFrame:
    """Bring what was computed per event back to the events."""
    return events.join(part, "event_id", how)


def event_report(events: DataFrame, regions: DataFrame, groups: DataFrame, statuses: list[str], lists: list[str]) -> DataFrame:
    """Per event_id its regions and one row for each status group.

    ``events`` may hold an event_id several times; each of its rows then meets
    every group once per copy, and the lists have every entry once per copy.
    ``copies`` carries that number.
    """
    copies = events.filter(F.col("event_id").isNotNull()).groupBy("event_id").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    report = attach(attach(copies, regions, "left"), groups, "left")
    filled = {s: F.coalesce(s, F.lit(STATUS_AUTHORIZED)) for s in statuses}
    filled |= {
        c: F.sort_array(F.flatten(F.array_repeat(F.coalesce(F.col(c), outside_any_region()), F.col("copies"))))
        for c in lists
    }
    return report.withColumns(filled)


def repeat_copies(df: DataFrame) -> DataFrame:
    """Repeat each row ``copies`` times, once if unknown."""
    return df.withColumn("copies", F.explode_outer(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
