"""Vessel inputs derived from the generic test tables.

The test tables hold no vessel data.  These functions turn them into tables
with the shape of the real inputs: ``events`` becomes position messages (one
segment and one vessel per user), and the other tables become identities,
regions, anchorages, port visits and voyages.  Everything scales with the
given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seawake.functions.cells import s2_cell
from seawake.functions.geo import distance_m
from seawake.functions.scalars import grid_index
from seawake.operators.slices import lag_within_key

DAY_SECONDS = 86_400
FIRST_SECOND = 1_704_067_200  # 2024-01-01 00:00:00 UTC


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Position messages: event time slowed by ten, one track per user."""
    events = table(spark, folder, "events")
    elapsed = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(FIRST_SECOND * 1_000_000)
    tenths = F.floor(elapsed / 10_000_000.0)
    # one message per user and second: the one with the smallest event_id
    second = events.select("user_id", "event_type", "value", "event_id", tenths.alias("second"))
    unique = (
        second.groupBy("user_id", "second")
        .agg(F.min_by(F.struct("event_type", "value"), "event_id").alias("row"))
        .select("user_id", "second", "row.*")
    )
    user, hour = F.col("user_id"), F.col("second") / 3600.0
    east = (user * 73) % 360 - 180 + hour * 0.01
    tracks = unique.select(
        F.concat(F.lit("v"), user).alias("ssvid"),
        F.concat(F.lit("s"), user).alias("seg_id"),
        F.timestamp_seconds(F.col("second") + FIRST_SECOND).alias("timestamp"),
        ((user * 37) % 120 - 60 + hour * 0.008 + F.col("value") / 100000).alias("lat"),
        F.when(east >= 180, (user * 73) % 360 - 540 + hour * 0.01).otherwise(east).alias("lon"),
        (F.col("value") - F.floor(F.col("value") / 12) * 12).alias("speed_knots"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 200), None)
        .when(F.col("event_type") == "signup", 0.0)
        .otherwise(1.0)
        .alias("nnet_score"),
        F.when(F.col("event_type").isin("view", "error"), 1.0).otherwise(0.0).alias("night_loitering"),
    )
    linked = lag_within_key(
        tracks,
        "seg_id",
        "timestamp",
        {"prev_lat": "lat", "prev_lon": "lon", "prev_timestamp": "timestamp"},
        DAY_SECONDS,
    )
    hours = (F.unix_seconds("timestamp") - F.unix_seconds("prev_timestamp")) / 3600.0
    return (
        linked.withColumn("meters_to_prev", distance_m(F.col("prev_lon"), F.col("prev_lat"), F.col("lon"), F.col("lat")))
        .withColumn("hours", hours)
        .withColumn("implied_speed_knots", F.col("meters_to_prev") / 1852 / F.col("hours"))
        .drop("prev_lat", "prev_lon", "prev_timestamp")
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user of the events table, with the number of events."""
    return (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("u"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def tagged(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segment quality: some segments are bad, some overlap."""
    u = F.col("u")
    return users(spark, folder).select(
        tagged("s", u).alias("seg_id"),
        (u % 11 != 4).alias("good_seg"),
        F.col("n").alias("positions"),
        (u % 13 == 5).alias("overlapping_and_short"),
    )


def segment_info(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("u")
    return users(spark, folder).select(tagged("s", u).alias("seg_id"), tagged("vid", u).alias("vessel_id"))


def segment_vessel(spark: SparkSession, folder: str) -> DataFrame:
    """Vessels of each segment; some have an older one, some a second one of the same date."""
    u = F.col("u")
    new, old = F.lit("2024-01-03").cast("date"), F.lit("2023-12-01").cast("date")
    claims = F.array(
        F.struct(tagged("vid", u).alias("vessel_id"), new.alias("last_date"), F.lit(True).alias("claimed")),
        F.struct(tagged("old", u).alias("vessel_id"), old.alias("last_date"), (u % 4 == 0).alias("claimed")),
        F.struct(tagged("zid", u).alias("vessel_id"), new.alias("last_date"), (u % 6 == 0).alias("claimed")),
    )
    return (
        users(spark, folder)
        .select(tagged("s", u).alias("seg_id"), F.explode(claims).alias("claim"))
        .filter("claim.claimed")
        .select("seg_id", "claim.vessel_id", "claim.last_date")
    )


def user_flag(u: Column) -> Column:
    return F.when(u % 3 == 0, "ESP").when(u % 3 == 1, "CHN").otherwise("USA")


def vessels(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("u")
    return users(spark, folder).select(
        tagged("vid", u).alias("vessel_id"),
        F.lit(2024).cast("long").alias("year"),
        tagged("v", u).alias("ssvid"),
        F.when(u % 7 == 3, "carrier").otherwise("fishing").alias("prod_shiptype"),
        F.when(u % 5 == 0, "squid_jigger").otherwise("trawlers").alias("prod_geartype"),
        F.when(u % 3 == 0, "trawlers").when(u % 3 == 1, "cargo").alias("registry_geartype"),
        (u % 2 == 0).alias("on_fishing_list_nn"),
        (u % 9 == 0).alias("shipname_indicates_likely_gear"),
        tagged("SHIP ", u).alias("ais_shipname"),
        user_flag(u).alias("ais_mmsi_flag"),
    )


def is_trawler(gear: Column) -> Column:
    return gear == "trawlers"


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def identity_core(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("u")
    return users(spark, folder).select(
        tagged("rec", u).alias("vessel_record_id"),
        tagged("v", u).alias("ssvid"),
        tagged("SHIP", u).alias("n_shipname"),
        F.when(u % 2 != 0, tagged("CS", u)).alias("n_callsign"),
        F.lit(None).cast("string").alias("imo"),
        user_flag(u).alias("flag"),
        instant("2020-01-01").alias("first_timestamp"),
        F.when(u % 4 == 1, instant("2024-01-02 12:00:00")).otherwise(instant("2025-01-01")).alias("last_timestamp"),
    )


# Registries of the sample authorizations; NAFO is not whitelisted, and NPFC has none.
SAMPLE_RFMOS = ("ICCAT", "IOTC", "WCPFC", "IATTC", "CCSBT", "SPRFMO", "NAFO")


def identity_authorization(spark: SparkSession, folder: str) -> DataFrame:
    registry = F.posexplode(F.array(*[F.lit(code) for code in SAMPLE_RFMOS])).alias("k", "source_code")
    granted = identity_core(spark, folder).select("*", registry)
    number = F.substring("ssvid", 2, 20).cast("long")
    return granted.filter((number + F.col("k")) % 3 == 0).select(
        "vessel_record_id",
        "ssvid",
        "n_shipname",
        "n_callsign",
        "imo",
        "flag",
        instant("2023-01-01").alias("authorized_from"),
        F.when(F.col("k") % 2 == 0, instant("2024-01-02 06:00:00"))
        .otherwise(instant("2024-06-01"))
        .alias("authorized_to"),
        "source_code",
    )


def box_cell(lon: Column, lat: Column) -> Column:
    """One-degree integer cells, which stand for S2 cells on the box regions."""
    return (F.floor(lon) * 1000 + F.floor(lat)).cast("long")


def regions(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes of 80 by 55 degrees, one per nation, with the cells they meet."""
    key = F.col("n_nationkey")
    row, column = key % 5, F.floor(key / 5)
    boxes = table(spark, folder, "nation").select(
        F.element_at(F.array(*[F.lit(x) for x in ("rfmo", "eez", "mpa", "high_seas", "major_fao")]), row + 1).alias("layer"),
        F.when(
            row == 0,
            F.element_at(F.array(*[F.lit(x) for x in ("ICCAT", "IOTC", "WCPFC", "NPFC", "NAFO")]), (column + 1).cast("int")),
        )
        .otherwise(tagged("R", key))
        .alias("id"),
        (-62 + row * 20).alias("south"),
        (-180 + column * 70).alias("west"),
    )
    west, south = F.col("west").cast("double"), F.col("south").cast("double")
    corners = [(west, south), (west + 80, south), (west + 80, south + 55), (west, south + 55)]
    ring = F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in corners])
    cells = F.flatten(
        F.transform(
            F.sequence(F.col("west"), F.col("west") + 80),
            lambda x: F.transform(F.sequence(F.col("south"), F.col("south") + 55), lambda y: box_cell(x, y)),
        )
    )
    return boxes.select("layer", "id", cells.alias("s2_cells"), F.array(ring).alias("geo"))


def grid_measures(corners: DataFrame) -> DataFrame:
    """Spatial measures for about nine tenths of the cells at lon, lat of the given rows."""
    x, y = F.col("x"), F.col("y")
    cells = corners.select(grid_index(F.col("lon")).alias("x"), grid_index(F.col("lat")).alias("y")).distinct()
    missing = (F.floor(x / 100) * 7 + F.floor(y / 100) * 3 + x + y) % 10 == 0
    return cells.filter(~missing).select(
        F.format_string("lon:%+07.2f_lat:%+07.2f", x / 100.0, y / 100.0).alias("gridcode"),
        (F.abs((x * 31 + y * 17) % 1000) * 100.0).alias("distance_from_shore_m"),
        (F.abs((x * 13 + y * 29) % 1000) * 100.0).alias("distance_from_port_m"),
    )


def anchorages(spark: SparkSession, folder: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        tagged("a", s).alias("s2id"),
        ((s * 37) % 120 - 60 + 0.255).alias("lat"),
        ((s * 73) % 360 - 180 + 0.255).alias("lon"),
        tagged("N", F.col("s_nationkey")).alias("iso3"),
        F.col("s_name").alias("label"),
        F.when(s % 4 == 0, "top_destination").otherwise("manual").alias("label_source"),
        F.upper("s_name").alias("top_destination"),
        (s * 100.0).alias("distance_from_shore_m"),
        (s % 2 == 0).alias("at_dock"),
    )


def hours_in(hours: Column) -> Column:
    """Time so many hours into 2024."""
    return F.timestamp_seconds(F.lit(FIRST_SECOND) + hours * 3600)


def _sized_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the orders, with how many users and suppliers there are (two one-row tables)."""
    n_users = users(spark, folder).agg(F.count(F.lit(1)).alias("nu"))
    n_suppliers = table(spark, folder, "supplier").agg(F.count(F.lit(1)).alias("ns"))
    sized = table(spark, folder, "orders").select("o_orderkey", "o_custkey").withColumn("one", F.lit(1))
    for count in (n_users, n_suppliers):
        sized = sized.join(F.broadcast(count.withColumn("one", F.lit(1))), "one")
    return sized.drop("one")


def _visits(sized: DataFrame, *more: str) -> DataFrame:
    """Port visits without their nested events; further columns pass through."""
    o = F.col("o_orderkey")
    return sized.select(
        "o_orderkey",
        tagged("pv", o).alias("visit_id"),
        tagged("vid", F.col("o_custkey") % F.col("nu")).alias("vessel_id"),
        tagged("v", F.col("o_custkey") % F.col("nu")).alias("ssvid"),
        hours_in(o % 60).alias("start_timestamp"),
        hours_in(o % 60 + o % 30 + 1).alias("end_timestamp"),
        ((o % 30 + 1) * 1.0).alias("duration_hrs"),
        (o % 4 + 1).alias("confidence"),
        tagged("a", o % F.col("ns")).alias("start_anchorage_id"),
        tagged("a", (o * 3 + 1) % F.col("ns")).alias("end_anchorage_id"),
        *more,
    )


def port_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Raw port visits: orders, with the order's lines as nested events.

    Orders and lines meet on the plain key, by which the lines are grouped
    already; names and times are made behind the join.
    """
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    # an order has a handful of lines
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(line)).alias("lines"))
    )
    order = F.col("o_orderkey")

    def as_event(entry: Column, index: Column) -> Column:
        seq = index + 1 + order % 5
        kind = (
            F.when(seq % 9 == 8, "PORT_OTHER")
            .when(seq % 4 == 0, "PORT_STOP_BEGIN")
            .when(seq % 4 == 1, "PORT_STOP_END")
            .when(seq % 4 == 2, "PORT_GAP_BEGIN")
            .otherwise("PORT_GAP_END")
        )
        return F.struct(
            kind.alias("event_type"),
            F.timestamp_seconds(F.lit(FIRST_SECOND) + (order % 60) * 3600 + seq * 60).alias("timestamp"),
            tagged("a", entry["l_suppkey"]).alias("anchorage_id"),
            tagged("s", entry["l_partkey"] % 15).alias("seg_id"),
        )

    places = anchorages(spark, folder)
    sized = _sized_orders(spark, folder).join(lines, order == F.col("l_orderkey"), "left")
    visits = _visits(sized, "lines").withColumn("events", F.transform("lines", as_event)).drop("o_orderkey", "lines")
    for side in ("start", "end"):
        spot = places.select(
            F.col("s2id").alias(f"{side}_anchorage_id"),
            F.col("lat").alias(f"{side}_lat"),
            F.col("lon").alias(f"{side}_lon"),
        )
        visits = visits.join(spot, f"{side}_anchorage_id")
    empty = F.array().cast(visits.schema["events"].dataType)
    return visits.withColumn("events", F.coalesce("events", empty))


def voyages(spark: SparkSession, folder: str) -> DataFrame:
    """Trips that end with some of the visits and start with the one before among them."""
    per_vessel = Window.partitionBy("vessel_id").orderBy("start_timestamp", "visit_id")
    return _visits(_sized_orders(spark, folder)).filter(F.col("o_orderkey") % 29 == 3).select(
        F.col("visit_id").alias("trip_id"),
        "vessel_id",
        F.lag("end_timestamp").over(per_vessel).alias("trip_start"),
        F.col("start_timestamp").alias("trip_end"),
        F.col("visit_id").alias("trip_end_visit_id"),
    )


def loitering(messages: DataFrame) -> DataFrame:
    """Six-hour stretches of each segment with more than one message."""
    ts = F.col("timestamp")
    place = F.struct("lat", "lon")
    return (
        messages.groupBy("seg_id", "ssvid", F.floor(F.unix_seconds(ts) / 21_600).alias("stretch"))
        .agg(
            F.min(ts).alias("loitering_start_timestamp"),
            F.max(ts).alias("loitering_end_timestamp"),
            F.min_by(place, ts).alias("first"),
            F.max_by(place, ts).alias("last"),
            (F.sum("meters_to_prev") / 1852).alias("tot_distance_nm"),
            F.avg("speed_knots").alias("avg_speed_knots"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter("n > 1")
        .select(
            "seg_id",
            "ssvid",
            "loitering_start_timestamp",
            "loitering_end_timestamp",
            F.col("first.lat").alias("start_lat"),
            F.col("first.lon").alias("start_lon"),
            F.col("last.lat").alias("end_lat"),
            F.col("last.lon").alias("end_lon"),
            ((F.unix_seconds("loitering_end_timestamp") - F.unix_seconds("loitering_start_timestamp")) / 3600.0).alias("loitering_hours"),
            "tot_distance_nm",
            "avg_speed_knots",
            (F.col("n") * 7 % 40).cast("double").alias("avg_distance_from_shore_nm"),
        )
    )


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    """Three encounters for each pair of users with successive numbers."""
    u, d = F.col("u"), F.col("d")
    everyone = users(spark, folder)
    partner = everyone.select((F.col("u") - 1).alias("u"))
    pairs = everyone.join(partner, "u").select("u", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("d"))
    return pairs.select(
        F.concat(F.lit("e"), u, F.lit("d"), d).alias("encounter_id"),
        tagged("vid", u).alias("vessel_1_id"),
        tagged("vid", u + 1).alias("vessel_2_id"),
        hours_in(d * 24 + u % 12).alias("start_time"),
        hours_in(d * 24 + u % 12 + u % 5 + 1).alias("end_time"),
        ((u % 30) / 10.0).alias("median_speed_knots"),
        ((u % 7) / 10.0).alias("median_distance_km"),
        ((u * 37) % 120 - 60 + 0.25 + d * 0.1).alias("mean_latitude"),
        ((u * 73) % 360 - 180 + 0.25 + d * 0.1).alias("mean_longitude"),
        F.array(tagged("s", u)).alias("vessel_1_seg_ids"),
        F.array(tagged("s", u + 1)).alias("vessel_2_seg_ids"),
        (u % 50).alias("vessel_1_point_count"),
        (u % 40).alias("vessel_2_point_count"),
    )


def covered_regions(regions: DataFrame, points: DataFrame) -> DataFrame:
    """Sample regions with real S2 cells: those of all points whose box cell the region has."""
    keyed = points.select(
        box_cell(F.col("lon"), F.col("lat")).alias("box"), s2_cell(F.col("lon"), F.col("lat")).alias("cell")
    ).distinct()
    boxes = regions.select("layer", "id", F.explode("s2_cells").alias("box"))
    cells = boxes.join(keyed, "box").groupBy("layer", "id").agg(F.collect_set("cell").alias("s2_cells"))
    return regions.drop("s2_cells").join(cells, ["layer", "id"])
