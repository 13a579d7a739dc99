"""Registered queries: one for each operator and product, over whole tables.

Results are laid out for comparison: times without zone, lists as text, and
computed floats rounded at a digit where both engines agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from contract.inputs import END, LAST_DAY, PREFIX, RELOAD, START, Inputs
from seawake.config import REGION_LAYERS
from seawake.functions.documents import first_vessel_field, json_scalar
from seawake.functions.cells import s2_cell
from seawake.functions.geo import anti_lon, distance_m
from seawake.functions.scalars import (
    event_id,
    filter_invalid_ssvid,
    float_text,
    gridcode,
    m_to_km,
    nm_to_km,
    seconds_between,
)
from seawake.operators import authorization as auth
from seawake.operators import coverings, identity, regions, summarize
from seawake.operators import sessionize as ses
from seawake.operators.joins import range_join, semi
from seawake.operators.voyages import destination_port, next_voyage
from seawake.plans import encounters as enc
from seawake.plans import fishing
from seawake.plans import loitering as loit
from seawake.plans import port_visits as ports
from seawake.session import ensure_checkpoint_dir
from seawake.sources import samples
from seawake.sources.tables import delete_range, drop_version, publish_versioned
from seawake.streaming import incremental as inc
from seawake.streaming.continuous import load_stream

FIELDS = ("nnet_score", "night_loitering")
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Inputs(spark, folder)))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    REGISTRY[build.__name__] = run
    return build


def rounded(digits: int, *names: str) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


def number(text: str, path: str, digits: int, name: str) -> Column:
    return F.round(json_scalar(F.col(text), path).cast("double"), digits).alias(name)


def field(text: str, path: str, name: str) -> Column:
    return json_scalar(F.col(text), path).alias(name)


def layer_texts(layers: tuple[str, ...] = REGION_LAYERS) -> list[Column]:
    return [F.array_join(F.col("regions_mean_position")[layer], ",").alias(f"in_{layer}") for layer in layers]


DISTANCES = (
    "start_distance_from_shore_km",
    "end_distance_from_shore_km",
    "start_distance_from_port_km",
    "end_distance_from_port_km",
)


# --- messages to events -------------------------------------------------------


def sources(i: Inputs, score_field: str = "nnet_score") -> DataFrame:
    return ses.source_messages(i.messages, START, END, score_field)


@query
def fishing_events_minimal(i: Inputs) -> DataFrame:
    """Flagship: sessionize, sum up, keep real events; no identity."""
    events = summarize.summarize(ses.tag_events(sources(i)))
    kept = events.withColumns(
        {
            "avg_speed_knots": F.col("speed_knots_sum") / F.col("speed_knots_count"),
            "event_distance_m": F.col("meters_to_prev_sum"),
        }
    )
    kept = summarize.event_thresholds(kept).filter(F.col("event_distance_m") > 500)
    return kept.select(
        "seg_id",
        "event_start",
        "event_end",
        "message_count",
        *rounded(9, "avg_speed_knots"),
        *rounded(3, "event_distance_m"),
    )


@query
def scan_padded(i: Inputs) -> DataFrame:
    rows = ses.source_messages(i.messages, "2024-01-02", "2024-01-03", "night_loitering")
    return rows.select("seg_id", "timestamp", "year", "lat", "lon", "speed_knots", "score")


def tagged(i: Inputs, score_field: str) -> DataFrame:
    return ses.tag_events(sources(i, score_field)).select(
        "seg_id", "timestamp", "event_start", "event_end", "event_end_date"
    )


@query
def sessionize_messages(i: Inputs) -> DataFrame:
    return tagged(i, "nnet_score")


@query
def sessionize_night(i: Inputs) -> DataFrame:
    return tagged(i, "night_loitering")


@query
def event_boundaries(i: Inputs) -> DataFrame:
    return ses.event_boundaries(sources(i)).select("seg_id", "event_start", "event_end", "score", "lat", "lon")


@query
def fuse_runs(i: Inputs) -> DataFrame:
    return ses.fuse_runs(sources(i)).drop("ssvid")


@query
def messages_in_ranges(i: Inputs) -> DataFrame:
    """Time-range join of all messages with the fused event ranges of their segment."""
    ranges = ses.fuse_runs(i.messages.withColumn("score", F.col("nnet_score"))).select(
        "seg_id", F.col("event_start").alias("low"), F.col("event_end").alias("high")
    )
    found = range_join(i.messages.select("seg_id", "timestamp"), ranges, ["seg_id"], "timestamp", "low", "high")
    return found.select("seg_id", "timestamp", F.col("low").alias("event_start"))


# --- incremental state -------------------------------------------------------------

STATE_OUT = ("seg_id", "timestamp", "event_start", "event_end", "event_end_date")


@query
def truncate_state(i: Inputs) -> DataFrame:
    return inc.truncate_state(i.state(), RELOAD).select(*STATE_OUT)


def before_reload(i: Inputs) -> DataFrame:
    return inc.truncate_state(i.state(), RELOAD)


def reload_delta(i: Inputs) -> DataFrame:
    return i.state(start=RELOAD)


@query
def open_events(i: Inputs) -> DataFrame:
    return inc.open_events(before_reload(i), RELOAD, 2)


@query
def merge_overlap(i: Inputs) -> DataFrame:
    return inc.overlap_join(
        inc.open_events(before_reload(i), RELOAD, 2), inc.padded_events(reload_delta(i), RELOAD, 2)
    )


@query
def merge_open_events(i: Inputs) -> DataFrame:
    return inc.merge_open_events(before_reload(i), reload_delta(i), RELOAD).select(*STATE_OUT)


@query
def upsert_state(i: Inputs) -> DataFrame:
    before = before_reload(i)
    staged = inc.merge_open_events(before, reload_delta(i), RELOAD)
    return inc.upsert(before, staged, inc.UPSERT_KEYS, inc.reach_of(RELOAD)).select(*STATE_OUT)


def _report(state: DataFrame, mode: str) -> DataFrame:
    return state.groupBy("event_end_date").agg(
        F.lit(mode).alias("mode"),
        F.count(F.lit(1)).alias("messages"),
        F.count(F.when(F.col("timestamp") == F.col("event_start"), 1)).alias("events"),
        F.sum(F.unix_seconds("event_end") - F.unix_seconds("event_start")).alias("seconds"),
    )


@query
def three_mode_parity(i: Inputs) -> DataFrame:
    """Stored tables after one load, after daily loads, and after a load followed by reloads: the same state."""
    days = [START, "2024-01-02", "2024-01-03", END]
    tables = {name: f"parity_{name}_{uuid.uuid4().hex}" for name in ("whole", "daily")}

    def loaded(table: str, mode: str, ranges: list[tuple[str, str]]) -> DataFrame:
        for first, last in ranges:
            inc.load_increment(i.spark, i.messages, tables[table], first, last, "nnet_score")
        return _report(i.spark.table(tables[table]), mode).checkpoint()

    once = loaded("whole", "once", [(START, END)])
    again = loaded("whole", "again", [(days[1], END), (days[2], END)])
    daily = loaded("daily", "daily", list(zip(days, days[1:])))
    for table in tables.values():
        drop_version(i.spark, table)
    return once.unionByName(daily).unionByName(again)


@query
def continuous_load(i: Inputs) -> DataFrame:
    """The state after a stream of three deliveries, the days of each overlapping those of the next."""
    ensure_checkpoint_dir(i.spark)
    name = f"stream_{uuid.uuid4().hex}"
    folder = f"{i.spark.sparkContext.getCheckpointDir()}/{name}"
    messages = ses.scan_messages(i.messages, START, END)
    messages.repartitionByRange(3, "timestamp").write.parquet(f"{folder}/in")
    source = i.spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    load_stream(source, f"{folder}/store", name, "nnet_score", f"{folder}/offsets").awaitTermination()
    report = _report(i.spark.table(name), "stream").checkpoint()
    drop_version(i.spark, name)
    return report


# --- identity and summaries ----------------------------------------------------


@query
def good_segments_semi(i: Inputs) -> DataFrame:
    parts = summarize.summarize(i.state())
    kept = semi(parts, identity.good_segments(i.sample("segments"), 10))
    return kept.select("seg_id", "event_start", "event_end", "message_count")


@query
def good_segments_inner(i: Inputs) -> DataFrame:
    kept = i.loitering.join(identity.good_segments(i.sample("segments")), "seg_id")
    return kept.select("seg_id", "loitering_start_timestamp", "avg_distance_from_shore_nm")


@query
def best_segment_vessel(i: Inputs) -> DataFrame:
    return identity.best_segment_vessel(i.sample("segment_vessel"))


@query
def fishing_vessels(i: Inputs) -> DataFrame:
    return identity.fishing_vessels(i.sample("vessels"), samples.is_trawler).select(
        "vessel_id", "year", "ssvid", "prod_shiptype", "prod_geartype", "registry_geartype"
    )


@query
def vessel_left_join(i: Inputs) -> DataFrame:
    parts = summarize.identified_parts(summarize.summarize(i.state()), **i.vessel_inputs())
    return parts.select(
        "seg_id",
        "event_start",
        "vessel_id",
        "main_vessel_shipname",
        "main_vessel_flag",
        "best_best_vessel_class",
        "message_count",
    )


def summary_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "ssvid",
        "seg_id",
        "vessel_id",
        "main_vessel_shipname",
        "main_vessel_flag",
        "best_best_vessel_class",
        "event_id",
        "event_start",
        "event_end",
        "event_end_date",
        "message_count",
        "lat_min",
        "lat_max",
        "lon_min",
        "lon_max",
        *rounded(9, "avg_speed_knots", "avg_hours"),
        *rounded(3, "avg_meters_to_prev", "event_distance_m", "avg_implied_speed_knots"),
        *rounded(6, "lat_mean", "lon_mean"),
    )


@query
def summarize_events(i: Inputs) -> DataFrame:
    return summary_columns(
        summarize.summarize_events(i.state(), score_field="nnet_score", lists=False, **i.vessel_inputs())
    )


@query
def summarize_events_night(i: Inputs) -> DataFrame:
    state = i.state("night_loitering")
    return summary_columns(
        summarize.summarize_events(state, score_field="night_loitering", lists=False, **i.vessel_inputs())
    )


def nine(number: Column) -> Column:
    return F.format_string("%.9f", number.cast("double"))


@query
def event_point_lists(i: Inputs) -> DataFrame:
    events = summarize.summarize_events(i.state(), score_field="nnet_score", **i.vessel_inputs())
    return events.select(
        "event_id",
        # read back from the stored text, and written with fewer digits, as engines differ in the last ones
        F.array_join(F.transform(F.split("points_wkt", ", "), lambda p: F.array_join(F.transform(F.split(p, " "), nine), " ")), ", ").alias("points_wkt"),
        F.size("geo_info").cast("long").alias("points"),
        F.array_join(F.transform("geo_info", lambda g: nine(g["point"]["lon"])), " ").alias("lons"),
        F.array_join(F.transform("geo_info", lambda g: nine(g["point"]["lat"])), " ").alias("lats"),
    )


@query
def event_class_filter(i: Inputs) -> DataFrame:
    """Which events pass the thresholds, and which score keeps them."""
    parts = summarize.identified_parts(summarize.summarize(i.state()), **i.vessel_inputs())
    events = summarize.event_thresholds(summarize.combine_parts(parts))
    kept = [summarize.class_filter(events, f).withColumn("score_field", F.lit(f)) for f in FIELDS]
    return kept[0].unionByName(kept[1]).select("seg_id", "event_start", "best_best_vessel_class", "score_field")


# --- authorizations and regions ---------------------------------------------------


def identities(i: Inputs) -> DataFrame:
    return auth.identity_authorizations(i.sample("identity_core"), i.sample("identity_authorization"))


@query
def identity_authorization(i: Inputs) -> DataFrame:
    return identities(i)


@query
def last_scrape(i: Inputs) -> DataFrame:
    return auth.last_scrape(i.sample("identity_authorization"))


@query
def activity_interval_join(i: Inputs) -> DataFrame:
    found = auth.activity_join(i.both_filtered(), identities(i), "ssvid", "event_start")
    return found.select("event_id", "event_start", "registry_rfmo", "registry_authorized_from", "registry_authorized_to")


@query
def vessel_authorizations(i: Inputs) -> DataFrame:
    return auth.vessel_authorizations(i.both_filtered(), identities(i), "ssvid", "event_start", "vessel_id")


@query
def region_cells(i: Inputs) -> DataFrame:
    return regions.grid_regions(i.regions).select("layer", "id", "cell")


def matches(i: Inputs, edges: str = "planar") -> DataFrame:
    return regions.match_regions(i.points(), i.regions, "within", edges)


@query
def region_match(i: Inputs) -> DataFrame:
    return matches(i)


@query
def region_match_covered(i: Inputs) -> DataFrame:
    """The same by S2 cells, those inside a region apart from those that its edges may touch."""
    points = regions.with_cell(i.points().drop("cell"))
    classed = coverings.classed_regions(samples.covered_regions(i.regions, points), "planar").checkpoint()
    return regions.match_regions(points, classed, "within", "planar")


@query
def region_match_spherical(i: Inputs) -> DataFrame:
    return matches(i, "spherical")


def places(i: Inputs) -> DataFrame:
    return regions.regions_struct(matches(i))


@query
def event_regions(i: Inputs) -> DataFrame:
    return places(i).select("event_id", *layer_texts())


def entries(name: str) -> Column:
    """A list of {rfmo, has_publicly_listed_authorization} as text."""
    text = F.transform(
        name,
        lambda e: F.concat(
            F.coalesce(e["rfmo"], F.lit("-")),
            F.lit(":"),
            F.coalesce(e["has_publicly_listed_authorization"].cast("string"), F.lit("-")),
        ),
    )
    return F.array_join(text, ",").alias(name)


@query
def authorization_status(i: Inputs) -> DataFrame:
    scrapes = auth.last_scrape(i.sample("identity_authorization"))
    groups = fishing.fishing_authorizations(i.both_filtered(), places(i), identities(i), scrapes)
    return groups.select(
        *auth.STATUS_GROUP, "vessel_public_authorization_status", entries("public_authorizations")
    )


@query
def gridcode_lookup(i: Inputs) -> DataFrame:
    events = i.both_filtered().select("event_id", "lon_min", "lat_min", "lon_max", "lat_max")
    measures = i.fishing_measures()
    start = regions.with_distances(events, measures, F.col("lon_min"), F.col("lat_min"), "start")
    both = regions.with_distances(start, measures, F.col("lon_max"), F.col("lat_max"), "end")
    return both.select("event_id", gridcode(F.col("lon_min"), F.col("lat_min")).alias("code"), *DISTANCES)


def authorized(i: Inputs) -> DataFrame:
    return fishing.authorize_events(
        i.filtered("nnet_score"),
        i.filtered("night_loitering"),
        i.sample("identity_core"),
        i.sample("identity_authorization"),
        i.fishing_measures(),
        i.regions,
        i.sample("vessels"),
        PREFIX,
        samples.is_trawler,
        edges="planar",
        points=i.points(),
    )


def fishing_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "event_type",
        "vessel_id",
        "seg_id",
        "event_start",
        "event_end",
        *rounded(6, "lat_mean", "lon_mean"),
        "lat_min",
        "lat_max",
        "lon_min",
        "lon_max",
        *layer_texts(),
        *DISTANCES,
        field("event_info", "$.message_count", "messages"),
        number("event_info", "$.avg_duration_hrs", 9, "avg_duration_hrs"),
        number("event_info", "$.distance_km", 6, "distance_km"),
        number("event_info", "$.avg_speed_knots", 9, "avg_speed_knots"),
        field("event_info", "$.potential_risk", "potential_risk"),
        field("event_info", "$.vessel_public_authorization_status", "status"),
        field("event_vessels", "$[0].id", "v_id"),
        field("event_vessels", "$[0].ssvid", "v_ssvid"),
        field("event_vessels", "$[0].name", "v_name"),
        field("event_vessels", "$[0].flag", "v_flag"),
        first_vessel_field(F.col("event_vessels"), "type").alias("v_type"),
        field("event_vessels", "$[0].seg_id", "v_seg_id"),
        field("event_vessels", "$[0].public_authorizations", "v_authorizations"),
    )


@query
def authorize_events(i: Inputs) -> DataFrame:
    return fishing_columns(authorized(i))


@query
def restrict_events(i: Inputs) -> DataFrame:
    return fishing.restrict_events(authorized(i)).select(
        "event_id", "vessel_id", first_vessel_field(F.col("event_vessels"), "type").alias("v_type")
    )


# --- port visits ----------------------------------------------------------------


@query
def port_visit_ranked(i: Inputs) -> DataFrame:
    return ports.first_ranked(i.port_visits)


def anchorage_fields(side: str) -> list[Column]:
    path = f"$.{side}_anchorage"
    return [
        field("event_info", f"{path}.anchorage_id", f"{side}_anchorage_id"),
        field("event_info", f"{path}.id", f"{side}_port_id"),
        field("event_info", f"{path}.flag", f"{side}_flag"),
        field("event_info", f"{path}.name", f"{side}_name"),
        field("event_info", f"{path}.top_destination", f"{side}_top_destination"),
        number("event_info", f"{path}.distance_from_shore_km", 6, f"{side}_shore_km"),
        field("event_info", f"{path}.at_dock", f"{side}_at_dock"),
        number("event_info", f"{path}.lat", 6, f"{side}_at_lat"),
        number("event_info", f"{path}.lon", 6, f"{side}_at_lon"),
    ]


POSITIONS = ("lat_mean", "lon_mean", "lat_min", "lat_max", "lon_min", "lon_max")


def port_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "event_type",
        "vessel_id",
        "seg_id",
        "event_start",
        "event_end",
        *POSITIONS,
        *layer_texts(),
        *DISTANCES,
        number("event_info", "$.duration_hrs", 6, "duration_hrs"),
        field("event_info", "$.visit_id", "visit_id"),
        field("event_info", "$.confidence", "confidence"),
        *anchorage_fields("start"),
        *anchorage_fields("end"),
        *anchorage_fields("intermediate"),
        field("event_info", "$.seg_ids", "seg_ids"),
        field("event_vessels", "$[0].id", "v_id"),
        field("event_vessels", "$[0].ssvid", "v_ssvid"),
        field("event_vessels", "$[0].name", "v_name"),
        field("event_vessels", "$[0].type", "v_type"),
        field("event_vessels", "$[0].flag", "v_flag"),
    )


def published_port_visits(i: Inputs) -> DataFrame:
    return ports.port_visit_events(
        i.port_visits,
        i.sample("vessels"),
        i.anchorage_measures(),
        i.s2_regions(),
        i.sample("anchorages"),
        LAST_DAY,
        PREFIX,
        edges="planar",
    )


@query
def port_visit_events(i: Inputs) -> DataFrame:
    return port_columns(published_port_visits(i))


# --- loitering -----------------------------------------------------------------


@query
def next_port(i: Inputs) -> DataFrame:
    vessels = i.loitering.join(i.sample("segment_info"), "seg_id")
    trips = next_voyage(
        vessels, i.sample("voyages"), "vessel_id", "loitering_start_timestamp", "loitering_end_timestamp"
    )
    return destination_port(trips, i.port_events).select(
        "seg_id", "loitering_start_timestamp", "trip_end_visit_id", "port_event_id", "port_id", "port_flag", "port_name"
    )


PORT_FIELDS = ("event_id", "id", "flag", "name")


def destination_fields() -> list[Column]:
    return [field("event_info", f"$.main_vessel_destination_port.{n}", f"port_{n}") for n in PORT_FIELDS]


def published_loitering(i: Inputs) -> DataFrame:
    return loit.loitering_events(
        i.loitering,
        i.sample("segment_info"),
        i.sample("segments"),
        i.sample("vessels"),
        i.sample("voyages"),
        i.port_events,
        i.loitering_measures(),
        i.s2_regions(),
        START,
        20,
        PREFIX,
        edges="planar",
    )


@query
def loitering_events(i: Inputs) -> DataFrame:
    return published_loitering(i).select(
        "event_id",
        "event_type",
        "vessel_id",
        "seg_id",
        "event_start",
        "event_end",
        *POSITIONS,
        *layer_texts(),
        *DISTANCES,
        number("event_info", "$.loitering_hours", 9, "loitering_hours"),
        number("event_info", "$.total_distance_km", 6, "total_distance_km"),
        number("event_info", "$.avg_distance_from_shore_km", 6, "avg_distance_from_shore_km"),
        number("event_info", "$.avg_speed_knots", 9, "avg_speed_knots"),
        field("event_info", "$.vessel_class", "vessel_class"),
        *destination_fields(),
        field("event_vessels", "$[0].id", "v_id"),
        field("event_vessels", "$[0].ssvid", "v_ssvid"),
        field("event_vessels", "$[0].name", "v_name"),
        field("event_vessels", "$[0].seg_id", "v_seg_id"),
        field("event_vessels", "$[0].type", "v_type"),
        field("event_vessels", "$[0].flag", "v_flag"),
    )


# --- encounters ----------------------------------------------------------------


@query
def mirror_encounters(i: Inputs) -> DataFrame:
    return enc.mirror_encounters(enc.quality_encounters(i.sample("encounters"))).select(
        "event_id",
        "vessel_id",
        "encountered_vessel_id",
        "start_time",
        "end_time",
        F.array_join("seg_ids", ",").alias("seg_ids"),
        F.array_join("encountered_seg_ids", ",").alias("encountered_seg_ids"),
        "vessel_point_count",
        "encountered_point_count",
    )


@query
def encounter_authorization(i: Inputs) -> DataFrame:
    pairs = enc.with_two_identities(
        enc.mirror_encounters(enc.quality_encounters(i.sample("encounters"))), i.sample("vessels"), PREFIX
    )
    points = regions.with_cell(
        pairs.select("event_id", F.col("mean_longitude").alias("lon"), F.col("mean_latitude").alias("lat"))
    )
    found = regions.regions_struct(regions.match_regions(points, i.s2_regions(), "intersects", "planar"))
    scrapes = auth.last_scrape(i.sample("identity_authorization"))
    return enc.encounter_authorizations(pairs, found, identities(i), scrapes).select(
        *auth.STATUS_GROUP,
        *enc.STATUSES,
        "joint_vessel_authorization_status",
        *[entries(c) for c in enc.LISTS],
        entries("joint_vessel_region_authorizations"),
    )


def published_encounters(i: Inputs) -> DataFrame:
    return enc.encounter_events(
        i.sample("encounters"),
        i.sample("vessels"),
        i.sample("voyages"),
        i.port_events,
        i.sample("identity_core"),
        i.sample("identity_authorization"),
        i.encounter_measures(),
        i.s2_regions(),
        PREFIX,
        edges="planar",
    )


@query
def encounter_events(i: Inputs) -> DataFrame:
    def vessel(position: int) -> list[Column]:
        names = ("id", "ssvid", "name", "point_count", "type", "flag", "seg_ids", "public_authorizations")
        return [field("event_vessels", f"$[{position}].{n}", f"v{position + 1}_{n}") for n in names]

    return published_encounters(i).select(
        "event_id",
        "event_type",
        "vessel_id",
        "seg_id",
        "event_start",
        "event_end",
        *POSITIONS,
        *layer_texts(),
        *DISTANCES,
        number("event_info", "$.median_distance_km", 6, "median_distance_km"),
        number("event_info", "$.median_speed_knots", 6, "median_speed_knots"),
        field("event_info", "$.encountered_vessel_id", "encountered_vessel_id"),
        field("event_info", "$.vessel_classes", "vessel_classes"),
        field("event_info", "$.potential_risk", "potential_risk"),
        field("event_info", "$.main_vessel_public_authorization_status", "main_status"),
        field("event_info", "$.encountered_vessel_public_authorization_status", "encountered_status"),
        *destination_fields(),
        *vessel(0),
        *vessel(1),
    )


# --- column functions ------------------------------------------------------------


@query
def scalar_helpers(i: Inputs) -> DataFrame:
    m = i.messages
    lon, lat, ts = F.col("lon"), F.col("lat"), F.col("timestamp")
    day = F.to_date(ts)
    return m.select(
        "seg_id",
        "timestamp",
        filter_invalid_ssvid(F.when(F.col("nnet_score") == 0, F.repeat(F.lit("h"), 64)).otherwise(F.col("ssvid"))).alias("shown_ssvid"),
        anti_lon(lon).alias("opposite"),
        gridcode(lon, lat).alias("code"),
        float_text(lon).cast("double").alias("lon_read_back"),
        m_to_km(F.lit(1500.0)).alias("km"),
        nm_to_km(F.floor("speed_knots").cast("double")).alias("nm_km"),
        event_id("fishing", F.col("ssvid"), ts, ts).alias("id"),
        day.alias("day"),
        F.date_sub(day, 1).alias("day_before"),
        F.year(ts).cast("long").alias("year"),
        seconds_between(F.date_trunc("day", ts), ts).alias("second_of_day"),
        F.coalesce("nnet_score", F.lit(-1.0)).alias("score_or_default"),
        F.round(F.floor("speed_knots") / 3, 3).alias("third"),
        F.lower(F.concat(F.upper("seg_id"), F.lit("-"), F.regexp_replace(F.lit("a b c"), " ", ""))).alias("joined"),
    )


@query
def geo_distance(i: Inputs) -> DataFrame:
    """Distance of every message from a fixed point."""
    away = distance_m(F.col("lon"), F.col("lat"), F.lit(-3.7), F.lit(40.4))
    return i.messages.select("seg_id", "timestamp", F.round(away, 3).alias("metres"))


@query
def s2_cells(i: Inputs) -> DataFrame:
    return i.messages.select("seg_id", "timestamp", s2_cell(F.col("lon"), F.col("lat")).alias("cell"))


@query
def range_deletion(i: Inputs) -> DataFrame:
    rows = i.state().select("seg_id", "timestamp", "event_start")
    both = delete_range(rows, "event_start", "2024-01-02", "2024-01-03").withColumn("kind", F.lit("both"))
    left = delete_range(rows, "event_start", "2024-01-02", "2024-01-03", "left").withColumn("kind", F.lit("left"))
    return both.unionByName(left)


@query
def versioned_publish(i: Inputs) -> DataFrame:
    """Publish two successive days; the view shows the second, and the first version is gone."""
    spark = i.spark
    # a name of its own for each session: folders of earlier sessions may still be there
    name = "seawake_port_events_" + spark.sparkContext.applicationId.replace("-", "_")
    publish_versioned(i.port_events.filter(F.col("event_start") < "2024-01-02"), name, "2024-03-09")
    current = publish_versioned(i.port_events, name, "2024-03-10")
    old_kept = spark.catalog.tableExists(f"{name}_v20240309")
    return spark.table(name).select(
        "event_id",
        "event_start",
        F.lit(current.removeprefix(name)).alias("version"),
        F.lit(old_kept).alias("previous_exists"),
    )


# The four products as published, without the unpacking the checks need.
PRODUCTS: dict[str, Callable[[Inputs], DataFrame]] = {
    "authorize_events": authorized,
    "port_visit_events": published_port_visits,
    "loitering_events": published_loitering,
    "encounter_events": published_encounters,
}
