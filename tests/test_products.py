"""Authorization and regions, and the four published products, on hand-made rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from seawake.operators import authorization as auth
from seawake.operators import regions as reg
from seawake.operators.voyages import known_voyages, next_voyage
from seawake.plans import encounters, fishing, loitering, port_visits
from seawake.sources.schemas import EVENTS_SCHEMA, FILTERED_SCHEMA
from tests.helpers import at
from tests.test_summarize import VESSELS, vessel

REGIONS = "id string, layer string, s2_cells array<long>, geo array<array<struct<lon:double,lat:double>>>"
MEASURES = "gridcode string, distance_from_shore_m double, distance_from_port_m double"
CORE = "vessel_record_id string, ssvid string, n_shipname string, n_callsign string, imo string, flag string, first_timestamp timestamp, last_timestamp timestamp"
GRANTS = "vessel_record_id string, ssvid string, n_shipname string, n_callsign string, imo string, flag string, authorized_from timestamp, authorized_to timestamp, source_code string"


def box(west, south, east, north):
    return [[(west, south), (east, south), (east, north), (west, north)]]


def region(name, layer, *bounds, cells=(1,)):
    return (name, layer, list(cells), box(*(float(b) for b in bounds)))


def grant(start, end, rfmo, record="r", ssvid="v1"):
    return (record, ssvid, None, None, None, None, at(start), at(end), rfmo)


def core(record="r", ssvid="v1"):
    return (record, ssvid, None, None, None, None, at("2020-01-01 00:00:00"), at("2030-01-01 00:00:00"))


def fishing_event(event_id="e", **changes):
    start, end = at("2024-01-01 00:00:00"), at("2024-01-01 05:00:00")
    base = dict(
        ssvid="v1", seg_id="s1", vessel_id="x", main_vessel_shipname="N", main_vessel_flag="F", best_best_vessel_class="trawlers",
        geo_info=[((5.0, 5.0), 1)], event_start=start, event_end=end, lat_min=5.0, lat_max=5.0, message_count=6, avg_speed_knots=2.0,
        avg_implied_speed_knots=2.0, avg_meters_to_prev=100.0, event_distance_m=1500.0, avg_hours=None, points_wkt="", lat_mean=5.0,
        lon_mean=5.0, lon_min=5.0, lon_max=5.0, event_id=event_id, event_end_date=end.date(),
    )
    return tuple({**base, **changes}.values())


def published(spark, events, regions, grants, cores=None, measures=None):
    out = fishing.authorize_events(
        spark.createDataFrame(events, FILTERED_SCHEMA),
        spark.createDataFrame([], FILTERED_SCHEMA),
        spark.createDataFrame(cores or [core()], CORE),
        spark.createDataFrame(grants, GRANTS),
        spark.createDataFrame(measures or [("lon:+005.00_lat:+005.00", 2000.0, 3000.0)], MEASURES),
        spark.createDataFrame(regions, REGIONS),
        spark.createDataFrame([vessel()], VESSELS),
        "ais_",
        edges="planar",
    )
    assert out.schema.simpleString() == EVENTS_SCHEMA.simpleString()
    return [(r, json.loads(r.event_info), json.loads(r.event_vessels)) for r in out.collect()]


ICCAT, IOTC = region("ICCAT", "rfmo", 0, 0, 10, 10), region("IOTC", "rfmo", 0, 0, 10, 10)
STATUS = "vessel_public_authorization_status"


def test_authorized_event_and_json_layout(spark):
    ((row, info, vessels),) = published(spark, [fishing_event()], [ICCAT], [grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT")])
    assert list(info) == ["message_count", "avg_duration_hrs", "distance_km", "avg_speed_knots", "potential_risk", STATUS]
    assert info["avg_duration_hrs"] is None and info["distance_km"] == 1.5 and info["potential_risk"] is False
    assert info[STATUS] == "publicly_authorized"
    assert list(vessels[0]) == ["id", "ssvid", "name", "flag", "type", "seg_id", "public_authorizations"]
    assert vessels[0]["public_authorizations"] == [{"rfmo": "ICCAT", "has_publicly_listed_authorization": "true"}]
    assert vessels[0]["flag"] is None
    assert row.start_distance_from_shore_km == 2.0 and row.end_distance_from_port_km == 3.0
    assert row.regions_mean_position.rfmo == ["ICCAT"] and row.regions_mean_position.eez == []


@pytest.mark.parametrize(
    "grants, eez, status, risk, flag",
    [
        # other vessels were listed until after the event, this one was not
        ([grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT", "other", "v9")], False, "not_matching_relevant_public_authorization", True, "false"),
        ([grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT", "other", "v9")], True, "not_matching_relevant_public_authorization", False, "false"),
        # the registry was last read before the event
        ([grant("2022-01-01 00:00:00", "2023-01-01 00:00:00", "ICCAT")], False, "pending_info", False, "pending"),
        # read at the very moment the event began
        ([grant("2022-01-01 00:00:00", "2024-01-01 00:00:00", "ICCAT", "other", "v9")], False, "pending_info", False, "false"),
        # never read
        ([], False, "partially_matched", False, "pending"),
    ],
)
def test_statuses(spark, grants, eez, status, risk, flag):
    areas = [ICCAT] + ([region("E", "eez", 0, 0, 10, 10)] if eez else [])
    ((_, info, vessels),) = published(spark, [fishing_event()], areas, grants)
    assert (info[STATUS], info["potential_risk"]) == (status, risk)
    assert vessels[0]["public_authorizations"][0]["has_publicly_listed_authorization"] == flag


def test_no_region(spark):
    ((row, info, vessels),) = published(spark, [fishing_event()], [region("R", "rfmo", 50, 50, 60, 60)], [])
    assert row.regions_mean_position is None
    assert (info[STATUS], info["potential_risk"]) == ("publicly_authorized", False)
    assert vessels[0]["public_authorizations"] == [{"rfmo": None, "has_publicly_listed_authorization": None}]


def test_region_outside_the_whitelist_counts_as_none(spark):
    ((row, info, _),) = published(spark, [fishing_event()], [region("NAFO", "rfmo", 0, 0, 10, 10)], [])
    assert row.regions_mean_position.rfmo == ["NAFO"] and info[STATUS] == "publicly_authorized"


def test_two_registries_of_different_age_give_two_rows(spark):
    grants = [grant("2022-01-01 00:00:00", "2023-01-01 00:00:00", "ICCAT"), grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "IOTC")]
    found = published(spark, [fishing_event()], [ICCAT, IOTC], grants)
    assert [r.event_id for r, _, _ in found] == ["e", "e"]
    assert sorted(i[STATUS] for _, i, _ in found) == ["pending_info", "publicly_authorized"]


def test_partial_match(spark):
    end = "2025-01-01 00:00:00"
    grants = [grant("2023-01-01 00:00:00", end, "ICCAT"), grant("2023-01-01 00:00:00", end, "IOTC", "other", "v9")]
    ((_, info, vessels),) = published(spark, [fishing_event()], [ICCAT, IOTC], grants)
    assert info[STATUS] == "partially_matched"
    assert [a["has_publicly_listed_authorization"] for a in vessels[0]["public_authorizations"]] == ["true", "false"]


def test_what_one_event_finds_holds_for_the_vessel(spark):
    early = fishing_event("early", event_start=at("2019-01-01 00:00:00"), event_end=at("2024-01-01 04:00:00"))
    grants = [grant("2018-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT")]
    # the early event is outside the identity's activity, and its vessel has no attributes that year
    found = published(spark, [early, fishing_event()], [ICCAT], grants)
    assert [r.event_id for r, _, _ in found] == ["e"]
    events = spark.createDataFrame([early, fishing_event()], FILTERED_SCHEMA)
    idents = auth.identity_authorizations(spark.createDataFrame([core()], CORE), spark.createDataFrame(grants, GRANTS))
    assert auth.vessel_authorizations(events, idents, "ssvid", "event_start", "vessel_id").count() == 1
    places = events.select("event_id", F.expr("named_struct('rfmo', array('ICCAT'), 'eez', array())").alias("regions_mean_position"))
    scrapes = auth.last_scrape(spark.createDataFrame(grants, GRANTS))
    statuses = fishing.fishing_authorizations(events, places, idents, scrapes).collect()
    assert [s[STATUS] for s in statuses] == ["publicly_authorized"] * 2


def test_repeated_event_ids_multiply(spark):
    # two copies: two rows of events, each meeting two rows of regions, and lists filled twice
    found = published(spark, [fishing_event(), fishing_event(seg_id="s2")], [ICCAT], [grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT")])
    assert sorted(r.seg_id for r, _, _ in found) == ["s1", "s1", "s2", "s2"]
    assert all(len(v[0]["public_authorizations"]) == 2 for _, _, v in found)


def test_events_without_measured_cell_are_dropped(spark):
    assert published(spark, [fishing_event(lon_max=7.0)], [ICCAT], []) == []


def test_within_excludes_the_boundary_and_intersects_does_not(spark):
    points = spark.createDataFrame([("edge", 0.0, 5.0, 1), ("in", 5.0, 5.0, 1), ("other cell", 5.0, 5.0, 2)], "event_id string, lon double, lat double, cell long")
    areas = spark.createDataFrame([ICCAT, ICCAT], REGIONS)
    for mode, want in (("within", ["in"]), ("intersects", ["edge", "in"])):
        assert sorted(r.event_id for r in reg.match_regions(points, areas, mode, "planar").collect()) == want


def test_identity_match_is_null_safe_but_not_on_the_record(spark):
    cores = [core(), core(None, "v2")]
    grants = [grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT"), grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT", None, "v2")]
    found = auth.identity_authorizations(spark.createDataFrame(cores, CORE), spark.createDataFrame(grants, GRANTS))
    assert [r.ssvid for r in found.collect()] == ["v1"]


def test_restrictive_subset(spark):
    rows = [('[{"type":"fishing"}]',), ('[{"type":"carrier"},{"type":"fishing"}]',), ('[{"type":null}]',)]
    assert fishing.restrict_events(spark.createDataFrame(rows, "event_vessels string")).count() == 1


# --- port visits --------------------------------------------------------------------

VISITS = (
    "visit_id string, vessel_id string, ssvid string, start_timestamp timestamp, end_timestamp timestamp, start_lat double, "
    "end_lat double, start_lon double, end_lon double, start_anchorage_id string, end_anchorage_id string, duration_hrs double, "
    "confidence long, events array<struct<event_type:string,timestamp:timestamp,anchorage_id:string,seg_id:string>>"
)
ANCHORAGES = "s2id string, iso3 string, label string, label_source string, top_destination string, lat double, lon double, distance_from_shore_m double, at_dock boolean"


def visit(name, nested, confidence=2, end="2024-01-02 00:00:00"):
    return (name, "x", "v1", at("2024-01-01 00:00:00"), at(end), 5.0, 5.0, 5.0, 5.0, "a1", "a1", 24.0, confidence, nested)


def stop(kind, minute, anchorage="a1", seg="s1"):
    return (kind, at(f"2024-01-01 00:{minute:02d}:00"), anchorage, seg)


def port_events(spark, visits):
    anchorages = [("a1", "ESP", "PORT ONE", "manual", "TOP", 5.5, 5.5, 100.0, True), ("a2", "FRA", "TWO", "top_destination", "TOP", 6.5, 6.5, 100.0, False)]
    cell = spark.range(1).select(reg.s2_cell(F.lit(6.5), F.lit(6.5))).first()[0]
    return port_visits.port_visit_events(
        spark.createDataFrame(visits, VISITS),
        spark.createDataFrame([vessel()], VESSELS),
        spark.createDataFrame([("lon:+005.00_lat:+005.00", 2000.0, 3000.0)], MEASURES),
        spark.createDataFrame([region("E", "eez", 6, 6, 7, 7, cells=[cell])], REGIONS),
        spark.createDataFrame(anchorages, ANCHORAGES),
        "2024-01-02",
        "ais_",
        "planar",
    )


def test_port_visits(spark):
    visits = [
        visit("ranked", [stop("PORT_STOP_END", 1), stop("PORT_STOP_BEGIN", 5, "a2", "s2"), stop("PORT_STOP_BEGIN", 9)]),
        visit("unknown type first", [stop("PORT_STOP_BEGIN", 1), stop("OTHER", 5, "a2")]),
        # ids are made of vessel, start and end, so this visit needs an end of its own
        visit("unknown anchorage", [stop("PORT_STOP_BEGIN", 1, "nowhere")], end="2024-01-02 01:00:00"),
        visit("empty", []),
        visit("no list", None),
        visit("low", [stop("PORT_STOP_BEGIN", 1)], confidence=1),
        visit("late", [stop("PORT_STOP_BEGIN", 1)], end="2024-01-03 00:00:00"),
    ]
    rows = {json.loads(r.event_info)["visit_id"]: r for r in port_events(spark, visits).collect()}
    assert sorted(rows) == ["ranked", "unknown anchorage", "unknown type first"]
    info = json.loads(rows["ranked"].event_info)
    assert list(info) == ["duration_hrs", "visit_id", "confidence", "start_anchorage", "end_anchorage", "intermediate_anchorage", "seg_ids"]
    assert info["seg_ids"] == ["s1", "s2"] and info["start_anchorage"]["id"] == "esp-portone"
    assert info["intermediate_anchorage"]["anchorage_id"] == "a2" and info["intermediate_anchorage"]["name"] is None
    assert rows["ranked"].regions_mean_position.eez == ["E"] and rows["ranked"].seg_id is None
    assert json.loads(rows["unknown type first"].event_info)["intermediate_anchorage"]["anchorage_id"] == "a2"
    lost = rows["unknown anchorage"]
    assert lost.lat_mean is None and lost.regions_mean_position is None
    assert set(json.loads(lost.event_info)["intermediate_anchorage"].values()) == {None}


# --- voyages, loitering, encounters -----------------------------------------------------

VOYAGES = "trip_id string, trip_start timestamp, trip_end timestamp, trip_end_visit_id string, vessel_id string"


def voyages(spark):
    return spark.createDataFrame(
        [
            ("first", None, at("2024-01-01 12:00:00"), "ranked", "x"),
            ("second", at("2024-01-01 13:00:00"), at("2024-06-01 00:00:00"), "other", "x"),
            ("unknown", at("1979-01-01 00:00:00"), at("2024-06-01 00:00:00"), "other", "x"),
        ],
        VOYAGES,
    )


def test_voyages(spark):
    assert sorted(r.trip_id for r in known_voyages(voyages(spark)).collect()) == ["first", "second"]
    events = spark.createDataFrame(
        [("x", at("2001-01-01 00:00:00"), at("2001-01-01 01:00:00")), ("x", at("2024-01-01 12:00:00"), at("2024-01-01 12:30:00")), ("x", at("2024-03-01 00:00:00"), at("2024-03-01 01:00:00")), ("y", at("2024-03-01 00:00:00"), at("2024-03-01 01:00:00"))],
        "vessel string, s timestamp, e timestamp",
    )
    found = [r.trip_end_visit_id for r in next_voyage(events, voyages(spark), "vessel", "s", "e").orderBy("vessel", "s").collect()]
    assert found == ["ranked", None, "other", None]


def test_loitering(spark):
    ports = port_events(spark, [visit("ranked", [stop("PORT_STOP_BEGIN", 1)])])
    rows = [
        ("s1", "v1", at("2024-01-01 01:00:00"), at("2024-01-01 02:00:00"), 5.0, 5.0, 5.0, 5.0, 1.0, 10.0, nm, 1.0)
        for nm in (19.9, 20.0)
    ]
    schema = (
        "seg_id string, ssvid string, loitering_start_timestamp timestamp, loitering_end_timestamp timestamp, start_lat double, start_lon double, "
        "end_lat double, end_lon double, loitering_hours double, tot_distance_nm double, avg_distance_from_shore_nm double, avg_speed_knots double"
    )
    segs = spark.createDataFrame([("s1", True, False)], "seg_id string, good_seg boolean, overlapping_and_short boolean")
    out = loitering.loitering_events(
        spark.createDataFrame(rows, schema),
        spark.createDataFrame([("s1", "x")], "seg_id string, vessel_id string"),
        segs.union(segs),
        spark.createDataFrame([vessel()], VESSELS),
        voyages(spark),
        ports,
        spark.createDataFrame([("lon:+005.00_lat:+005.00", 2000.0, 3000.0)], MEASURES),
        spark.createDataFrame([ICCAT], REGIONS),
        "2024-01-01",
        20,
        "ais_",
        "planar",
    )
    found = out.collect()
    assert len(found) == 2  # the segment is listed twice
    info = json.loads(found[0].event_info)
    assert list(info) == ["loitering_hours", "total_distance_km", "avg_distance_from_shore_km", "avg_speed_knots", "vessel_class", "main_vessel_destination_port"]
    assert info["total_distance_km"] == pytest.approx(18.52)
    port = info["main_vessel_destination_port"]
    assert list(port) == ["event_id", "id", "flag", "name"] and port["id"] == "esp-portone" and len(port["event_id"]) == 32
    assert found[0].event_start == datetime(2024, 1, 1, 1) and found[0].regions_mean_position is None


ENCOUNTERS = (
    "encounter_id string, vessel_1_id string, vessel_2_id string, start_time timestamp, end_time timestamp, mean_latitude double, mean_longitude double, "
    "median_speed_knots double, median_distance_km double, vessel_1_seg_ids array<string>, vessel_2_seg_ids array<string>, vessel_1_point_count long, vessel_2_point_count long"
)


def test_encounters(spark):
    def meet(name, hours, speed=1.23456):
        return (name, "x", "y", at("2024-01-01 01:00:00"), at(f"2024-01-01 {hours + 1:02d}:00:01"), 5.0, 5.0, speed, 0.12345, ["s1"], ["s2", "s3"], 3, 4)

    cell = spark.range(1).select(reg.s2_cell(F.lit(5.0), F.lit(5.0))).first()[0]
    out = encounters.encounter_events(
        spark.createDataFrame([meet("good", 2), meet("short", 1), meet("fast", 3, 2.0)], ENCOUNTERS),
        spark.createDataFrame([vessel(), vessel(year=None, vessel_id="y", name="M")], VESSELS),
        voyages(spark),
        port_events(spark, [visit("ranked", [stop("PORT_STOP_BEGIN", 1)])]),
        spark.createDataFrame([core()], CORE),
        spark.createDataFrame([grant("2023-01-01 00:00:00", "2025-01-01 00:00:00", "ICCAT")], GRANTS),
        spark.createDataFrame([("lon:+005.00_lat:+005.00", 2000.0, 3000.0)], MEASURES),
        spark.createDataFrame([region("ICCAT", "rfmo", 0, 0, 10, 10, cells=[cell])], REGIONS),
        "ais_",
        "planar",
    )
    assert out.schema.simpleString() == EVENTS_SCHEMA.simpleString()
    # without a year of their own, the attributes of y hold; both vessels have the ssvid of the sample row
    one, two = out.orderBy("event_id").collect()
    assert (one.event_id, one.vessel_id, two.event_id, two.vessel_id) == ("good.1", "x", "good.2", "y")
    info = json.loads(one.event_info)
    assert list(info) == [
        "median_distance_km", "median_speed_knots", "encountered_vessel_id", "vessel_classes", "potential_risk",
        "main_vessel_public_authorization_status", "encountered_vessel_public_authorization_status", "main_vessel_destination_port",
    ]
    assert (info["median_distance_km"], info["median_speed_knots"], info["vessel_classes"]) == (0.123, 1.235, "fishing-fishing")
    assert info["main_vessel_destination_port"]["id"] == "esp-portone"
    assert json.loads(two.event_info)["main_vessel_destination_port"]["id"] is None
    first, second = json.loads(one.event_vessels)
    assert list(first) == ["id", "ssvid", "name", "point_count", "type", "flag", "seg_ids", "public_authorizations"]
    assert (first["point_count"], second["seg_ids"], second["name"]) == (3, ["s2", "s3"], "M")
    assert one.seg_id is None and one.start_distance_from_shore_km == one.end_distance_from_shore_km == 2.0
