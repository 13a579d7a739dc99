from datetime import date

import pytest
from pyspark.sql import functions as F

from seawake.config import EventRules
from seawake.operators import identity, summarize
from seawake.operators.sessionize import sessionize
from tests.helpers import MESSAGES, at, messages, naive, track

SEGMENTS = "seg_id string, good_seg boolean, positions long, overlapping_and_short boolean"
OWNERS = "seg_id string, vessel_id string, last_date date"
VESSELS = (
    "vessel_id string, year long, ssvid string, prod_shiptype string, prod_geartype string, registry_geartype string, "
    "on_fishing_list_nn boolean, shipname_indicates_likely_gear boolean, ais_shipname string, ais_mmsi_flag string"
)


def vessel(year=2024, name="N", gear="trawlers", vessel_id="x"):
    return (vessel_id, year, "v1", "fishing", gear, None, None, None, name, None)


def summary(spark, rows, vessels=None, field="nnet_score", start="2024-01-01", end="2024-02-01", **more):
    return summarize.summarize_events(
        sessionize(messages(spark, rows), start, end, "nnet_score"),
        spark.createDataFrame([("s1", True, 11, False), ("s2", True, 11, False)], SEGMENTS),
        spark.createDataFrame([("s1", "x", date(2024, 1, 1)), ("s2", "x", date(2024, 1, 1))], OWNERS),
        spark.createDataFrame(vessels or [vessel()], VESSELS),
        field,
        "ais_",
        **more,
    )


RUN = [(i * 300, i * 0.3, 1.0) for i in range(8)]


def test_one_event(spark):
    (e,) = summary(spark, track(RUN)).collect()
    assert e.message_count == 8 and e.vessel_id == "x" and e.main_vessel_shipname == "N" and e.main_vessel_flag is None
    # the first message measures from outside the event
    assert e.avg_hours == pytest.approx(300 / 3600) and e.event_distance_m == pytest.approx(2100)
    assert e.avg_implied_speed_knots == pytest.approx(4) and e.avg_meters_to_prev == pytest.approx(300)
    assert len(e.geo_info) == 8 and e.points_wkt.startswith("10 0, 10 0.0026979610968")
    assert e.geo_info[0].point.lat == 0.0 and e.geo_info[0].s2_cell != 0
    assert e.lat_mean == pytest.approx(8 / 8 * 1.05 / 111.19508, abs=1e-6) and e.lon_mean == pytest.approx(10)


@pytest.mark.parametrize(
    "rows, kept",
    [
        ([(i * 200, i * 0.3, 1.0) for i in range(7)], 0),  # exactly 20 minutes
        ([(i * 201, i * 0.3, 1.0) for i in range(7)], 1),
        ([(i * 600, i * 0.3, 1.0) for i in range(5)], 0),  # five messages
        ([(i * 300, i * 0.05, 1.0) for i in range(8)], 0),  # 350 m
    ],
)
def test_thresholds(spark, rows, kept):
    assert summary(spark, track(rows)).count() == kept


def test_squid_jiggers_belong_to_the_other_score(spark):
    rows = track([(i * 300, i * 0.05, 1.0) for i in range(8)])
    jigger = [vessel(gear="squid_jigger")]
    assert summary(spark, rows, jigger).count() == 0
    assert summary(spark, rows, jigger, field="night_loitering").count() == 1
    unknown = [vessel(gear=None)]
    assert summary(spark, track(RUN), unknown).count() + summary(spark, track(RUN), unknown, "night_loitering").count() == 0


def test_repeated_positions_count_once_in_the_centroid(spark):
    rows = [("v1", "s1", at(f"2024-01-01 00:{5 * i:02d}:00"), 0.0, 0.0 if i < 9 else 1.0, 1.0, 100.0, 1.0, 0.1, 1.0, 0.0) for i in range(10)]
    tagged = sessionize(spark.createDataFrame(rows, MESSAGES), "2024-01-01", "2024-01-02", "nnet_score")
    owner = tagged.select("ssvid", "seg_id", "timestamp", "lon", "lat").withColumns(
        {"event_id": F.lit("e"), "main_vessel_shipname": F.lit(None).cast("string"), "main_vessel_flag": F.lit("F"), "best_best_vessel_class": F.lit("c")}
    )
    (c,) = summarize.centroids(owner).collect()
    assert (round(c.lon_mean, 9), round(c.lat_mean, 9)) == (0.5, 0.0)


def test_new_year_splits_by_changed_attributes_only(spark):
    rows = track([(i * 300, i * 0.3, 1.0) for i in range(24)], start="2023-12-31 23:00:00")
    span = dict(start="2023-12-31", end="2024-02-01")
    same = summary(spark, rows, [vessel(2023), vessel(2024)], **span).collect()
    assert [e.message_count for e in same] == [24] and len(same[0].geo_info) == 24
    renamed = summary(spark, rows, [vessel(2023, "OLD"), vessel(2024, "NEW")], **span).orderBy("event_end").collect()
    assert [(e.main_vessel_shipname, e.message_count, len(e.geo_info)) for e in renamed] == [("OLD", 12, 12), ("NEW", 12, 12)]
    assert renamed[0].event_start == renamed[1].event_start and renamed[0].event_id != renamed[1].event_id


def test_doubled_vessel_rows_double_the_messages(spark):
    (e,) = summary(spark, track(RUN), [vessel(), vessel()]).collect()
    assert e.message_count == 16 and len(e.geo_info) == 16 and e.event_distance_m == pytest.approx(4200)


def test_slices_of_a_long_event_are_put_in_order(spark):
    positions = messages(spark, track([(i * 3000, i * 0.1, 1.0) for i in range(40)])).select("ssvid", "seg_id", "timestamp", "lon", "lat").withColumns(
        {"event_id": F.lit("e"), "main_vessel_shipname": F.lit("n"), "main_vessel_flag": F.lit(None).cast("string"), "best_best_vessel_class": F.lit("c")}
    )
    (found,) = summarize.point_lists(positions, slice_seconds=7200).collect()
    lats = [g.point.lat for g in found.geo_info]
    assert lats == sorted(lats) and len(lats) == 40
    assert found.points_wkt.count(",") == 39


def test_segment_filters(spark):
    segs = spark.createDataFrame(
        [("a", True, 11, False), ("b", True, 10, False), ("c", False, 99, False), ("d", True, 99, True), ("e", True, None, False), ("a", True, 12, False)],
        SEGMENTS,
    )
    assert sorted(r.seg_id for r in identity.good_segments(segs, EventRules().min_segment_positions).collect()) == ["a", "a"]
    assert sorted(r.seg_id for r in identity.good_segments(segs).collect()) == ["a", "a", "b", "e"]


def test_best_vessel(spark):
    rows = [("a", "old", date(2023, 1, 1)), ("a", "y", date(2024, 1, 1)), ("a", "x", date(2024, 1, 1)), ("b", "n", None), ("b", "m", date(1999, 1, 1))]
    found = dict(map(tuple, identity.best_segment_vessel(spark.createDataFrame(rows, OWNERS)).collect()))
    assert found == {"a": "x", "b": "m"}


def test_fishing_vessel_rule_is_null_safe(spark):
    base = dict(zip([c.split()[0] for c in VESSELS.split(", ")], vessel()))

    def row(vessel_id, **changes):
        return tuple({**base, "vessel_id": vessel_id, "prod_shiptype": None, **changes}.values())

    rows = [
        row("type", prod_shiptype="fishing"),
        row("gear", registry_geartype="trawlers", shipname_indicates_likely_gear=False),
        row("list", on_fishing_list_nn=True, shipname_indicates_likely_gear=False),
        row("buoy", on_fishing_list_nn=True, shipname_indicates_likely_gear=True),
        row("unknown name", on_fishing_list_nn=True),
        row("nothing", shipname_indicates_likely_gear=False),
    ]
    found = identity.fishing_vessels(spark.createDataFrame(rows, VESSELS)).collect()
    assert sorted(r.vessel_id for r in found) == ["gear", "list", "type"]


def test_messages_carry_no_vessel_data_through_the_first_shuffle(spark):
    parts = summarize.summarize(sessionize(messages(spark, track(RUN)), "2024-01-01", "2024-02-01", "nnet_score"))
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(speed_knots" in plan and "collect_list" not in plan
    assert naive(at("2024-01-01 00:00:00")) == parts.first().event_start
