import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from seawake.functions.cells import s2_cell
from seawake.functions.documents import first_vessel_field, json_string_or_null, json_text
from seawake.functions.geo import anti_lon, dateline_bbox, distance_m, point, point_in
from seawake.functions.scalars import (
    event_id,
    filter_invalid_ssvid,
    float_text,
    gridcode,
    is_whitelisted_rfmo,
    nfc,
    null_key,
    overlaps,
    port_event_rank,
    port_id,
    seconds_between,
    timestamp_text,
)


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_ssvid_of_64_characters_is_hidden(spark):
    assert value(spark, filter_invalid_ssvid(F.lit("x" * 64))) is None
    assert value(spark, filter_invalid_ssvid(F.lit("123456789"))) == "123456789"
    assert value(spark, filter_invalid_ssvid(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("lon, opposite", [(90, -90), (-90, 90), (1, -179), (-179, 1), (0, -180)])
def test_anti_lon(spark, lon, opposite):
    assert value(spark, anti_lon(F.lit(float(lon)))) == opposite


def test_gridcode_floors_decimals(spark):
    assert value(spark, gridcode(F.lit(-0.001), F.lit(0.0))) == "lon:-000.01_lat:+000.00"
    assert value(spark, gridcode(F.lit(-179.995), F.lit(-0.005))) == "lon:-180.00_lat:-000.01"
    assert value(spark, gridcode(F.lit(10.29), F.lit(12.345))) == "lon:+010.29_lat:+012.34"
    assert value(spark, gridcode(F.lit(None).cast("double"), F.lit(1.0))) is None


def test_event_id_text_and_null(spark):
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-01 00:00:00", "2024-01-01 01:00:00.5"))
    assert value(spark, timestamp_text(start)) == "2024-01-01 00:00:00+00"
    assert value(spark, timestamp_text(end)) == "2024-01-01 01:00:00.500+00"
    text = "fishing|v|2024-01-01 00:00:00+00|2024-01-01 01:00:00.500+00"
    assert value(spark, event_id("fishing", F.lit("v"), start, end)) == value(spark, F.md5(F.lit(text)))
    assert value(spark, event_id("fishing", F.lit(None).cast("string"), start, end)) is None


def test_seconds_are_whole(spark):
    a, b = F.lit("2024-01-01 00:00:00.9").cast("timestamp"), F.lit("2024-01-01 01:00:01.1").cast("timestamp")
    assert value(spark, seconds_between(a, b)) == 3600


def test_port_helpers(spark):
    assert value(spark, port_event_rank(F.lit("PORT_STOP_BEGIN"))) == 1
    assert value(spark, port_event_rank(F.lit("PORT_GAP_END"))) == 4
    assert value(spark, port_event_rank(F.lit("OTHER"))) is None
    decomposed = "Coruña Bay"
    assert value(spark, port_id(F.lit("ESP"), nfc(F.lit(decomposed)))) == "esp-coruñabay"


def test_predicates(spark):
    assert value(spark, is_whitelisted_rfmo(F.lit("NPFC")))
    assert not value(spark, is_whitelisted_rfmo(F.lit("NAFO")))
    assert value(spark, null_key(F.lit(None).cast("string"))) == "NULL"
    assert value(spark, overlaps(F.lit(1), F.lit(3), F.lit(2), F.lit(5)))
    assert not value(spark, overlaps(F.lit(1), F.lit(2), F.lit(2), F.lit(5)))


def test_json(spark):
    struct = F.struct(F.lit(None).cast("string").alias("a"), F.lit(1.5).alias("b"))
    assert value(spark, json_text(struct)) == '{"a":null,"b":1.5}'
    path = "$.intermediate_anchorage.id"
    assert value(spark, json_string_or_null(F.lit('{"intermediate_anchorage":{"id":"x"}}'), path)) == "x"
    for text in ('{"intermediate_anchorage":{"id":5}}', '{"intermediate_anchorage":{"id":null}}', "{}", "no json"):
        assert value(spark, json_string_or_null(F.lit(text), path)) is None
    assert value(spark, first_vessel_field(F.lit('[{"type":"fishing"},{"type":"x"}]'), "type")) == "fishing"


def test_point_and_distance(spark):
    assert value(spark, point(F.lit(1.0), F.lit(91.0))) is None
    assert tuple(value(spark, point(F.lit(1.0), F.lit(2.0)))) == (1.0, 2.0)
    quarter = value(spark, distance_m(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)))
    assert quarter == pytest.approx(6371010 * math.pi / 2)
    assert value(spark, distance_m(F.lit(179.9), F.lit(0.0), F.lit(-179.9), F.lit(0.0))) == pytest.approx(22239, abs=1)


def test_dateline_box(spark):
    lons = spark.createDataFrame([(x,) for x in (179.5, 179.9, -179.9, -179.2)], "lon double")
    bounds = lons.agg(
        F.min("lon").alias("a"), F.max("lon").alias("b"), F.min(anti_lon(F.col("lon"))).alias("c"), F.max(anti_lon(F.col("lon"))).alias("d")
    )
    west, east = dateline_bbox(*[F.col(c) for c in "abcd"])
    row = bounds.select(west.alias("w"), east.alias("e")).first()
    assert (round(row.w, 9), round(row.e, 9)) == (-179.2, 179.5)


# public S2 cell definition: lat, lon, level-10 id
CELLS = [
    (49.703498679, 11.770681595, 5161629848803737600),
    (55.685376759, 12.588490937, 5067203790210334720),
    (45.486546517, -93.449700022, 5959118826569203712),
    (34.364439040, 108.330699969, 3919241083044757504),
    (-25.285264027, 133.823116966, 3110858144071286784),
    (-75.000000031, 0.000000133, -5720135576225579008),
    (-24.694439215, -47.537363213, -7720679390777966592),
]


def test_s2_cells(spark):
    df = spark.createDataFrame(CELLS, "lat double, lon double, want long")
    assert df.filter(s2_cell(F.col("lon"), F.col("lat")) != F.col("want")).count() == 0
    assert value(spark, s2_cell(F.lit(None).cast("double"), F.lit(1.0))) is None


SQUARE = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]]
ACROSS = [[(175.0, -5.0), (-175.0, -5.0), (-175.0, 5.0), (175.0, 5.0)]]
RINGS = "array<array<struct<lon:double,lat:double>>>"


@pytest.mark.parametrize("edges", ["planar", "spherical"])
def test_polygon_with_hole_and_boundary(spark, edges):
    cases = [
        (5.0, 2.0, True, True),
        (5.0, 5.0, False, False),  # in the hole
        (0.0, 5.0, True, False),  # on an edge
        (10.0, 10.0, True, False),  # on a vertex
        (11.0, 5.0, False, False),
        (-175.0, -5.0, False, False),  # antipode of an inner point
    ]
    df = spark.createDataFrame([(SQUARE, *c) for c in cases], f"rings {RINGS}, lon double, lat double, incl boolean, excl boolean")
    wrong = df.filter(
        (point_in(F.col("lon"), F.col("lat"), F.col("rings"), edges, True) != F.col("incl"))
        | (point_in(F.col("lon"), F.col("lat"), F.col("rings"), edges, False) != F.col("excl"))
    )
    assert wrong.count() == 0


def test_spherical_polygon_crosses_the_dateline(spark):
    df = spark.createDataFrame([(ACROSS, x) for x in (179.0, -179.0, 170.0, 0.0)], f"rings {RINGS}, lon double")
    inside = df.filter(point_in(F.col("lon"), F.lit(1.0), F.col("rings"), "spherical", True))
    assert sorted(r.lon for r in inside.collect()) == [-179.0, 179.0]


def test_geodesic_edges_bulge_poleward(spark):
    box = [[(0.0, 40.0), (60.0, 40.0), (60.0, 50.0), (0.0, 50.0)]]
    df = spark.createDataFrame([(box, 30.0, 51.0), (box, 30.0, 41.0)], f"rings {RINGS}, lon double, lat double")
    got = df.select(point_in(F.col("lon"), F.col("lat"), F.col("rings"), "spherical", True)).collect()
    assert [r[0] for r in got] == [True, False]


def test_polygons_around_the_poles(spark):
    def cap(lat):
        return [[(float(x), lat) for x in range(-180, 180, 30)]]

    cases = [(cap(70.0), 80.0, True), (cap(70.0), 60.0, False), (cap(-70.0), -80.0, True), (cap(-70.0), 60.0, False)]
    df = spark.createDataFrame(cases, f"rings {RINGS}, lat double, want boolean")
    wrong = df.filter(point_in(F.lit(12.5), F.col("lat"), F.col("rings"), "spherical", True) != F.col("want"))
    assert wrong.count() == 0


def test_utc_session(spark):
    assert value(spark, F.lit("2024-01-01 00:00:00+00").cast("timestamp").cast("timestamp_ntz")) == datetime(2024, 1, 1)


def test_regions_across_the_dateline_keep_their_meridian(spark):
    """180, -180 and 181 degrees lie in a box from 175 to -175, in both modes."""
    from seawake.operators.regions import match_regions, match_regions_of_places, with_cell

    box = [[(175.0, -10.0), (-175.0, -10.0), (-175.0, 10.0), (175.0, 10.0)]]
    points = [("a", 180.0, 1.0), ("b", -180.0, 1.0), ("c", 179.99, 1.0), ("d", 181.0, 1.0), ("e", 170.0, 1.0), ("f", -184.0, 1.0)]
    df = with_cell(spark.createDataFrame(points, "event_id string, lon double, lat double"))
    cells = [r[0] for r in df.select("cell").distinct().collect()]
    schema = "layer string, id string, geo array<array<struct<lon: double, lat: double>>>, s2_cells array<long>"
    regions = spark.createDataFrame([("eez", "1", box, cells)], schema)
    for mode in ("within", "intersects"):
        assert {r["event_id"] for r in match_regions(df, regions, mode).collect()} == set("abcd") | {"f"}
        assert {r["event_id"] for r in match_regions_of_places(df, regions, mode).collect()} == set("abcd") | {"f"}


def test_number_text_keeps_every_digit(spark):
    """Texts read back as the same doubles, without exponents or needless zeros."""
    numbers = spark.range(3000).select(((F.rand(1) - 0.5) * F.pow(F.lit(10.0), (F.col("id") % 9) - 4.0)).alias("x"))
    numbers = numbers.unionByName(spark.createDataFrame([(x,) for x in (0.0, 10.0, -180.0, 1e-5, 0.1, 1e-9, 100.0, 1234567.5)], "x double")).checkpoint()
    texts = numbers.select("x", float_text(F.col("x")).alias("t")).checkpoint()
    assert texts.filter(~F.col("t").rlike(r"^-?[0-9]+(\.[0-9]*[1-9])?$") | (F.col("t").cast("double") != F.col("x"))).isEmpty()
    assert [value(spark, float_text(F.lit(x))) for x in (10.0, -0.5, 1e-5, None)] == ["10", "-0.5", "0.00001", None]
