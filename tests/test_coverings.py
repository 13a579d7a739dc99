"""Coverings with inner and boundary cells against plain geometry."""

import pytest
from pyspark.sql import functions as F

from seawake.functions.cells import cell_bounds, cell_children, cell_parent, s2_cell
from seawake.functions.geo import eastward, point_in
from seawake.operators.coverings import classed_regions, covered_regions
from seawake.operators.regions import match_regions, with_cell

REGIONS = "layer string, id string, geo array<array<struct<lon: double, lat: double>>>"


def box(west, south, east, north):
    return [[(west, south), (east, south), (east, north), (west, north)]]


SHAPES = [
    ("eez", "dateline", box(178.0, -2.0, -177.5, 1.5)),
    ("eez", "hole", [[(0.0, 0.0), (6.0, 1.5), (3.5, 5.5)], [(2.5, 2.0), (3.5, 2.0), (3.0, 3.0)]]),
    ("mpa", "north", box(-1.1, 60.2, 3.3, 61.7)),
    ("rfmo", "small", box(2.0, 2.0, 2.02, 2.03)),
]


def places(spark, n):
    """Points around the shapes and all over the globe."""
    def between(low, high, seed):
        return F.rand(seed) * (high - low) + low

    kind = F.col("id") % 5
    lon = F.when(kind == 0, between(-180, 180, 1)).when(kind == 1, between(-2, 7, 2)).when(kind == 2, between(1.95, 2.1, 3))
    lon = lon.when(kind == 3, between(-2, 5, 4)).otherwise(between(-4, 4, 5) + F.when(F.col("id") % 2 == 0, 180).otherwise(-180))
    lat = F.when(kind == 0, between(-90, 90, 6)).when(kind == 1, between(-1, 6, 7)).when(kind == 2, between(1.95, 2.1, 8))
    lat = lat.when(kind == 3, between(60, 63, 9)).otherwise(between(-3, 3, 10))
    return with_cell(spark.range(n).select(F.col("id").cast("string").alias("event_id"), lon.alias("lon"), lat.alias("lat"))).checkpoint()


def test_boxes_hold_their_cells_and_levels_are_nested(spark):
    points = spark.range(1500).select((F.rand(1) * 360 - 180).alias("lon"), F.degrees(F.asin(F.rand(2) * 2 - 1)).alias("lat")).checkpoint()
    cell = s2_cell(F.col("lon"), F.col("lat"))
    nested = [cell_parent(cell, level) == s2_cell(F.col("lon"), F.col("lat"), level) for level in (6, 8, 10)]
    nested.append(F.array_contains(cell_children(cell_parent(cell, 6), 6, 8), cell_parent(cell, 8)))
    assert points.select(*[n.alias(f"n{i}") for i, n in enumerate(nested)]).checkpoint().filter("NOT (n0 AND n1 AND n2 AND n3)").isEmpty()
    for level in (6, 10):
        bounds = points.withColumn("cell", s2_cell(F.col("lon"), F.col("lat"), level)).checkpoint()
        bounds = bounds.withColumn("b", cell_bounds(F.col("cell"), F.lit(level))).checkpoint()
        off = eastward(F.col("lon") - F.col("b.lon"), "spherical")
        held = (off >= F.col("b.west") - F.col("b.lon")) & (off <= F.col("b.east") - F.col("b.lon")) & F.col("lat").between(F.col("b.south"), F.col("b.north"))
        centre = s2_cell(F.col("b.lon"), F.col("b.lat"), level) == F.col("cell")
        assert bounds.filter(~(centre & (held | F.col("b.polar")))).isEmpty()


@pytest.mark.parametrize("edges", ["spherical", "planar"])
def test_coverings_answer_as_the_polygons_do(spark, edges):
    shapes = SHAPES if edges == "spherical" else SHAPES[1:]
    # a region row that is repeated, and one of another shape under the same id
    regions = spark.createDataFrame([*shapes, SHAPES[3], ("rfmo", "small", box(4.0, 0.1, 4.4, 0.4))], REGIONS)
    covered = covered_regions(regions, edges).checkpoint()
    assert covered.filter(F.size("inner_cells") > 100).count() >= 2
    points = places(spark, 4000)
    own = regions.withColumn("s2_cells", F.lit(None).cast("array<long>"))
    cells = points.join(regions.distinct(), point_in(F.col("lon"), F.col("lat"), F.col("geo"), edges, True)).select("layer", "id", "geo", "cell")
    listed = own.drop("s2_cells").join(cells.groupBy("layer", "id", "geo").agg(F.collect_set("cell").alias("s2_cells")), ["layer", "id", "geo"])
    classed = classed_regions(listed, edges).checkpoint()
    for mode in ("within", "intersects"):
        holds = point_in(F.col("lon"), F.col("lat"), F.col("geo"), edges, mode == "intersects")
        want = points.join(regions, holds).select("event_id", "layer", "id").distinct().checkpoint()
        assert want.count() > 250
        for found in (match_regions(points, covered, mode, edges), match_regions(points, classed, mode, edges)):
            assert want.exceptAll(found).isEmpty() and found.exceptAll(want).isEmpty()


def test_inner_cells_need_no_geometry(spark):
    regions = spark.createDataFrame([(*SHAPES[3], [11], [22])], f"{REGIONS}, s2_cells array<long>, inner_cells array<long>")
    points = spark.createDataFrame([("a", 2.0, 2.0, 11)], "event_id string, lon double, lat double, cell long")
    plan = match_regions(points, regions, "within")._jdf.queryExecution().optimizedPlan().toString()
    # edges are taken apart once, for the boundary cells; the branch of inner cells reads no shape
    assert plan.count("collect_set(edge") == 1
    assert "edge" in plan.split("explode(s2_cells")[1].split("explode(inner_cells")[0]
    assert "geo" not in [x for x in plan.split("Join") if "explode(inner_cells" in x][0].split("explode(inner_cells")[0]
