"""Coverings of regions by S2 cells, with cells apart that lie wholly inside.

A point in an inner cell is in the region whatever its exact place, so it
needs no geometry; only cells that an edge may touch do.  Inner cells are as
large as they come, and points meet them by the parents of their own cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.config import COVERING_LEVELS, S2_LEVEL
from seawake.functions.cells import cell_bounds, cell_children, s2_cell
from seawake.functions.geo import (
    bands_between,
    edge_meets_box,
    inside,
    longitude_band,
    ring_span,
)
from seawake.operators.regions import region_edges

#: Spacing of the points that find the first cells, and how far they go beyond a region: a cell of the
#: first level is between 0.8 and 1.7 degrees wide.
SPACING, MARGIN = 0.5, 2.0
SHAPE = ["layer", "id", "shape"]


def classed_cells(cells: DataFrame, regions: DataFrame, edges: str) -> DataFrame:
    """``layer``, ``id``, ``shape``, ``cell``, ``level``, ``inner`` of the cells that meet their region.

    ``cells`` has the same columns without ``inner``.  A cell is inner if no
    edge comes near it and its centre is inside, and left out if no edge comes
    near it and its centre is outside.  Boxes around cells are somewhat too
    large, which makes a cell a boundary cell for nothing now and then.
    """
    # as the output of a generator, a box is computed once and not again for each of its uses
    placed = cells.select("*", F.explode(F.array(cell_bounds(F.col("cell"), F.col("level")))).alias("box"))
    placed = placed.withColumn("band", F.explode(bands_between(F.col("box.west"), F.col("box.east"), edges)))
    near = placed.join(region_edges(regions, edges), [*SHAPE, "band"])
    box = F.col("box")
    met = F.exists("edges", lambda e: edge_meets_box(e, box, edges))
    centre = inside(box["lon"], box["lat"], F.col("edges"), F.col("pole"), edges, boundary=False)
    here = F.when(F.col("band") == longitude_band(box["lon"], edges), centre).otherwise(False)
    # around a pole, and where a plane map ends, boxes are not to be trusted
    odd = box["polar"] if edges == "spherical" else box["polar"] | (box["west"] <= -180) | (box["east"] >= 180)
    found = near.groupBy(*SHAPE, "cell", "level").agg(F.max(met | odd).alias("touched"), F.max(here).alias("within"))
    return found.filter("touched OR within").select(*SHAPE, "cell", "level", (~F.col("touched")).alias("inner"))


def _first_cells(regions: DataFrame, edges: str) -> DataFrame:
    """Cells of the first level around each region."""
    spans = regions.select("layer", "id", F.xxhash64("geo").alias("shape"), ring_span(F.col("geo"), edges).alias("span")).distinct()
    steps = [
        F.sequence(F.floor((F.col(f"span.{low}") - MARGIN) / SPACING), F.ceil((F.col(f"span.{high}") + MARGIN) / SPACING))
        for low, high in (("west", "east"), ("south", "north"))
    ]
    points = spans.select(*SHAPE, F.explode(steps[0]).alias("x"), steps[1].alias("ys")).select(*SHAPE, "x", F.explode("ys").alias("y"))
    lat = F.greatest(F.lit(-90.0), F.least(F.lit(90.0), F.col("y") * SPACING))
    return points.select(*SHAPE, s2_cell(F.col("x") * SPACING, lat, COVERING_LEVELS[0]).alias("cell")).distinct().withColumn("level", F.lit(COVERING_LEVELS[0]))


def covering(regions: DataFrame, edges: str = "spherical") -> DataFrame:
    """All cells of the regions' polygons, from coarse inner cells to boundary cells of the point level.

    The result is used once for each set of regions: store it, or what
    :func:`covered` makes of it.
    """
    cells, kept = _first_cells(regions, edges), None
    for n, level in enumerate(COVERING_LEVELS):
        found = classed_cells(cells, regions, edges)
        if level == COVERING_LEVELS[-1]:
            return found if kept is None else kept.unionByName(found)
        # each level is read twice and is the base of the next
        found = found.checkpoint()
        inner = found.filter("inner")
        kept = inner if kept is None else kept.unionByName(inner)
        children = F.explode(cell_children(F.col("cell"), level, COVERING_LEVELS[n + 1])).alias("cell")
        cells = found.filter("NOT inner").select(*SHAPE, children).withColumn("level", F.lit(COVERING_LEVELS[n + 1]))
    return kept


def covered(regions: DataFrame, cells: DataFrame) -> DataFrame:
    """Regions with ``s2_cells`` (boundary cells) and ``inner_cells`` taken from a table of classed cells."""
    lists = cells.groupBy(*SHAPE).agg(
        F.collect_list(F.when(~F.col("inner"), F.col("cell"))).alias("s2_cells"), F.collect_list(F.when(F.col("inner"), F.col("cell"))).alias("inner_cells")
    )
    kept = regions.drop("s2_cells", "inner_cells").withColumn("shape", F.xxhash64("geo")).dropDuplicates(SHAPE)
    return kept.join(lists, SHAPE).drop("shape")


def classed_regions(regions: DataFrame, edges: str = "spherical") -> DataFrame:
    """Regions that bring their own cells of the point level, with those apart that lie inside."""
    cells = regions.select("layer", "id", F.xxhash64("geo").alias("shape"), F.explode("s2_cells").alias("cell")).distinct()
    return covered(regions, classed_cells(cells.withColumn("level", F.lit(S2_LEVEL)), regions, edges))


def covered_regions(regions: DataFrame, edges: str = "spherical") -> DataFrame:
    """Regions with cells made from their polygons; polygons may be given without any."""
    return covered(regions, covering(regions, edges))
