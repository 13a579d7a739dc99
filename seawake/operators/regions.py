"""Which maritime regions contain an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.config import COVERING_LEVELS, REGION_LAYERS
from seawake.functions.cells import cell_parent, s2_cell
from seawake.functions.geo import bands_spanned, edge_list, holds_north_pole, inside, longitude_band
from seawake.functions.scalars import gridcode, m_to_km


def grid_regions(regions: DataFrame) -> DataFrame:
    """One row per region and cell, without the geometry."""
    return regions.select("layer", "id", F.xxhash64("geo").alias("shape"), F.explode("s2_cells").alias("cell"))


def with_cell(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add the join key of the region lookup; 0, which is no cell, for a missing point.

    A key that is never null keeps the join from filtering on it, which would
    compute the cell a second time.
    """
    return points.withColumn("cell", F.coalesce(s2_cell(F.col(lon), F.col(lat)), F.lit(0).cast("long")))


def region_edges(regions: DataFrame, edges: str) -> DataFrame:
    """Per region and longitude band, the polygon edges that touch the band.

    A detailed coast has many thousand edges; a point is tested against the few
    of its band, and the points of a vast region spread over its bands.
    """
    return (
        regions.select(
            "layer",
            "id",
            F.xxhash64("geo").alias("shape"),
            holds_north_pole(F.col("geo"), edges).alias("pole"),
            F.explode(edge_list(F.col("geo"), edges)).alias("edge"),
        )
        .withColumn("band", F.explode(bands_spanned(F.col("edge"), edges)))
        .groupBy("layer", "id", "shape", "pole", "band")
        # a region row that is repeated must not repeat its edges
        .agg(F.collect_set("edge").alias("edges"))
    )


def match_regions(points: DataFrame, regions: DataFrame, mode: str, edges: str = "spherical") -> DataFrame:
    """Distinct ``(event_id, layer, id)`` of regions that hold a point of the event.

    ``points`` has event_id, lon, lat and cell.  ``mode`` is ``within``
    (boundary excluded) or ``intersects`` (included).  Equal cells give the
    candidates, without any geometry; they meet the edges of their band.
    Regions with ``inner_cells`` (:mod:`seawake.operators.coverings`) have
    boundary cells only as ``s2_cells``; in inner cells, distinct cells of the
    events answer without geometry.
    """
    if mode not in ("within", "intersects"):
        raise ValueError(f"mode must be within or intersects, not {mode!r}")
    candidates = (
        points.select("event_id", "lon", "lat", "cell")
        .join(grid_regions(regions), "cell")
        .withColumn("band", longitude_band(F.col("lon"), edges))
        .drop("cell")
    )
    held = inside(
        F.col("lon"), F.col("lat"), F.col("edges"), F.col("pole"), edges, boundary=mode == "intersects"
    )
    found = (
        candidates.join(region_edges(regions, edges), ["layer", "id", "shape", "band"])
        .filter(held)
        .select("event_id", "layer", "id")
    )
    if "inner_cells" in regions.columns:
        found = found.unionByName(inner_matches(points, regions))
    return found.distinct()


def inner_matches(points: DataFrame, regions: DataFrame) -> DataFrame:
    """``(event_id, layer, id)`` by the inner cells of any level that hold a point's cell."""
    parents = F.array(*[cell_parent(F.col("cell"), level) for level in COVERING_LEVELS])
    # events stay in few cells: their distinct cells are far fewer than their points
    places = points.filter("cell <> 0").select("event_id", "cell").distinct().select("event_id", F.explode(parents).alias("cell"))
    cells = regions.select("layer", "id", F.explode("inner_cells").alias("cell"))
    return places.join(cells, "cell").select("event_id", "layer", "id")


def match_regions_of_places(points: DataFrame, regions: DataFrame, mode: str, edges: str = "spherical") -> DataFrame:
    """As :func:`match_regions` for events that share positions: each position is looked up once.

    ``points`` has event_id, lon and lat; its cells are computed here.
    """
    place = F.concat_ws(" ", F.col("lon").cast("string"), F.col("lat").cast("string"))
    known = points.select("event_id", "lon", "lat").filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    places = with_cell(known.select("lon", "lat").distinct().select(place.alias("event_id"), "lon", "lat"))
    found = match_regions(places, regions, mode, edges).withColumnRenamed("event_id", "place")
    return known.select("event_id", place.alias("place")).join(found, "place").select("event_id", "layer", "id").distinct()


def regions_struct(matches: DataFrame) -> DataFrame:
    """Per event the sorted ids of every layer; a layer without match is an empty array."""
    # one small set per event; a set per layer would carry a dozen empty ones through the shuffle
    found = matches.groupBy("event_id").agg(F.sort_array(F.collect_set(F.struct("layer", "id"))).alias("found"))

    def ids(layer: str) -> Column:
        return F.transform(F.filter("found", lambda r: r["layer"] == layer), lambda r: r["id"]).alias(layer)

    return found.select("event_id", F.struct(*[ids(x) for x in REGION_LAYERS]).alias("regions_mean_position"))


def with_distances(events: DataFrame, measures: DataFrame, lon: Column, lat: Column, side: str) -> DataFrame:
    """Distances in km from shore and port of the 0.01 degree cell at lon, lat.

    Events without a measured cell are dropped.
    """
    lookup = measures.select(
        F.col("gridcode").alias("__gridcode"),
        m_to_km(F.col("distance_from_shore_m")).alias(f"{side}_distance_from_shore_km"),
        m_to_km(F.col("distance_from_port_m")).alias(f"{side}_distance_from_port_km"),
    )
    return (
        events.withColumn("__code", gridcode(lon, lat))
        .join(lookup, F.col("__code") == F.col("__gridcode"))
        .drop("__code", "__gridcode")
    )
