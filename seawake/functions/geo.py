"""Geography as column arithmetic on a sphere; longitudes and latitudes in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seawake.config import EARTH_RADIUS_M

# A point this close to a geodesic edge (in terms of tangents) lies on it.
TOUCH_TOLERANCE = 1e-12
BANDS_PER_DEGREE = 10


def point(lon: Column, lat: Column) -> Column:
    """Struct of lon and lat; null if either is missing or the latitude is impossible."""
    return F.when(
        lon.isNotNull() & (F.abs(lat) <= 90), F.struct(lon.alias("lon"), lat.alias("lat"))
    )


def distance_m(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def unit_vector(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    lam, phi = F.radians(lon), F.radians(lat)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def vector_lon(x: Column, y: Column) -> Column:
    return F.degrees(F.atan2(y, x))


def vector_lat(x: Column, y: Column, z: Column) -> Column:
    return F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))


def anti_lon(lon: Column) -> Column:
    """The opposite meridian; applied twice it gives the longitude back (but 0 gives -180)."""
    return F.when(lon < 0, lon + 180.0).otherwise(lon - 180.0)


def dateline_bbox(
    lon_min: Column, lon_max: Column, anti_min: Column, anti_max: Column
) -> tuple[Column, Column]:
    """West and east bound over the shorter way round, from bounds of lon and of anti_lon."""
    direct = (lon_max - lon_min) <= (anti_max - anti_min)
    return (
        F.when(direct, lon_min).otherwise(anti_lon(anti_max)),
        F.when(direct, lon_max).otherwise(anti_lon(anti_min)),
    )


# A point is inside a polygon if the meridian from it to the north pole crosses the
# boundary an odd number of times, or an even number if the polygon holds that pole.
# Only edges that span the point's longitude matter, so edges can be found by longitude.


def _check(edges: str) -> None:
    if edges not in ("planar", "spherical"):
        raise ValueError(f"edges must be planar or spherical, not {edges!r}")


def eastward(degrees: Column, edges: str) -> Column:
    """A difference of longitudes, by the shorter way round on the sphere."""
    return degrees if edges == "planar" else degrees - 360.0 * F.floor((degrees + 180.0) / 360.0)


def edge_list(rings: Column, edges: str) -> Column:
    """All edges of all rings: start, signed width in longitude, and end latitude."""
    _check(edges)

    def of_ring(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.named_struct(
                F.lit("lon"),
                a["lon"],
                F.lit("lat"),
                a["lat"],
                F.lit("width"),
                eastward(b["lon"] - a["lon"], edges),
                F.lit("end_lat"),
                b["lat"],
            ),
        )

    return F.flatten(F.transform(rings, of_ring))


def holds_north_pole(rings: Column, edges: str) -> Column:
    """Does a ring go round the north pole?  Polygons are smaller than a hemisphere."""
    if edges == "planar":
        return F.lit(False)

    def total(ring: Column, part: str) -> Column:
        return F.aggregate(edge_list(F.array(ring), edges), F.lit(0.0), lambda acc, e: acc + e[part])

    around = F.filter(rings, lambda r: (F.abs(total(r, "width")) > 180) & (total(r, "lat") > 0))
    return F.size(around) % 2 == 1


def inside(lon: Column, lat: Column, edge_array: Column, pole: Column, edges: str, boundary: bool) -> Column:
    """Is the point inside?  ``edge_array`` has at least the edges that span its longitude."""
    _check(edges)

    def height_over(e: Column, off: Column) -> Column:
        """Positive where the edge passes north of the point (times the sign of its width)."""
        if edges == "planar":
            return (e["end_lat"] - e["lat"]) * off - (lat - e["lat"]) * e["width"]
        start, end, here = (F.tan(F.radians(x)) for x in (e["lat"], e["end_lat"], lat))
        width, part = F.radians(e["width"]), F.radians(off)
        return start * F.sin(width - part) + end * F.sin(part) - here * F.sin(width)

    def crosses(e: Column) -> Column:
        off = eastward(lon - e["lon"], edges)
        # half open, so that a vertex belongs to one of its two edges
        east, west = (off >= 0) & (off < e["width"]), (off >= e["width"]) & (off < 0)
        return (east & (height_over(e, off) > 0)) | (west & (height_over(e, off) < 0))

    def touches(e: Column) -> Column:
        off = eastward(lon - e["lon"], edges)
        low, high = F.least(e["lat"], e["end_lat"]), F.greatest(e["lat"], e["end_lat"])
        spanned = ((off >= 0) & (off <= e["width"])) | ((off <= 0) & (off >= e["width"]))
        upright = (e["width"] != 0) | lat.between(low, high)
        return spanned & upright & (F.abs(height_over(e, off)) <= (0.0 if edges == "planar" else TOUCH_TOLERANCE))

    odd = F.size(F.filter(edge_array, crosses)) % 2 == 1
    touched = F.exists(edge_array, touches)
    return (touched | (odd != pole)) if boundary else ((odd != pole) & ~touched)


def point_in(lon: Column, lat: Column, rings: Column, edges: str, boundary: bool) -> Column:
    """Is the point inside a polygon given as rings (holes are further rings)?

    ``edges`` is ``planar`` (straight in lon/lat) or ``spherical`` (geodesics;
    polygons smaller than a hemisphere).  ``boundary`` says whether points on
    an edge or vertex count as inside.
    """
    return inside(lon, lat, edge_list(rings, edges), holds_north_pole(rings, edges), edges, boundary)


def _band(lon: Column) -> Column:
    return F.floor(lon * BANDS_PER_DEGREE)


def _once_around(band: Column) -> Column:
    """The same band in [-180, 180) degrees: on a sphere, 180 and -180 are one meridian."""
    turn = 360 * BANDS_PER_DEGREE
    return F.pmod(band + turn // 2, F.lit(turn)) - turn // 2


def longitude_band(lon: Column, edges: str) -> Column:
    """Longitude band of a point."""
    return _band(lon) if edges == "planar" else _once_around(_band(lon))


def bands_spanned(edge: Column, edges: str) -> Column:
    """Longitude bands an edge touches, numbered as those of points."""
    first = _band(F.least(edge["lon"], edge["lon"] + edge["width"]))
    last = _band(F.greatest(edge["lon"], edge["lon"] + edge["width"]))
    # one more on either side, against rounding of the edge's far end
    bands = F.sequence(first - 1, last + 1)
    return bands if edges == "planar" else F.array_distinct(F.transform(bands, _once_around))


def bands_between(west: Column, east: Column, edges: str) -> Column:
    """Longitude bands from west to east (not below west, also beyond 180 degrees)."""
    bands = F.sequence(_band(west), _band(east))
    return bands if edges == "planar" else F.array_distinct(F.transform(bands, _once_around))


def edge_meets_box(e: Column, box: Column, edges: str) -> Column:
    """May the edge touch the box (west, east, south, north, and lon of its middle)?

    The edge's latitude is taken where it enters and leaves the box's range of
    longitudes; between the two it stays within the margin that boxes have.
    """
    _check(edges)
    middle = eastward(box["lon"] - e["lon"], edges)
    low = F.greatest(middle + (box["west"] - box["lon"]), F.least(F.lit(0.0), e["width"]))
    high = F.least(middle + (box["east"] - box["lon"]), F.greatest(F.lit(0.0), e["width"]))
    upright = F.abs(e["width"]) < 1e-9

    def lat(off: Column) -> Column:
        if edges == "planar":
            return e["lat"] + (e["end_lat"] - e["lat"]) * off / e["width"]
        start, end = F.tan(F.radians(e["lat"])), F.tan(F.radians(e["end_lat"]))
        width, part = F.radians(e["width"]), F.radians(off)
        return F.degrees(F.atan((start * F.sin(width - part) + end * F.sin(part)) / F.sin(width)))

    one, two = F.when(upright, e["lat"]).otherwise(lat(low)), F.when(upright, e["end_lat"]).otherwise(lat(high))
    return (low <= high) & (F.least(one, two) <= box["north"]) & (F.greatest(one, two) >= box["south"])


def ring_span(rings: Column, edges: str) -> Column:
    """west, east, south and north around all rings, up to the pole and all around for a ring that goes round one."""

    def of_ring(ring: Column) -> Column:
        first = ring[0]
        start = F.struct(*[first["lon"].alias(n) for n in ("at", "west", "east")])
        span = F.aggregate(
            edge_list(F.array(ring), edges),
            start,
            lambda acc, e: F.struct(
                (acc["at"] + e["width"]).alias("at"),
                F.least(acc["west"], acc["at"] + e["width"]).alias("west"),
                F.greatest(acc["east"], acc["at"] + e["width"]).alias("east"),
            ),
        )
        around = F.abs(span["at"] - first["lon"]) > 180 if edges == "spherical" else F.lit(False)
        lats = F.transform(ring, lambda p: p["lat"])
        low, high = F.array_min(lats), F.array_max(lats)
        # a geodesic of up to this width may pass its ends by so much
        bulge = F.lit(0.0) if edges == "planar" else F.least(F.lit(30.0), (span["east"] - span["west"]) ** 2 / 400)
        return F.struct(
            F.when(around, -180.0).otherwise(span["west"]).alias("west"),
            F.when(around, 180.0).otherwise(span["east"]).alias("east"),
            F.when(around & (low + high < 0), -90.0).otherwise(F.greatest(F.lit(-90.0), low - bulge)).alias("south"),
            F.when(around & (low + high >= 0), 90.0).otherwise(F.least(F.lit(90.0), high + bulge)).alias("north"),
        )

    spans = F.transform(rings, of_ring)

    def part(name: str) -> Column:
        return F.transform(spans, lambda s: s[name])

    return F.struct(
        F.array_min(part("west")).alias("west"),
        F.array_max(part("east")).alias("east"),
        F.array_min(part("south")).alias("south"),
        F.array_max(part("north")).alias("north"),
    )
