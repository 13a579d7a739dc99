"""S2 cell ids as a native expression.

A point is projected on the face of a cube, its two face coordinates are cut
into ``level`` bits each, and the bit pairs are read along a Hilbert curve.
Intermediate results are bound to lambda variables: written out as one plain
expression they would be repeated hundreds of times in the generated code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from seawake.config import S2_LEVEL
from seawake.functions.geo import eastward, unit_vector, vector_lat, vector_lon

LEAF_LEVEL = 30
SWAPPED, INVERTED = 1, 2


def hilbert_steps() -> list[int]:
    """For ``orientation * 4 + (i << 1 | j)``: ``position * 4 + next orientation``.

    The curve visits the quadrants (0,0) (0,1) (1,1) (1,0); a swapped curve
    exchanges i and j, an inverted one runs from the opposite corner.  The
    first quadrant swaps, the last one swaps and inverts.
    """
    turns = [SWAPPED, 0, 0, SWAPPED | INVERTED]
    table = [0] * 16
    for orientation in range(4):
        for position, (i, j) in enumerate([(0, 0), (0, 1), (1, 1), (1, 0)]):
            if orientation & SWAPPED:
                i, j = j, i
            if orientation & INVERTED:
                i, j = 1 - i, 1 - j
            table[orientation * 4 + 2 * i + j] = position * 4 + (orientation ^ turns[position])
    return table


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it many times in body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cube_face(p: Column) -> Column:
    """Face 0-5 of a vector: its longest axis, plus 3 if it points the negative way."""
    ax, ay, az = F.abs(p["x"]), F.abs(p["y"]), F.abs(p["z"])
    return (
        F.when((ax >= ay) & (ax >= az), F.when(p["x"] < 0, 3).otherwise(0))
        .when(ay >= az, F.when(p["y"] < 0, 4).otherwise(1))
        .otherwise(F.when(p["z"] < 0, 5).otherwise(2))
    )


def _face_coordinates(p: Column, face: Column) -> tuple[Column, Column]:
    """The two coordinates on the face, in [-1, 1]."""
    x, y, z = p["x"], p["y"], p["z"]
    across = [y / x, -x / y, -x / z, z / x, z / y, -y / z]
    along = [z / x, z / y, -y / z, y / x, -x / y, -x / z]

    def pick(options: list[Column]) -> Column:
        chain = F.when(face == 0, options[0])
        for number in range(1, 6):
            chain = chain.when(face == number, options[number])
        return chain

    return pick(across), pick(along)


def _cut(coordinate: Column, level: int) -> Column:
    """Quadratic area correction, then an index in [0, 2**level)."""
    root = F.sqrt(1 + 3 * F.abs(coordinate)) / 2
    stretched = F.when(coordinate >= 0, root).otherwise(1 - root)
    top = (1 << level) - 1
    return F.greatest(F.lit(0), F.least(F.lit(top), F.floor(stretched * (1 << level)))).cast("int")


def s2_cell(lon: Column, lat: Column, level: int = S2_LEVEL) -> Column:
    """Signed 64-bit id of the S2 cell that holds the point; null for a null point."""
    table = F.lit(hilbert_steps())
    bits = F.lit(list(range(level - 1, -1, -1)))
    low = 2 * (LEAF_LEVEL - level)

    def curve(ij: Column, face: Column) -> Column:
        # the accumulator holds the position read so far, then two bits of orientation
        def read_bit(acc: Column, bit: Column) -> Column:
            quadrant = F.getbit(ij["i"], bit) * 2 + F.getbit(ij["j"], bit)
            step = F.get(table, (acc.bitwiseAND(F.lit(3)) * 4 + quadrant).cast("int"))
            return F.shiftleft(F.shiftright(acc, 2), 4).bitwiseOR(step.cast("long"))

        start = face.bitwiseAND(F.lit(SWAPPED)).cast("long")
        return F.aggregate(bits, start, read_bit, lambda acc: F.shiftright(acc, 2))

    def on_face(p: Column, face: Column) -> Column:
        u, v = _face_coordinates(p, face)
        ij = F.struct(_cut(u, level).alias("i"), _cut(v, level).alias("j"))
        return (
            F.shiftleft(face.cast("long"), 61)
            .bitwiseOR(F.shiftleft(_let(ij, lambda cut: curve(cut, face)), low + 1))
            .bitwiseOR(F.lit(1 << low))
        )

    x, y, z = unit_vector(lon, lat)
    vector = F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    cell = _let(vector, lambda p: _let(_cube_face(p), lambda face: on_face(p, face)))
    return F.when(lon.isNotNull() & lat.isNotNull(), cell)


def cell_parent(cell: Column, level: int) -> Column:
    """The cell of a coarser (or the same) level around a cell."""
    low = 1 << 2 * (LEAF_LEVEL - level)
    return cell.bitwiseAND(F.lit(-low)).bitwiseOR(F.lit(low))


def cell_children(cell: Column, level: int, below: int) -> Column:
    """Array of the cells of a finer level in a cell of ``level``."""
    low, step = 1 << 2 * (LEAF_LEVEL - level), 1 << 2 * (LEAF_LEVEL - below) + 1
    return F.transform(F.sequence(F.lit(0), F.lit(4 ** (below - level) - 1)), lambda n: cell - low + (step >> 1) + n * step)


def _uncut(index: Column, level: Column) -> Column:
    """Face coordinate of a line between the cells of a level."""
    s = index / F.pow(F.lit(2.0), level)
    return F.when(s >= 0.5, (4 * s * s - 1) / 3).otherwise((1 - 4 * (1 - s) * (1 - s)) / 3)


def _face_vector(face: Column, u: Column, v: Column) -> Column:
    """Vector on the cube: the inverse of the face coordinates."""
    one = F.lit(1.0)
    options = [(one, u, v), (-u, one, v), (-u, -v, one), (-one, -v, -u), (v, -one, -u), (v, u, -one)]

    def pick(axis: int) -> Column:
        chain = F.when(face == 0, options[0][axis])
        for number in range(1, 6):
            chain = chain.when(face == number, options[number][axis])
        return chain

    return F.struct(pick(0).alias("x"), pick(1).alias("y"), pick(2).alias("z"))


def cell_bounds(cell: Column, level: Column) -> Column:
    """Box around a cell: lon and lat of its centre, west, east, south, north; ``polar`` where it is of no use.

    The box goes a quarter of its size beyond the corners on all sides, more
    than the sides bulge from level 4 on; west and east may pass 180 degrees.
    """
    inverse = [0] * 16
    for at, step in enumerate(hilbert_steps()):
        inverse[at & 12 | step >> 2] = (at & 3) * 4 + (step & 3)
    table = F.lit(inverse)

    def read_pair(acc: Column, n: Column) -> Column:
        position = F.call_function("shiftright", cell, 59 - 2 * n).bitwiseAND(F.lit(3)).cast("int")
        step = F.get(table, acc["turn"] * 4 + position)
        quadrant = F.call_function("shiftright", step, F.lit(2))
        return F.struct(
            (acc["i"] * 2 + F.call_function("shiftright", quadrant, F.lit(1))).alias("i"),
            (acc["j"] * 2 + quadrant.bitwiseAND(F.lit(1))).alias("j"),
            step.bitwiseAND(F.lit(3)).alias("turn"),
        )

    face = F.shiftrightunsigned(cell, 61).cast("int")
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), face.bitwiseAND(F.lit(SWAPPED)).alias("turn"))
    place = F.aggregate(F.sequence(F.lit(0), level - 1), start, read_pair)

    def around(ij: Column) -> Column:
        def at(di: float, dj: float) -> Column:
            p = _face_vector(face, _uncut(ij["i"] + di, level), _uncut(ij["j"] + dj, level))
            return _let(p, lambda q: F.struct(vector_lon(q["x"], q["y"]).alias("lon"), vector_lat(q["x"], q["y"], q["z"]).alias("lat")))

        def box(points: Column) -> Column:
            centre, corners = points[0], F.slice(points, 2, 4)
            offs = F.transform(corners, lambda c: eastward(c["lon"] - centre["lon"], "spherical"))
            lats = F.transform(corners, lambda c: c["lat"])
            west, east, south, north = F.array_min(offs), F.array_max(offs), F.array_min(lats), F.array_max(lats)
            dx, dy = (east - west) / 4, (north - south) / 4
            return F.struct(
                centre["lon"].alias("lon"),
                centre["lat"].alias("lat"),
                (centre["lon"] + west - dx).alias("west"),
                (centre["lon"] + east + dx).alias("east"),
                (south - dy).alias("south"),
                (north + dy).alias("north"),
                (F.greatest(F.abs(south), F.abs(north)) > 85).alias("polar"),
            )

        return _let(F.array(at(0.5, 0.5), at(0, 0), at(0, 1), at(1, 0), at(1, 1)), box)

    return _let(place, around)
