"""Near-duplicate embeddings by collision counting over sorted projections.

Vectors of a label are compared when their cosine may reach ``least`` (0.93).

1. Equal vectors are one point with a number of copies.
2. Points are sorted along a lead direction (the first principal component of
   a bounded sample) and dealt into blocks.  Two points within the distance
   that the cosine allows are as close along any unit direction, so only
   blocks whose ranges come that close meet; none of the pairs is lost here.
3. Where two blocks meet, ``PROJECTIONS`` random directions are sorted one by
   one.  A window around each query on each of them marks its collisions, and
   a pair that collides often enough is verified by its cosine in double
   precision.  For a pair at the threshold the number of collisions is
   binomial, whatever the data; the count is set so that such a pair passes
   with probability ``RECALL``, and closer pairs pass more surely.
4. Each meeting returns the links of each point as a number, and edges that
   join up what is linked, never all pairs.

Meetings are of bounded size and dealt over all tasks, also those of a label
with most of the rows.  The number of meetings grows with the square of a
label's points where the lead direction does not keep them apart.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing; vectors of
different lengths are not compared; repeated rows are linked to each other;
rows that share an id are one node; a null id has no component; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import batch, shuffle_partitions, stored
from seawake.llm.components import components

LEAST = 0.93
PROJECTIONS = 32
RECALL = 0.9999
BLOCK = 1024
SAMPLE = 4096
CUTS = 512


def least_collisions(projections: int = PROJECTIONS, recall: float = RECALL) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``.

    A window is as wide as the deviation of such a pair's difference, which a
    normal variable meets with probability erf(1 / sqrt 2).
    """
    p = erf(1 / sqrt(2))
    tail, k = 1.0, 0
    while True:
        tail -= comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if tail < recall:
            return k
        k += 1


def directions(length: int, count: int = PROJECTIONS) -> np.ndarray:
    """Random directions for vectors of a length; the same on all tasks."""
    return np.random.default_rng(length).standard_normal((length, count))


def usable(vector) -> np.ndarray | None:
    """The vector in double precision, or None if it can link with nothing."""
    if vector is None:
        return None
    values = np.array([np.nan if v is None else v for v in vector], np.float64)
    return values if len(values) and np.isfinite(values).all() and values.any() else None


def _points(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("vector", pa.binary())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels = b.column(2).to_pylist()
            found = [None if k is None else usable(v.as_py()) for v, k in zip(b.column(1), labels, strict=True)]
            yield batch(schema, b.column(0), labels, [None if v is None else v.tobytes() for v in found])

    rows = vectors.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"), F.col(label_col).cast("string"))
    return rows.mapInArrow(of, "id long, label string, vector binary")


def _unit(raw) -> np.ndarray:
    matrix = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _lead(points: DataFrame) -> np.ndarray:
    """First principal component of a bounded sample of unit vectors of one length."""
    share = min(1.0, SAMPLE / max(1, points.count()))
    some = points.filter(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30)))
    raw = [bytes(r["vector"]) for r in some.select("vector").limit(2 * SAMPLE).collect()]
    if not raw:
        return np.ones(1)
    size = max({len(r) for r in raw}, key=lambda n: (sum(len(r) == n for r in raw), n))
    unit = _unit([r for r in raw if len(r) == size])
    return np.linalg.eigh(np.cov(unit.T) if len(unit) > 1 and unit.shape[1] > 1 else np.eye(unit.shape[1]))[1][:, -1]


def _meet(own: list[dict], least: float, count: int) -> tuple[list[tuple], list[tuple]]:
    """Links of points in one or two blocks: (rep, number of linked vectors) and joining edges."""
    same = all(r["first"] == r["second"] for r in own)
    unit = _unit([r["vector"] for r in own])
    reps = np.array([r["rep"] for r in own])
    copies = np.array([r["copies"] for r in own], np.int64)
    side = np.array([r["block"] == r["first"] for r in own])
    queries, others = (np.arange(len(own)),) * 2 if same else (np.flatnonzero(side), np.flatnonzero(~side))
    if not len(queries) or not len(others):
        return [], []
    projected = unit @ directions(unit.shape[1])
    half = sqrt(max(0.0, 2 - 2 * least))
    order = np.argsort(projected[others], axis=0, kind="stable")
    ranked = np.take_along_axis(projected[others], order, axis=0)
    lows = np.stack([np.searchsorted(ranked[:, j], projected[queries, j] - half) for j in range(order.shape[1])])
    highs = np.stack([np.searchsorted(ranked[:, j], projected[queries, j] + half, "right") for j in range(order.shape[1])])
    degree = np.zeros(len(own), np.int64)
    parent = np.arange(len(own))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, q in enumerate(queries.tolist()):
        tally = np.zeros(len(others), np.int16)
        for j in range(order.shape[1]):
            tally[order[lows[j, i] : highs[j, i], j]] += 1
        near = others[tally >= count]
        if same:
            near = near[near > q]
        near = near[unit[near] @ unit[q] >= least]
        if len(near):
            degree[q] += copies[near].sum()
            degree[near] += copies[q]
            for x in near.tolist():
                a, b = sorted((root(q), root(x)))
                parent[b] = a
    linked = np.flatnonzero(degree)
    edges = [(int(reps[x]), int(reps[root(x)])) for x in linked.tolist() if root(x) != x]
    return [(int(reps[x]), int(degree[x])) for x in linked.tolist()], edges


def _meetings(least: float, count: int):
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key = None
        for b in batches:
            for row in b.to_pylist():
                own = (row["label"], row["length"], row["first"], row["second"])
                if own != key and held:
                    yield from out(*_meet(held, least, count))
                    held = []
                key = own
                held.append(row)
        if held:
            yield from out(*_meet(held, least, count))

    def out(links: list[tuple], edges: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = [(*x, None, None) for x in links] + [(None, None, *x) for x in edges]
        if rows:
            yield batch(schema, *zip(*rows, strict=True))

    return found


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id (smallest id reachable), kept."""
    spark = vectors.sparkSession
    rows = stored(_points(vectors, id_col, vector_col, label_col), "vectors")
    points = rows.filter("vector is not null and id is not null").groupBy("label", "vector")
    points = stored(points.agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "points")
    lead = _lead(points)

    @F.pandas_udf("double")
    def along(raw: pd.Series) -> pd.Series:
        out = np.zeros(len(raw))
        sizes = raw.map(len).to_numpy() if len(raw) else np.zeros(0, int)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            unit = _unit([raw.iloc[i] for i in at])
            out[at] = unit @ lead if unit.shape[1] == len(lead) else unit[:, 0]
        return pd.Series(out)

    placed = points.withColumn("length", F.length("vector")).withColumn("lead", along("vector"))
    placed = stored(placed, "placed")
    shares = [i / CUTS for i in range(1, CUTS)]
    spread = placed.groupBy("label", "length").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("lead", shares, F.lit(10 * CUTS)).alias("cuts"))
    blocks = F.least(F.ceil(F.col("n") / block), F.lit(CUTS))
    step = F.greatest(F.lit(1), (F.lit(CUTS) / blocks).cast("int"))
    chosen = F.filter("cuts", lambda c, i: F.pmod(i + 1, step) == 0)
    spread = stored(spread.select("label", "length", F.when(blocks > 1, chosen).otherwise(F.array().cast("array<double>")).alias("cuts")), "cuts")
    number = F.size(F.filter("cuts", lambda c: c <= F.col("lead")))
    placed = stored(placed.join(spread, ["label", "length"]).withColumn("block", number).drop("cuts"), "blocks")
    ranges = stored(placed.groupBy("label", "length", "block").agg(F.min("lead").alias("low"), F.max("lead").alias("high")), "ranges")
    reach = sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    other = ranges.select("label", "length", F.col("block").alias("second"), F.col("low").alias("next_low"))
    pairs = ranges.withColumnRenamed("block", "first").join(other, ["label", "length"])
    pairs = pairs.filter((F.col("second") >= F.col("first")) & (F.col("next_low") <= F.col("high") + reach)).select("label", "length", "first", "second")
    pairs = stored(pairs, "meetings")
    seats = pairs.select("*", F.explode(F.array_distinct(F.array("first", "second"))).alias("block"))
    # the meetings of a block as one list, bounded by the number of blocks: points of a hot block are not joined many times over
    seats = stored(seats.groupBy("label", "length", "block").agg(F.collect_list(F.struct("first", "second")).alias("seats")), "seats")
    seated = placed.join(seats, ["label", "length", "block"]).select("label", "length", "block", "rep", "copies", "vector", F.explode("seats").alias("seat"))
    seated = seated.select("label", "length", "seat.first", "seat.second", "block", "rep", "copies", "vector")
    keys = ["label", "length", "first", "second"]
    dealt = seated.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "rep")
    met = stored(dealt.mapInArrow(_meetings(least, least_collisions()), "rep long, links long, a long, b long"), "links")
    degrees = met.filter("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(met.filter("a is not null").select("a", "b")).select(F.col("node").alias("rep"), "root")
    known = points.join(degrees, "rep", "left").join(roots, "rep", "left")
    known = known.select(
        F.col("label").alias("p_label"),
        F.col("vector").alias("p_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("root", "rep").alias("component"),
    )
    known = stored(known, "known-points")
    joined = rows.join(known, (F.col("label") == F.col("p_label")) & (F.col("vector") == F.col("p_vector")), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce(F.when(F.col("id").isNotNull(), F.col("links")), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
