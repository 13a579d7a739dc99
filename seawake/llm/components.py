"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each node of ``edges`` (a, b) can reach.

    In each round every node moves to its smallest neighbour, if that is
    smaller; pointers of these moves are then doubled until all of them point
    to where they end, so that an ascending chain of any length is one move.
    Edges are carried over to the nodes that are left.  A node that neither
    moved nor was moved to has smaller neighbours only in the next round, so
    the nodes at least halve every two rounds.  The moves are followed back at
    the end.  Tables are stored in each round, those that are
    of no more use are dropped, and joins on a node with many edges can be
    split at run time.  Rows with a null end are no edges; repeated edges and
    loops change nothing.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    moves = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a"))
        move = both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to"))
        move = _to_ends(stored(move, "moves"))
        moves.append(move)
        left, right = (move.select(F.col("node").alias(n), F.col("to").alias(f"{n}_to")) for n in ("a", "b"))
        carried = edges.join(left, "a").select(F.col("a_to").alias("a"), "b").join(right, "b").select("a", F.col("b_to").alias("b"))
        before, carried = edges, carried.filter("a <> b")
        edges = stored(carried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        dropped(before)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves.pop().select("node", F.col("to").alias("root"))
    while moves:
        move = moves.pop()
        known = roots.select(F.col("node").alias("to"), "root")
        roots = stored(move.join(known, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "roots")
        dropped(move)
    return roots


def _to_ends(move: DataFrame) -> DataFrame:
    """Pointers to smaller nodes, followed to their ends in a logarithm of the longest way."""
    while True:
        onward = move.filter("node <> to").select(F.col("node").alias("to"), F.col("to").alias("next"))
        longer = stored(move.join(onward, "to", "left").select("node", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("on")), "moves")
        dropped(move)
        move = longer.select("node", "to")
        if longer.filter("on").isEmpty():
            return move
