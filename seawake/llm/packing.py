"""Packing documents into sequences by a linear grouping scheme.

1. Documents are cut only where they exceed the capacity; a task counts its
   pieces of each length.  There are at most ``capacity`` lengths, so the
   counts of the corpus are a small table whatever its size.
2. Large lengths (over an eighth of the capacity) are sorted and dealt into
   groups of equal cardinality, and each is rounded up to the largest of its
   group.  Few sizes remain, and configurations of them are optimised: the
   fullest one is repeated as often as the counts allow, until none is left.
3. Actual lengths take the places of rounded ones, which leaves room, and the
   small lengths go best-fit into what room there is.

Each step works on counts: a configuration that is used a million times is one
row with a number.  A document finds its sequence by its rank among the pieces
of its length.

Defined cases: null and empty texts are the end id alone; texts may have any
length; an empty table gives no piece; repeated rows and ids are packed each;
a null id is kept; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawake.llm.bpe import model_text
from seawake.llm.common import batch, stored, strings
from seawake.llm.encoding import SharedEncoder

CAPACITY = 2048
GROUPS = 1200
LARGE = 8
END_ID = 0


def rounded_sizes(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> dict[int, int]:
    """For each large length the size it is rounded up to: the largest of its group."""
    large = sorted((n for n in counts if n * LARGE > capacity), reverse=True)
    share = max(1, -(-sum(counts[n] for n in large) // groups))
    out, filled, size = {}, share, 0
    for n in large:
        if filled >= share:
            filled, size = 0, n
        out[n] = size
        filled += counts[n]
    return out


def _fullest(sizes: list[int], left: dict[int, int], capacity: int) -> list[int]:
    """A configuration that holds the largest size left and is as full as can be.

    Reachable sums of the other sizes are found by dynamic programming over
    (size, times), larger sizes first.
    """
    first = next(s for s in sizes if left[s])
    room = capacity - first
    reached: dict[int, tuple[int, ...]] = {0: ()}
    for s in sizes:
        if s > room:
            continue
        most = left[s] - (s == first)
        for total in sorted(reached):
            parts = reached[total]
            for k in range(1, min(most, (room - total) // s) + 1):
                reached.setdefault(total + k * s, parts + (s,) * k)
        if room in reached:
            break
    return [first, *reached[max(reached)]]


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations of the sizes with the number of sequences that use each."""
    left = dict(counts)
    sizes = sorted(left, reverse=True)
    out = []
    while any(left.values()):
        sizes = [s for s in sizes if left[s]]
        best = _fullest(sizes, left, capacity)
        times = min(left[s] // best.count(s) for s in set(best))
        for s in best:
            left[s] -= times
        out.append((best, times))
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[list[int], int]]:
    """Sequences for so many pieces of each length, as (lengths, times) with lengths in order."""
    size_of = rounded_sizes(counts, capacity, groups)
    per_size: dict[int, int] = {}
    waiting: dict[int, list[list[int]]] = {}
    for n in sorted(size_of, reverse=True):
        per_size[size_of[n]] = per_size.get(size_of[n], 0) + counts[n]
        waiting.setdefault(size_of[n], []).append([n, counts[n]])
    # actual lengths in place of rounded ones; a use that meets several lengths is split
    open_bins: list[tuple[list[int], int]] = []
    for places, times in configurations(per_size, capacity):
        while times:
            taken, use = [], times
            need: dict[int, int] = {}
            for s in places:
                need[s] = need.get(s, 0) + 1
            for s, k in need.items():
                # the k places of a size take k lengths from the front of its list
                front = waiting[s]
                if front[0][1] >= k:
                    taken += [(front[0], k)]
                    use = min(use, front[0][1] // k)
                else:
                    use = 1
                    for entry in front:
                        part = min(entry[1], k)
                        taken += [(entry, part)]
                        k -= part
                        if not k:
                            break
            lengths = []
            for entry, k in taken:
                entry[1] -= k * use
                lengths += [entry[0]] * k
            for s in need:
                waiting[s] = [e for e in waiting[s] if e[1]]
            open_bins.append((sorted(lengths, reverse=True), use))
            times -= use
    return _fill(open_bins, {n: c for n, c in counts.items() if n not in size_of}, capacity)


def _fill(open_bins: list[tuple[list[int], int]], small: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Small lengths, longest first, each into the fullest sequences that still have room."""
    bins: dict[int, list[tuple[list[int], int]]] = {}
    rooms: list[int] = []

    def put(lengths: list[int], times: int) -> None:
        room = capacity - sum(lengths)
        if room not in bins:
            insort(rooms, room)
        bins.setdefault(room, []).append((lengths, times))

    for lengths, times in open_bins:
        put(lengths, times)
    for n in sorted(small, reverse=True):
        count = small[n]
        while count:
            at = bisect_left(rooms, n)
            if at == len(rooms):
                # new sequences full of this length, and one with the rest
                per = capacity // n
                full, rest = divmod(count, per)
                if full:
                    put([n] * per, full)
                if rest:
                    put([n] * rest, 1)
                break
            room = rooms[at]
            lengths, times = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            fit = min(room // n, count)
            use = min(times, count // fit)
            put(lengths + [n] * fit, use)
            if times > use:
                put(lengths, times - use)
            count -= use * fit
    return [x for room in rooms for x in bins[room]]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Stored pieces: id, piece, start, length, ids_crc32, and where asked for their ids.

    ``part`` and ``place`` number the pieces of a length within a task's output.
    """
    model = docs.sparkSession.sparkContext.broadcast(SharedEncoder(model_text(tokenizer), "dropped"))
    end = np.array([end_id], "<u4").tobytes()
    columns = "id long, piece int, start long, length int, ids_crc32 long, part int, place int, ids binary"
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    schema = pa.schema([(c.split()[0], k) for c, k in zip(columns.split(", "), kinds, strict=True)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model.value.encoder
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for b in batches:
            for at in range(0, len(b), 512):
                some = b.slice(at, 512)
                rows = []
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder(strings(some.column(1))), strict=True):
                    ids += end
                    for i in range(0, len(ids), 4 * capacity):
                        own = ids[i : i + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc_id, i // (4 * capacity), i // 4, n, zlib.crc32(own), part, seen[n], own if with_ids else None))
                        seen[n] += 1
                yield batch(schema, *zip(*rows, strict=True))

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return stored(rows.mapInArrow(cut, columns), "pieces")


def pack(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (length, part, place, and any others)."""
    spark = cut.sparkSession
    by_part = stored(cut.groupBy("length", "part").count(), "piece-counts")
    # at most one row for each length comes to the driver
    counts = {r["length"]: r["total"] for r in by_part.groupBy("length").agg(F.sum("count").alias("total")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_part.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    places = spark.sparkContext.broadcast(_places(plan(counts, capacity, groups)))
    ranked = cut.join(ranks, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place")).drop("before", "place", "part")
    kept = [f for f in ranked.schema if f.name != "rank"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                ends, first, base, step, at = table[int(n)]
                i = np.searchsorted(ends, rank[own], "right")
                inside = rank[own] - first[i]
                sequence[own] = base[i] + inside // step[i]
                offset[own] = at[i] + inside % step[i] * n
            names = [f.name for f in kept]
            arrays = [b.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return ranked.mapInArrow(assign, f"{ddl}, sequence_id long, offset long")


def _places(sequences: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of places: last rank (exclusive), first rank, first sequence, places in a sequence, offset."""
    runs: dict[int, list[list[int]]] = {}
    base = 0
    for lengths, times in sequences:
        at = 0
        for n in dict.fromkeys(lengths):
            k = lengths.count(n)
            own = runs.setdefault(n, [])
            first = own[-1][0] if own else 0
            own.append([first + k * times, first, base, k, at])
            at += k * n
        base += times
    return {n: tuple(np.array(own, np.int64).T) for n, own in runs.items()}
