"""Near copies by Jaccard similarity of word shingles: every link is verified.

1. SimHash fingerprints of five-word shingles go through the byte-position
   inverted index of :mod:`seawake.llm.simhash`: shared positional bytes are
   tallied, bits compared, and fingerprints within four bits are candidates.
2. Texts that are as similar but whose fingerprints are further apart are met
   by their sets of hashed shingles.  Shingles have one order, the rare ones
   first; two sets of a similarity of at least t share one of the first
   n - ceil(t n) + 1 shingles of each (n its size), so an index of these
   prefixes misses no pair.  How common shingles are is counted in a sample;
   any order gives the same links, only with more work.  Members of a list are
   paired if their sizes, and what is left of their sets behind the shared
   shingle, can give the similarity.
3. The bits of wide SimHash fingerprints drop pairs far off: the bound is
   ``MARGIN`` deviations above the bits expected at the similarity.
4. What is left is verified in Spark joins with the whole sets, which are made
   for documents of such pairs only and deleted when nothing reads them any
   more.

Lists over ``DENSE`` members are not paired in their task.  Each list elects
leaders in rounds, members are verified against them, and a list whose members
have all met in one component is done.  The first leader has the fewest
shingles rarer than the list's: in a group of near copies that is the text the
others were made from, and it is closer to each of them than they are to each
other.  Lists that are left and have much the same members become one, as the
many lists of one group of near copies do.  Then blocks of members meet over
all tasks, and only members of different components are compared; members of
the largest component do not meet each other.  They meet with their
fingerprints first, and those that are near another once more with their whole
sets: a common line makes long lists of texts that are not alike, whose sets
stay where they are.  A meeting sends the links that join its members up, so
no rows are made for pairs.  Where a large list does not fall into one
component, the comparisons within the meetings still grow with the square of
the rest.

Defined cases: case and white space do not count; texts of fewer than five
words are one shingle; texts without words are copies of each other; rows of
one id are one document with several texts; null ids take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat
from math import acos, ceil, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from seawake.llm import simhash
from seawake.llm.common import GOLDEN, batch, dropped, in_pieces, mixed, runs, shuffle_partitions, stored
from seawake.llm.components import components
from seawake.llm.repeats import filter_bits, marked, repeated_keys

SHINGLE = 5
SIMILARITY = 0.8
LANES = 4
POSITIONS = 8 * LANES
#: Deviations of the differing bits above their mean that a candidate may have.
MARGIN = 8
#: Lists up to this length are paired in one task; members of a block in the meetings of longer ones.
DENSE = 128
BLOCK = 128
#: Blocks of a list from which on they get larger instead of more, and how many times as large they may get:
#: where members meet with their sets, and with their fingerprints only.
SPREAD, LARGER = 16, 8
FEW, WIDER = 4, 16
#: Shingles of a set from which on it counts as several members of a block.
LONG = 1000
#: Rounds of leaders before the members that are left meet.
TURNS = 2
#: Documents whose shingles are counted for the order, and the shingles whose counts are kept.
SAMPLE = 20_000
COMMON = 200_000
_FP = [f"f{i}" for i in range(LANES)]


def most_bits(similarity: float = SIMILARITY, deviations: float = 1) -> int:
    """Differing bits expected at a similarity, and so many deviations more."""
    share = acos(2 * similarity / (1 + similarity)) / pi
    n = 64 * LANES
    return ceil(n * share + deviations * (n * share * (1 - share)) ** 0.5)


def shingle_set(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    count = max(1, len(tokens) - words + 1)
    shingles = map(joined.__getitem__, map(slice, (ends - lengths)[:count].tolist(), ends[-count:].tolist()))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, count))


def wide_fingerprint(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Four 64-bit lanes of the fingerprint over distinct shingles."""
    return _fingerprint(shingle_set(text, words))


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(LANES, np.uint64)
    for lane in range(LANES):
        counts = np.zeros(64, np.int64)
        own = mixed(hashes + np.uint64(GOLDEN * (lane + 1) % 2**64))
        for at in range(0, len(own), 1 << 14):
            part = own[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[lane] = np.packbits(counts * 2 > len(own), bitorder="little").view("<u8")[0]
    return out


def _octets(lanes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(lanes.astype("<i8")).view(np.uint8).reshape(len(lanes), POSITIONS)


def _near(lanes: np.ndarray, others: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count((lanes ^ others).view(np.uint64)).sum(axis=-1, dtype=np.int64) <= most


def joined_up(lanes: np.ndarray, most: int) -> np.ndarray:
    """For each fingerprint of a list the first of those it is linked with, however far along."""
    n = len(lanes)
    group = np.full(n, -1)
    leaders = []
    while (free := np.flatnonzero(group < 0)).size:
        leader = free[0]
        leaders.append(leader)
        group[free[_near(lanes[free], lanes[leader], most // 2)]] = leader
        group[leader] = leader

    def merge(a: int, members: np.ndarray) -> None:
        touched = np.unique(np.r_[group[a], group[members]])
        if len(touched) > 1:
            group[np.isin(group, touched)] = touched[0]

    for leader in leaders:
        merge(leader, np.flatnonzero(_near(lanes, lanes[leader], most)))
    names, sizes = np.unique(group, return_counts=True)
    largest = names[sizes.argmax()]
    known = set(leaders)
    for at in np.flatnonzero(group != largest).tolist():
        if at not in known:
            merge(at, np.flatnonzero(_near(lanes, lanes[at], most)))
    return group


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample, sorted, and how many of its documents have them."""
    total = docs.count()
    schema = pa.schema([("key", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column(1):
                yield from in_pieces(schema, [shingle_set(text.as_py(), words).view(np.int64)])

    share = min(1.0, SAMPLE / max(1, total))
    some = docs.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    counts = some.mapInArrow(of, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 2")
    best = counts.orderBy(F.desc("n"), "key").limit(COMMON).toArrow()
    keys = best["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], best["n"].to_numpy()[order]


def prefix(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """The first shingles in the common order, one of which any set as similar has among its own."""
    if not len(hashes):
        return np.zeros(1, np.uint64)
    keys, counts = common
    rank = np.zeros(len(hashes), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        rank = np.where(keys[at] == hashes, counts[at], 0)
    order = np.lexsort((hashes, rank))
    return hashes[order[: len(hashes) - ceil(similarity * len(hashes) - 1e-9) + 1]]


def _index(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """A row for each shingle of each document's prefix: key, id, size of the set, place in the order."""
    shared = docs.sparkSession.sparkContext.broadcast(_common(docs, words))
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 100):
                part = b.slice(low, 100)
                sets = [shingle_set(x.as_py(), words) for x in part.column(1)]
                first = [prefix(s, shared.value, similarity) for s in sets]
                sizes = [len(f) for f in first]
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), sizes)
                keys, at = np.concatenate(first).view(np.int64), np.concatenate([np.arange(k) for k in sizes])
                yield from in_pieces(schema, [keys, ids, np.repeat([len(s) for s in sets], sizes), at])

    return docs.mapInArrow(of, "key long, id long, n int, at int")


def _possible(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of sizes n and m, whose first shared shingle stands at these places, can be as similar."""
    least = similarity / (1 + similarity) * (n + m) - 1e-6
    return (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6) & (np.minimum(n - at, m - to) >= least)


def _pairs(similarity: float, dense: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Possible pairs of each list; members of lists that are too long, with their keys."""
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])
        for part, long in runs(batches, "key", dense):
            key, ids, n, at = (part[c] for c in ("key", "id", "n", "at"))
            if long:
                yield batch(schema, [None] * len(key), ids, key, n, at)
                continue
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            live = np.flatnonzero(np.repeat(sizes, sizes) > 1)
            last = np.repeat(starts + sizes, sizes)[live]
            for step in range(1, int(sizes.max())):
                inside = live + step < last
                live, last = live[inside], last[inside]
                if not len(live):
                    break
                to = live + step
                good = _possible(n[live], at[live], n[to], at[to], similarity) & (ids[live] != ids[to])
                if good.any():
                    a, b = ids[live[good]], ids[to[good]]
                    nulls = [None] * len(a)
                    yield batch(schema, np.minimum(a, b), np.maximum(a, b), nulls, nulls, nulls)

    return found


def _by_fingerprint(docs: DataFrame, words: int) -> DataFrame:
    """Pairs (a, b) of documents whose fingerprints the byte-position index links, or are equal."""
    prints = stored(simhash.fingerprints(docs, "id", "text", words), "near-prints")
    reps = stored(prints.groupBy("fp").agg(F.min("id").alias("rep")), "near-reps")
    equal = prints.join(reps, "fp").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    pairs = simhash.links(reps).union(equal).filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _ends(pairs: DataFrame) -> DataFrame:
    """The documents of the pairs, stored."""
    return stored(pairs.select(F.col("a").alias("own")).union(pairs.select("b")).distinct(), "near-ids")


def _of_some(docs: DataFrame, ids: DataFrame, words: int, made: Callable[[list[np.ndarray]], list], fields: list[pa.Field], name: str) -> DataFrame:
    """``id`` and what is made of the shingle sets of the documents with these ids and, by chance, few others; stored."""
    bits = filter_bits(ids.count(), 16)
    plane = repeated_keys(ids.union(ids), bits, 3)
    schema = pa.schema([pa.field("id", pa.int64()), *fields])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = marked(b.column(0).to_numpy(zero_copy_only=False), plane.value, bits, 3)
            for low in range(0, len(rows := np.flatnonzero(kept)), 100):
                part = b.take(pa.array(rows[low : low + 100]))
                yield batch(schema, part.column(0), *made([shingle_set(x.as_py(), words) for x in part.column(1)]))

    return stored(docs.mapInArrow(of, from_arrow_schema(schema)), name)


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id`` and ``shingles``."""
    fields = [pa.field("shingles", pa.list_(pa.int64()))]
    return _of_some(docs, ids, words, lambda sets: [[s.view(np.int64) for s in sets]], fields, "near-sets")


def _lanes(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id`` and the lanes of the wide fingerprint."""

    def made(sets: list[np.ndarray]) -> list:
        return [*np.array([_fingerprint(s) for s in sets], np.uint64).reshape(-1, LANES).view(np.int64).T]

    return _of_some(docs, ids, words, made, [pa.field(f, pa.int64()) for f in _FP], "near-lanes")


def _verified(pairs: DataFrame, docs: DataFrame, lanes: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets have the similarity, stored; ``lanes`` has all their documents."""
    sides = [lanes.select(F.col("id").alias(e), *(F.col(f).alias(f"{e}_{f}") for f in _FP)) for e in "ab"]
    differ = sum((F.bit_count(F.col(f"a_{f}").bitwiseXOR(F.col(f"b_{f}"))) for f in _FP), F.lit(0))
    close = pairs.join(sides[0], "a").join(sides[1], "b").filter(differ <= most_bits(similarity, MARGIN)).select("a", "b").distinct()
    close = stored(close, "near-close")
    sets = _sets(docs, _ends(close), words)
    sides = [sets.select(F.col("id").alias(e), F.col("shingles").alias(f"{e}_set")) for e in "ab"]
    both = F.size(F.array_intersect("a_set", "b_set"))
    alike = both >= similarity * (F.size("a_set") + F.size("b_set") - both) - 1e-9
    links = stored(close.join(sides[1], "b").join(sides[0], "a").filter(alike).select("a", "b"), "near-links")
    dropped(sets)
    return links


def _spanning(n: np.ndarray, at: np.ndarray, root: np.ndarray, inner: np.ndarray, sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Places of members that are as similar and whose components were apart until then.

    Members marked ``inner`` come last and do not meet each other; if there are
    any, the others meet only them.  At most one link for each member is found.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    names, place = np.unique(np.concatenate(sets), return_inverse=True)
    root, mixed_up = root.copy(), bool(inner.any())
    for i in range(int((~inner).sum())):
        good = _possible(n[i], at[i], n[i + 1 :], at[i + 1 :], similarity) & (root[i + 1 :] != root[i])
        if mixed_up:
            good &= inner[i + 1 :]
        if not good.any():
            continue
        own = np.zeros(len(names), bool)
        own[place[ends[i] - sizes[i] : ends[i]]] = True
        shared = np.r_[0, np.cumsum(own[place])]
        both = (shared[ends] - shared[ends - sizes])[i + 1 :]
        good &= both >= similarity * (sizes[i] + sizes[i + 1 :] - both) - 1e-9
        for to in (np.flatnonzero(good) + i + 1).tolist():
            if root[to] != root[i]:
                yield i, to
                root[root == root[to]] = root[i]


def _gathered(members: DataFrame) -> DataFrame:
    """The members (key, id, n, at, root) with lists of much the same members made one.

    A document is at home in the longest of its lists.  A list half of whose
    members are at home in one list joins that one, so members of a list still
    meet, and documents that share many lists meet once.  ``at`` is the least
    place of a document, so pairs that were possible in one of the lists stay so.
    """
    sized = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "key")
    homes = sized.groupBy("id").agg(F.max_by("key", F.struct("size", "key")).alias("home"))
    by_home = members.join(homes, "id").groupBy("key", "home").agg(F.count(F.lit(1)).alias("here"))
    most = by_home.groupBy("key").agg(F.max_by("home", F.struct("here", "home")).alias("home"), F.max("here").alias("here"), F.sum("here").alias("size"))
    named = most.select("key", F.when(F.col("here") * 2 >= F.col("size"), F.col("home")).otherwise(F.col("key")).alias("name"))
    return members.join(named, "key").groupBy(F.col("name").alias("key"), "id", "n", "root").agg(F.min("at").alias("at"))


def _dealt(members: DataFrame, weight: Column, blocks: Callable[[Column], Column]) -> DataFrame:
    """Rows (meeting, key, id, n, at, root, inner): all blocks of members that are to meet.

    Members of a list's largest component (inner) form blocks of their own, which
    meet those of the others; these meet each other as well.
    """
    sizes = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    sizes = sizes.select("key", "root", weight.alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.sum("size").alias("all"), F.max("size").alias("most"))
    rows = members.join(largest, "key").withColumn("inner", F.col("root") == F.col("main"))
    many, few = blocks(F.col("most")), F.greatest(F.lit(1), blocks(F.col("all") - F.col("most")))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("inner"), many).otherwise(few)).cast("int")
    rows = rows.withColumn("own", own)
    outer = F.transform(F.sequence(F.lit(0), few - 1), lambda j: F.struct(F.least("own", j).alias("x"), F.greatest("own", j).alias("y"), F.lit(False).alias("mixed")))
    cross = F.transform(F.sequence(F.lit(0), many - 1), lambda j: F.struct(j.alias("x"), F.col("own").alias("y"), F.lit(True).alias("mixed")))
    inner = F.transform(F.sequence(F.lit(0), few - 1), lambda j: F.struct(F.col("own").alias("x"), j.alias("y"), F.lit(True).alias("mixed")))
    dealt = rows.withColumn("place", F.explode(F.when(F.col("inner"), inner).otherwise(F.concat(outer, cross))))
    return dealt.select(F.xxhash64("key", "place.x", "place.y", "place.mixed").alias("meeting"), "key", "id", "n", "at", "root", "inner")


def _in_blocks(size: Column, block: int, spread: int, larger: int) -> Column:
    """Number of blocks; they get larger, up to so many times, before there are more than ``spread``."""
    full, wide = (F.ceil(size / F.lit(n)).cast("int") for n in (block, block * larger))
    return F.greatest(F.least(full, F.lit(spread)), wide)


def _near_another(members: DataFrame, lanes: DataFrame, block: int, similarity: float) -> DataFrame:
    """Members that are possible partners of others of their list, and near them by the bits; stored."""
    dealt = _dealt(members, F.col("size"), lambda size: _in_blocks(size, block, FEW, WIDER))
    dealt = dealt.join(lanes, "id").repartition(shuffle_partitions(members.sparkSession), "meeting")
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])
    most = most_bits(similarity, MARGIN)

    def found(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("inner").combine_chunks()
        n, at, root, inner = (rows[c].to_numpy(zero_copy_only=False) for c in ("n", "at", "root", "inner"))
        bits = np.stack([rows[f].to_numpy(zero_copy_only=False) for f in _FP], axis=1)
        first = int((~inner).sum())
        near = np.zeros(len(n), bool)
        for i in range(first):
            low = max(i + 1, first) if first < len(n) else i + 1
            good = low + np.flatnonzero(_possible(n[i], at[i], n[low:], at[low:], similarity) & (root[low:] != root[i]))
            good = good[_near(bits[good], bits[i], most)]
            near[good] = True
            near[i] |= len(good) > 0
        return rows.select(["key", "id"]).filter(pa.array(near)).cast(schema)

    found_ids = dealt.groupBy("meeting").applyInArrow(found, "key long, id long").distinct()
    return stored(members.join(found_ids, ["key", "id"], "left_semi"), "near-members")


def _meetings(members: DataFrame, docs: DataFrame, block: int, words: int, similarity: float, lanes: DataFrame | None = None) -> DataFrame:
    """Verified links between members of different components of a list (key, id, n, at, root), stored.

    Members that are near none by their fingerprints (``lanes``) leave first.
    A meeting of the others compares the whole sets of two blocks in its task
    and sends the links that join its members up, fewer than it has members;
    long sets make blocks smaller.  A member goes to as many meetings as there
    are blocks.
    """
    ids = lambda: stored(members.select(F.col("id").alias("own")).distinct(), "near-ids")
    members = stored(_gathered(members), "near-members")
    members = _near_another(members, _lanes(docs, ids(), words) if lanes is None else lanes, block, similarity)
    sets = _sets(docs, ids(), words)
    weight = F.greatest(F.col("size"), F.ceil(F.col("shingles") / LONG))
    dealt = _dealt(members, weight, lambda size: _in_blocks(size, block, SPREAD, LARGER))
    dealt = dealt.drop("key").join(sets, "id").repartition(shuffle_partitions(members.sparkSession), "meeting")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("inner").combine_chunks()
        ids, n, at, root, inner = (rows[c].to_numpy(zero_copy_only=False) for c in ("id", "n", "at", "root", "inner"))
        sets = [x.values.to_numpy(zero_copy_only=False) for x in rows["shingles"]]
        at = np.array(list(_spanning(n, at, root, inner, sets, similarity)), np.int64).reshape(-1, 2)
        return pa.table([pa.array(np.sort(ids[at], axis=1)[:, i], pa.int64()) for i in (0, 1)], schema=schema)

    links = stored(dealt.groupBy("meeting").applyInArrow(found, "a long, b long"), "near-links")
    dropped(sets)
    return links


def links(docs: DataFrame, words: int = SHINGLE, similarity: float = SIMILARITY, dense: int = DENSE, block: int = BLOCK) -> DataFrame:
    """Verified edges (a, b) whose components are those of all pairs of the similarity; ``docs`` has id and text."""
    lists = _index(docs, words, similarity).repartition(shuffle_partitions(docs.sparkSession), "key").sortWithinPartitions("key")
    found = lists.mapInArrow(_pairs(similarity, dense), "a long, b long, key long, n int, at int")
    found = stored(found, "near-pairs")
    candidates = _by_fingerprint(docs, words).union(found.filter("a is not null").select("a", "b"))
    candidates = stored(candidates.distinct(), "near-candidates")
    crowd = stored(found.filter("a is null").select("key", F.col("b").alias("id"), "n", "at").distinct(), "near-crowd")
    lanes = _lanes(docs, _ends(candidates.union(crowd.select("id", "id"))), words)
    edges = _verified(candidates, docs, lanes, words, similarity)
    for turn in range(TURNS + 1):
        if crowd.isEmpty():
            break
        roots = stored(components(edges), "near-known")
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b")
        members = crowd.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        members = stored(members, "near-members")
        several = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        members = stored(members.join(several.filter("low < high").select("key"), "key"), "near-members")
        crowd = members.drop("root")
        if turn == TURNS:
            edges = edges.union(_meetings(members, docs, block, words, similarity, lanes))
            break
        first = F.struct(F.when(F.lit(turn == 0), F.col("at")), F.xxhash64("id", F.lit(turn)))
        leaders = members.groupBy("key").agg(F.min_by(F.struct("id", "n", "at", "root"), first).alias("l"))
        pairs = members.join(leaders, "key").filter((F.col("id") != F.col("l.id")) & (F.col("root") != F.col("l.root")))
        pairs = pairs.select(F.least("id", "l.id").alias("a"), F.greatest("id", "l.id").alias("b"))
        edges = edges.union(_verified(pairs.distinct(), docs, lanes, words, similarity))
    dropped(lanes)
    return edges


def near_copy_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, dense: int = DENSE, block: int = BLOCK
) -> DataFrame:
    """``id``, ``component_id`` (smallest id reachable) of each document with an id."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    roots = stored(components(links(rows, similarity=similarity, dense=dense, block=block)), "near-roots").select(F.col("node").alias("id"), "root")
    return rows.select("id").join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("component_id"))


def without_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents with one of each group left, that with the smallest id; null ids stay."""
    groups = near_copy_groups(docs, id_col, text_col, similarity)
    gone = stored(groups.filter("id <> component_id").select(F.col("id").alias("gone_id")).distinct(), "wide-gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"))
    return rows.join(gone, F.col("own_id") == F.col("gone_id"), "left_anti").select("row.*")
