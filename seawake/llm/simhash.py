"""SimHash near-deduplication over a byte-position inverted index.

A fingerprint has eight bytes.  Two that differ in at most ``max_bits`` (4)
bits differ in at most four bytes, so at least four positional bytes are
shared.  Twenty triples of positions are enough that any four positions hold
one of them; the index lists each fingerprint under the bytes at each triple.
Pairs of a list tally all their shared positional bytes, those with four or
more are kept, and their bits are compared.  A pair that meets in several
lists is reported by the first.

Fingerprints are indexed once, whatever the number of documents that have
them.  A list longer than ``DENSE`` is joined up without comparing its pairs:
two fingerprints within four bits share a neighbour within two bits of both,
so equal neighbours link exactly those components; that is grouped by Spark
and grows with the list, not with its square.

Defined cases: null or wordless texts have fingerprint zero and are linked
like any others; texts of fewer words than a shingle are one shingle of all
words; repeated rows are documents with equal fingerprints; a null id takes
part in no group and is its own component (null).  Further columns are ignored
by :func:`simhash_components` and kept by :func:`without_near_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import batch, in_pieces, runs, shuffle_partitions, stored
from seawake.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LEAST_SHARED = 4
#: Lists up to this length are compared pair by pair in one task.
DENSE = 512
_CLASSES = ((0, 1, 2), (3, 4, 5), (6, 7))


def position_triples() -> list[tuple[int, ...]]:
    """Twenty triples of byte positions, one of them in any four positions.

    Positions form three classes; of any four, three are in one class, or two
    are in a class with one in the next class around.
    """
    found = [c for cls in _CLASSES for c in combinations(cls, 3)]
    for i, cls in enumerate(_CLASSES):
        found += [tuple(sorted((*two, one))) for two in combinations(cls, 2) for one in _CLASSES[(i + 1) % 3]]
    return found


TRIPLES = position_triples()
#: For each set of shared positions (as a bit mask), the first triple in it.
FIRST_TRIPLE = np.array([next((i for i, t in enumerate(TRIPLES) if all(m >> p & 1 for p in t)), -1) for m in range(256)])
_BIT_COUNT = np.array([bin(m).count("1") for m in range(256)])


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned 64-bit number."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    shingles = map(joined.__getitem__, map(slice, starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(tokens) - words + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint's bits as a signed long) of each document."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(x.as_py(), words) for x in b.column(1)], dtype=np.uint64)
            yield batch(schema, b.column(0), prints.view(np.int64))

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(of, "id long, fp long")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index: a row for each fingerprint and triple, keyed by the triple and its bytes."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("rep", pa.int64())])
    for b in batches:
        fps, reps = (b.column(n).to_numpy(zero_copy_only=False) for n in ("fp", "rep"))
        octets = fps.astype("<i8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        for i, (x, y, z) in enumerate(TRIPLES):
            keys = i << 24 | octets[:, x] << 16 | octets[:, y] << 8 | octets[:, z]
            yield from in_pieces(schema, [keys, fps, reps])


def _tally(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of shared byte positions, and differing bits, of fingerprints in pairs."""
    differ = a ^ b
    octets = differ.astype("<i8").reshape(-1).view(np.uint8).reshape(*differ.shape, 8)
    return np.packbits(octets == 0, axis=-1, bitorder="little")[..., 0], np.bitwise_count(differ.astype(np.uint64))


def _pairs(dense: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Linked pairs of each list; members of lists that are too long, unpaired."""
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("dense_fp", pa.int64()), ("dense_rep", pa.int64())])
        for part, long in runs(batches, "key", dense):
            key, fp, rep = part["key"], part["fp"], part["rep"]
            if long:
                nulls = [None] * len(key)
                yield batch(schema, nulls, nulls, fp, rep)
                continue
            # lists in bulk: neighbours at each distance within a list
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            live = np.flatnonzero(np.repeat(sizes, sizes) > 1)
            last = np.repeat(starts + sizes, sizes)[live]
            for step in range(1, int(sizes.max())):
                inside = live + step < last
                live, last = live[inside], last[inside]
                if not len(live):
                    break
                shared, bits = _tally(fp[live], fp[live + step])
                good = (_BIT_COUNT[shared] >= LEAST_SHARED) & (bits <= MAX_BITS) & (FIRST_TRIPLE[shared] == key[live] >> 24)
                if good.any():
                    at = live[good]
                    nulls = [None] * len(at)
                    yield batch(schema, rep[at], rep[at + step], nulls, nulls)

    return found


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint's neighbours within two bits, itself included."""
    schema = pa.schema([("near", pa.int64()), ("rep", pa.int64())])
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    masks = np.concatenate([np.zeros(1, np.uint64), one, one[i] | one[j]])
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        reps = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for at in range(0, len(fps), 64):
            near = (fps[at : at + 64, None] ^ masks[None, :]).ravel()
            yield from in_pieces(schema, [near.view(np.int64), np.repeat(reps[at : at + 64], len(masks))])


def links(prints: DataFrame, dense: int = DENSE) -> DataFrame:
    """Edges (a, b) between representatives whose components are those of all links.

    ``prints``: stored rows (fp, rep), one for each fingerprint.
    """
    n = shuffle_partitions(prints.sparkSession)
    index = prints.select("fp", "rep").mapInArrow(_listed, "key long, fp long, rep long")
    lists = index.repartition(n, "key").sortWithinPartitions("key", "fp")
    found = stored(lists.mapInArrow(_pairs(dense), "a long, b long, dense_fp long, dense_rep long"), "simhash-pairs")
    edges = found.filter("a is not null").select("a", "b")
    crowd = found.filter("dense_fp is not null").select("dense_fp", "dense_rep").distinct()
    if crowd.isEmpty():
        return edges
    # members of long lists: those that share a neighbour go to the smallest of them
    crowd = stored(crowd, "simhash-dense")
    near = crowd.mapInArrow(_neighbours, "near long, rep long")
    # a run of equal neighbours is as long as the number of fingerprints within two bits: 2081 at most
    stars = near.groupBy("near").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("all")).filter("size(all) > 1")
    return edges.union(stars.select("a", F.explode("all").alias("b")).filter("a <> b").distinct())


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, dense: int = DENSE
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    prints = stored(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    reps = stored(prints.filter("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "simhash-reps")
    roots = components(links(reps, dense)).select(F.col("node").alias("rep"), "root")
    known = stored(reps.join(roots, "rep", "left").select("fp", F.coalesce("root", "rep").alias("component_id")), "simhash-known")
    return prints.join(known, "fp", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """The documents with one of each component left, that with the smallest id; null ids stay.

    Only ids of documents that go are joined with the rows.
    """
    groups = simhash_components(docs, id_col, text_col, words)
    gone = stored(groups.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone_id")).distinct(), "simhash-gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"))
    return rows.join(gone, F.col("own_id") == F.col("gone_id"), "left_anti").select("row.*")
