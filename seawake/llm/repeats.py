"""Bloom filter of the keys that may occur more than once.

Keys set a few slots each.  A slot is kept if at least two insertions reached
it, so a key that occurs twice finds all its slots kept; others find them by
chance only.  Tasks send slot positions, grouped by segment of the filter, and
each segment is summed on its own.  The filter has a size bound: with more
keys it lets more of them through, which costs work and never a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from seawake.llm.common import GOLDEN, batch, mixed

SEGMENT = 1 << 16
#: Bound of the filter, and so of its broadcast: 2^29 bits are 64 MB.
MAX_BITS = 1 << 29
FLUSH = 1 << 21
_PARTS = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])

#: Batches of rows to batches whose first column are keys.
KeysOf = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def filter_bits(keys: int, bits_per_key: int, most: int = MAX_BITS) -> int:
    """Size of a filter for so many keys: a power of two within the bound."""
    return min(most, max(SEGMENT, 1 << int(max(1, keys) * bits_per_key - 1).bit_length()))


def slots(keys: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """Slot positions, one row for each hash."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    keys = keys.astype(np.uint64, copy=False)
    return np.stack([mixed(keys + np.uint64(GOLDEN * (j + 1) % 2**64)) >> shift for j in range(hashes)]).astype(np.int64)


def marked(keys: np.ndarray, plane: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """Whether all slots of each key were reached at least twice."""
    at = slots(keys, bits, hashes)
    return ((plane[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def repeated_keys(rows: DataFrame, bits: int, hashes: int, keys_of: KeysOf = iter) -> Broadcast[np.ndarray]:
    """Broadcast filter over the keys of rows; test keys with :func:`marked`.

    The keys are the single long column, or what ``keys_of`` makes of the rows
    in the same worker: a second Python step in a task would start a second
    worker in each of its slots, and executors keep those through all that follows.
    """

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for b in keys_of(batches):
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += len(held[-1])
            if size >= FLUSH:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        at, counts = np.unique(slots(np.concatenate(held), bits, hashes).ravel(), return_counts=True)
        cuts = np.flatnonzero(np.diff(at // SEGMENT)) + 1
        found = []
        for part, n in zip(np.split(at, cuts), np.split(counts, cuts), strict=True):
            offsets = (part % SEGMENT).astype("<u2")
            found.append((int(part[0] // SEGMENT), offsets[n == 1].tobytes(), offsets[n > 1].tobytes()))
        for i in range(0, len(found), 1000):
            yield batch(_PARTS, *zip(*found[i : i + 1000], strict=True))

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(SEGMENT, np.uint8)
        kept = np.zeros(SEGMENT, bool)
        for once, more in zip(parts["once"], parts["more"], strict=True):
            offsets = np.frombuffer(once, "<u2")
            kept[offsets[seen[offsets] > 0]] = True
            kept[np.frombuffer(more, "<u2")] = True
            seen[offsets] = 1
            seen[np.frombuffer(more, "<u2")] = 1
        packed = np.packbits(kept, bitorder="little").tobytes()
        return pd.DataFrame({"segment": parts["segment"].iloc[:1], "plane": [packed]})

    parts = rows.mapInArrow(positions, "segment int, once binary, more binary")
    planes = parts.groupBy("segment").applyInPandas(total, "segment int, plane binary")
    whole = np.zeros(bits // 8, np.uint8)
    for row in planes.toLocalIterator():
        whole[row["segment"] * SEGMENT // 8 :][: SEGMENT // 8] = np.frombuffer(row["plane"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(whole)
