"""Substring deduplication with suffix automata of reference shards.

A window is ``window`` (35) consecutive words.  Words are removed that lie in a
window whose word sequence also starts elsewhere, in the same document or in
another.

1. Each window chooses an anchor: of its runs of ``GRAM`` words, the first
   with the smallest hash.  Equal windows choose equal anchors, so anchors say
   which windows can be equal at all; about one word in fourteen is one.
2. A Bloom filter of bounded size finds anchors that may occur again.  Only
   the passages around those are sent anywhere: the words of all windows that
   chose the anchor.
3. Passages of an anchor meet in one reference shard.  The shard's suffix
   automaton is built from its distinct passages, and each passage is streamed
   through what was built before it: where the matching statistic reaches the
   window, that window and its first occurrence are repeats.  Automata stay
   where their passages are and are never larger than ``HOT`` passages.
   Sending every automaton to every task would compare all shards with all
   documents, which grows with the square of the corpus.
4. An anchor with more than ``HOT`` passages (a passage that very many
   documents share) is not put in one shard: its windows are counted by a
   128-bit hash of their words, over all tasks.
5. Ranges return to their documents, and maximal spans are cut out.

Defined cases: null and empty texts have no words; texts shorter than a window
lose nothing, nor does a text that occurs once; documents are told apart by id
and text, so a null id, an id with several texts and repeated rows work, and
rows that repeat in both lose all their windows; further columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import batch, mixed, shuffle_partitions, stored, strings
from seawake.llm.repeats import filter_bits, marked, repeated_keys

WINDOW = 35
GRAM = 8
HOT = 1000
BITS_PER_ANCHOR = 16
HASHES = 2
#: Bytes whose arrays are held at once (or one longer text), and words whose hashes a task keeps.
CHUNK_BYTES = 1 << 20
KEPT_WORDS = 200_000
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class WordHashes:
    """64-bit hashes of words, each computed once per task."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        for w in set(filterfalse(self.known.__contains__, words)):
            self.known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def rolled(hashes: np.ndarray, width: int, factor: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    out = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for j in range(width):
        out = out * np.uint64(factor) + hashes[j : j + len(out)]
    return mixed(out)


def anchors(hashes: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of documents that lie one after another: hash, first window, last window, document."""
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none.astype(np.uint64), none, none, none
    grams = rolled(hashes, gram, _FACTORS[0])
    best = np.arange(len(grams))
    width, need = 1, window - gram + 1
    while width < need:
        step = min(width, need - width)
        left, right = best[:-step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        width += step
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)[: len(best)]
    starts = np.flatnonzero(np.arange(len(best)) + window <= ends[doc])
    own = best[starts]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else none
    last = np.r_[first[1:] - 1, len(own) - 1] if len(own) else none
    return grams[own[first]], starts[first], starts[last], doc[starts[first]]


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE = _FACTORS[0]
_BYTE_INVERSE = pow(_BYTE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _byte_powers(n: int) -> list[np.ndarray]:
    """Powers of the byte factor and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        _powers[:] = [np.r_[np.uint64(1), np.cumprod(np.full(size, f, np.uint64))] for f in (_BYTE, _BYTE_INVERSE)]
    return _powers


def _chunks(texts: list[str]) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents in bounded chunks: number of the first, bytes, starts and ends of words, their hashes, words of each.

    Hashes are sums of bytes times powers, taken from running sums; they only
    choose anchors, so that equal hashes of different words change no result.
    """
    raw: list[bytes] = []
    at = size = 0
    for i, text in enumerate(texts):
        raw.append(text.encode("utf-8", "surrogatepass"))
        size += len(raw[-1]) + 1
        if size <= CHUNK_BYTES and i < len(texts) - 1:
            continue
        whole = b"\n".join(raw)
        data = np.frombuffer(whole, np.uint8)
        inside = np.r_[False, ~_SPACE[data], False]
        starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        power, inverse = _byte_powers(len(data))
        sums = np.r_[np.uint64(0), np.cumsum((data + np.uint64(1)) * power[: len(data)])]
        hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
        bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
        lengths = np.diff(np.searchsorted(starts, bounds))
        yield at, whole, starts, ends, hashes, lengths
        raw, size, at = [], 0, i + 1


class SuffixAutomaton:
    """Online suffix automaton of passages; states know where they ended first."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _copy(self, state: int, length: int) -> int:
        self.next.append(self.next[state].copy())
        self.link.append(self.link[state])
        self.length.append(length)
        self.first.append(self.first[state])
        return len(self.next) - 1

    def _redirect(self, p: int, word: str, old: int, new: int) -> None:
        while p != -1 and self.next[p].get(word) == old:
            self.next[p][word] = new
            p = self.link[p]

    def add(self, words: list[str], number: int) -> None:
        """Insert a passage; its word i ends at place ``number << 32 | i``."""
        last = 0
        for i, word in enumerate(words):
            known = self.next[last].get(word)
            if known is not None:
                if self.length[known] != self.length[last] + 1:
                    copy = self._copy(known, self.length[last] + 1)
                    self.link[known] = copy
                    self._redirect(last, word, known, copy)
                    known = copy
                last = known
                continue
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            self.first.append(number << 32 | i)
            state, p = len(self.next) - 1, last
            while p != -1 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p != -1:
                q = self.next[p][word]
                if self.length[q] != self.length[p] + 1:
                    copy = self._copy(q, self.length[p] + 1)
                    self.link[q] = copy
                    self._redirect(p, word, q, copy)
                    q = copy
                self.link[state] = q
            last = state

    def repeats(self, words: list[str], window: int) -> list[tuple[int, int]]:
        """Stream a passage: (place of the word, first place) for each end of a window that is known."""
        out = []
        state = matched = 0
        nexts, link, length = self.next, self.link, self.length
        for i, word in enumerate(words):
            while state and word not in nexts[state]:
                state = link[state]
                matched = length[state]
            if word in nexts[state]:
                state = nexts[state][word]
                matched += 1
                if matched >= window:
                    while length[link[state]] >= window:
                        state = link[state]
                        matched = length[state]
                    out.append((i, self.first[state]))
        return out


def repeated_windows(passages: list[str], counts: list[int], window: int) -> list[bytearray]:
    """For each distinct passage, which of its windows occur more than once in all of them."""
    words = [p.split(" ") for p in passages]
    flags = [bytearray(b"\1" if c > 1 else b"\0") * (len(w) - window + 1) for w, c in zip(words, counts, strict=True)]
    automaton = SuffixAutomaton()
    for number, own in enumerate(words):
        if number:
            for end, first in automaton.repeats(own, window):
                flags[number][end - window + 1] = 1
                flags[first >> 32][(first & 0xFFFFFFFF) - window + 1] = 1
        if number < len(words) - 1:
            automaton.add(own, number)
    return flags


def _spans(flags: bytearray, window: int) -> list[tuple[int, int]]:
    """Maximal spans of words that flagged windows cover."""
    out = []
    at = flags.find(1)
    while at != -1:
        last, stop = at, at + window
        while (after := flags.find(1, last + 1, stop + 1)) != -1:
            last, stop = after, after + window
        out.append((at, stop))
        at = flags.find(1, last + 1)
    return out


_RANGES = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
_PASSAGES = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("passage", pa.string())])
_RANGES_DDL = "id long, digest long, start int, stop int"
_PASSAGES_DDL = "anchor long, id long, digest long, start int, passage string"


def _rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))


def repeated_ranges(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """Ranges of words to remove, (id, digest of the text, start, stop); they may overlap."""
    rows = _rows_of(docs, id_col, text_col)
    n = shuffle_partitions(docs.sparkSession)
    letters = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = filter_bits(letters // 6 * 2 // (window - gram + 2), BITS_PER_ANCHOR)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for *_, hashes, lengths in _chunks(strings(b.column(0))):
                yield batch(pa.schema([("key", pa.int64())]), anchors(hashes, lengths, window, gram)[0].view(np.int64))

    plane = repeated_keys(rows.select("text"), bits, HASHES, keys)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, digests = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at, whole, starts, ends, hashes, lengths in _chunks(strings(b.column(2))):
                key, first, last, doc = anchors(hashes, lengths, window, gram)
                again = marked(key, plane.value, bits, HASHES)
                key, first, last, doc = key[again], first[again], last[again], doc[again]
                places = first - (np.cumsum(lengths) - lengths)[doc]
                low, high = starts[first].tolist(), ends[last + window - 1].tolist()
                for piece in range(0, len(key), 20_000):
                    part = slice(piece, piece + 20_000)
                    d = (doc[part] + at).tolist()
                    words = [b" ".join(whole[x:y].split()).decode("utf-8", "surrogatepass") for x, y in zip(low[part], high[part], strict=True)]
                    yield batch(_PASSAGES, key[part].view(np.int64), [ids[x] for x in d], [digests[x] for x in d], places[part], words)

    around = stored(rows.mapInArrow(passages, _PASSAGES_DDL), "passages")
    crowded = stored(around.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor"), "crowded-anchors")
    crowds = not crowded.isEmpty()
    usual = around.join(crowded, "anchor", "left_anti") if crowds else around
    shards = usual.select("anchor", "id", "digest", "start", "passage").repartition(n, "anchor").sortWithinPartitions("anchor")
    ranges = shards.mapInArrow(_shard(window), _RANGES_DDL)
    return ranges.union(_crowded_ranges(around.join(crowded, "anchor", "left_semi"), window)) if crowds else ranges


def _shard(window: int):
    """Ranges of the passages of each anchor; a run of equal anchors is at most ``hot`` rows."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_anchor = None
        for b in batches:
            anchor = b.column(0).to_numpy(zero_copy_only=False)
            ids, digests, starts, texts = (b.column(i).to_pylist() for i in (1, 2, 3, 4))
            cuts = np.r_[0, np.flatnonzero(np.diff(anchor)) + 1, len(anchor)].tolist()
            rows: list[tuple] = []
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if x and y - x == 1 and y < cuts[-1]:
                    continue  # an anchor that came once after all
                own = list(zip(ids[x:y], digests[x:y], starts[x:y], texts[x:y], strict=True))
                if held_anchor is not None and held_anchor == anchor[x]:
                    held += own
                else:
                    rows += _of_anchor(held, window)
                    held, held_anchor = own, anchor[x]
            if rows:
                yield batch(_RANGES, *zip(*rows, strict=True))
        if rows := _of_anchor(held, window):
            yield batch(_RANGES, *zip(*rows, strict=True))

    return ranges


def _of_anchor(rows: list[tuple], window: int) -> list[tuple]:
    """Ranges of the passages (id, digest, start, passage) of one anchor."""
    if len(rows) < 2:
        return []
    own: dict[str, list[tuple]] = {}
    for doc_id, digest, start, passage in rows:
        own.setdefault(passage, []).append((doc_id, digest, start))
    if len(own) == 1:  # copies only: all of it repeats
        size = rows[0][3].count(" ") + 1
        return [(doc_id, digest, start, start + size) for doc_id, digest, start, _ in rows]
    flags = repeated_windows(list(own), [len(x) for x in own.values()], window)
    return [
        (doc_id, digest, start + a, start + b)
        for places, flag in zip(own.values(), flags, strict=True)
        for a, b in _spans(flag, window)
        for doc_id, digest, start in places
    ]


def _crowded_ranges(around: DataFrame, window: int) -> DataFrame:
    """Ranges of anchors with very many passages, counted over all tasks.

    A Bloom filter of window hashes cuts each passage down to the windows that
    may come again.  What is left of a shared passage is the same text for all
    that share it, and is counted once for each text; only windows of distinct
    texts are counted one by one.
    """
    texts = stored(around.groupBy("passage").agg(F.least(F.count(F.lit(1)), F.lit(2)).alias("times")), "crowded-texts")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = WordHashes()
        for b in batches:
            found = [
                np.tile(rolled(words_of(p.encode("utf-8", "surrogatepass").split()), window, _FACTORS[0]), times)
                for p, times in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            ]
            yield batch(pa.schema([("key", pa.int64())]), np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))

    bits = filter_bits(texts.count() * window, BITS_PER_ANCHOR)
    plane = repeated_keys(texts, bits, HASHES, keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = WordHashes()
        schema = pa.schema([f for f in _PASSAGES if f.name != "anchor"])
        for b in batches:
            rows = []
            for doc_id, digest, start, passage in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = passage.encode("utf-8", "surrogatepass").split()
                again = marked(rolled(words_of(words), window, _FACTORS[0]), plane.value, bits, HASHES)
                for x, y in _spans(bytearray(again.tobytes()), 1):
                    rows.append((doc_id, digest, start + x, b" ".join(words[x : y + window - 1]).decode("utf-8", "surrogatepass")))
            if rows:
                yield batch(schema, *zip(*rows, strict=True))

    parts = around.select("id", "digest", "start", "passage").mapInArrow(cut, _PASSAGES_DDL.split(", ", 1)[1])
    return _counted_ranges(stored(parts, "crowded-parts"), window)


def _counted_ranges(around: DataFrame, window: int) -> DataFrame:
    """Ranges of passages (id, digest, start, passage): passages, then windows, counted over all tasks."""
    texts = stored(around.groupBy("passage").agg(F.count(F.lit(1)).alias("times")), "crowded-passages")
    columns = [("first", pa.int64()), ("second", pa.int64()), ("passage", pa.string()), ("at", pa.int32())]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = WordHashes()
        for b in batches:
            for passage in b.column(0).to_pylist():
                hashes = words_of(passage.encode("utf-8", "surrogatepass").split())
                one, two = (rolled(hashes, window, f) for f in _FACTORS)
                yield batch(pa.schema(columns), one.view(np.int64), two.view(np.int64), [passage] * len(one), np.arange(len(one)))

    once = texts.filter("times = 1").select("passage").mapInArrow(windows, "first long, second long, passage string, at int")
    often = texts.filter("times > 1").select("passage").mapInArrow(windows, "first long, second long, passage string, at int")
    once = stored(once.select("first", "second", F.xxhash64("passage").alias("own"), "at"), "crowded-windows")
    known = once.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    known = known.union(often.select("first", "second", F.lit(2).cast("long"))).groupBy("first", "second").agg(F.sum("n").alias("n"))
    known = stored(known.filter("n > 1").select("first", "second"), "crowded-known")
    found = once.join(known, ["first", "second"]).select("own", "at")
    spans = stored(found.groupBy("own").agg(F.collect_set("at").alias("at")), "crowded-found")
    whole = texts.filter("times > 1").select(F.xxhash64("passage").alias("own"), F.lit(None).cast("array<int>").alias("at"))
    marks = stored(spans.union(whole), "crowded-marks")
    rows = around.withColumn("own", F.xxhash64("passage")).join(marks, "own")
    last = F.size(F.split("passage", " ")) - window
    return rows.select("id", "digest", "start", "at", last.alias("last")).mapInArrow(_merged(window), _RANGES_DDL)


def _merged(window: int):
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, digest, start, at, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                flags = bytearray(b"\1" if at is None else b"\0") * (last + 1)
                for i in at or ():
                    flags[i] = 1
                rows += [(doc_id, digest, start + x, start + y) for x, y in _spans(flags, window)]
            if rows:
                yield batch(_RANGES, *zip(*rows, strict=True))

    return ranges


def _covered(words: int, starts, stops) -> np.ndarray:
    """Whether each word is in a range."""
    steps = np.zeros(words + 1, np.int32)
    if starts is not None:
        np.add.at(steps, np.asarray(starts, np.int64), 1)
        np.add.at(steps, np.asarray(stops, np.int64), -1)
    return np.cumsum(steps[:-1]) > 0


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``row`` (all columns of the document), text, and its ranges as two arrays."""
    ranges = repeated_ranges(docs, id_col, text_col, window).select("id", "digest", F.struct("start", "stop").alias("range"))
    ranges = stored(ranges.groupBy("id", "digest").agg(F.collect_set("range").alias("ranges")), "ranges")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"), F.xxhash64(text).alias("own"), F.col(id_col).cast("long").alias("own_id"))
    joined = rows.join(ranges, (F.col("own") == F.col("digest")) & F.col("own_id").eqNullSafe(F.col("id")), "left")
    return joined.select("row", "text", F.col("ranges.start").alias("starts"), F.col("ranges.stop").alias("stops"))


def substring_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of each document."""

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def digest(text: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(text, starts, stops, strict=True):
            words = t.encode("utf-8", "surrogatepass").split()
            gone = _covered(len(words), a, b) if a is not None else None
            kept = words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256"])

    rows = _with_ranges(docs, id_col, text_col, window)
    return rows.select(F.col("row").getField(id_col).alias(id_col), digest("text", "starts", "stops").alias("d")).select(id_col, "d.*")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents with repeated spans cut from their texts.

    A text that loses words is its other words joined by single spaces, and
    may be empty; a text that loses none is unchanged, null too.
    """

    @F.pandas_udf("string")
    def cut(text: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        out = []
        for t, a, b in zip(text, starts, stops, strict=True):
            if a is None:
                out.append(None)
                continue
            words = t.encode("utf-8", "surrogatepass").split()
            gone = _covered(len(words), a, b).tolist()
            out.append(b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode("utf-8", "surrogatepass"))
        return pd.Series(out, dtype=object)

    rows = _with_ranges(docs, id_col, text_col, window)
    rows = rows.withColumn("cut", cut("text", "starts", "stops"))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c != text_col]
    text = F.when(F.col("starts").isNull(), F.col("row").getField(text_col)).otherwise(F.col("cut")).alias(text_col)
    return rows.select(*kept, text).select(*docs.columns)
