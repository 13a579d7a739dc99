"""Collocations: phrases of two to five words, counted and scored for each language.

1. *Slots.* Words and pairs of neighbours are counted in hashed slots, up to
   the least count of a candidate, and then the longer phrases all of whose
   pairs can be frequent.  A slot that does not reach that count holds no part
   of any candidate.  The slots grow with the corpus up to a bound; a fuller
   table lets more windows through and changes no result.
2. *Windows.* Each word begins a window: columns lead from it to the next four
   words, up to the end of the piece or of what can be frequent, and are null
   beyond.  Only these longest windows are counted.  Words that
   begin no frequent phrase are summed in one row of nulls.
3. *ROLLUP* over language and columns sums the windows to all their beginnings:
   a phrase's count is that of its row, and the language's row has all words.
   A part of a frequent phrase is frequent itself, so every count that a score
   needs is among the rows kept.
4. Cuts are joined with the counts of both parts; scores are exact decimals.

Defined cases: null and empty texts have no words; a null language counts as
``und``; pieces without words give nothing; repeated rows count each; equal
scores of cuts take the smaller k; equal phrases in the report cannot be, and
equal scores are ordered by count and then by the phrase's bytes; a language
without candidates has no rows, as has an empty table; texts of any length are
read whole, a batch of texts at a time; columns other than text and language
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.llm.common import GOLDEN, batch, mixed, shuffle_partitions, stored
from seawake.llm.repeats import SEGMENT

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
#: Bound of the slots: the broadcast has a bit for each, 32 MB at most.
MAX_SLOTS = 1 << 28
#: Words and pairs for each slot that a table of slots is made for.
SLOT_LOAD = 8
#: Windows or slots that a task holds before it sums them; words a worker keeps.
FLUSH = 1 << 20
KEPT_WORDS = 400_000
#: Text of a task that counts windows, where there are tasks for all cores: each task sends a frequent phrase once.
TASK_BYTES = 256 << 20
#: Texts that are split at once, by their bytes.
SPLIT_BYTES = 4 << 20
WORDS = [f"w{n}" for n in range(1, LONGEST + 1)]

# lower-case A-Z; marks and line ends end a piece, tabs are spaces
_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 10
_TABLE[9] = 32
_TABLE = bytes(_TABLE)
_BREAK, _SPACE = 10, 32
_ENDS = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")


class Numbers(dict):
    """Numbers of words, given when they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words of some texts; for each the number of its piece, and of its text."""
    data = b"\n".join(texts).translate(_TABLE)
    words = data.split()
    raw = np.frombuffer(data, np.uint8)
    gap = (raw == _BREAK) | (raw == _SPACE)
    starts = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
    breaks = np.flatnonzero(raw == _BREAK)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return words, np.searchsorted(breaks, starts), np.searchsorted(ends, starts, "right")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Languages (numbers of a list that ends each batch) and texts, a bounded number of bytes at a time."""
    for b in batches:
        languages, texts, at = [], [], 0
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            parts = _cut((text or "").encode())
            languages += [lang] * len(parts)
            texts += parts
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size == 0 or size + len(texts[end]) <= SPLIT_BYTES):
                size += len(texts[end]) + 1
                end += 1
            yield languages[at:end], texts[at:end]
            at = end


def _cut(text: bytes) -> list[bytes]:
    """A long text in parts that end with pieces."""
    if len(text) <= SPLIT_BYTES:
        return [text]
    cuts, at = [0], SPLIT_BYTES
    while found := _ENDS.search(text, at):
        cuts.append(found.end())
        at = found.end() + SPLIT_BYTES
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def _hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class Reader:
    """Words of batches of texts as numbers, with hashes that hold for all tasks."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers, self.hashes = Numbers(), np.zeros(0, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, piece, text = split_words(texts)
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if len(self.numbers) > len(self.hashes):
            new = list(self.numbers)[len(self.hashes) :]
            self.hashes = np.r_[self.hashes, _hashes(new)]
        return ids, piece, text

    def keep(self, used: np.ndarray) -> None:
        """Forget all words but those of some ascending numbers, which become 0, 1, ..."""
        words = list(self.numbers)
        self.numbers = Numbers((words[u], i) for i, u in enumerate(used.tolist()))
        self.hashes = self.hashes[used]

    @property
    def full(self) -> bool:
        return len(self.numbers) > KEPT_WORDS


def _slots(hashes: np.ndarray, seeds: np.ndarray, slots: int) -> np.ndarray:
    shift = np.uint64(64 - (slots.bit_length() - 1))
    return (mixed(hashes + seeds) >> shift).astype(np.int64)


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(GOLDEN) + second)


def _language_seeds(languages: list[str], text: np.ndarray) -> np.ndarray:
    names, at = np.unique(np.array(languages, object), return_inverse=True)
    return _hashes([n.encode() for n in names])[at][text]


def _follows(piece: np.ndarray) -> np.ndarray:
    """For each word, whether another one of its piece comes after it."""
    return np.r_[piece[1:] == piece[:-1], np.zeros(min(1, len(piece)), bool)]


def _frequent_pairs(hashes: np.ndarray, seeds: np.ndarray, piece: np.ndarray, plane: np.ndarray, slots: int) -> np.ndarray:
    """For each word, whether it may begin a frequent pair."""
    follows = _follows(piece)
    at = np.flatnonzero(follows)
    follows[at] = _flags(plane, _slots(_pair_hashes(hashes[at], hashes[at + 1]), seeds[at], slots))
    return follows


def frequent_slots(rows: DataFrame, slots: int, least: int, pairs: Broadcast[np.ndarray] | None = None) -> Broadcast[np.ndarray]:
    """Bits of the slots that at least so many words and pairs fall into; ``rows``: lang, text.

    With the slots of the pairs, those of longer phrases all of whose pairs are marked.
    """
    schema = pa.schema([("segment", pa.int32()), ("offsets", pa.binary()), ("counts", pa.binary())])
    most = min(least, 255)

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        at, counts = np.unique(np.concatenate(held), return_counts=True)
        if not len(at):
            return
        counts = np.minimum(counts, most).astype(np.uint8)
        cuts = np.flatnonzero(np.diff(at // SEGMENT)) + 1
        found = [
            (int(p[0] // SEGMENT), (p % SEGMENT).astype("<u2").tobytes(), n.tobytes())
            for p, n in zip(np.split(at, cuts), np.split(counts, cuts), strict=True)
            if len(p)
        ]
        for i in range(0, len(found), 1000):
            yield batch(schema, *zip(*found[i : i + 1000], strict=True))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, held, size = Reader(), [], 0
        for languages, texts in _parts(batches):
            ids, piece, text = read(texts)
            hashes, seeds = read.hashes[ids], _language_seeds(languages, text)
            if pairs is None:
                at = np.flatnonzero(_follows(piece))
                held += [_slots(hashes, seeds, slots), _slots(_pair_hashes(hashes[at], hashes[at + 1]), seeds[at], slots)]
                size += len(ids) + len(at)
            else:
                follows = _frequent_pairs(hashes, seeds, piece, pairs.value, slots)
                at = np.flatnonzero(follows)
                phrase = _pair_hashes(hashes[at], hashes[at + 1])
                for k in range(2, LONGEST):
                    on = follows[at + k - 1]
                    at, phrase = at[on], phrase[on]
                    phrase = _pair_hashes(phrase, hashes[at + k])
                    held.append(_slots(phrase, seeds[at], slots))
                    size += len(at)
            if size >= FLUSH:
                yield from flush(held)
                held, size = [], 0
            if read.full:
                read.clear()
        if size:
            yield from flush(held)

    planes = pa.schema([("segment", pa.int32()), ("plane", pa.binary())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a segment follow each other; one segment is held."""
        segment, counts = None, np.zeros(SEGMENT, np.int64)
        for b in batches:
            for own, offsets, added in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != segment:
                    if segment is not None:
                        yield batch(planes, [segment], [np.packbits(counts >= most, bitorder="little").tobytes()])
                    segment, counts = own, np.zeros(SEGMENT, np.int64)
                counts[np.frombuffer(offsets, "<u2")] += np.frombuffer(added, np.uint8)
        if segment is not None:
            yield batch(planes, [segment], [np.packbits(counts >= most, bitorder="little").tobytes()])

    found = rows.mapInArrow(positions, "segment int, offsets binary, counts binary")
    found = found.repartition(shuffle_partitions(rows.sparkSession), "segment").sortWithinPartitions("segment")
    whole = np.zeros(slots // 8, np.uint8)
    for row in found.mapInArrow(sums, "segment int, plane binary").toLocalIterator():
        whole[row["segment"] * SEGMENT // 8 :][: SEGMENT // 8] = np.frombuffer(row["plane"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(whole)


def _flags(plane: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (plane[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def counted_windows(rows: DataFrame, slots: int, least: int, size: int = 0) -> DataFrame:
    """``lang``, ``w1`` to ``w5`` (null beyond the window's end), ``n``: the longest windows, each counted.

    Texts of ``size`` bytes go to two tasks for each core, or to more of ``TASK_BYTES``.
    """
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES)
    marked = frequent_slots(rows, slots, least)
    longer = frequent_slots(rows, slots, least, marked)
    schema = pa.schema([("lang", pa.string()), *((w, pa.string()) for w in WORDS), ("n", pa.int64())])
    bits = 21

    def summed(windows: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Each window once, with the sum of its counts."""
        keys = list(windows.T)
        if words < 1 << bits:  # three columns in one integer and two in another, 0 for null
            keys = [(windows[:, 0] << 2 * bits) | (windows[:, 1] << bits) | windows[:, 2], (windows[:, 3] << bits) | windows[:, 4]]
        order = np.lexsort(keys[::-1])
        changed = np.zeros(max(0, len(order) - 1), bool)
        for key in keys:
            changed |= np.diff(key[order]) != 0
        first = np.flatnonzero(np.r_[len(order) > 0, changed])
        return windows[order[first]], np.add.reduceat(counts[order], first) if len(first) else counts[:0]

    def flush(read: Reader, held: dict[str, list], others: dict[str, int]) -> Iterator[pa.RecordBatch]:
        words = list(read.numbers)
        for lang, parts in held.items():
            windows, counts = summed(*map(np.concatenate, zip(*parts, strict=True)), len(words))
            for at in range(0, len(windows), 50_000):
                part = windows[at : at + 50_000]
                used, place = np.unique(part, return_inverse=True)
                texts = np.array([None if u == 0 else words[u - 1].decode() for u in used.tolist()], object)[place.reshape(part.shape)]
                yield batch(schema, [lang] * len(part), *texts.T, counts[at : at + 50_000])
        for lang, n in others.items():
            yield batch(schema, [lang], *[[None]] * LONGEST, [n])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, held, others, size, most = Reader(), {}, {}, 0, FLUSH
        for languages, texts in _parts(batches):
            ids, piece, text = read(texts)
            hashes, seeds = read.hashes[ids], _language_seeds(languages, text)
            follows = _frequent_pairs(hashes, seeds, piece, marked.value, slots)
            begins = np.flatnonzero(_flags(marked.value, _slots(hashes, seeds, slots)))
            windows = np.zeros((len(begins), LONGEST), np.int64)
            windows[:, 0] = ids[begins] + 1
            row = np.full(len(ids), -1)
            row[begins] = np.arange(len(begins))
            at = np.flatnonzero(follows & (row >= 0))
            windows[row[at], 1] = ids[at + 1] + 1
            phrase = _pair_hashes(hashes[at], hashes[at + 1])
            for k in range(2, LONGEST):
                on = follows[at + k - 1]
                at, phrase = at[on], phrase[on]
                phrase = _pair_hashes(phrase, hashes[at + k])
                on = _flags(longer.value, _slots(phrase, seeds[at], slots))
                at, phrase = at[on], phrase[on]
                windows[row[at], k] = ids[at + k] + 1
            language = np.array(languages, object)[text]
            for lang in set(languages):
                own = language == lang
                mine = windows[own[begins]]
                held.setdefault(lang, []).append((mine, np.ones(len(mine), np.int64)))
                others[lang] = others.get(lang, 0) + int(own.sum()) - len(mine)
            size += len(begins)
            if size >= most:  # windows that came again are one
                held = {x: [summed(*map(np.concatenate, zip(*parts, strict=True)), len(read.numbers))] for x, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                most = max(FLUSH, 2 * size)
            if full := read.full:  # words of no window go
                used = np.r_[True, np.zeros(len(read.numbers), bool)]
                for windows, _ in (x for parts in held.values() for x in parts):
                    used[windows] = True
                number = np.cumsum(used) - 1
                held = {x: [(number[windows], counts) for windows, counts in parts] for x, parts in held.items()}
                read.keep(np.flatnonzero(used[1:]))
                full = 2 * len(read.numbers) > KEPT_WORDS
            if size >= 4 * FLUSH or full:
                yield from flush(read, held, others)
                held, others, size, most = {}, {}, 0, FLUSH
                read.clear()
        yield from flush(read, held, others)

    names = ", ".join(f"{w} string" for w in WORDS)
    return rows.coalesce(tasks).mapInArrow(of, f"lang string, {names}, n long").groupBy("lang", *WORDS).agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (``lang``, ``words``, ``f``) of one to five words, and all words of each language (``lang``, ``n``)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    # about six bytes a word; a word counts itself and a pair
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = min(MAX_SLOTS, max(SEGMENT, 1 << (int(size / 3 / SLOT_LOAD)).bit_length()))
    windows = counted_windows(rows, slots, least, size)
    # how many of the columns a row of the roll-up has
    columns = len(WORDS) + 1 - F.length(F.replace(F.bin(F.grouping_id()), F.lit("0"), F.lit("")))
    sums = windows.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("set"), columns.alias("columns"))
    phrase = F.array(*WORDS)
    last = F.element_at(phrase, F.greatest(F.col("columns") - 1, F.lit(1)))
    kept = ((F.col("set") == (1 << LONGEST) - 1) | (F.col("columns") > 1) & last.isNotNull() & (F.col("f") >= least)) & (F.col("columns") > 0)
    sums = stored(sums.filter(kept).select("lang", F.slice(phrase, 1, F.col("columns") - 1).alias("words"), "f"), "phrases")
    return sums.filter(F.size("words") > 0), sums.filter(F.size("words") == 0).select("lang", F.col("f").alias("n"))


def collocations(
    docs: DataFrame, top: int = TOP, least: int = LEAST_COUNT, share: int = 100, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language.

    A candidate within a longer one of at least ``share`` per cent of its count is left out.
    """
    phrases, totals = phrase_counts(docs, least, text_col, lang_col)
    candidates = phrases.filter(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))
    best = _scored(candidates, phrases, totals)
    inner = _inner_counts(candidates)
    kept = best.join(inner, ["lang", "words"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    named = kept.withColumn("phrase", F.array_join("words", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _scored(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with the counts and the score of their lowest-scoring cut."""
    cuts = candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("words", F.lit(1), F.col("k"))).withColumn(
        "right", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))
    )
    left = phrases.select("lang", F.col("words").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("words").alias("right"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    score = F.expr("CAST(1000 AS DECIMAL(38,0)) * a * n DIV (CAST(l AS DECIMAL(20,0)) * CAST(r AS DECIMAL(18,0)))")
    both = both.withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    return both.groupBy("lang", "words").agg(F.first("a").alias("a"), F.first("n").alias("n"), lowest).select("lang", "words", "a", "n", "low.*")


def _inner_counts(candidates: DataFrame) -> DataFrame:
    """``longer``: the largest count of a longer candidate around each phrase that lies in one."""

    def parts(length: int) -> Column:
        size = F.size("words")
        starts = F.when(size > length, F.sequence(F.lit(1), size - length + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.slice("words", at, F.lit(length)))

    inner = reduce(lambda x, y: F.concat(x, y), [parts(n) for n in range(2, LONGEST)])
    rows = candidates.select("lang", F.explode(inner).alias("words"), "a")
    return rows.groupBy("lang", "words").agg(F.max("a").alias("longer"))
