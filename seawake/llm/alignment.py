"""Alignment of two tokenizers' tokens by their bytes.

Texts are cut into chunks where both tokenizers cut for certain: before a
space or line feed that follows neither white space nor the sign that stands
for a space.  A task tokenizes and aligns each chunk once.  New chunks are
aligned by the batch: ``merge_asof`` within each chunk finds, for the start of
each token of one side, the token of the other side that covers it; both
directions together are all overlaps, and overlaps whose ends are equal are
the ends of groups, and links.

Documents then keep their links as pairs of ids with how often they occur.
Spark counts each pair over the corpus and each B id's highest count.  The most
frequent pairs, up to a bound, are broadcast; all others are joined.

Defined cases: null and empty texts, and texts whose tokens do not give back
the text after a space, have no tokens, zeros and an empty column; a null id
passes through; rows of one id are aligned each, and repeated rows count each;
of equal highest counts all are highest; an empty table has no rows; texts of
any length are read whole; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.bpe import byte_letters, model_text
from seawake.llm.common import in_pieces, stored, strings
from seawake.llm.encoding import Library

#: Sign for a space in pieces of side B.
BLANK = "▁"
#: Characters with the property White_Space.
_WHITE = r"\t-\r \x85\xa0  -     　"
#: Runs of white space with what follows; a chunk ends before a space or line feed only.
_CHUNK = regex.compile(rf"[ \n](?:[^ \n]++|(?<=[{_WHITE}{BLANK}])[ \n])*+")
#: A space or line feed where chunks do not end; texts without one are cut by plain splitting.
_INNER = regex.compile(rf"[{_WHITE}{BLANK}][ \n]")
#: Chunks that a worker keeps with their alignment.
KEPT_CHUNKS = 350_000
#: Bound of the broadcast pairs: 17 bytes each.
HOT_PAIRS = 1 << 20
#: Links that a task holds before their counts leave it.
FLUSH = 1 << 22
_LOW = (1 << 32) - 1


Key = str | tuple[str]


def chunks(text: str) -> list[Key]:
    """Keys of the chunks of a text with a space before it."""
    text = " " + text
    if _INNER.search(text):
        return [(c,) for c in _CHUNK.findall(text)]
    return text[1:].replace("\n", " \n").split(" ")


def spelled(key: Key) -> str:
    """The chunk of a key: a tuple has it as it is, a text from a line feed on or without its first space."""
    return key[0] if isinstance(key, tuple) else key if key[:1] == "\n" else " " + key


class ByteSide:
    """Side A: a byte-level vocabulary of the tokenizers library."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        from tokenizers import Tokenizer

        self.library, self.tokenizer = Library(model, "kept"), Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(of_letter.get(c, 0) for c in token)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and how many each has."""
        if any(s in p for s in self.specials for p in parts):
            found = [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        else:  # many parts in one call
            found = self.library.short_texts(parts)
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64), np.fromiter(map(len, found), np.int64, len(found)) // 4


class PieceSide:
    """Side B: a sentencepiece model, which puts a space before a text."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)
        size = self.processor.get_piece_size()
        pieces = [self.processor.id_to_piece(i) for i in range(size)]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = self.processor.piece_to_id(BLANK)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and how many each has.

        The space that the model adds is the part's own first one; before a
        line feed its token is left out.  To an empty text it adds nothing.
        """
        found = self.processor.encode([p.removeprefix(" ") for p in parts], num_threads=1)
        for i, part in enumerate(parts):
            if part == " ":
                found[i] = [self.blank]
            elif part[0] != " ":
                found[i] = found[i][1:]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of tokens (``a``, ``b``: row numbers) of two sides that share a byte.

    Rows: ``text`` and ``start`` of each token, in order; starts grow over all
    texts, and each text's tokens follow each other without a gap.
    """
    a, b = (x[["text", "start"]].assign(row=np.arange(len(x))) for x in (a, b))
    sides = []
    for left, right, names in ((a, b, ("a", "b")), (b, a, ("b", "a"))):
        found = pd.merge_asof(left, right, on="start", by="text", suffixes=("", "_other"))
        sides.append(pd.DataFrame({names[0]: found["row"], names[1]: found["row_other"]})[["a", "b"]])
    both = pd.concat(sides).dropna().astype("int64")
    codes = np.unique(both["a"].to_numpy() * max(1, len(b)) + both["b"].to_numpy())
    return pd.DataFrame({"a": codes // max(1, len(b)), "b": codes % max(1, len(b))})


class Aligner:
    """Alignments of chunks, kept up to a bound."""

    def __init__(self, model_a: str, model_b: bytes, kept: int = KEPT_CHUNKS):
        self.a, self.b, self.kept = ByteSide(model_a), PieceSide(model_b), kept
        self.lengths = [np.array(list(map(len, side.bytes_of)), np.int64) for side in (self.a, self.b)]
        # ids spelled with what follows them: inside or at the end of A's part of a group, of B's part
        self.names = [f"{i}{end}" for i in range(max(map(len, self.lengths))) for end in (",", "|", ",", ";")]
        self.clear()

    def clear(self) -> None:
        self.number: dict[Key, int] = {}
        self.text: list[str] = []
        self.whole = np.zeros(0, bool)
        self.sizes = np.zeros((0, 3), np.int64)
        self.links = np.zeros(0, np.int64)
        self.place = np.zeros(1, np.int64)
        #: Documents that had each chunk since the table was last shrunk.
        self.met = np.zeros(0, np.int64)

    def shrink(self) -> None:
        """Forget the chunks that only one document had, and more of the rare ones beyond half the bound."""
        kept = np.flatnonzero(self.met > 1)
        if len(kept) > self.kept // 2:
            kept = np.sort(kept[np.argsort(-self.met[kept], kind="stable")[: self.kept // 2]])
        starts, sizes = self.place[kept], self.place[kept + 1] - self.place[kept]
        self.links = self.links[_places(starts, sizes)]
        self.whole, self.sizes, self.place = self.whole[kept], self.sizes[kept], np.r_[0, np.cumsum(sizes)]
        keys = list(self.number)  # in the order of their numbers
        self.number = {keys[i]: n for n, i in enumerate(kept.tolist())}
        self.text = list(map(self.text.__getitem__, kept.tolist()))
        self.met = np.ones(len(kept), np.int64)

    def learn(self, keys: list[Key]) -> None:
        """Align chunks and keep what documents are put together from."""
        new = list(map(spelled, keys))
        raw = [c.encode() for c in new]
        whole, sides = np.ones(len(new), bool), []
        for side, lengths in zip((self.a, self.b), self.lengths, strict=True):
            ids, counts = side.encode(new)
            whole &= _same_bytes(raw, ids, counts, side.bytes_of)
            ends = np.cumsum(lengths[ids])
            sides.append(pd.DataFrame({"text": np.repeat(np.arange(len(new)), counts), "id": ids, "start": ends - lengths[ids], "end": ends}))
        if not whole.all():
            sides = [_kept(x, whole[x["text"]]) for x in sides]
        a, b = sides
        met = overlaps(a, b)
        at_a, at_b = met["a"].to_numpy(), met["b"].to_numpy()
        same = a["end"].to_numpy()[at_a] == b["end"].to_numpy()[at_b]
        at_a, at_b = np.sort(at_a[same]), np.sort(at_b[same])  # both in order of their ends, which grow over all chunks
        ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
        counts = np.bincount(a["text"].to_numpy()[at_a], minlength=len(new))
        tokens = [np.bincount(x["text"], minlength=len(new)) for x in sides]
        codes = _in_groups(ids_a, ids_b, at_a, at_b)
        names = list(map(self.names.__getitem__, codes.tolist()))
        cuts = np.r_[0, np.cumsum(tokens[0] + tokens[1])].tolist()
        self.number.update(zip(keys, range(len(self.text), len(self.text) + len(new)), strict=True))
        self.text += ["".join(names[x:y]) for x, y in zip(cuts, cuts[1:])]
        self.whole = np.r_[self.whole, whole]
        self.met = np.r_[self.met, np.zeros(len(new), np.int64)]
        self.sizes = np.r_[self.sizes, np.c_[tokens[0], tokens[1], counts]]
        self.place = np.r_[self.place, self.place[-1] + np.cumsum(counts)]
        self.links = np.r_[self.links, ids_a[at_a] << 32 | ids_b[at_b]]

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
        """For each text numbers of A tokens, B tokens and groups; the groups' digest; its linked pairs and their times."""
        nothing = np.zeros(3, np.int64), "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(texts), 256):
            cut = [chunks(t) if t else [] for t in texts[at : at + 256]]
            if len(self.number) > self.kept:
                self.shrink()
            new: set[Key] = set()
            for own in cut:
                new.update(filterfalse(self.number.__contains__, own))
            for low in range(0, len(fresh := list(new)), 50_000):
                self.learn(fresh[low : low + 50_000])
            for own in cut:
                n = np.fromiter(map(self.number.__getitem__, own), np.int64, len(own))
                self.met[n] += 1
                if not own or not self.whole[n].all():
                    yield nothing
                    continue
                starts, sizes = self.place[n], self.place[n + 1] - self.place[n]
                pairs, times = np.unique(self.links[_places(starts, sizes)], return_counts=True)
                groups = "".join(map(self.text.__getitem__, n.tolist()))[:-1]
                yield self.sizes[n].sum(axis=0), hashlib.sha256(groups.encode()).hexdigest(), pairs, times


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers of all places in ranges."""
    return np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())


def _same_bytes(raw: list[bytes], ids: np.ndarray, counts: np.ndarray, bytes_of: list[bytes]) -> np.ndarray:
    """Whether each chunk's tokens give back its bytes."""
    found = list(map(bytes_of.__getitem__, ids.tolist()))
    if b"".join(found) == b"".join(raw):  # and so each of them, unless bytes have gone over to a neighbour
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        places = np.r_[0, np.cumsum(sizes)][np.cumsum(counts)]
        if (places == np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))).all():
            return np.ones(len(raw), bool)
    ends = np.cumsum(counts)
    return np.array([b"".join(found[e - n : e]) == r for e, n, r in zip(ends.tolist(), counts.tolist(), raw, strict=True)], bool)


def _kept(tokens: pd.DataFrame, kept: pd.Series | np.ndarray) -> pd.DataFrame:
    """The tokens of whole chunks, placed one after the other."""
    left = tokens[np.asarray(kept)].reset_index(drop=True)
    ends = (left["end"] - left["start"]).cumsum()
    return left.assign(start=ends - (left["end"] - left["start"]), end=ends)


def _in_groups(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Numbers of names of all tokens, group by group, A's tokens before B's."""
    out = np.zeros(len(ids_a) + len(ids_b), np.int64)
    rows_a, rows_b = np.arange(len(ids_a)), np.arange(len(ids_b))
    group_a, group_b = np.searchsorted(ends_a, rows_a), np.searchsorted(ends_b, rows_b)
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[ends_a], last_b[ends_b] = 1, 1
    out[rows_a + np.r_[0, ends_b + 1][group_a]] = ids_a * 4 + last_a
    out[rows_b + (ends_a + 1)[group_b]] = ids_b * 4 + 2 + last_b
    return out


@lru_cache(1)
def _aligner(model_a: str, model_b: bytes) -> Aligner:
    return Aligner(model_a, model_b)


def aligned(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document ``id``, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256``, and its links as ``pairs`` and ``times``."""
    schema = pa.schema(
        [("id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups")), ("groups_sha256", pa.string())]
        + [("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
    )
    with open(tokenizer_b, "rb") as file:
        models = docs.sparkSession.sparkContext.broadcast((model_text(tokenizer_a), file.read()))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = _aligner(*models.value)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                found = list(align(strings(part.column(1))))
                sizes = np.array([f[0] for f in found], np.int64).reshape(-1, 3)
                ends = np.cumsum([0, *(len(f[2]) for f in found)]).astype(np.int32)
                flat = (np.concatenate([f[k] for f in found]) for k in (2, 3))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(t))) for x, t in zip(flat, (np.int64, np.int32), strict=True)]
                columns = [part.column(0), *map(pa.array, sizes.T), pa.array([f[1] for f in found], pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(of, "id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair``, ``links`` over all documents, and whether that is the highest of the pair's B id (``best``)."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append((b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy()))
            size += len(held[-1][0])
            if size >= FLUSH:
                held = [_summed(held)]
                size = len(held[0][0])
                if size >= FLUSH // 2:
                    yield from in_pieces(schema, list(held[0]))
                    held, size = [], 0
        if size:
            yield from in_pieces(schema, list(_summed(held)))

    counts = links.select("pairs", "times").mapInArrow(sums, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("links"))
    counts = stored(counts.withColumn("b", F.col("pair").bitwiseAND(_LOW)), "pair-counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return stored(counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best")), "pairs")


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    return pairs, np.bincount(at, np.concatenate([h[1] for h in held]), len(pairs)).astype(np.int64)


def _frequent(counts: DataFrame, most: int) -> int:
    """The least power of two such that at most so many pairs have as many links."""
    sizes = {r["level"]: r["count"] for r in counts.groupBy(F.length(F.bin("links")).alias("level")).count().collect()}
    total, least = 0, 63
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > most:
            break
        least = level
    return 1 << (least - 1)


def alignment(
    docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """One row per document: sizes, links, the counts of its links over the corpus, and a digest of its groups."""
    links = stored(aligned(docs, tokenizer_a, tokenizer_b, id_col, text_col), "alignments")
    counts = pair_counts(links)
    least = _frequent(counts, hot_pairs)
    hot = counts.filter(F.col("links") >= least).toArrow()
    codes = hot["pair"].to_numpy()
    order = np.argsort(codes)
    shared = docs.sparkSession.sparkContext.broadcast((codes[order], hot["links"].to_numpy()[order], hot["best"].to_numpy()[order]))
    schema = pa.schema(
        [("row", pa.string()), ("id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum"))]
        + [("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
    )

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, links, best = shared.value
        for b in batches:
            pairs, times = b.column(5), b.column(6)
            flat, weight = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            sizes = np.diff(pairs.offsets.to_numpy())
            owner = np.repeat(np.arange(len(b)), sizes)
            at = np.minimum(np.searchsorted(codes, flat), max(0, len(codes) - 1))
            known = codes[at] == flat if len(codes) else np.zeros(len(flat), bool)
            total, top = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            np.add.at(total, owner[known], weight[known] * links[at[known]])
            np.add.at(top, owner[known], weight[known] * best[at[known]])
            ends = np.r_[0, np.cumsum(np.bincount(owner[~known], minlength=len(b)))].astype(np.int32)
            rest = [pa.ListArray.from_arrays(ends, pa.array(x[~known].astype(t))) for x, t in ((flat, np.int64), (weight, np.int32))]
            # a name for each row that has pairs left
            names = [os.urandom(16).hex() if n else None for n in np.diff(ends).tolist()]
            columns = [pa.array(names, pa.string()), *b.columns[:4], pa.array(top), pa.array(total), b.column(4), *rest]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    wanted = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in list(schema)[:8])
    found = links.mapInArrow(looked_up, f"{wanted}, pairs array<long>, times array<int>")
    columns = [F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links")]
    if least == 1:
        return found.select(*columns, "n_best", "count_sum", "groups_sha256")
    found = stored(found, "alignments-found")
    rest = found.filter("row IS NOT NULL").select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rest = rest.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    rest = rest.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("links")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    joined = found.join(rest, "row", "left")
    sums = [(F.col(c) + F.coalesce(f"more_{m}", F.lit(0))).alias(c) for c, m in (("n_best", "best"), ("count_sum", "sum"))]
    return joined.select(*columns, *sums, "groups_sha256")
