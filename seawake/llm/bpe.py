"""Byte-level BPE in batched numpy merge rounds.

Symbols of many words lie in one flat array.  A round looks up every pair of
neighbours by binary search in the sorted keys of mergeable pairs, takes the
lowest rank of each word, and merges its places from left to right; words
without a mergeable pair leave the array.  Only chunks a task has not met are
encoded (:mod:`seawake.llm.encoding`).  Decoding joins the bytes of the ids.

Defined cases: null and empty texts have no ids and decode to the empty text;
special tokens written out in a text are one id each, as the tokenizers
library reads them; a null id column passes through; repeated rows are
encoded each.  Bytes that are not UTF-8 decode to replacement characters.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import batch, strings
from seawake.llm.encoding import ChunkEncoder, byte_letters

#: Fixed value: the public word pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class NumpyBpe:
    """A byte-level BPE vocabulary in the JSON form of the tokenizers library."""

    def __init__(self, model: str):
        parsed = json.loads(model)
        vocab, merges = parsed["model"]["vocab"], parsed["model"]["merges"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        spell = {i: bytes(of_letter[c] for c in t) for t, i in vocab.items() if t not in self.special}
        spell |= {i: t.encode() for t, i in self.special.items()}
        self.bytes_of = [spell.get(i, b"") for i in range(max(spell) + 1)]
        self.words = regex.compile(PATTERN)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each (non-empty) word, as little-endian unsigned 32-bit integers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            pair = np.full(len(symbols), -1, np.int64)
            inside = np.flatnonzero(word[1:] == word[:-1])
            pair[inside] = symbols[inside] << 32 | symbols[inside + 1]
            at = np.searchsorted(self.keys, pair).clip(max=len(self.keys) - 1)
            rank = np.where(self.keys[at] == pair, self.ranks[at], len(self.keys))
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            best = np.repeat(best, np.diff(np.r_[starts, len(word)]))
            over = best == len(self.keys)
            done_symbols.append(symbols[over])
            done_words.append(word[over])
            hit = (rank == best) & ~over
            # of places that overlap (a symbol that repeats), every second one
            place = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            hit &= (place - run_start) % 2 == 0
            symbols = np.where(hit, self.merged[rank.clip(max=len(self.keys) - 1)], symbols)
            left = ~over & ~np.r_[False, hit[:-1]]
            symbols, word = symbols[left], word[left]
        flat, owner = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(words))
        raw = flat[order].astype("<u4").tobytes()
        ends = np.cumsum(counts) * 4
        return list(map(raw.__getitem__, map(slice, (ends - counts * 4).tolist(), ends.tolist())))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of short texts, as little-endian unsigned 32-bit integers."""
        parts: list[list[bytes | int]] = []
        for t in texts:
            if self.parts is not None and self.parts.search(t):
                own: list[bytes | int] = []
                for i, p in enumerate(self.parts.split(t)):
                    own += [self.special[p]] if i % 2 else [w.encode() for w in self.words.findall(p)]
                parts.append(own)
            else:
                parts.append([w.encode() for w in self.words.findall(t)])
        words = list({w for own in parts for w in own if isinstance(w, bytes)})
        ids: dict[bytes | int, bytes] = {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        for at in range(0, len(words), 50_000):
            some = words[at : at + 50_000]
            ids.update(zip(some, self.encode_words(some), strict=True))
        return [b"".join(map(ids.__getitem__, own)) for own in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids, special tokens written out."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").encode()


@lru_cache(2)
def worker_bpe(model: str) -> tuple[NumpyBpe, ChunkEncoder]:
    bpe = NumpyBpe(model)
    return bpe, ChunkEncoder(bpe.encode_many, "kept", bpe.special)


def model_text(path: str) -> str:
    """A tokenizer's file, read by the driver; its size is that of the vocabulary."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (binary, little-endian unsigned 32-bit) of each whole text."""
    schema = pa.schema([("id", pa.int64()), ("ids", pa.binary())])
    model = docs.sparkSession.sparkContext.broadcast(model_text(tokenizer))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = worker_bpe(model.value)
        for b in batches:
            yield batch(schema, b.column(0), encoder(strings(b.column(1))))

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(of, "id long, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``text`` of each row of ids; null ids give the empty text."""
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])
    model = encoded.sparkSession.sparkContext.broadcast(model_text(tokenizer))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = worker_bpe(model.value)
        for b in batches:
            yield batch(schema, b.column(0), [bpe.decode(np.frombuffer(x.as_py() or b"", "<u4")).decode() for x in b.column(1)])

    rows = encoded.select(F.col(id_col).cast("long"), F.col(ids_col))
    return rows.mapInArrow(of, "id long, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text and decode its ids in one task; digests of both, so that neither leaves it."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    model = docs.sparkSession.sparkContext.broadcast(model_text(tokenizer))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = worker_bpe(model.value)
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                ids = encoder(strings(part.column(1)))
                texts = (bpe.decode(np.frombuffer(x, "<u4")) for x in ids)
                sha = [hashlib.sha256(x).hexdigest() for x in ids]
                yield batch(schema, part.column(0), [len(x) // 4 for x in ids], sha, [hashlib.sha256(t).hexdigest() for t in texts])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(of, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
