"""Token ids of whole texts, with each chunk of text encoded once per task.

A text is cut where its tokens cannot depend on what lies on the other side;
ids of the chunks are kept in a bounded table, so that only chunks not seen
before reach the encoder.  The ids are those of the whole text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from functools import cached_property

import numpy as np

#: Chunks in the newer half of a worker's table; when it is full it becomes the older half.
KEPT_CHUNKS = 350_000
#: Marks at the end of a word never share a token with its last letter or digit; only well-known ones are cut.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MARK_SET = frozenset(_MARKS)
_ENDS = frozenset(c for c in map(chr, range(0x250)) if c.isalnum() and (c < "\x80" or c >= "À") and len(c.lower()) == 1)
_PLAIN = re.compile("[" + "".join(sorted(c for c in _ENDS if c.isalpha())) + "]+")
#: A special token ends the run like the end of a text does.
_OTHER_SPACE = re.compile(r"[^\S \n]")
_SPACED = re.compile(r"[ \n]*[^ \n]+|[ \n]+")

EncodeMany = Callable[[list[str]], list[bytes]]
#: Ids of words of letters that follow a space, or None if they cannot be told apart.
EncodeWords = Callable[[list[str]], list[bytes] | None]


class ChunkEncoder:
    """Encodes batches of texts to little-endian unsigned 32-bit ids.

    ``encode_many`` gives the ids of short texts.  With ``spaces`` "kept", a
    token may begin with one space and white space makes tokens (byte-level
    vocabularies): a cut is before a space or line feed that ends a run of
    white space or begins one.  With "dropped", white space separates words.
    Text with other arrangements of white space is cut at runs of it, or not
    at all.
    """

    def __init__(
        self, encode_many: EncodeMany, spaces: str, specials: Iterable[str] = (), kept: int = KEPT_CHUNKS, encode_words: EncodeWords | None = None
    ):
        self.encode_many, self.kept, self.encode_words = encode_many, kept, encode_words
        ends = "|".join([r"\s", r"\Z", *map(re.escape, specials)])
        # a separator within or at the end of a run of white space that a token may hold whole: no cut is safe there
        self.inner_space = re.compile(rf"\s[ \n](?:{ends})")
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")
        self.spaces_kept = spaces == "kept"
        self.cut = self._cut_kept if spaces == "kept" else self._cut_dropped
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 256):
            pieces = [self.cut(t) for t in texts[at : at + 256]]
            if len(self.ids) > self.kept:
                self.ids, self.older = {}, self.ids
            found = [list(map(self.ids.get, p)) for p in pieces]
            gaps = [[i for i, ids in enumerate(f) if ids is None] if None in f else [] for f in found]
            new: set[str] = set()
            for p, gap in zip(pieces, gaps, strict=True):
                new.update(map(p.__getitem__, gap))
            if new:
                self._learn(new)
            for p, f, gap in zip(pieces, found, gaps, strict=True):
                for i in gap:
                    f[i] = self.ids[p[i]]
                out.append(b"".join(f))
        return out

    def _learn(self, keys: set[str]) -> None:
        """Add keys; a word with marks at its end is put together from both."""
        if self.older:
            old = list(filter(self.older.__contains__, keys))
            self.ids.update(zip(old, map(self.older.__getitem__, old), strict=True))
            keys.difference_update(old)
        split: list[tuple[str, str, str]] = []
        special = self.special.search("\0".join(keys)) is not None
        ended = [k for k in keys if k[-1:] in _MARK_SET]
        keys.difference_update(ended)
        for k in ended:
            base = k.rstrip(_MARKS)
            if base[-1:] in _ENDS and not (special and self.special.search(k)):
                marks = "\r" + k[len(base) :] if self.spaces_kept else k[len(base) :]
                split.append((k, base, marks))
                if base not in self.ids:
                    keys.add(base)
                if marks not in self.ids:
                    keys.add(marks)
            else:
                keys.add(k)
        if self.encode_words is not None:
            plain = [k for k in keys if k.isascii() and k.isalpha() or _PLAIN.fullmatch(k)]
            found = self.encode_words(plain)
            if found is not None:
                self.ids.update(zip(plain, found, strict=True))
                keys.difference_update(plain)
        rest = list(keys)
        self.ids.update(zip(rest, self.encode_many([self.spelled(k) for k in rest]), strict=True))
        self.ids.update((k, self.ids[a] + self.ids[b]) for k, a, b in split)

    # keys of chunks: "\r" + text for a chunk taken as it is, else the text after a space, or from a line feed on
    @staticmethod
    def spelled(key: str) -> str:
        return key[1:] if key[:1] == "\r" else key if key[:1] == "\n" else " " + key

    def _cut_kept(self, text: str) -> list[str]:
        if self.inner_space.search(text):
            chunks = [text] if _OTHER_SPACE.search(text) else _SPACED.findall(text)
            return ["\r" + c for c in chunks]
        pieces = text.replace("\n", " \n").split(" ")
        pieces[0] = "\r" + pieces[0]
        if "\r" in text:  # such a piece would read as a key of another kind
            pieces[1:] = ["\r " + p if p[:1] == "\r" else p for p in pieces[1:]]
        return pieces

    @staticmethod
    def _cut_dropped(text: str) -> list[str]:
        pieces = text.replace("\n", " ").split(" ")
        return ["\r" + p if p[:1] == "\r" else p for p in pieces] if "\r" in text else pieces


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Library:
    """A model of the tokenizers library, made from the text of its file, that encodes short texts and words."""

    def __init__(self, model: str, spaces: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        from tokenizers import Tokenizer

        self.tokenizer, self.spaces = Tokenizer.from_str(model), spaces
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        special = [t for t in added.items() if t[1].special and not (t[1].lstrip or t[1].rstrip or t[1].single_word)]
        self.mark_id, self.mark = (special[0][0], special[0][1].content) if special else (-1, None)
        parsed = json.loads(model)
        cut = parsed["pre_tokenizer"] or {}
        plain = parsed["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        #: A space and a word of letters are one word to the model, spelled with the letters of their bytes.
        self.spelling = dict(enumerate(byte_letters())) if plain and spaces == "kept" and not any(t.strip().isalpha() for t in self.added) else None
        # for each id whether its token begins a word (with the letter for a space) or ends one
        vocabulary = self.tokenizer.get_vocab()
        self.marks = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.marks[i] = token.startswith("Ġ") if spaces == "kept" else token.endswith("</w>")

    def short_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of short texts; many go through one call, with a special token between them."""
        out: list[bytes] = []
        for at in range(0, len(texts), 1000):
            some = texts[at : at + 1000]
            if self.mark and not any(self.mark in t for t in some):
                ids = np.array(self.tokenizer.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids, "<u4")
                cuts = np.flatnonzero(ids == self.mark_id) * 4
                raw = ids.tobytes()
                out += map(raw.__getitem__, map(slice, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)]))
            else:
                out += [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def words(self, words: list[str]) -> list[bytes] | None:
        """Ids of words of letters: by the model itself where their spelling is known, else in one text.

        In a text a word's first token begins with a space, or its last ends a word.
        """
        out: list[bytes] = []
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            if self.spelling is not None:
                ids, bounds = self._spelled(some)
            else:
                ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
                cuts = np.flatnonzero(self.marks[ids])
                if len(cuts) != len(some):
                    return None
                bounds = np.r_[cuts, len(ids)] if self.spaces == "kept" else np.r_[0, cuts + 1]
            raw, bounds = ids.tobytes(), bounds * 4
            out += map(raw.__getitem__, map(slice, bounds[:-1].tolist(), bounds[1:].tolist()))
        return out

    def _spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space before it, and the bounds of the words."""
        tokens = self.tokenizer.model.tokenize
        ids, bounds = [], [0]
        for w in words:
            spelled = "Ġ" + w if w.isascii() else (" " + w).encode().decode("latin-1").translate(self.spelling)
            ids += [t.id for t in tokens(spelled)]
            bounds.append(len(ids))
        return np.array(ids, "<u4"), np.array(bounds)


def library_encoder(model: str, spaces: str, kept: int = KEPT_CHUNKS) -> ChunkEncoder:
    """An encoder for a tokenizers model, given as the text of its file."""
    library = Library(model, spaces)
    return ChunkEncoder(library.short_texts, spaces, library.added, kept, library.words)


class SharedEncoder:
    """Value of a broadcast: the model's text travels, and each worker makes one encoder of it.

    The encoder and the chunks it keeps last as long as the worker holds the
    broadcast: over the tasks of a job, and not into the stages after it.
    """

    def __init__(self, model: str, spaces: str, kept: int = KEPT_CHUNKS):
        self.model, self.spaces, self.kept = model, spaces, kept

    def __reduce__(self):
        return SharedEncoder, (self.model, self.spaces, self.kept)

    @cached_property
    def encoder(self) -> ChunkEncoder:
        return library_encoder(self.model, self.spaces, self.kept)
