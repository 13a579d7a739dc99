"""Bounded tables of workers keep what is met again, and results do not depend on them."""

import random

import numpy as np
import public_tokenizers

from seawake.llm import toxicity
from seawake.llm.alignment import Aligner
from seawake.llm.bpe import model_text


def test_chunks_met_again_survive_a_full_table():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        models = model_text(public_tokenizers.path("byte_bpe_50k.json")), file.read()
    rng = random.Random(1)
    texts = ["again and again", *(f"again {rng.randrange(10**9):x} and {rng.randrange(10**9):x}\n{rng.choice('abc')} x" for _ in range(900))]
    small, large = Aligner(*models, kept=300), Aligner(*models, kept=10**6)
    for x, y in zip(small(texts), large(texts), strict=True):
        assert x[1] == y[1] and all((x[i] == y[i]).all() for i in (0, 2, 3))
    small.shrink()
    assert {"again", "and"} <= set(small.number) and len(small.number) <= 150
    assert len(small.text) == len(small.whole) == len(small.sizes) == len(small.place) - 1 == len(small.met) == len(small.number)
    assert len(small.links) == small.place[-1]


def test_words_of_examples_stay_known(monkeypatch):
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 3)
    words = ["one", "two", "three"]
    vectors = toxicity.Vectors(np.sort(toxicity._hashed(words)), np.ones(3))
    for i in range(20):
        own = [*words, f"odd{i}"]
        got = vectors.numbers(own)
        assert sorted(got[:3].tolist()) == [0, 1, 2] and got[3] == -1
        assert set(words) <= set(vectors.known) and len(vectors.known) <= 3 + 5
