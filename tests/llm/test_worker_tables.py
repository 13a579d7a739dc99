"""Tables of workers go with their broadcast, and words keep the library's ids."""

import pickle
import random

import numpy as np
import public_tokenizers

from seawake.llm.bpe import model_text
from seawake.llm.encoding import Library, SharedEncoder

BYTES = model_text(public_tokenizers.path("byte_bpe_50k.json"))
WORDS = model_text(public_tokenizers.path("word_bpe_49k.json"))


def test_encoders_travel_without_their_tables_and_are_not_shared():
    for model, spaces in ((BYTES, "kept"), (WORDS, "dropped")):
        one = SharedEncoder(model, spaces)
        assert one.encoder is one.encoder and one.encoder(["some words"])
        other = pickle.loads(pickle.dumps(one))
        assert "encoder" not in vars(other)
        assert other.encoder is not one.encoder and not other.encoder.ids
        assert other.encoder(["some words"]) == one.encoder(["some words"])


def test_words_by_the_model_are_those_of_whole_texts():
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZéèüßñÿÀÖ"
    words = ["a", "the", "ß", *("".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(2000))]
    library = Library(BYTES, "kept")
    assert library.spelling is not None and Library(WORDS, "dropped").spelling is None
    want = [np.array(e.ids, "<u4").tobytes() for e in library.tokenizer.encode_batch([" " + w for w in words], add_special_tokens=False)]
    assert library.words(words) == want


def test_the_size_of_the_table_travels_and_changes_no_ids():
    text = " ".join(f"{w}{e}" for w in ("alpha", "beta", "gamma", "delta") for e in ("", ",", "ly", "ness!"))
    small = pickle.loads(pickle.dumps(SharedEncoder(BYTES, "kept", 3)))
    assert small.encoder.kept == 3
    for _ in range(3):
        assert small.encoder([text] * 2) == SharedEncoder(BYTES, "kept").encoder([text] * 2)
