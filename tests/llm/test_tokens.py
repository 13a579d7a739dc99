"""Token ids, token files and packing against the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seawake.llm import bpe, packing, queries, tokenfile
from seawake.llm.common import shared_folder
from seawake.llm.encoding import ChunkEncoder, library_encoder
from tests.llm.brute import DOCS

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [
    " ", "  ", "\n", "\n\n", " \n", "\t", "\r", "a", "b", "it's", "'", "foo,", "bar.", "<|endoftext|>", "<", "|>", "Σ", "ΑΣ", "é", "e\u0301", "\u0301",
    "\xa0", "\x1c", "!", "12", "你好", "🙂", "aaaaaaa", "\u2003", "the", "İ", "ﬁ", "\x00",
]
DOCUMENTS = [(1, "Hello world, it's  here.\n\nNew"), (2, None), (3, ""), (4, "word " * 30_000), (2, "<|endoftext|> x"), (None, "no id")]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(15))) for _ in range(n)]


def library_ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_own_merges_are_those_of_the_library():
    texts = random_texts(5000, 1) + ["x" * 5000, "ab" * 999, " " * 300, "\n" * 50 + "y"]
    own, encoder = bpe.worker_bpe(bpe.model_text(BYTES))
    assert encoder(texts) == library_ids(BYTES, texts)
    assert own.encode_many(texts) == library_ids(BYTES, texts)


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, "kept"), (WORDS, "dropped")])
def test_chunks_do_not_change_ids(path, spaces):
    texts = random_texts(5000, 2)
    assert library_encoder(bpe.model_text(path), spaces)(texts) == library_ids(path, texts)


def test_encoder_forgets_and_goes_on():
    own, _ = bpe.worker_bpe(bpe.model_text(BYTES))
    encoder = ChunkEncoder(own.encode_many, "kept", own.special, kept=50)
    texts = random_texts(2000, 3)
    assert encoder(texts) == library_ids(BYTES, texts)
    assert len(encoder.ids) < 2000 and len(encoder.older) < 2000


def test_decoding_is_that_of_the_library():
    own, _ = bpe.worker_bpe(bpe.model_text(BYTES))
    tokenizer = Tokenizer.from_file(BYTES)
    rng = random.Random(4)
    for _ in range(300):  # also ids whose bytes are no UTF-8
        ids = [rng.randrange(50_257) if rng.random() < 0.5 else rng.randrange(256) for _ in range(rng.randrange(12))]
        assert own.decode(np.array(ids, "<u4")).decode() == tokenizer.decode(ids, skip_special_tokens=False)


def test_round_trip_through_frames(spark):
    df = spark.createDataFrame([(*r, 1) for r in DOCUMENTS], DOCS + ", ids int")
    encoded = bpe.encode(df, BYTES)
    want = [(i, x) for (i, _), x in zip(DOCUMENTS, library_ids(BYTES, [t or "" for _, t in DOCUMENTS]), strict=True)]
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in encoded.collect()), key=str) == sorted(want, key=str)
    back = sorted(((r["doc_id"], r["text"]) for r in bpe.decode(encoded, BYTES).collect()), key=str)
    assert back == sorted([(i, t or "") for i, t in DOCUMENTS], key=str)
    counts = sorted((str(r["doc_id"]), r["n_tokens"]) for r in bpe.round_trip(df, BYTES).collect())
    assert counts == sorted((str(i), len(x) // 4) for i, x in want)
    assert bpe.round_trip(df.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_planes_and_index(bits):
    rng = np.random.default_rng(0)
    docs = []
    for i in range(120):
        top = int(rng.choice([1, 2, 300, 50_257, 2**32 - 1]))
        docs.append((i or None, rng.integers(0, top, rng.integers(0, 200)).astype("<u4").tobytes()))
    file = tokenfile.in_memory(docs, 64, bits)
    assert [(i, ids.tobytes()) for i, _, ids in file.documents()] == docs
    whole = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    for _ in range(50):
        a, b = sorted(rng.integers(0, len(whole) + 1, 2).tolist())
        assert (file.ids(a, b) == whole[a:b]).all()
    assert {n for _, n, _ in file.blocks[:-1]} == {64}
    assert list(tokenfile.in_memory([], 64, bits).documents()) == []


def test_a_cut_file_is_refused():
    import io

    out = io.BytesIO()
    writer = tokenfile.Writer(out)
    writer.add(1, b"\1\0\0\0")
    writer.close()
    cut = out.getvalue()[:-3]
    with pytest.raises(ValueError, match="not whole"):
        tokenfile.Reader(io.BytesIO(cut), len(cut))


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, bits):
    folder = shared_folder(spark, "tokens")
    df = spark.createDataFrame([(*r, "x") for r in DOCUMENTS], DOCS + ", part string").repartition(3)
    manifest = tokenfile.write_token_files(df, folder, BYTES, bits=bits, block=128)
    got = tokenfile.read_token_files(spark, folder, manifest).orderBy("start").collect()
    ordered = sorted(DOCUMENTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [x + bytes(4) for x in library_ids(BYTES, [t or "" for _, t in ordered])]
    starts = np.cumsum([0] + [len(x) // 4 for x in ids[:-1]]).tolist()
    assert [(r["doc_id"], r["start"], bytes(r["ids"])) for r in got] == [(i, s, x) for (i, _), s, x in zip(ordered, starts, ids, strict=True)]


def test_no_documents_give_no_file(spark):
    folder = shared_folder(spark, "tokens")
    manifest = tokenfile.write_token_files(spark.createDataFrame([], DOCS), folder, BYTES)
    assert manifest.count() == 0
    assert tokenfile.read_token_files(spark, folder, manifest).count() == 0


@pytest.mark.parametrize("groups", [1, 8, 2048])
def test_plans_place_every_length_once(groups):
    rng = random.Random(groups)
    for _ in range(30):
        capacity = rng.choice([10, 64, 2048])
        counts = {n: rng.randint(1, 60) for n in rng.sample(range(1, capacity + 1), rng.randint(0, min(capacity, 150)))}
        placed: Counter = Counter()
        for lengths, times in packing.plan(counts, capacity, groups):
            assert sum(lengths) <= capacity and times > 0
            for n in lengths:
                placed[n] += times
        assert placed == counts


def test_plans_are_near_the_bound():
    rng = random.Random(0)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 0.8)) + 1) for _ in range(20_000))
    least = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert sum(t for _, t in packing.plan(dict(counts))) <= 1.01 * least


def check_packing(rows, docs, capacity):
    ids = library_ids(WORDS, [t or "" for _, t in docs])
    want = Counter()
    for (doc_id, _), x in zip(docs, ids, strict=True):
        x += bytes(4)
        for i in range(0, len(x), 4 * capacity):
            want[doc_id, i // 4 // capacity, i // 4, len(x[i : i + 4 * capacity]) // 4, zlib.crc32(x[i : i + 4 * capacity])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places: dict = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing(spark):
    docs = DOCUMENTS + [(10 + i, "some words " * (i % 7)) for i in range(60)]
    df = spark.createDataFrame([(*r, 1, 2) for r in docs], DOCS + ", length int, part int").repartition(3)
    packed = packing.pack(packing.pieces(df, WORDS, 64), 64).withColumnRenamed("id", "doc_id")
    rows = packed.collect()
    sequences = check_packing(rows, docs, 64)
    assert sequences <= 1.05 * -(-sum(r["length"] for r in rows) // 64)
    empty = packing.pack(packing.pieces(df.limit(0), WORDS))
    assert empty.count() == 0


def test_pieces_carry_their_ids(spark):
    df = spark.createDataFrame(DOCUMENTS, DOCS)
    rows = packing.pieces(df, WORDS, 100, with_ids=True).select("ids_crc32", F.crc32("ids").alias("crc"), "length", F.length("ids").alias("n"))
    assert all(r["ids_crc32"] == r["crc"] and r["n"] == 4 * r["length"] for r in rows.collect())


def test_registered_queries(spark, tmp_path):
    docs = [r for r in DOCUMENTS if r[0] not in (2, None)] + [(7, "A b"), (5, "c")]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op5_best_fit_packing(spark, str(tmp_path)).collect()
    check_packing(rows, docs, 2048)
    ordered = sorted(docs)
    ids = library_ids(BYTES, [t or "" for _, t in ordered])
    at, want = 0, []
    for (doc_id, _), x in zip(ordered, ids, strict=True):
        want.append((doc_id, at, len(x) // 4 + 1, zlib.crc32(x + bytes(4))))
        at += len(x) // 4 + 1
    files = queries.op2_token_files(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in files] == want
