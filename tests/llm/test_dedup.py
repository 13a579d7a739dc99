"""Exact, SimHash, substring and embedding deduplication against plain versions."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from seawake.llm import repeats, substrings
from seawake.llm.common import runs, stored
from seawake.llm.components import components
from seawake.llm.embeddings import least_collisions, near_vectors
from seawake.llm.exact import exact_groups, without_copies
from seawake.llm.simhash import TRIPLES, fingerprint, links, simhash_components, without_near_copies
from seawake.llm.substrings import SuffixAutomaton, repeated_ranges, substring_digests, without_repeats
from tests.llm.brute import DOCS, Groups, fingerprint_groups, simhash, substring_rows, vector_rows

CLASHING = "doc_id long, text string, row string, id string, h long, sha string, ranges int, digest string, anchor int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clashing(spark, docs):
    return spark.createDataFrame([(i, t, "r", "x", 1, "s", 2, "d", 3) for i, t in docs], CLASHING)


# --- shared pieces ---------------------------------------------------------


@pytest.mark.parametrize("most", [3, 100])
def test_runs_never_split_a_key(most):
    rng = random.Random(most)
    for _ in range(100):
        keys = np.sort([rng.randrange(6) for _ in range(rng.randrange(40))]).astype(np.int64)
        batches, at = [], 0
        while at < len(keys):
            step = rng.randrange(8)
            batches.append(pa.record_batch({"key": pa.array(keys[at : at + step])}))
            at += step
        got = []
        for part, long in runs(batches, "key", most):
            got += part["key"].tolist()
            for k in set(part["key"].tolist()):
                whole = int((keys == k).sum())
                assert long == (whole > most)
                assert long or int((part["key"] == k).sum()) == whole
        assert sorted(got) == keys.tolist()


def test_bloom_filter_lets_every_repeat_through(spark):
    keys = list(range(2000)) + list(range(50))
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    bits = repeats.filter_bits(len(keys), 32)
    plane = repeats.repeated_keys(df, bits, 3).value
    hit = repeats.marked(np.arange(2000), plane, bits, 3)
    assert hit[:50].all()
    assert hit[50:].mean() < 0.05
    empty = repeats.repeated_keys(df.limit(0), bits, 3).value
    assert not repeats.marked(np.arange(9), empty, bits, 3).any()


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7), (1, 2), (2, 1), (None, 3)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    groups = Groups()
    for a, b in edges:
        if a is not None and a != b:
            groups.link(a, b)
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {n: groups.root(n) for n in groups.parent}
    assert rows_of(components(spark.createDataFrame([], "a long, b long"))) == []


# --- exact -------------------------------------------------------------------

EXACT = [(1, "Same"), (2, "sAME"), (3, "other"), (4, None), (5, ""), (6, "ÄB"), (7, "äB"), (8, "x" * 200_000), (9, "X" * 200_000)]


def test_exact_groups(spark):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(spark.createDataFrame(EXACT, DOCS)).collect()}
    assert got == {
        1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (5, 2, False), 5: (5, 2, True),
        6: (6, 1, True), 7: (7, 1, True), 8: (9, 2, False), 9: (9, 2, True),
    }


def test_exact_survivors_keep_all_columns(spark):
    docs = EXACT + [(2, "Same"), (None, "same"), (None, "alone"), (10, "one"), (10, "two")]
    out = without_copies(clashing(spark, docs))
    assert out.columns == clashing(spark, docs).columns
    ids = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert ids == sorted([2, 3, 5, 6, 7, 9, None, 10, 10], key=str)
    empty = spark.createDataFrame([], CLASHING)
    assert rows_of(without_copies(empty)) == [] and rows_of(exact_groups(empty)) == []


def test_exact_dedup_of_one_text_in_most_rows(spark):
    docs = [(i, "hot" if i % 3 else f"own {i}") for i in range(3000)]
    got = exact_groups(spark.createDataFrame(docs, DOCS)).groupBy("keep_id").count().collect()
    assert max((r["count"], r["keep_id"]) for r in got) == (2000, 2999)


# --- SimHash -------------------------------------------------------------------


def test_every_four_positions_hold_a_triple():
    assert len(TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in TRIPLES) for four in combinations(range(8), 4))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two three", "a b c d", "Á b\x0bc d e f a b c d", "x " * 5000, "no break space"])
def test_fingerprints(text):
    assert fingerprint(text) == simhash(text)


@pytest.mark.parametrize("dense", [512, 3])
def test_links_of_near_fingerprints(spark, dense):
    rng = random.Random(dense)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            other = base
            for _ in range(rng.randrange(0, 6)):
                other ^= 1 << rng.randrange(64)
            prints.add(other)
    own = dict(enumerate(sorted(prints)))
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in own.items()]
    edges = links(stored(spark.createDataFrame(signed, "fp long, rep long"), "prints"), dense)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    want = fingerprint_groups(own)
    assert {i: got.get(i, i) for i in own} == want
    assert len(set(want.values())) < len(want)


def near_texts():
    rng = random.Random(5)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(400)]
    other = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(300)]
    texts = [(i, " ".join(base[:200] + [f"w{i}"] + base[200:])) for i in range(5)]
    return texts + [(10, " ".join(other)), (11, " ".join(other).upper()), (12, None), (13, ""), (14, "two words"), (14, "two words")]


def test_simhash_components(spark):
    docs = near_texts() + [(None, "two words")]
    got = simhash_components(clashing(spark, docs)).collect()
    want = fingerprint_groups({i: simhash(t) for i, t in near_texts()})
    assert len(got) == len(docs)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got if r["doc_id"] is not None} == {
        (i, f"{simhash(t):016x}", want[i]) for i, t in near_texts()
    }
    assert rows_of(simhash_components(spark.createDataFrame([], DOCS))) == []


def test_one_near_copy_stays(spark):
    docs = near_texts()
    want = fingerprint_groups({i: simhash(t) for i, t in docs})
    out = without_near_copies(clashing(spark, docs))
    assert out.columns == CLASHING.replace(",", "").split()[::2]
    assert {r["doc_id"] for r in out.collect()} == set(want.values())


# --- substrings ------------------------------------------------------------------


def test_suffix_automaton_finds_first_places():
    rng = random.Random(2)
    for _ in range(200):
        passages = [[rng.choice("ab") for _ in range(rng.randrange(3, 14))] for _ in range(4)]
        automaton, window, seen = SuffixAutomaton(), 3, {}
        for number, words in enumerate(passages):
            want = [(i, seen[k]) for i in range(window - 1, len(words)) if (k := tuple(words[i - window + 1 : i + 1])) in seen]
            assert automaton.repeats(words, window) == want
            automaton.add(words, number)
            for i in range(window - 1, len(words)):
                seen.setdefault(tuple(words[i - window + 1 : i + 1]), number << 32 | i)


def passages(seed, n=80):
    rng = random.Random(seed)
    shared = [[rng.choice("abcdefgh") for _ in range(60)] for _ in range(4)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(5)):
            low = rng.randrange(20)
            words += rng.choice(shared)[low : low + rng.randrange(40)] if rng.random() < 0.6 else rng.choices("abcdefghijklmnop", k=rng.randrange(30))
        docs.append((None if i % 17 == 0 else i // 2 if i % 13 == 0 else i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words) if i % 11 else None))
    return docs + docs[:3] + [(900, ""), (901, "no break " * 40), (902, "short")]


@pytest.mark.parametrize(("gram", "hot"), [(4, 1000), (2, 3)])
def test_substring_digests(spark, monkeypatch, gram, hot):
    docs = passages(gram)
    monkeypatch.setattr(substrings, "repeated_ranges", lambda d, i, t, w: repeated_ranges(d, i, t, w, gram, hot))
    got = rows_of(substring_digests(clashing(spark, docs).repartition(3), window=12))
    want = sorted(substring_rows(docs, 12), key=str)
    assert got == want
    assert 0 < sum(x[2] for x in want) < sum(x[1] for x in want)


def test_cut_texts_keep_what_is_left(spark):
    words = [f"w{i}" for i in range(80)]
    passage = " ".join(words[:40])
    docs = [(1, "start " + passage + "\nend"), (2, passage), (3, " ".join(words[40:]) + "  tail\n"), (4, None)]
    out = without_repeats(clashing(spark, docs))
    assert out.columns == clashing(spark, docs).columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "start end", 2: "", 3: docs[2][1], 4: None}
    assert rows_of(without_repeats(spark.createDataFrame([], CLASHING))) == []


# --- embeddings --------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(0)
    rows, base = [], rng.standard_normal(16)
    for k in range(240):
        if k % 4 == 0:
            base = rng.standard_normal(16)
        rows.append((k, (base + 0.2 * rng.standard_normal(16)).tolist(), int(rng.integers(0, 2))))
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, None], []]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(1010, [1.0] * 16, None), (1011, [1e200] * 16, 1), (1012, [1e-200] * 16, 1)]
    return rows + [(1020, rows[5][1], rows[5][2]), (1021, rows[5][1], rows[5][2]), (1030, [1.0, 2.0], 1), (1031, [2.0, 4.0], 1)]


@pytest.mark.parametrize("block", [1024, 30])
def test_near_vectors(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, rep string, lead int")
    got = rows_of(near_vectors(df, block=block))
    scaled = [(i, [x * 1e-180 if i == 1011 else x * 1e180 for x in v] if i in (1011, 1012) else v, k) for i, v, k in rows]
    assert got == sorted(vector_rows(scaled), key=str)
    assert sum(r[1] for r in got) > 100


def test_near_vectors_of_nothing(spark):
    assert rows_of(near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>, label int"))) == []


def test_recall_at_the_threshold():
    """Pairs of exactly the least cosine collide often enough."""
    from math import sqrt

    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    other = 0.93 * a + sqrt(1 - 0.93**2) * b
    from seawake.llm.embeddings import directions

    collisions = (np.abs((a - other) @ directions(64)) <= sqrt(2 - 2 * 0.93)).sum(axis=1)
    assert (collisions >= least_collisions()).mean() > 0.998
