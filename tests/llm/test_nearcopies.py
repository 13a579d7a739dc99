"""Wide fingerprints: lists against all pairs, and near copies of texts."""

import random

import numpy as np
import pytest

from seawake.llm import nearcopies
from seawake.llm.nearcopies import POSITIONS, _near, _octets, joined_up, most_bits, near_copy_groups, wide_fingerprint, without_similar
from tests.llm.brute import DOCS, Groups


def test_lists_are_joined_up_like_all_pairs():
    rng, most = np.random.default_rng(0), most_bits()
    for _ in range(60):
        base = rng.integers(-(2**63), 2**63 - 1, (3, 4))
        prints = []
        for _ in range(rng.integers(2, 70)):
            one = base[rng.integers(0, 3)].copy() if rng.random() < 0.8 else rng.integers(-(2**63), 2**63 - 1, 4)
            for _ in range(rng.integers(0, 40)):
                one[rng.integers(0, 4)] ^= np.int64(1) << np.int64(rng.integers(0, 63))
            prints.append(one)
        lanes, groups = np.array(prints), Groups()
        for i in range(len(lanes)):
            for j in range(i):
                if _near(lanes[i], lanes[j], most):
                    groups.link(i, j)
        want = [groups.root(i) for i in range(len(lanes))]
        got = joined_up(lanes, most).tolist()
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


@pytest.mark.parametrize("text", [None, "", " \n"])
def test_no_words_no_bits(text):
    assert not wide_fingerprint(text).any()


def test_fingerprints_ignore_case_space_and_repeats():
    assert (wide_fingerprint("A b  c\nd e f") == wide_fingerprint("a B c d e F")).all()
    assert (wide_fingerprint("x " * 5) == wide_fingerprint("x " * 5000)).all()
    assert _octets(wide_fingerprint("a")[None].view(np.int64)).shape == (1, POSITIONS)


def near_copies():
    """Groups whose copies are well inside the bound; a pair near it may fall on either side."""
    rng = random.Random(0)
    texts, at = {}, 0
    for group in range(25):
        base = [f"{rng.randrange(5000)}" for _ in range(400)]
        for copy in range(rng.randrange(1, 60) if group % 5 == 0 else 2):
            words = list(base)
            for _ in range(copy % 5):
                words[rng.randrange(400)] = f"e{rng.randrange(5000)}"
            texts[at] = (group, " ".join(words))
            at += 1
    return texts


def test_near_copies_are_one_group(spark):
    texts = near_copies()
    first = {}
    for i, (group, _) in texts.items():
        first.setdefault(group, i)
    rows = [(i, t, "r") for i, (_, t) in texts.items()]
    odd = [(9000, None, "r"), (9001, "", "r"), (None, texts[0][1], "r"), (9002, "few words", "r"), (9002, "few words", "r")]
    df = spark.createDataFrame(rows + odd, DOCS + ", row string").repartition(3)
    got = {(r["id"], r["component_id"]) for r in near_copy_groups(df).collect()}
    assert got == {(i, first[g]) for i, (g, _) in texts.items()} | {(9000, 9000), (9001, 9000), (9002, 9002)}
    left = without_similar(df)
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [*first.values(), 9000, 9002, 9002, None]))
    assert without_similar(df.limit(0)).count() == 0


def plain_shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def edited_copies():
    """Groups with 0 to 20 edits of 200 to 400 words: pairs at 0.7 to 0.85 among them."""
    rng, rows, at = random.Random(7), [], 0
    for group in range(20):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(200, 400))]
        for _ in range(40 if group == 0 else rng.randrange(2, 8)):
            words = list(base)
            for _ in range(rng.randrange(20 if group % 2 else 8)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(4000)}"
            rows.append((at, " ".join(words)))
            at += 1
    return rows


@pytest.mark.parametrize("bounds", [{}, {"dense": 2, "block": 4}])
def test_links_are_those_of_the_exact_similarity(spark, bounds, monkeypatch):
    monkeypatch.setattr(nearcopies, "TURNS", 1, raising=False)
    rows = edited_copies()
    sets, groups, near = {i: plain_shingles(t) for i, t in rows}, Groups(), 0
    for i in sets:
        for j in range(i):
            similarity = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            near += 0.7 <= similarity <= 0.85
            if similarity >= 0.8:
                groups.link(i, j)
    assert near > 50
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = {r["id"]: r["component_id"] for r in near_copy_groups(df, **bounds).collect()}
    assert got == {i: groups.root(i) for i in sets}


def edited(words, rng, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def test_copies_of_one_text_make_no_rows_for_their_pairs(spark, monkeypatch):
    rng, rows = random.Random(3), []
    base = [f"b{i}" for i in range(150)]
    texts = [*(edited(base, rng, 2 if i % 4 else 4) for i in range(300)), " ".join(base)]
    rows = list(enumerate(texts))
    made, verified = [], nearcopies._verified

    def counted(pairs, *rest):
        made.append(pairs.distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(nearcopies, "_verified", counted)
    sets, groups = {i: plain_shingles(t) for i, t in rows}, Groups()
    for i in sets:
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                groups.link(i, j)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = {r["id"]: r["component_id"] for r in near_copy_groups(df, dense=4, block=16).collect()}
    assert got == {i: groups.root(i) for i in sets}
    assert sum(made) < 10 * len(rows)


def test_meetings_send_no_more_links_than_members(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, edited(base, rng, 1)) for i in range(60)] + [(60, None), (61, "")]
    members = [(key, i, 5 * (i < 60), 0, i) for key in (1, 2) for i in range(62)]
    members = spark.createDataFrame(members, "key long, id long, n int, at int, root long").withColumn("n", nearcopies.F.when(nearcopies.F.col("n") > 0, 146).otherwise(0))
    found = nearcopies._meetings(members, spark.createDataFrame(rows, DOCS), 100, 5, 0.8)
    found = [(r["a"], r["b"]) for r in found.collect()]
    sets, groups, joined = {i: plain_shingles(t or "") for i, t in rows}, Groups(), Groups()
    for i in range(60):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                groups.link(i, j)
    groups.link(60, 61)
    for a, b in found:
        assert a < b
        joined.link(a, b)
    assert {i: joined.root(i) for i in range(62)} == {i: groups.root(i) for i in range(62)}
    assert len(found) < 2 * 62
