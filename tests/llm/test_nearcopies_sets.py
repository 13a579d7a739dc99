"""Whole shingle sets of near copies are made and sent for few documents, and few times."""

import random
from collections import Counter

import numpy as np
import pytest

from seawake.llm import nearcopies
from seawake.llm.nearcopies import near_copy_groups
from tests.llm.brute import DOCS, Groups
from tests.llm.test_nearcopies import edited, plain_shingles


@pytest.mark.parametrize("dense", [128, 4])
def test_texts_with_a_common_line_send_no_sets(spark, monkeypatch, dense):
    """They are pairs of short lists, or members of long ones, and not alike."""
    rng = random.Random(11)
    line = " ".join(f"l{i}" for i in range(30))
    texts = [f"{line} {' '.join(f'w{rng.randrange(10**9)}' for _ in range(70))}" for _ in range(40)]
    texts += [texts[0] + " more", texts[1].replace("l29", "l29 odd")]
    made, stored = Counter(), nearcopies.stored

    def counted(df, name):
        out = stored(df, name)
        made[name] += out.count()
        return out

    monkeypatch.setattr(nearcopies, "stored", counted)
    monkeypatch.setattr(nearcopies, "_common", lambda docs, words: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))  # the line stays in the prefixes
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    got = {r["id"]: r["component_id"] for r in near_copy_groups(df, dense=dense, block=8).collect()}
    assert got == {i: i for i in range(40)} | {40: 0, 41: 1}
    assert made["near-sets"] < 30  # of 42 documents


def test_documents_that_share_many_lists_meet_once(spark, monkeypatch, tmp_path):
    rng = random.Random(13)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, edited(base, rng, 3)) for i in range(60)]
    sets = {i: plain_shingles(t) for i, t in rows}
    members = [(key, i, len(sets[i]), key % 7, i) for key in range(40) for i in range(60) if (key + i) % 9]
    members += [(40 + i // 30, i, len(sets[i]), 0, i) for i in range(60)]
    members = spark.createDataFrame(members, "key long, id long, n int, at int, root long")
    seen, spanning = str(tmp_path / "seen"), nearcopies._spanning

    def counted(n, *rest):
        with open(seen, "a") as f:
            f.write(f"{len(n)}\n")
        return spanning(n, *rest)

    monkeypatch.setattr(nearcopies, "_spanning", counted)
    found = nearcopies._meetings(members, spark.createDataFrame(rows, DOCS), 20, 5, 0.8)
    want, joined = Groups(), Groups()
    for i in range(60):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                want.link(i, j)
    for r in found.collect():
        joined.link(r["a"], r["b"])
    assert {i: joined.root(i) for i in range(60)} == {i: want.root(i) for i in range(60)}
    with open(seen) as f:
        assert sum(map(int, f)) < 1000
