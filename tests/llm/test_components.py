"""Components in a logarithmic number of rounds."""

import math
import random

import pytest

from seawake.llm import components as module
from seawake.llm.components import components
from tests.llm.brute import Groups


def chain(order):
    return list(zip(order, order[1:]))


def alternating(n):
    """Ids that go up and down, so that half of them are local minima."""
    low, high = list(range(n // 2)), list(range(n // 2, n))
    random.Random(1).shuffle(low)
    random.Random(2).shuffle(high)
    return [x for pair in zip(low, high) for x in pair]


@pytest.mark.parametrize("order, most", [(list(range(2000)), 15), (list(range(2000, 0, -1)), 15), (alternating(600), 60)])
def test_rounds_of_long_chains(spark, monkeypatch, order, most):
    stores, plain = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: stores.append(name) or plain(df, name))
    got = dict(components(spark.createDataFrame(chain(order), "a long, b long")).collect())
    assert got == dict.fromkeys(order, min(order))
    assert len(stores) <= most and stores.count("edges") - 1 <= 2 * math.log2(len(order))


def test_stars_of_stars_and_repeated_edges(spark):
    rng = random.Random(4)
    edges = [(0, i * 50) for i in range(1, 20)] + [(i * 50, i * 50 + j) for i in range(1, 20) for j in range(1, 30)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(180)] + edges[:50]
    groups = Groups()
    for a, b in edges:
        groups.link(a, b)
    got = dict(components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect())
    assert got == {n: groups.root(n) for n in groups.parent if any(n in e and e[0] != e[1] for e in edges)}
