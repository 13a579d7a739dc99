"""The near-copy stage goes through the fingerprints' byte-position index."""

from seawake.llm import nearcopies, simhash
from seawake.llm.nearcopies import near_copy_groups
from tests.llm.brute import DOCS


def test_fingerprints_find_near_copies_and_links_are_verified(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "_pairs", lambda similarity, dense: lambda batches: iter(()))  # no pairs by prefixes
    words = [f"w{i}" for i in range(3000)]
    odd = [*words[:1500], "odd", *words[1500:]]
    apart = [f"v{i}" for i in range(3000)]
    repeated = ["x"] * 4000  # one distinct shingle, which weighs as much as all the others in a fingerprint
    texts = {1: words, 2: odd, 3: apart, 4: words, 5: repeated, 6: [*repeated, "a", "b", "c", "d", "e"]}
    texts = {i: " ".join(t) for i, t in texts.items()}
    near = [bin(simhash.fingerprint(texts[a], 5) ^ simhash.fingerprint(texts[b], 5)).count("1") for a, b in ((1, 2), (5, 6))]
    assert max(near) <= 4
    df = spark.createDataFrame(list(texts.items()), DOCS).repartition(3)
    got = {r["id"]: r["component_id"] for r in near_copy_groups(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6}
