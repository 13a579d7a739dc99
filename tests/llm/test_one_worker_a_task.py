"""Tasks of the repeated-key filter run one Python step, so that a slot needs one worker."""

from seawake.llm import substrings


def test_keys_are_made_in_the_worker_that_counts_them(spark, monkeypatch):
    given, count = [], substrings.repeated_keys

    def watched(rows, *more):
        given.append(rows._jdf.queryExecution().executedPlan().toString())
        return count(rows, *more)

    monkeypatch.setattr(substrings, "repeated_keys", watched)
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, f"a{i} {passage} z{i}") for i in range(9)] + [(9, "nothing that comes again here"), (10, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = substrings.repeated_ranges(docs, window=6, gram=2, hot=4).collect()
    covered = {i: {w for r in found if r["id"] == i for w in range(r["start"], r["stop"])} for i in range(11)}
    assert covered == {i: set(range(1, 13)) if i < 9 else set() for i in range(11)}
    assert len(given) == 2 and not any("MapInArrow" in plan for plan in given)
