"""Tasks that count windows are few and send each window once."""

import numpy as np
from pyspark.sql import functions as F

from seawake.llm import collocations


def test_readers_keep_the_words_of_windows():
    read = collocations.Reader()
    ids, *_ = read([b"one two three four"])
    before = read.hashes[ids]
    read.keep(np.array([1, 3]))
    again, *_ = read([b"four two five"])
    assert again.tolist() == [1, 0, 2] and list(read.numbers) == [b"two", b"four", b"five"]
    assert read.hashes[:2].tolist() == before[[1, 3]].tolist()


def test_many_small_partitions_are_counted_by_few_tasks(spark):
    texts = [(i, "en", "good morning all you" if i % 2 else f"odd{i} good morning") for i in range(400)]
    rows = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(50).select("lang", "text")
    counted = collocations.counted_windows(rows, collocations.SEGMENT, 100)
    assert f"Repartition {2 * spark.sparkContext.defaultParallelism}, false" in counted._jdf.queryExecution().optimizedPlan().toString()
    found = {(r["w1"], r["w2"], r["w3"], r["w4"]): r["n"] for r in counted.filter(F.col("w1").isNotNull()).collect()}
    assert found[("good", "morning", "all", "you")] == 200 and found[("good", "morning", None, None)] == 200
