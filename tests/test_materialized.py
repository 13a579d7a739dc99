"""Frames kept on shared storage."""

from pyspark.sql import functions as F

from seawake.session import materialized


def test_stored_frames_are_compressed_columns(spark):
    rows = spark.range(50_000).select("id", F.lit("the same text in every row").alias("text"))
    kept = materialized(rows)
    assert kept.schema.simpleString() == rows.schema.simpleString() and kept.count() == 50_000
    files = kept.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
