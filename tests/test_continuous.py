import pytest
from pyspark.errors import StreamingQueryException

from seawake.sources import tables
from seawake.streaming import incremental as inc
from seawake.streaming.continuous import load_batch, load_stream, progress
from tests.helpers import messages, track
from tests.test_incremental import FIELD, state_rows, unique
from tests.test_sessionize import random_tracks


def deliver(spark, folder, rows):
    """One more file of messages for the stream."""
    messages(spark, rows).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def stream(spark, folder, table):
    source = spark.readStream.schema(messages(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    query = load_stream(source, str(folder / "store"), table, FIELD, str(folder / "offsets"))
    query.awaitTermination()


def by_day(rows):
    days = sorted({r[2].date() for r in rows})
    return [[r for r in rows if r[2].date() == day] for day in days]


def test_stream_equals_one_load(spark, tmp_path):
    rows = unique(random_tracks(11))
    inc.load_increment(spark, messages(spark, rows), "streamed_at_once", min(r[2] for r in rows).date(), "2024-01-10", FIELD)
    want = state_rows(spark.table("streamed_at_once"))
    days = by_day(rows)
    assert len(days) > 2 and want
    late, days[0] = days[0][::3], [r for i, r in enumerate(days[0]) if i % 3]
    for day in days[:2]:
        deliver(spark, tmp_path, day)
    stream(spark, tmp_path, "streamed")
    for day in [*days[2:], late]:  # started again; some of the first day's messages come last
        deliver(spark, tmp_path, day)
    stream(spark, tmp_path, "streamed")
    assert state_rows(spark.table("streamed")) == want
    assert progress(spark, "streamed", "messages")[0] == len(days)
    stream(spark, tmp_path, "streamed")  # nothing new
    assert state_rows(spark.table("streamed")) == want


def test_interrupted_stream_goes_on(spark, tmp_path, monkeypatch):
    """Stop at every change of the catalog within the second batch, its record included; then start again."""
    rows = track([(i * 1800, 0.1 * i, 1.0) for i in range(6)], start="2024-01-31 23:00:00")
    days = by_day(rows)
    plain, step = tables.change_catalog, 0
    inc.load_increment(spark, messages(spark, rows), "whole_stream", "2024-01-31", "2024-02-02", FIELD)
    want = state_rows(spark.table("whole_stream"))
    while True:
        folder, table, done = tmp_path / str(step), f"stopped_stream_{step}", 0
        deliver(spark, folder, days[0])
        stream(spark, folder, table)
        deliver(spark, folder, days[1])

        def stop(session, statement):
            nonlocal done
            if done == step:
                raise InterruptedError(statement)
            done += 1
            plain(session, statement)

        monkeypatch.setattr(tables, "change_catalog", stop)
        try:
            stream(spark, folder, table)
            break
        except StreamingQueryException:
            pass
        finally:
            monkeypatch.setattr(tables, "change_catalog", plain)
        stream(spark, folder, table)
        assert state_rows(spark.table(table)) == want
        step += 1
    assert step >= 4


def test_odd_batches(spark, tmp_path):
    rows = track([(0, 0, 1.0), (600, 0.1, 1.0)])
    store = str(tmp_path / "store")
    load_batch(messages(spark, []), 0, store, "odd_batches", FIELD)
    assert progress(spark, "odd_batches", "messages") == (0, None)
    load_batch(messages(spark, [*rows, (*rows[0][:2], None, *rows[0][3:])]), 1, store, "odd_batches", FIELD)
    assert spark.table("odd_batches").count() == 2
    load_batch(messages(spark, rows[:1]), 1, store, "odd_batches", FIELD)  # the state has batch 1
    assert spark.table("odd_batches").count() == 2


def test_repeated_messages_are_refused(spark):
    rows = track([(0, 0, 1.0), (600, 0.1, 1.0), (700, 0.2, 0.0)])
    inc.load_increment(spark, messages(spark, rows), "refused", "2024-01-01", "2024-01-02", FIELD)
    before = state_rows(spark.table("refused"))
    other = track([(700, 0.2, 0.0)], seg="s0")
    with pytest.raises(ValueError, match="s1 2024-01-01 00:11:40"):  # also where the score is not 1
        inc.load_increment(spark, messages(spark, [*rows, *other, rows[2]]), "refused", "2024-01-01", "2024-01-02", FIELD)
    assert state_rows(spark.table("refused")) == before
