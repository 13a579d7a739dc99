import pytest
from pyspark.sql import functions as F

from seawake.operators.sessionize import sessionize
from seawake.sources.schemas import STATE_SCHEMA
from seawake.sources import tables
from seawake.sources.tables import partitions
from seawake.streaming import incremental as inc
from tests.helpers import at, messages, naive, track
from tests.test_sessionize import random_tracks

FIELD = "nnet_score"


def unique(rows):
    return list({(r[1], r[2]): r for r in rows}.values())


def state_rows(df):
    return sorted((r.seg_id, r.timestamp, r.event_start, r.event_end, r.event_end_date) for r in df.collect())


def load(spark, rows, table, *ranges):
    source = messages(spark, rows)
    for start, end in ranges:
        inc.load_increment(spark, source, table, start, end, FIELD)
    return spark.table(table)


def test_midnight_event_is_continued(spark):
    # 23:00 to 01:30, every half hour
    rows = track([(i * 1800, 0.1 * i, 1.0) for i in range(6)], start="2024-01-01 23:00:00")
    state = load(spark, rows, "midnight", ("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-03"))
    found = state.select("event_start", "event_end").distinct().collect()
    assert [tuple(r) for r in found] == [(naive(at("2024-01-01 23:00:00")), naive(at("2024-01-02 01:30:00")))]
    assert state.count() == 6


def test_reload_shortens_then_extends(spark):
    rows = track([(i * 1800, 0.1 * i, 1.0) for i in range(6)], start="2024-01-01 23:00:00")
    whole = state_rows(load(spark, rows, "whole", ("2024-01-01", "2024-01-03")))
    again = load(spark, rows, "again", ("2024-01-01", "2024-01-03"), ("2024-01-02", "2024-01-03"))
    assert state_rows(again) == whole
    cut = inc.truncate_state(spark.table("whole").select(*STATE_SCHEMA.names), "2024-01-02")
    assert {r.event_end for r in cut.collect()} == {naive(at("2024-01-01 23:30:00"))}


def test_month_left_without_rows_is_dropped(spark):
    # an event that moves from January to February as it grows, and back again
    rows = track([(i * 1800, 0.1 * i, 1.0) for i in range(6)], start="2024-01-31 23:00:00")
    table = "months"
    state = load(spark, rows, table, ("2024-01-31", "2024-02-01"))
    assert partitions(spark, table) == ["2024-01"]
    state = load(spark, rows, table, ("2024-02-01", "2024-02-02"))
    assert partitions(spark, table) == ["2024-02"] and state.count() == 6
    # reloaded without the February messages
    inc.load_increment(spark, messages(spark, rows[:2]), table, "2024-02-01", "2024-02-02", FIELD)
    assert partitions(spark, table) == ["2024-01"]
    assert {r.event_end_date.month for r in spark.table(table).collect()} == {1}


def test_interrupted_load_is_repaired_by_running_it_again(spark, monkeypatch):
    """Stop at every change of the catalog, and before the first; then run the load again."""
    rows = track([(i * 1800, 0.1 * i, 1.0) for i in range(6)], start="2024-01-31 23:00:00")
    ranges = ("2024-01-31", "2024-02-01"), ("2024-02-01", "2024-02-02")
    fewer = messages(spark, rows[:2])
    want_table = "uninterrupted"
    load(spark, rows, want_table, *ranges)
    inc.load_increment(spark, fewer, want_table, "2024-02-01", "2024-02-02", FIELD)
    want, plain, step = state_rows(spark.table(want_table)), tables.change_catalog, 0
    while True:
        table, done = f"stopped_{step}", 0
        before = state_rows(load(spark, rows, table, *ranges))

        def stop(session, statement):
            nonlocal done
            if done == step:
                raise InterruptedError(statement)
            done += 1
            plain(session, statement)

        monkeypatch.setattr(tables, "change_catalog", stop)
        try:
            inc.load_increment(spark, fewer, table, "2024-02-01", "2024-02-02", FIELD)
            break
        except InterruptedError:
            if step == 0:
                assert state_rows(spark.table(table)) == before  # not announced, nothing changed
        finally:
            monkeypatch.setattr(tables, "change_catalog", plain)
        inc.load_increment(spark, fewer, table, "2024-02-01", "2024-02-02", FIELD)
        assert state_rows(spark.table(table)) == want
        assert partitions(spark, table) == ["2024-01"]
        step += 1
    assert step >= 4


def test_event_cut_back_by_more_than_the_padding(spark):
    # the middle of the event is missing from the messages, so the cut goes back months
    rows = [
        *track([(0, 0, 1.0), (600, 0.1, 1.0)], start="2023-11-10 00:00:00"),
        *track([(0, 0.2, 1.0, 10, 1.0), (600, 0.3, 1.0)], start="2024-01-10 12:00:00"),
    ]
    table = "cut_back"
    state = spark.createDataFrame(
        [(r[0], r[1], r[2], 2024, r[3], r[4], r[5], r[6], r[7], r[8], 1.0, rows[0][2], rows[-1][2], at("2024-01-10 00:00:00").date()) for r in rows],
        STATE_SCHEMA,
    )
    inc.ensure_table(spark, table, STATE_SCHEMA, inc.MONTH)
    state.withColumn(inc.MONTH, inc.month_of(F.col("event_end_date"))).write.insertInto(table)
    older = state.filter(F.col("timestamp") == rows[0][2]).withColumns({"seg_id": F.lit("other"), "event_end_date": F.lit("2023-11-30").cast("date")})
    older.withColumn(inc.MONTH, F.lit("2023-11")).write.insertInto(table)
    inc.load_increment(spark, messages(spark, []), table, "2024-01-10", "2024-01-11", FIELD)
    assert partitions(spark, table) == ["2023-11"]
    left = state_rows(spark.table(table))
    assert [r[0] for r in left] == ["other", "s1", "s1"]
    assert left[1][3] == naive(at("2023-11-10 00:10:00"))


@pytest.mark.parametrize("seed", [11])
def test_three_load_modes_agree(spark, seed):
    rows = unique(random_tracks(seed))
    days = [f"2024-01-{d:02d}" for d in range(1, 5)]
    once = sessionize(messages(spark, rows), days[0], days[-1], FIELD).checkpoint()
    want = state_rows(once)
    state = once.filter(F.lit(False))
    for start, end in zip(days, days[1:]):
        delta = sessionize(messages(spark, rows), start, end, FIELD)
        state = inc.apply_increment(state, delta, start).checkpoint()
    assert state_rows(state) == want
    for start in days[1:3]:
        state = inc.apply_increment(state, sessionize(messages(spark, rows), start, days[-1], FIELD), start).checkpoint()
    assert state_rows(state) == want


def test_only_the_latest_open_event_is_a_candidate(spark):
    rows = track([(0, 0, 1.0), (60, 0, 0.0), (4000, 0, 1.0), (4060, 0, 1.0)], start="2024-01-01 22:30:00")
    state = sessionize(messages(spark, rows), "2024-01-01", "2024-01-02", FIELD)
    assert state.select("event_start").distinct().count() == 2
    (found,) = inc.open_events(state, "2024-01-02", 2).collect()
    assert found.event_start == naive(at("2024-01-01 23:36:40"))


def test_upsert_is_bounded_and_refuses_double_keys(spark):
    rows = track([(0, 0, 1.0)], start="2024-01-01 12:00:00")
    state = sessionize(messages(spark, rows), "2024-01-01", "2024-01-02", FIELD)
    inside = inc.upsert(state, state, inc.UPSERT_KEYS, inc.reach_of("2024-01-02"))
    outside = inc.upsert(state, state, inc.UPSERT_KEYS, inc.reach_of("2024-01-03"))
    # an equal key in an older part of the state is not found, so the row is inserted again
    assert (inside.count(), outside.count()) == (1, 2)
    with pytest.raises(ValueError):
        inc.assert_unique(state.unionByName(state), inc.UPSERT_KEYS)


def test_ties_are_kept(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 0)], "k string, v int")
    assert sorted(map(tuple, inc.top_with_ties(df, ["k"], "v").collect())) == [("a", 2), ("a", 2), ("b", 0)]
