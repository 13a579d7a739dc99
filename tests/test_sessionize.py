import math
import random
from collections import defaultdict

import pytest

from pyspark.sql import functions as F
from pyspark.sql import Window

from seawake.config import SessionRules
from seawake.operators import sessionize as ses
from seawake.operators.joins import range_join
from seawake.operators.slices import lag_within_key, with_group_max
from tests.helpers import at, messages, naive, track

START, END = "2024-01-01", "2024-02-01"


def events(spark, rows, **rules):
    tagged = ses.sessionize(messages(spark, rows), START, END, "nnet_score", rules=SessionRules(**rules) if rules else None)
    found = tagged.groupBy("seg_id", "event_start").agg(F.max("event_end"), F.min("event_end"), F.count("*")).collect()
    assert all(r[2] == r[3] for r in found)
    return sorted((r[0], r[1], r[2], r[4]) for r in found)


def sizes(spark, rows, **rules):
    return [e[3] for e in events(spark, rows, **rules)]


MINUTE = 60


def test_unscored_message_inside_a_run(spark):
    assert sizes(spark, track([(0, 0, 1.0), (300, 0.1, None), (600, 0.2, 1.0)])) == [2]


def test_message_after_an_unscored_one_begins_a_run(spark):
    rows = track([(0, 0, 1.0), (300, 0.1, None), (600, 2.5, 1.0)])
    # near the last message, but more than 2 km from the start of the run before
    assert sizes(spark, rows) == [1, 1]


@pytest.mark.parametrize("gap, expected", [(50, [2]), (70, [1, 1])])
def test_interrupted_fishing_is_joined_within_an_hour(spark, gap, expected):
    rows = track([(0, 0, 1.0), (gap * 30, 0.1, 0.0), (gap * 60, 0.2, 1.0)])
    assert sizes(spark, rows) == expected


def test_distance_is_measured_between_starts(spark):
    run = [(i * 600, i * 0.5, 1.0) for i in range(7)]  # 3 km long
    rows = track([*run, (4000, 3.2, 0.0), (4200, 3.5, 1.0)])
    assert sizes(spark, rows) == [7, 1]


def test_jump_and_gap_begin_a_run(spark):
    assert sizes(spark, track([(0, 0, 1.0), (30, 10.0, 1.0, 10_001)])) == [1, 1]
    assert sizes(spark, track([(0, 0, 1.0), (30, 0.5, 1.0, 10_001)])) == [2]
    assert sizes(spark, track([(0, 0, 1.0), (7200, 0.5, 1.0, 500, 2.0)])) == [2]
    assert sizes(spark, track([(0, 0, 1.0), (7201, 0.5, 1.0, 500, 2.0003)])) == [1, 1]


def test_poles_and_missing_latitude_are_dropped(spark):
    rows = track([(0, 0, 1.0), (60, 0.1, 1.0), (120, 0.2, 1.0), (180, 0.3, 1.0)])
    bad = [tuple({1: 90.0, 2: None, 3: -90.0}[i] if k == 3 else v for k, v in enumerate(r)) if i else r for i, r in enumerate(rows)]
    assert sizes(spark, bad) == [1]


def test_single_message_event(spark):
    (found,) = events(spark, track([(0, 0, 1.0)]))
    assert found[1] == found[2] == naive(at("2024-01-01 00:00:00"))


def test_scan_pads_one_day_and_reaches_the_scan(spark, tmp_path):
    rows = track([(i * 43_200, 0, 1.0) for i in range(8)])
    messages(spark, rows).write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    scan = ses.scan_messages(stored, "2024-01-02", "2024-01-03")
    assert sorted(r.timestamp.day for r in scan.collect()) == [1, 1, 2, 2]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp,2023" in plan or "GreaterThanOrEqual(timestamp" in plan


def test_unknown_score_field(spark):
    with pytest.raises(ValueError):
        ses.select_score(messages(spark, track([(0, 0, 1.0)])), "lat")


def brute_force(rows, rules):
    """The definition, message by message."""
    result = {}
    segments = defaultdict(list)
    for r in rows:
        segments[r[1]].append(r)
    for seg, stops in segments.items():
        stops.sort(key=lambda r: r[2])
        runs, previous = [], None
        for r in stops:
            score = r[9]
            fresh = (
                previous is None
                or previous[9] is None
                or (score is not None and score != previous[9])
                or (r[6] is not None and r[6] > rules.max_jump_m)
                or (r[8] is not None and r[8] > rules.max_gap_hours)
            )
            if fresh:
                runs.append([])
            runs[-1].append(r)
            previous = r
        event = last = None
        for run in (x for x in runs if x[0][9] == 1.0):
            if last is not None:
                late = int((run[0][2] - last[-1][2]).total_seconds()) > rules.fuse_seconds
                far = metres(run[0], last[0]) > rules.fuse_distance_m
            if last is None or late or far:
                event = run[0][2]
            for r in run:
                if r[9] == 1.0:
                    result[(seg, naive(r[2]))] = naive(event)
            last = run
    return result


def metres(a, b):
    p, q = math.radians(a[3]), math.radians(b[3])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[4] - a[4]) / 2) ** 2
    return 2 * 6371010 * math.asin(min(1, math.sqrt(h)))


def random_tracks(seed):
    rng = random.Random(seed)
    rows = []
    for number in range(12):
        seconds, km, path = 0, 0.0, []
        for _ in range(rng.randint(1, 120)):
            path.append((seconds, km, rng.choice([1.0, 1.0, 1.0, 0.0, None])))
            seconds += rng.choice([1, 60, 600, 1500, 3600, 3601, 7200, 7300, 30_000])
            km += rng.choice([0, 0.1, 0.9, 1.5, 11])
        rows += track(path, seg=f"s{number}")
    # one segment with a third of all messages, fishing almost without pause
    rows += track([(i * 240, 0.0004 * i, None if i % 97 == 5 else 1.0) for i in range(len(rows) // 2)], seg="hot")
    return rows


@pytest.mark.parametrize("seed, slice_seconds", [(1, 86_400), (2, 3_600), (3, 600), (4, 10_000_000)])
def test_against_brute_force(spark, seed, slice_seconds):
    rows = random_tracks(seed)
    rules = SessionRules(slice_seconds=slice_seconds)
    tagged = ses.sessionize(messages(spark, rows), START, "2024-06-01", "nnet_score", rules=rules)
    got = {(r.seg_id, r.timestamp): (r.event_start, r.event_end) for r in tagged.collect()}
    want = brute_force(rows, rules)
    assert {k: v[0] for k, v in got.items()} == want
    ends = defaultdict(list)
    for (seg, ts), start in want.items():
        ends[seg, start].append(ts)
    assert all(v[1] == max(ends[k[0], v[0]]) for k, v in got.items())


def test_boundaries_leave_the_last_run_open(spark):
    rows = track([(0, 0, 1.0), (60, 0, 1.0), (120, 0, 0.0), (180, 0, None), (240, 0, 1.0)])
    found = ses.event_boundaries(ses.source_messages(messages(spark, rows), START, END, "nnet_score")).orderBy("event_start").collect()
    assert [(r.score, r.event_end and r.event_end.minute) for r in found] == [(1.0, 1), (0.0, 3), (1.0, None)]


def test_no_message_level_shuffle_by_segment_alone(spark):
    rows = messages(spark, track([(0, 0, 1.0), (60, 0, 1.0)]))
    plan = ses.sessionize(rows, START, END, "nnet_score")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(seg_id" in line]
    by_slice = [line for line in exchanges if "time_slice" in line]
    # one wide and one narrow shuffle of messages; the summaries go by segment and come back
    assert len([e for e in exchanges if "time_slice" not in e]) == 1 and 2 <= len(by_slice) <= 4


def test_run_boundaries_read_messages_as_often_as_events_do(spark):
    rows = messages(spark, track([(0, 0, 1.0), (60, 0, 1.0)]))
    source = ses.source_messages(rows, START, END, "nnet_score")
    scans = [df._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") for df in (ses.event_boundaries(source), ses.tag_events(source))]
    assert scans == [2, 2]


def test_sliced_lag_and_maximum_equal_window_functions(spark):
    df = messages(spark, random_tracks(7)).select("seg_id", "timestamp", "lat")
    whole = Window.partitionBy("seg_id").orderBy("timestamp")
    want = df.withColumn("before", F.lag("lat").over(whole))
    got = lag_within_key(df, "seg_id", "timestamp", {"before": "lat"}, 3600)
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0
    want = df.withColumn("top", F.max("lat").over(Window.partitionBy("seg_id")))
    got = with_group_max(df, ["seg_id"], "timestamp", {"top": F.col("lat")}, 3600)
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_range_join_equals_plain_condition(spark):
    points = spark.createDataFrame([(k, at(f"20{y:02d}-0{m}-01 12:00:00")) for k in "ab" for y in (5, 12, 24, 50) for m in (1, 5)], "k string, t timestamp")
    spans = spark.createDataFrame(
        [
            ("a", 1, at("2012-01-01 00:00:00"), at("2024-03-01 00:00:00")),
            ("a", 2, None, at("2013-01-01 00:00:00")),
            ("b", 3, at("2024-01-01 12:00:00"), None),
            ("b", 4, at("2024-05-01 12:00:00"), at("2024-01-01 12:00:00")),
            ("c", 5, None, None),
        ],
        "k string, n int, lo timestamp, hi timestamp",
    )
    got = range_join(points, spans, ["k"], "t", "lo", "hi", how="left").select("k", "t", "n")
    low_ok = F.col("lo").isNull() | (F.col("t") >= F.col("lo"))
    high_ok = F.col("hi").isNull() | (F.col("t") <= F.col("hi"))
    right = spans.withColumnRenamed("k", "k2")
    want = points.join(right, (F.col("k") == F.col("k2")) & low_ok & high_ok, "left").select("k", "t", "n")
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0
    assert got.filter("n is not null").count() > 6
