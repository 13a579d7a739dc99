"""Incremental loads of event-tagged messages.

The state holds every message of every event found so far.  A load re-reads
one day before its start, so that events still open at the start can be
continued, and rewrites only the months it touches.  Loading a range at once,
day by day, or again gives the same state.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from seawake.config import SessionRules
from seawake.operators.sessionize import as_instant, refuse_repeats, sessionize
from seawake.operators.slices import with_group_max
from seawake.session import materialized
from seawake.sources.schemas import STATE_SCHEMA, conform
from seawake.sources.tables import ensure_table, finish_replacement, month_of, partitions, replace_months

UPSERT_KEYS = ["seg_id", "event_start", "timestamp"]
STATE_COLUMNS = STATE_SCHEMA.names
RELABELLED = ("event_start", "event_end", "event_end_date")
MONTH = "event_end_month"


def _day(start: str | date, back: int = 0) -> Column:
    day = date.fromisoformat(start) if isinstance(start, str) else start
    return F.lit(day - timedelta(days=back))


def _hours_before(start: str | date, hours: float) -> Column:
    return as_instant(start) - timedelta(hours=hours)


def top_with_ties(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rows that hold the maximum of column within their keys, all of them on a tie."""
    top = F.max(column).over(Window.partitionBy(*keys))
    return df.withColumn("top", top).filter(F.col(column) == F.col("top")).drop("top")


def _split_for_reload(state: DataFrame, start: str | date) -> tuple[DataFrame, DataFrame]:
    """Rows a reload from start leaves alone, and the shortened events it keeps."""
    ends_later = F.col("event_end_date") >= _day(start)
    shortened = with_group_max(
        state.filter(ends_later & (F.col("timestamp") < as_instant(start))),
        ["seg_id", "event_start"],
        "timestamp",
        {"event_end": F.col("timestamp"), "event_end_date": F.to_date("timestamp")},
        SessionRules.slice_seconds,
    )
    return state.filter(~ends_later), shortened.select(*state.columns)


def truncate_state(state: DataFrame, start: str | date) -> DataFrame:
    """State as it was before start: later messages dropped, cut events end earlier."""
    untouched, shortened = _split_for_reload(state, start)
    return untouched.unionByName(shortened)


def open_events(state: DataFrame, start: str | date, max_gap_hours: float) -> DataFrame:
    """The latest event per segment that ended within the gap before start.

    Reduced to event boundaries before anything is compared within a segment:
    at most the events of a few hours remain.
    """
    recent = state.filter(
        (F.col("event_end") >= _hours_before(start, max_gap_hours))
        & (F.col("event_end_date") >= _day(start, 1))
    )
    bounds = recent.select("seg_id", "event_start", "event_end").distinct()
    return top_with_ties(bounds, ["seg_id"], "event_end")


def padded_events(delta: DataFrame, start: str | date, max_gap_hours: float) -> DataFrame:
    """The latest new event per segment with a message in the gap before start."""
    since = _hours_before(start, max_gap_hours)
    in_gap = delta.filter(
        (F.col("event_end") >= since)
        & (F.col("timestamp") >= since)
        & (F.col("timestamp") < as_instant(start))
    )
    bounds = in_gap.select("seg_id", "event_start", "event_end", "event_end_date").distinct()
    return top_with_ties(bounds, ["seg_id"], "event_end")


def overlap_join(opened: DataFrame, padded: DataFrame) -> DataFrame:
    """Open and new events of one segment that overlap: the merged event and where they meet."""
    o, n = opened.alias("o"), padded.alias("n")
    touching = (
        (F.col("o.seg_id") == F.col("n.seg_id"))
        & (F.col("o.event_start") <= F.col("n.event_end"))
        & (F.col("o.event_end") >= F.col("n.event_start"))
    )
    return o.join(n, touching).select(
        "o.seg_id",
        F.col("o.event_start").alias("merged_start"),
        F.col("n.event_end").alias("merged_end"),
        F.col("n.event_end_date").alias("merged_end_date"),
        F.col("o.event_end").alias("meeting_point"),
    )


def _relabelled(rows: DataFrame, when: Column) -> DataFrame:
    """Rows with the merged event's bounds where the condition holds."""
    merged = {name: F.col(name.replace("event", "merged")) for name in RELABELLED}
    return rows.select(
        *[
            F.when(when, merged[c]).otherwise(F.col(c)).alias(c) if c in merged else F.col(c)
            for c in STATE_COLUMNS
        ]
    )


def merge_open_events(
    state: DataFrame, delta: DataFrame, start: str | date, max_gap_hours: float = 2
) -> DataFrame:
    """Rows to upsert: continued events under one start, and the new events."""
    since = _hours_before(start, max_gap_hours)
    merged = overlap_join(
        open_events(state, start, max_gap_hours), padded_events(delta, start, max_gap_hours)
    )
    # messages of an open event: the meeting point is that event's end
    recent = state.filter((F.col("event_end") >= since) & (F.col("event_end_date") >= _day(start, 1)))
    continued = recent.join(
        merged.withColumn("event_end", F.col("meeting_point")), ["seg_id", "event_end"]
    ).filter(F.col("timestamp") <= F.col("meeting_point"))

    # new messages up to the meeting point are in the state already
    fresh = delta.filter(F.col("event_end") >= since).join(merged, "seg_id", "left")
    inside = (F.col("timestamp") > F.col("meeting_point")) & (F.col("timestamp") <= F.col("merged_end"))
    alone = F.col("merged_start").isNull() | (F.col("timestamp") > F.col("merged_end"))
    return _relabelled(continued, F.lit(True)).unionByName(
        _relabelled(fresh.filter(inside | alone), inside)
    )


def upsert(state: DataFrame, staged: DataFrame, keys: list[str], bound: Column) -> DataFrame:
    """Replace or insert staged rows; state rows outside bound are never matched."""
    reach = F.coalesce(bound, F.lit(False))
    kept = state.filter(reach).join(staged.select(*keys), keys, "left_anti")
    return state.filter(~reach).unionByName(kept.select(*state.columns)).unionByName(
        staged.select(*state.columns)
    )


def reach_of(start: str | date) -> Column:
    return F.col("event_end_date") >= _day(start, 1)


def apply_increment(
    state: DataFrame, delta: DataFrame, start: str | date, max_gap_hours: float = 2
) -> DataFrame:
    """New state from the old one and the padded new events."""
    before = truncate_state(state, start)
    staged = merge_open_events(before, delta, start, max_gap_hours)
    return upsert(before, staged, UPSERT_KEYS, reach_of(start))


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """A row matched by several staged rows has no defined result: refuse it."""
    twice = df.groupBy(*keys).count().filter("count > 1").select(*keys).take(1)
    if twice:
        raise ValueError(f"several staged rows share the key {twice[0].asDict()}")


def load_increment(
    spark: SparkSession,
    messages: DataFrame,
    state_table: str,
    start: str | date,
    end: str | date,
    score_field: str,
    max_gap_hours: float = 2,
) -> None:
    """Sessionize ``[start, end)`` and merge it into the state table.

    The table is partitioned by the month of ``event_end_date``.  Rows ending
    before ``start - 1 day`` are only read where their month is rewritten.
    New months are written beside the table and then put in place in the
    catalog (see :func:`replace_months`); a load that was interrupted anywhere
    is repaired by running it again.  Messages that share segment and time are
    refused before anything is changed; where no message is tagged, no new
    rows come and nothing is refused.
    """
    # read four times below; on shared storage, so that a lost executor costs nothing
    repeats = Observation()
    delta = materialized(sessionize(messages, start, end, score_field, max_gap_hours, repeats=repeats))
    if not delta.isEmpty():  # where nothing is tagged, Spark may leave out what is observed
        refuse_repeats(repeats)

    ensure_table(spark, state_table, STATE_SCHEMA, MONTH)
    finish_replacement(spark, state_table)
    stored = spark.table(state_table)
    first_month = month_of(_day(start, 1))

    # Shortening an event can move its rows to an earlier month.
    later = stored.filter(F.col(MONTH) >= first_month).select(*STATE_COLUMNS)
    _, shortened = _split_for_reload(later, start)
    earlier_months = [
        row[0]
        for row in shortened.select(month_of(F.col("event_end_date")).alias("m"))
        .distinct()
        .filter(F.col("m") < first_month)
        .collect()
    ]
    in_range = (F.col(MONTH) >= first_month) | F.col(MONTH).isin(earlier_months)
    state = stored.filter(in_range).select(*STATE_COLUMNS)

    # each is read several times below, and the affected months only once
    before = materialized(truncate_state(state, start))
    staged = materialized(merge_open_events(before, delta, start, max_gap_hours))
    assert_unique(staged, UPSERT_KEYS)
    result = conform(upsert(before, staged, UPSERT_KEYS, reach_of(start)), STATE_SCHEMA)
    result = result.withColumn(MONTH, month_of(F.col("event_end_date")))
    existing = [m for m in partitions(spark, state_table) if m >= _month_text(start) or m in earlier_months]
    order = [MONTH, "seg_id", "timestamp"]
    replace_months(result.repartitionByRange(*order).sortWithinPartitions(*order), state_table, MONTH, existing)


def _month_text(start: str | date) -> str:
    day = date.fromisoformat(start) if isinstance(start, str) else start
    return f"{day - timedelta(days=1):%Y-%m}"
