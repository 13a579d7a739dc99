"""Scored messages to fishing events, per track segment.

Definitions, for the messages of one segment in time order:

* a *run* begins at a message whose predecessor is missing or has no score,
  at a change of score, after a jump, or after a gap.  A message without a
  score stays in the run before it, the message after it begins a new one;
* a *fishing run* is a run of score 1.  It is joined to the fishing run before
  it when it starts soon after that run's last message **and** near that run's
  first position;
* an *event* is a maximal chain of joined fishing runs, and consists of their
  messages of score 1.

A segment may be of any length, so nothing is computed over a whole segment at
message level.  Messages are shuffled once by (segment, slice).  Inside a slice
only the first message and the first fishing run depend on the past; a second,
narrow pass summarizes each slice, and window functions over the summaries (one
row per segment and day) settle those two and the ends of events that leave the
slice.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from seawake.config import SCORE_FIELDS, SessionRules
from seawake.functions.geo import distance_m
from seawake.functions.scalars import is_true, seconds_between
from seawake.operators.slices import SLICE, rows_in_slice, slices_of, time_slice

MESSAGE_COLUMNS = (
    "ssvid",
    "seg_id",
    "timestamp",
    "year",
    "lat",
    "lon",
    "speed_knots",
    "meters_to_prev",
    "implied_speed_knots",
    "hours",
    "score",
)


def as_instant(day: str | date | datetime) -> Column:
    """Midnight UTC of a date, or the given time."""
    if isinstance(day, str):
        day = datetime.fromisoformat(day)
    if not isinstance(day, datetime):
        day = datetime(day.year, day.month, day.day)
    return F.lit(day.isoformat(" ") + "+00:00").cast("timestamp")


def scan_messages(df: DataFrame, start: str | date, end: str | date, pad_days: int = 1) -> DataFrame:
    """Messages of ``[start - pad_days, end)``; plain bounds, so they reach the scan."""
    ts = F.col("timestamp")
    return df.filter((ts >= as_instant(start) - timedelta(days=pad_days)) & (ts < as_instant(end)))


def valid_positions(df: DataFrame) -> DataFrame:
    return df.filter((F.col("lat") > -90) & (F.col("lat") < 90))


def select_score(df: DataFrame, field: str) -> DataFrame:
    """Message columns with the chosen score column as ``score``."""
    if field not in SCORE_FIELDS:
        raise ValueError(f"score field must be one of {SCORE_FIELDS}")
    derived = {"year": F.year("timestamp").cast("long"), "score": F.col(field)}
    return df.select(*[derived.get(c, F.col(c)).alias(c) for c in MESSAGE_COLUMNS])


def source_messages(
    df: DataFrame, start: str | date, end: str | date, field: str, pad_days: int = 1
) -> DataFrame:
    return select_score(valid_positions(scan_messages(df, start, end, pad_days)), field)


def _far_apart(at: Column, until: Column, row: Column | None, rules: SessionRules) -> Column:
    """Is a fishing run that starts at ``row`` too late or too far to be joined?"""
    ts, lon, lat = (
        (F.col("timestamp"), F.col("lon"), F.col("lat"))
        if row is None
        else (row["timestamp"], row["lon"], row["lat"])
    )
    late = seconds_between(until, ts) > rules.fuse_seconds
    far = distance_m(lon, lat, at["lon"], at["lat"]) > rules.fuse_distance_m
    return is_true(late | far)


def _mark(messages: DataFrame, rules: SessionRules) -> DataFrame:
    """What each message is, as far as its slice tells."""
    ts = F.col("timestamp")
    rows = rows_in_slice("seg_id", "timestamp")
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    jump = is_true(
        (F.col("meters_to_prev") > rules.max_jump_m) | (F.col("hours") > rules.max_gap_hours)
    )
    position = F.struct("lon", "lat")
    marked = (
        messages.withColumns(
            {
                SLICE: time_slice(ts, rules.slice_seconds),
                "jump": jump,
                "fishing": is_true(F.col("score") == 1.0),
            }
        )
        .withColumns(
            {
                "prev_score": F.lag("score").over(rows),
                "repeats": F.lag("timestamp").over(rows) == ts,
                "leads": F.row_number().over(rows) == 1,
            }
        )
        .withColumn(
            "breaks",
            ~F.col("leads")
            & (F.col("prev_score").isNull() | is_true(F.col("score") != F.col("prev_score")) | F.col("jump")),
        )
        .withColumn("starts", F.col("breaks") & F.col("fishing"))
    )
    # the unscored message behind a fishing message still belongs to its run
    trails = (
        ~F.col("leads") & F.col("score").isNull() & is_true(F.col("prev_score") == 1.0) & ~F.col("jump")
    )
    marked = (
        marked.withColumn("in_run", F.col("fishing") | trails)
        # together, so that they share one window operator
        .withColumns(
            {
                "prev_end": F.last(F.when(F.col("in_run"), ts), True).over(before),
                "prev_at": F.last(F.when(F.col("starts"), position), True).over(before),
                "last_break": F.max(F.when(F.col("breaks"), ts)).over(so_far),
                "last_start": F.max(F.when(F.col("starts"), ts)).over(so_far),
            }
        )
    )
    opens = (
        F.col("starts")
        & F.col("prev_at").isNotNull()
        & _far_apart(F.col("prev_at"), F.col("prev_end"), None, rules)
    )
    return marked.withColumn("opens", opens).withColumn(
        "last_open", F.max(F.when(F.col("opens"), ts)).over(so_far)
    )


def _settle(marked: DataFrame, rules: SessionRules, repeats: Observation | None = None) -> DataFrame:
    """One row per (segment, slice): what its messages need from other slices.

    ``repeats`` learns of messages that share segment and time, which always
    fall into one slice: how many slices have some, and the first such key.
    """
    ts = F.col("timestamp")
    fishing_ts = F.when(F.col("fishing"), ts)
    position = F.struct("lon", "lat")
    summary = marked.groupBy("seg_id", SLICE).agg(
        # the first message, and the first fishing run that starts behind it
        F.min_by(F.struct("timestamp", "lon", "lat", "score", "jump"), ts).alias("head"),
        F.min_by(
            F.struct("timestamp", "lon", "lat", "prev_end"), F.when(F.col("starts"), ts)
        ).alias("first"),
        F.max_by("score", ts).alias("closing_score"),
        F.max(F.when(F.col("in_run"), ts)).alias("closing_end"),
        F.max_by(position, F.when(F.col("starts"), ts)).alias("closing_at"),
        F.max(F.when(F.col("breaks"), ts)).alias("closing_break"),
        F.max(F.when(F.col("opens"), ts)).alias("closing_open"),
        F.max(F.when(F.col("last_start").isNull(), fishing_ts)).alias("fished_before_first"),
        F.max(F.when(F.col("last_open").isNull(), fishing_ts)).alias("fished_before_open"),
        F.min(F.when(F.col("repeats"), ts)).alias("repeated"),
        F.max(ts).alias("closing"),
    )
    if repeats is not None:
        key = F.when(F.col("repeated").isNotNull(), F.concat_ws(" ", "seg_id", F.col("repeated").cast("string")))
        summary = summary.observe(repeats, F.count("repeated").alias("slices"), F.min(key).alias("key"))

    slices = slices_of("seg_id")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    head, first = F.col("head"), F.col("first")

    # 1. the head against the last score of the slice before
    known = summary.withColumn("carried_score", F.lag("closing_score").over(slices))
    head_breaks = (
        F.col("carried_score").isNull()
        | is_true(head["score"] != F.col("carried_score"))
        | head["jump"]
    )
    head_trails = head["score"].isNull() & is_true(F.col("carried_score") == 1.0) & ~head["jump"]
    head_position = F.struct(head["lon"].alias("lon"), head["lat"].alias("lat"))
    known = (
        known.withColumn("head_breaks", head_breaks)
        .withColumn("head_starts", F.col("head_breaks") & is_true(head["score"] == 1.0))
        .withColumn("head_end", F.when(head_trails, head["timestamp"]))
        .withColumn("head_at", F.when(F.col("head_starts"), head_position))
    )

    # 2. the last fishing run before the slice, hence whether head and first open an event
    known = known.withColumns(
        {
            "carried_end": F.last(F.coalesce("closing_end", "head_end"), True).over(earlier),
            "carried_at": F.last(F.coalesce("closing_at", "head_at"), True).over(earlier),
        }
    )
    head_opens = F.col("head_starts") & (
        F.col("carried_at").isNull()
        | _far_apart(F.col("carried_at"), F.col("carried_end"), head, rules)
    )
    known = known.withColumns(
        {
            "head_opens": head_opens,
            "first_end": F.coalesce(first["prev_end"], F.col("head_end"), F.col("carried_end")),
            "first_at": F.coalesce("head_at", "carried_at"),
        }
    )
    known = known.withColumn(
        "first_opens",
        first.isNotNull()
        & (F.col("first_at").isNull() | _far_apart(F.col("first_at"), F.col("first_end"), first, rules)),
    )

    # 3. the event that reaches into the slice, and where it and the last own event end
    known = known.withColumn(
        "own_open",
        F.coalesce(
            "closing_open",
            F.when(F.col("first_opens"), first["timestamp"]),
            F.when(F.col("head_opens"), head["timestamp"]),
        ),
    ).withColumn(
        "continued_until",
        F.when(F.col("head_opens"), None)
        .when(F.col("first_opens"), F.col("fished_before_first"))
        .otherwise(F.col("fished_before_open")),
    )
    own_break = F.coalesce("closing_break", F.when(F.col("head_breaks"), head["timestamp"]))
    same_event = Window.partitionBy("seg_id", "carried_open")
    known = (
        known.withColumns(
            {
                "carried_break": F.last(own_break, True).over(earlier),
                "carried_open": F.last("own_open", True).over(earlier),
            }
        )
        .withColumn("carried_until", F.max("continued_until").over(same_event))
        .withColumn("own_until", F.lead("carried_until").over(slices))
    )
    # the slices of a segment are partitioned by it already
    known = known.withColumn("segment_end", F.max("closing").over(Window.partitionBy("seg_id")))
    return known.select(
        "seg_id",
        SLICE,
        "segment_end",
        "carried_open",
        "carried_until",
        "own_open",
        "own_until",
        F.when(F.col("first_opens"), first["timestamp"]).alias("first_open"),
        F.when(F.col("head_opens"), head["timestamp"]).alias("head_open"),
        F.when(F.col("head_breaks"), head["timestamp"]).alias("head_break"),
        "carried_break",
    )


def _mark_and_settle(messages: DataFrame, rules: SessionRules, repeats: Observation | None = None) -> DataFrame:
    marked = _mark(messages, rules)
    return marked.join(_settle(marked, rules, repeats), ["seg_id", SLICE])


def tag_runs(messages: DataFrame, rules: SessionRules = SessionRules()) -> DataFrame:
    """All messages (of whatever score) with the first timestamp of their run."""
    return _runs(messages, rules).select(*messages.columns, "run_start")


def _runs(messages: DataFrame, rules: SessionRules) -> DataFrame:
    run_start = F.coalesce("last_break", "head_break", "carried_break")
    return _mark_and_settle(messages, rules).withColumn("run_start", run_start)


def event_boundaries(messages: DataFrame, rules: SessionRules = SessionRules()) -> DataFrame:
    """One row per run: first message's position and score, and the run's last timestamp.

    The end of a segment's last run is open (null).
    """
    ts = F.col("timestamp")
    # a segment is one track even where its ssvid changes: the first message gives a run's ssvid
    runs = _runs(messages, rules).groupBy("seg_id", "run_start").agg(
        F.min_by(F.struct("ssvid", "score", "lat", "lon"), ts).alias("head"),
        F.max(ts).alias("last_message"),
        F.first("segment_end").alias("segment_end"),
    )
    return runs.select(
        "head.ssvid",
        "seg_id",
        F.col("run_start").alias("event_start"),
        F.when(F.col("last_message") < F.col("segment_end"), F.col("last_message")).alias("event_end"),
        "head.score",
        "head.lat",
        "head.lon",
    )


def tag_events(
    messages: DataFrame, rules: SessionRules = SessionRules(), repeats: Observation | None = None
) -> DataFrame:
    """Messages of score 1 with the start and end of their event."""
    settled = _mark_and_settle(messages, rules, repeats).filter("fishing")
    first_open = F.when(F.col("timestamp") >= F.col("first_open"), F.col("first_open"))
    tagged = settled.withColumn(
        "event_start", F.coalesce("last_open", first_open, "head_open", "carried_open")
    )
    in_slice = Window.partitionBy("seg_id", SLICE, "event_start")
    event_end = F.greatest(
        F.max("timestamp").over(in_slice),
        F.when(F.col("event_start") == F.col("own_open"), F.col("own_until")),
        F.when(F.col("event_start") == F.col("carried_open"), F.col("carried_until")),
    )
    return tagged.withColumn("event_end", event_end).select(
        *messages.columns, "event_start", "event_end", F.to_date("event_end").alias("event_end_date")
    )


def fuse_runs(messages: DataFrame, rules: SessionRules = SessionRules()) -> DataFrame:
    """One row per event: start, end and number of messages."""
    return (
        tag_events(messages, rules)
        .groupBy("ssvid", "seg_id", "event_start")
        .agg(F.max("timestamp").alias("event_end"), F.count(F.lit(1)).alias("messages"))
    )


def sessionize(
    messages: DataFrame,
    start: str | date,
    end: str | date,
    score_field: str,
    max_gap_hours: float = 2,
    rules: SessionRules | None = None,
    repeats: Observation | None = None,
) -> DataFrame:
    """Messages of ``[start - 1 day, end)`` tagged with their fishing events.

    ``(seg_id, timestamp)`` must be unique; ``repeats`` observes where it is not,
    in the shuffle that is made anyway (see :func:`refuse_repeats`).
    """
    rules = rules or SessionRules(max_gap_hours=max_gap_hours)
    return tag_events(source_messages(messages, start, end, score_field), rules, repeats)


def refuse_repeats(repeats: Observation) -> None:
    """Refuse messages that share segment and time, once the observed frame was computed."""
    found = repeats.get
    if found.get("slices"):
        raise ValueError(f"several messages share segment and time: {found['key']}, and so in {found['slices']} slices")
