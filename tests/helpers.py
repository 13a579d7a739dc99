"""Small inputs for the tests."""

from datetime import datetime, timedelta, timezone

UTC = timezone.utc
MESSAGES = (
    "ssvid string, seg_id string, timestamp timestamp, lat double, lon double, speed_knots double, "
    "meters_to_prev double, implied_speed_knots double, hours double, nnet_score double, night_loitering double"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def naive(ts: datetime) -> datetime:
    return ts.replace(tzinfo=None)


def track(rows, start="2024-01-01 00:00:00", seg="s1", ssvid="v1"):
    """rows: (seconds since start, km north, score[, metres to previous[, hours]])."""
    out, begin, previous = [], at(start), None
    for row in rows:
        seconds, km, score, *rest = row
        metres = rest[0] if rest else (abs(km - previous[1]) * 1000 if previous else None)
        hours = rest[1] if len(rest) > 1 else ((seconds - previous[0]) / 3600 if previous else None)
        out.append(
            (
                ssvid,
                seg,
                begin + timedelta(seconds=seconds),
                km / 111.19508,
                10.0,
                3.0,
                float(metres) if metres is not None else None,
                4.0,
                hours,
                score,
                0.0,
            )
        )
        previous = (seconds, km)
    return out


def messages(spark, rows):
    return spark.createDataFrame(rows, MESSAGES)
