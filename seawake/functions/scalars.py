"""Identifiers, units, time and text."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from seawake.config import (
    HASHED_SSVID_LENGTH,
    KM_PER_NAUTICAL_MILE,
    NULL_KEY,
    PORT_EVENT_PRIORITY,
    WHITELISTED_RFMOS,
)


def filter_invalid_ssvid(ssvid: Column) -> Column:
    """Null for a hashed (64 character) identifier, else the identifier."""
    return F.when(F.length(ssvid) != HASHED_SSVID_LENGTH, ssvid)


def m_to_km(metres: Column) -> Column:
    return metres / 1000


def nm_to_km(miles: Column) -> Column:
    return miles * KM_PER_NAUTICAL_MILE


def grid_index(degrees: Column) -> Column:
    """Index of the 0.01 degree cell, floored on decimals so that no float error moves it."""
    return F.floor(degrees.cast("decimal(38,9)") * F.lit(100)).cast("long")


def gridcode(lon: Column, lat: Column) -> Column:
    """Key of the spatial measures table, such as ``lon:-000.01_lat:+012.30``."""
    text = F.format_string(
        "lon:%+07.2f_lat:%+07.2f", grid_index(lon) / 100.0, grid_index(lat) / 100.0
    )
    return F.when(lon.isNotNull() & lat.isNotNull(), text)


def timestamp_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS[.fff[fff]]+00``, the form used inside event ids."""
    micros = F.unix_micros(ts.cast("timestamp")) % 1_000_000
    pattern = (
        F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(micros % 1000 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return F.concat(pattern, F.lit("+00"))


def event_id(kind: str, vessel_id: Column, start: Column, end: Column) -> Column:
    """Hex MD5 of type, vessel, start and end; null as soon as one part is null."""
    bar = F.lit("|")
    text = F.concat(
        F.lit(kind), bar, vessel_id, bar, timestamp_text(start), bar, timestamp_text(end)
    )
    return F.md5(text)


def mirrored_id(encounter_id: Column, side: int) -> Column:
    return F.concat(encounter_id, F.lit(f".{side}"))


def float_text(value: Column) -> Column:
    """Text of a number with all its digits: it reads back as the same double, and has no exponent.

    Whole numbers have no decimals.
    """
    number = value.cast("double")
    # where Spark would write an exponent, decimals wide enough for every digit
    wide = F.when(F.abs(number) < 1, number.cast("decimal(38,36)").cast("string")).otherwise(number.cast("decimal(38,10)").cast("string"))
    text = F.when((F.abs(number) >= 1e-3) & (F.abs(number) < 1e7), number.cast("string")).otherwise(wide)
    shorter = F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(shorter, r"\.$", "")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", start, end)


def null_key(value: Column) -> Column:
    """Lets nulls meet in an equality join."""
    return F.coalesce(value, F.lit(NULL_KEY))


def is_true(condition: Column) -> Column:
    """Two-valued: null counts as false."""
    return F.coalesce(condition, F.lit(False))


def is_whitelisted_rfmo(code: Column) -> Column:
    return code.isin(*WHITELISTED_RFMOS)


def overlaps(from_a: Column, to_a: Column, from_b: Column, to_b: Column) -> Column:
    """Open interval overlap."""
    return (from_a < to_b) & (to_a > from_b)


def port_event_rank(event_type: Column) -> Column:
    """1 for the preferred type; null, which sorts first, for an unknown one."""
    cases = enumerate(PORT_EVENT_PRIORITY, start=1)
    first_rank, first = next(cases)
    return reduce(
        lambda chain, case: chain.when(event_type == case[1], case[0]),
        cases,
        F.when(event_type == first, first_rank),
    )


def nfc(label: Column) -> Column:
    """Unicode NFC.  Used on the anchorage dimension only; Spark has no built-in."""

    def normalized(batch: pd.Series) -> pd.Series:
        return batch.str.normalize("NFC")

    return F.pandas_udf(normalized, StringType())(label)


def port_id(iso3: Column, label: Column) -> Column:
    """``iso3-label`` in lower case, without blanks; label is in NFC already."""
    return F.lower(F.concat(iso3, F.lit("-"), F.replace(label, F.lit(" "), F.lit(""))))
