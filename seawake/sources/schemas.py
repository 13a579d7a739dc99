"""Fixed table layouts: names, order and types are those of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from seawake.config import REGION_LAYERS

_TEXT, _INTEGER, _FLOAT = StringType(), LongType(), DoubleType()
_TIME, _DATE = TimestampType(), DateType()


def _schema(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# Messages tagged with their event.
STATE_SCHEMA = _schema(
    ssvid=_TEXT,
    seg_id=_TEXT,
    timestamp=_TIME,
    year=_INTEGER,
    lat=_FLOAT,
    lon=_FLOAT,
    speed_knots=_FLOAT,
    meters_to_prev=_FLOAT,
    implied_speed_knots=_FLOAT,
    hours=_FLOAT,
    score=_FLOAT,
    event_start=_TIME,
    event_end=_TIME,
    event_end_date=_DATE,
)

POINT = _schema(lon=_FLOAT, lat=_FLOAT)
GEO_INFO = ArrayType(_schema(point=POINT, s2_cell=_INTEGER))

# Summarized and filtered fishing events.
FILTERED_SCHEMA = _schema(
    ssvid=_TEXT,
    seg_id=_TEXT,
    vessel_id=_TEXT,
    main_vessel_shipname=_TEXT,
    main_vessel_flag=_TEXT,
    best_best_vessel_class=_TEXT,
    geo_info=GEO_INFO,
    event_start=_TIME,
    event_end=_TIME,
    lat_min=_FLOAT,
    lat_max=_FLOAT,
    message_count=_INTEGER,
    avg_speed_knots=_FLOAT,
    avg_implied_speed_knots=_FLOAT,
    avg_meters_to_prev=_FLOAT,
    event_distance_m=_FLOAT,
    avg_hours=_FLOAT,
    points_wkt=_TEXT,
    lat_mean=_FLOAT,
    lon_mean=_FLOAT,
    lon_min=_FLOAT,
    lon_max=_FLOAT,
    event_id=_TEXT,
    event_end_date=_DATE,
)

REGIONS = _schema(**{layer: ArrayType(_TEXT) for layer in REGION_LAYERS})

# Published events of all four types.
EVENTS_SCHEMA = _schema(
    event_id=_TEXT,
    event_type=_TEXT,
    vessel_id=_TEXT,
    seg_id=_TEXT,
    event_start=_TIME,
    event_end=_TIME,
    lat_mean=_FLOAT,
    lon_mean=_FLOAT,
    lat_min=_FLOAT,
    lat_max=_FLOAT,
    lon_min=_FLOAT,
    lon_max=_FLOAT,
    regions_mean_position=REGIONS,
    start_distance_from_shore_km=_FLOAT,
    end_distance_from_shore_km=_FLOAT,
    start_distance_from_port_km=_FLOAT,
    end_distance_from_port_km=_FLOAT,
    event_info=_TEXT,
    event_vessels=_TEXT,
)


def conform(df: DataFrame, schema: StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Columns of the schema, in its order and types.

    A missing column is an error unless it is named optional; then it is null.
    """
    missing = [n for n in schema.names if n not in df.columns and n not in optional]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
