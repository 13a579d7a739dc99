"""JSON texts written to and read from events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(value: Column) -> Column:
    """JSON of a struct or array, with nulls written as ``null``."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_scalar(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)


def json_string_or_null(text: Column, path: str) -> Column:
    """The value at path if it is a JSON string, else null (numbers are not turned to text)."""
    node = F.try_variant_get(F.try_parse_json(text), path, "variant")
    return F.when(F.schema_of_variant(node) == "STRING", F.try_variant_get(node, "$", "string"))


def first_vessel_field(event_vessels: Column, name: str) -> Column:
    return F.get_json_object(event_vessels, f"$[0].{name}")
