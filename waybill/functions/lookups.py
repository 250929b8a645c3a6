"""Fixed small lookups as map literals."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.functions.geo import col
from waybill.schemas import ACCIDENT_RISK, WEATHER_SENSITIVITY, WEATHER_SEVERITY


def lookup(value: Column | str, table: dict) -> Column:
    """Value of a literal map; null for unknown keys."""
    literal = F.create_map(*(F.lit(x) for x in chain.from_iterable(table.items())))
    return F.try_element_at(literal, col(value))


def weather_sensitivity(vehicle_type: Column | str) -> Column:
    return lookup(vehicle_type, WEATHER_SENSITIVITY)


def accident_risk(vehicle_type: Column | str) -> Column:
    return lookup(vehicle_type, ACCIDENT_RISK)


def weather_severity(weather_type: Column | str) -> Column:
    return lookup(weather_type, WEATHER_SEVERITY)
