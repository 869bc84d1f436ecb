"""Staging: landed rows, whose every value is text, as typed rows under the names and spellings that the models use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOMENT = "yyyy-MM-dd'T'HH:mm'Z'"


def _text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def moment(name: str) -> Column:
    """A time as the feed writes it; anything else is an error."""
    return F.to_timestamp_ntz(_text(name), F.lit(MOMENT))


def typed(landed: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return landed.select(*(c.alias(name) for name, c in columns.items()))


def national(landed: DataFrame) -> DataFrame:
    """ts, forecast, actual, band; blanks are null."""
    return typed(landed, {"ts": moment("ts"), "forecast": _text("forecast").cast("int"), "actual": _text("actual").cast("int"), "band": F.lower(_text("band"))})


def mix(landed: DataFrame) -> DataFrame:
    """ts, fuel in lower case, share."""
    return typed(landed, {"ts": moment("ts"), "fuel": F.lower(_text("fuel")), "share": _text("share").cast("double")})


def regional(landed: DataFrame) -> DataFrame:
    return typed(landed, {"ts": moment("ts"), "region_id": _text("region_id").cast("int"), "forecast": _text("forecast").cast("int"), "band": F.lower(_text("band"))})


def regional_mix(landed: DataFrame) -> DataFrame:
    return typed(landed, {"ts": moment("ts"), "region_id": _text("region_id").cast("int"), "fuel": F.lower(_text("fuel")), "share": _text("share").cast("double")})
