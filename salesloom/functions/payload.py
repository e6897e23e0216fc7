"""Weather payload text to typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.columns import first_element, q
from salesloom.sources.schemas import WEATHER_FIELDS, WEATHER_PAYLOAD


def _number(reading: Column) -> Column:
    return reading.try_cast("double")


def _whole(reading: Column) -> Column:
    return F.coalesce(reading.try_cast("long"), F.rint(_number(reading)).try_cast("long"))


def _identifier(reading: Column) -> Column:
    """A whole number, also written as 803.0; nothing else is an id."""
    number = _number(reading)
    return F.when(number == F.rint(number), _whole(reading))


def _weather_columns() -> dict[str, Column]:
    station = first_element(F.col("_weather"))
    reading, wind = F.col("_main"), F.col("_wind")
    return {
        "weather_id": _identifier(station["id"]),
        "weather_main": station["main"],
        "weather_description": station["description"],
        "weather_icon": station["icon"],
        "temp": _number(reading["temp"]),
        "feels_like": _number(reading["feels_like"]),
        "temp_min": _number(reading["temp_min"]),
        "temp_max": _number(reading["temp_max"]),
        "pressure": _whole(reading["pressure"]),
        "humidity": _whole(reading["humidity"]),
        "visibility": _whole(F.col("_visibility")),
        "wind_speed": _number(wind["speed"]),
        "wind_deg": _whole(wind["deg"]),
        "cloudiness": _whole(F.col("_clouds")["all"]),
    }


def extract_payload(
    df: DataFrame,
    payload: str = "payload",
    on_missing: str = "drop",
    required: Sequence[str] = WEATHER_FIELDS,
) -> DataFrame:
    """Replace a JSON text column by the 14 weather columns; other columns follow them.

    A payload that is NULL, not JSON, or without one of the ``required`` fields is a failed
    lookup: ``on_missing="drop"`` leaves its row out, ``"fail"`` raises, ``"keep"`` keeps it
    with NULLs. ``from_json`` gives a struct of NULLs for bad text, hence the test of fields.
    """
    if on_missing not in ("drop", "fail", "keep"):
        raise ValueError(f"on_missing must be 'drop', 'fail' or 'keep', not {on_missing!r}")
    carried = [c for c in df.columns if c != payload]
    # A generator keeps the parsed text as columns. A plain projection would be merged into the
    # next one, and every field and every test of a field would parse the text again.
    parts = [f"_{name}" for name in WEATHER_PAYLOAD.fieldNames()]
    parsed = df.select(
        *[q(c) for c in carried],
        F.inline(F.array(F.from_json(q(payload), WEATHER_PAYLOAD))).alias(*parts),
    )
    fields = _weather_columns()
    out = parsed.select(*[c.alias(n) for n, c in fields.items()], *[q(c) for c in carried])
    if on_missing == "keep" or not required:
        return out
    complete = F.lit(True)
    for name in required:
        complete = complete & q(name).isNotNull()
    if on_missing == "fail":
        complete = F.when(complete, F.lit(True)).otherwise(
            F.raise_error(F.lit("weather payload without a required field")).cast("boolean")
        )
    return out.where(complete)
