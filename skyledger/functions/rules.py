"""Enrichment rules as column expressions.

All functions take columns and return a column, so they run inside generated
code and keep filters and column pruning effective.  They treat NULL as SQL
does ("strict"); :func:`zero_default` wraps inputs for the second profile, in
which a missing measure counts as zero.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
# Band tables: (bound, is the bound itself inside, label); first match wins.
TEMPERATURE_BANDS = (
    (0, False, "Freezing"),
    (10, True, "Cold"),
    (20, True, "Mild"),
    (30, True, "Warm"),
)
TEMPERATURE_ABOVE = "Hot"
WIND_BANDS = (
    (5, False, "Light"),
    (15, True, "Moderate"),
    (25, True, "Strong"),
)
WIND_ABOVE = "Very Strong"

# Severity points: outside (low, high) for temperature, above for wind.
TEMPERATURE_POINTS = ((-10, 40, 3), (0, 35, 2), (5, 30, 1))
WIND_POINTS = ((25, 3), (15, 2), (10, 1))
# A thunderstorm already counts as a storm, hence five points.
DESCRIPTION_POINTS = (
    (("storm", "tornado", "hurricane"), 5),
    (("heavy rain", "snow"), 3),
    (("rain",), 2),
    (("fog", "mist"), 1),
)
SEVERITY_CAP = 10

HYDRATE = "🌡️ Stay hydrated and avoid direct sunlight"
ICE = "🧥 Dress warmly and be careful of ice"
SECURE = "💨 Strong winds - secure loose objects"
HUMID = "💧 High humidity - stay cool and hydrated"
UMBRELLA = "☔ Carry an umbrella"
PLEASANT = "😊 Pleasant weather conditions"

# Points lost per missing field.
QUALITY_LOSSES = (("temperature", 20), ("humidity", 15), ("pressure", 15), ("wind_speed", 10))
DESCRIPTION_LOSS = 10
# ----------------------------------------------------------------------------


def first_match(cases: Iterable[tuple[Column, Column]], otherwise: Column) -> Column:
    """CASE WHEN over (condition, value) pairs."""
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def number(value: int | str) -> Column:
    """Exact decimal literal; avoids double arithmetic."""
    return F.lit(Decimal(str(value)))


def banded(value: Column, bands: Sequence[tuple[int, bool, str]], above: str) -> Column:
    """Label a measure by ascending bounds.  NULL matches no band, so it gets ``above``."""
    return first_match(
        (
            (value <= number(bound) if inside else value < number(bound), F.lit(label))
            for bound, inside, label in bands
        ),
        F.lit(above),
    )


def zero_default(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def temperature_category(temperature: Column) -> Column:
    return banded(temperature, TEMPERATURE_BANDS, TEMPERATURE_ABOVE)


def wind_category(wind_speed: Column) -> Column:
    return banded(wind_speed, WIND_BANDS, WIND_ABOVE)


def heat_index(temperature: Column, humidity: Column) -> Column:
    """Felt heat in °C.  Decimal until the end: half-up ties at the third
    decimal are common here and double arithmetic gets them wrong."""
    felt = (
        temperature
        + number("0.5") * (temperature - number(27))
        + humidity.cast("decimal(10,0)") * number("0.02")
    )
    hot_and_humid = (temperature >= number(27)) & (humidity >= 40)
    return F.when(hot_and_humid, F.round(felt, 2).cast("double")).otherwise(
        temperature.cast("double")
    )


def fahrenheit(temperature: Column) -> Column:
    return F.round(temperature * number("1.8") + number(32), 2).cast("double")


def comfort_level(temperature: Column, humidity: Column) -> Column:
    return first_match(
        (
            (
                temperature.between(number(18), number(24)) & humidity.between(40, 60),
                F.lit("Comfortable"),
            ),
            ((temperature < number(5)) | (temperature > number(35)), F.lit("Uncomfortable")),
            ((humidity > 80) | (humidity < 20), F.lit("Humid/Dry")),
        ),
        F.lit("Moderate"),
    )


def quality_binary(*required: Column) -> Column:
    """100 when every required field is present, else 75."""
    present = F.lit(True)
    for field in required:
        present = present & field.isNotNull()
    return F.when(present, F.lit(100)).otherwise(F.lit(75))


def quality_weighted(
    temperature: Column, humidity: Column, pressure: Column, wind_speed: Column, description: Column
) -> Column:
    """100 minus a loss per missing field, never below zero."""
    fields = dict(
        temperature=temperature, humidity=humidity, pressure=pressure, wind_speed=wind_speed
    )
    score = F.lit(100)
    for name, loss in QUALITY_LOSSES:
        score = score - F.when(fields[name].isNull(), F.lit(loss)).otherwise(F.lit(0))
    no_text = description.isNull() | (description == "")
    score = score - F.when(no_text, F.lit(DESCRIPTION_LOSS)).otherwise(F.lit(0))
    return F.greatest(score, F.lit(0))


def severity(temperature: Column, wind_speed: Column, description: Column) -> Column:
    """0 to 10 from three independent point tables; a NULL input adds nothing."""
    nothing = F.lit(0)
    by_temperature = first_match(
        (
            ((temperature < number(low)) | (temperature > number(high)), F.lit(points))
            for low, high, points in TEMPERATURE_POINTS
        ),
        nothing,
    )
    by_wind = first_match(
        ((wind_speed > number(above), F.lit(points)) for above, points in WIND_POINTS), nothing
    )
    lowered = F.lower(description)
    by_text = first_match(
        ((mentions(lowered, words), F.lit(points)) for words, points in DESCRIPTION_POINTS),
        nothing,
    )
    return F.least(by_temperature + by_wind + by_text, F.lit(SEVERITY_CAP))


def mentions(text: Column, words: Sequence[str]) -> Column:
    found = text.contains(words[0])
    for word in words[1:]:
        found = found | text.contains(word)
    return found


def extreme(temperature: Column, wind_speed: Column, humidity: Column) -> Column:
    return (
        (temperature < number(-5))
        | (temperature > number(40))
        | (wind_speed > number(20))
        | (humidity > 90)
        | (humidity < 10)
    )


def recommendation(
    temperature: Column, humidity: Column, wind_speed: Column, description: Column
) -> Column:
    return first_match(
        (
            (temperature > number(35), F.lit(HYDRATE)),
            (temperature < number(0), F.lit(ICE)),
            (wind_speed > number(20), F.lit(SECURE)),
            (humidity > 80, F.lit(HUMID)),
            (F.lower(description).contains("rain"), F.lit(UMBRELLA)),
        ),
        F.lit(PLEASANT),
    )
