"""Boundary rows with expected values for both profiles."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyledger.functions import rules
from skyledger.operators import stats
from skyledger.operators.enrich import enrich, report_projection
from skyledger.sinks.conform import conform

INPUTS = "id int, temperature decimal(5,2), humidity int, pressure int, wind_speed decimal(5,2), weather_description string"

# id; temperature, humidity, pressure, wind, description
ROWS = [
    (1, "-10.01", 50, 1000, "10.01", "Heavy Rain"),
    (2, "-10.00", 50, 1000, "25.00", "fog"),
    (3, "-0.01", 50, 1000, "5.00", "clear sky"),
    (4, "0.00", 50, 1000, "15.00", "Snow"),
    (5, "10.00", 39, 1000, "4.99", "mist"),
    (6, "10.01", 40, 1000, "15.01", "clear sky"),
    (7, "18.00", 40, 1000, "5.00", "clear sky"),
    (8, "20.00", 41, 1000, "25.00", "light rain"),
    (9, "24.00", 60, 1000, "2.00", "clear sky"),
    (10, "24.01", 60, 1000, "2.00", "clear sky"),
    (11, "27.00", 40, 1000, "25.01", "Tornado"),
    (12, "27.00", 39, 1000, "2.00", "clear sky"),
    (13, "27.01", 40, 1000, "2.00", "clear sky"),
    (14, "30.00", 80, 1000, "20.00", "clear sky"),
    (15, "30.01", 100, 1000, "20.01", "thunderstorm"),
    (16, "35.00", 81, 1000, "3.00", "clear sky"),
    (17, "35.01", 55, 1000, "2.00", "clear sky"),
    (18, "40.01", 19, 1000, "26.00", "hurricane"),
    (19, None, 50, 1000, "1.00", "clear sky"),
    (20, "20.00", None, 1000, None, None),
    (21, None, 90, None, None, ""),
    (22, None, None, None, None, None),
    (23, "4.99", 9, 1000, "2.00", "heavy intensity rain"),
]

# id: temperature category, heat index, wind category, comfort, quality, fahrenheit
STRICT = {
    1: ("Freezing", -10.01, "Moderate", "Uncomfortable", 100, 13.98),
    2: ("Freezing", -10.0, "Strong", "Uncomfortable", 100, 14.0),
    3: ("Freezing", -0.01, "Moderate", "Uncomfortable", 100, 31.98),
    4: ("Cold", 0.0, "Moderate", "Uncomfortable", 100, 32.0),
    5: ("Cold", 10.0, "Light", "Moderate", 100, 50.0),
    6: ("Mild", 10.01, "Strong", "Moderate", 100, 50.02),
    7: ("Mild", 18.0, "Moderate", "Comfortable", 100, 64.4),
    8: ("Mild", 20.0, "Strong", "Comfortable", 100, 68.0),
    9: ("Warm", 24.0, "Light", "Comfortable", 100, 75.2),
    10: ("Warm", 24.01, "Light", "Moderate", 100, 75.22),
    11: ("Warm", 27.8, "Very Strong", "Moderate", 100, 80.6),
    12: ("Warm", 27.0, "Light", "Moderate", 100, 80.6),
    13: ("Warm", 27.82, "Light", "Moderate", 100, 80.62),
    14: ("Warm", 33.1, "Strong", "Moderate", 100, 86.0),
    15: ("Hot", 33.52, "Strong", "Humid/Dry", 100, 86.02),
    16: ("Hot", 40.62, "Light", "Humid/Dry", 100, 95.0),
    17: ("Hot", 40.12, "Light", "Uncomfortable", 100, 95.02),
    18: ("Hot", 40.01, "Very Strong", "Uncomfortable", 100, 104.02),
    19: ("Hot", None, "Light", "Moderate", 75, None),
    20: ("Mild", 20.0, "Very Strong", "Moderate", 75, 68.0),
    21: ("Hot", None, "Very Strong", "Humid/Dry", 75, None),
    22: ("Hot", None, "Very Strong", "Moderate", 75, None),
    23: ("Cold", 4.99, "Light", "Uncomfortable", 100, 40.98),
}

# The same, then severity, extreme, recommendation.
ZERO = {
    1: ("Freezing", -10.01, "Moderate", "Uncomfortable", 100, 13.98, 7, True, rules.ICE),
    2: ("Freezing", -10.0, "Strong", "Uncomfortable", 100, 14.0, 5, True, rules.ICE),
    3: ("Freezing", -0.01, "Moderate", "Uncomfortable", 100, 31.98, 2, False, rules.ICE),
    4: ("Cold", 0.0, "Moderate", "Uncomfortable", 100, 32.0, 5, False, rules.PLEASANT),
    5: ("Cold", 10.0, "Light", "Moderate", 100, 50.0, 1, False, rules.PLEASANT),
    6: ("Mild", 10.01, "Strong", "Moderate", 100, 50.02, 2, False, rules.PLEASANT),
    7: ("Mild", 18.0, "Moderate", "Comfortable", 100, 64.4, 0, False, rules.PLEASANT),
    8: ("Mild", 20.0, "Strong", "Comfortable", 100, 68.0, 4, True, rules.SECURE),
    9: ("Warm", 24.0, "Light", "Comfortable", 100, 75.2, 0, False, rules.PLEASANT),
    10: ("Warm", 24.01, "Light", "Moderate", 100, 75.22, 0, False, rules.PLEASANT),
    11: ("Warm", 27.8, "Very Strong", "Moderate", 100, 80.6, 8, True, rules.SECURE),
    12: ("Warm", 27.0, "Light", "Moderate", 100, 80.6, 0, False, rules.PLEASANT),
    13: ("Warm", 27.82, "Light", "Moderate", 100, 80.62, 0, False, rules.PLEASANT),
    14: ("Warm", 33.1, "Strong", "Moderate", 100, 86.0, 2, False, rules.PLEASANT),
    15: ("Hot", 33.52, "Strong", "Humid/Dry", 100, 86.02, 8, True, rules.SECURE),
    16: ("Hot", 40.62, "Light", "Humid/Dry", 100, 95.0, 1, False, rules.HUMID),
    17: ("Hot", 40.12, "Light", "Uncomfortable", 100, 95.02, 2, False, rules.HYDRATE),
    18: ("Hot", 40.01, "Very Strong", "Uncomfortable", 100, 104.02, 10, True, rules.HYDRATE),
    19: ("Cold", 0.0, "Light", "Uncomfortable", 80, 32.0, 0, False, rules.PLEASANT),
    20: ("Mild", 20.0, "Light", "Humid/Dry", 65, 68.0, 0, True, rules.PLEASANT),
    21: ("Cold", 0.0, "Light", "Uncomfortable", 45, 32.0, 0, False, rules.HUMID),
    22: ("Cold", 0.0, "Light", "Uncomfortable", 30, 32.0, 0, True, rules.PLEASANT),
    23: ("Cold", 4.99, "Light", "Uncomfortable", 100, 40.98, 3, True, rules.UMBRELLA),
}

COMMON = (
    "temperature_category",
    "heat_index",
    "wind_category",
    "comfort_level",
    "data_quality_score",
    "temperature_fahrenheit",
)


@pytest.fixture(scope="module", params=["decimal(5,2)", "decimal(38,18)"])
def rows(spark, request):
    """Stored width, and the width of freshly parsed measures."""

    def exact(text):
        return None if text is None else Decimal(text)

    data = [(i, exact(t), h, p, exact(w), d) for i, t, h, p, w, d in ROWS]
    frame = spark.createDataFrame(data, INPUTS)
    return frame.withColumns(
        {name: F.col(name).cast(request.param) for name in ("temperature", "wind_speed")}
    )


def test_strict_profile(rows):
    got = {r["id"]: tuple(r[c] for c in COMMON) for r in enrich(rows, "strict").collect()}
    assert got == STRICT


def test_zero_default_profile(rows):
    columns = (*COMMON, "weather_severity_index", "is_extreme", "recommendation")
    got = {r["id"]: tuple(r[c] for c in columns) for r in enrich(rows, "zero_default").collect()}
    assert got == ZERO


def test_heat_index_rounds_ties_up(spark):
    """0.5 × 1.01 ends in 5 at the third decimal; doubles often miss it."""
    t = spark.range(2700, 5000).select((F.col("id").cast("decimal(10,2)") / 100).cast("decimal(5,2)").alias("t"))
    got = t.select("t", rules.heat_index(F.col("t"), F.lit(55)).alias("h")).collect()
    for row in got:
        exact = row["t"] + (row["t"] - 27) / 2 + Decimal("1.1")
        assert row["h"] == float(exact.quantize(Decimal("0.01"), "ROUND_HALF_UP"))


def test_report_projection_has_twenty_columns(rows):
    full = conform(rows).drop(*[c for c in STRICT_DERIVED])
    assert len(report_projection(enrich(full)).columns) == 20


STRICT_DERIVED = (
    *COMMON,
    "processing_timestamp",
)


def test_each_row_falls_in_exactly_one_category(spark):
    measures = spark.range(-6000, 6000, 7).select(
        (F.col("id").cast("decimal(10,2)") / 100).cast("decimal(5,2)").alias("temperature"),
        (F.abs("id") % 101).cast("int").alias("humidity"),
        F.lit(1000).alias("pressure"),
        (F.abs("id") % 4000 / 100).cast("decimal(5,2)").alias("wind_speed"),
        F.lit("fog").alias("weather_description"),
    )
    for profile in ("strict", "zero_default"):
        rows = enrich(measures, profile)
        for label in ("temperature_category", "wind_category", "comfort_level"):
            counted = stats.distribution(rows, label).collect()
            assert sum(r["row_count"] for r in counted) == rows.count()
            assert all(r[label] is not None for r in counted)


def test_reports_on_no_rows(spark):
    none = enrich(spark.createDataFrame([], INPUTS), "zero_default")
    assert stats.average_quality(none).first()["avg_quality"] == 0
    assert stats.extreme_count(none).first().asDict() == {"extreme_records": 0, "total_records": 0}
    assert stats.distribution_of_total(none).collect() == []


def test_deviation_of_one_row_is_null(rows):
    one = enrich(rows.filter("id = 1")).withColumn("city_name", F.lit("x"))
    row = stats.temperature_stats(one).first()
    assert row["temp_stddev"] is None and row["avg_temperature"] == -10.01
