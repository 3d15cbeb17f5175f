"""JSON edge payloads."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from skyledger.functions import casts, text
from skyledger.operators import parse
from skyledger.operators.variant import parse_documents
from skyledger.schemas import LANDING, RECORD
from skyledger.sinks.conform import conform
from skyledger.sources import cities

FULL_CITY = {
    "name": "E",
    "country": "EE",
    "coord": {"lat": 1.5, "lon": "-2.25"},
    "sunrise": 1700000000,
    "sunset": 1700040000,
}


def landed(spark, body, kind="current", url="https://api.example/x?lat=1.500000&lon=-2.250000"):
    body = body if body is None or isinstance(body, str) else json.dumps(body)
    return spark.createDataFrame([(kind, "asked", url, 200, body, None, None)], LANDING)


@pytest.fixture
def current(spark):
    return lambda body: parse.parse_current(landed(spark, body)).first()


@pytest.fixture
def forecast(spark):
    return lambda body: parse.parse_forecast_first(landed(spark, body, "forecast")).first()


def test_numbers_and_numeric_text(current):
    row = current('{"main":{"temp":12.50,"humidity":"45"},"dt":1700000000}')
    assert float(row["temperature"]) == 12.5 and row["humidity"] == 45
    assert row["api_timestamp"] == datetime.datetime(2023, 11, 14, 22, 13, 20)
    assert row["parse_error"] is None


def test_a_bad_leaf_spoils_nothing_else(current):
    row = current({"main": {"temp": "abc", "humidity": 81.9}})
    assert row["temperature"] is None and row["humidity"] == 81 and row["parse_error"] is None
    row = current({"main": {"temp": None, "humidity": -3.7}})
    assert row["temperature"] is None and row["humidity"] == -3
    assert current({"main": {"humidity": "x"}})["humidity"] is None


@pytest.mark.parametrize("body", ["nope", "", None, '{"dt":1', "{'dt':1}"])
def test_text_that_is_not_json_is_rejected(current, forecast, body):
    assert current(body)["parse_error"] == parse.MALFORMED
    assert forecast(body)["parse_error"] == parse.MALFORMED


@pytest.mark.parametrize("body", [{"main": 5, "dt": 1700000000}, {"list": 5, "dt": 1700000000}])
def test_an_odd_shape_is_not_malformed(current, body):
    row = current(body)
    assert row["parse_error"] is None and row["temperature"] is None
    assert row["api_timestamp"] is not None


@pytest.mark.parametrize("body", [{"list": [], "city": FULL_CITY}, {"city": FULL_CITY}, {"list": "x", "city": FULL_CITY}])
def test_forecast_without_entries_keeps_the_city(forecast, body):
    row = forecast(body)
    assert (row["city"], row["country"]) == ("E", "EE")
    assert row["temperature"] is None and row["api_timestamp"] is None and row["parse_error"] is None


def test_only_the_first_forecast_entry_counts(forecast):
    entries = [{"main": {"temp": t}, "dt": 1700000000 + t} for t in (1, 2, 3)]
    entries[1]["wind"] = {"speed": 9}
    row = forecast({"list": entries, "city": FULL_CITY})
    assert float(row["temperature"]) == 1 and row["wind_speed"] is None


def test_empty_weather_list(current):
    row = current({"weather": [], "name": "A"})
    assert row["weather_main"] is None and row["weather_description"] is None


def test_an_incomplete_coord_hides_the_city_coord(current):
    row = current({"coord": {"lat": 3}, "city": FULL_CITY})
    assert row["latitude"] is None and row["longitude"] is None


def test_city_coord_when_there_is_no_coord(current):
    row = current({"city": FULL_CITY})
    assert (float(row["latitude"]), float(row["longitude"])) == (1.5, -2.25)
    assert row["city"] == "E" and row["sunrise_time"] is not None


def test_an_empty_sys_hides_the_sun_but_not_the_country(current):
    row = current({"sys": {}, "city": FULL_CITY})
    assert row["sunrise_time"] is None and row["sunset_time"] is None
    assert row["country"] == "EE"


def test_a_wide_value_is_parsed(current):
    assert float(current({"main": {"temp": 123456.7}})["temperature"]) == 123456.7


@pytest.mark.parametrize("dt", [10**18, -(10**18), "soon", 10**40, True])
def test_absurd_times_are_null(current, dt):
    row = current({"dt": dt, "name": "A"})
    assert row["api_timestamp"] is None and row["city"] == "A"


def test_uv_takes_coordinates_from_the_request(spark):
    parsed = parse.parse_uv(landed(spark, {"value": 7.25, "lat": 9}, "uv"))
    row = parsed.first()
    assert (float(row["latitude"]), float(row["longitude"])) == (1.5, -2.25)
    assert float(conform(parsed).first()["uv_index"]) == 7.3
    assert parse.parse_uv(landed(spark, "{}", "uv")).first()["uv_index"] is None


def test_mixed_kinds_in_one_pass(spark):
    """The one-pass parser gives each kind what its own parser gives."""
    bodies = [
        {"coord": {"lat": 3}, "city": FULL_CITY, "main": {"temp": 5}, "list": [{"main": {"temp": 6}}]},
        {"sys": {}, "name": "N", "city": FULL_CITY, "dt": 1, "list": []},
        {"name": "N", "weather": [{"main": "m"}], "city": 4},
        "nope",
    ]
    for kind, alone in (("current", parse.parse_current), ("forecast", parse.parse_forecast_first)):
        rows = None
        for body in bodies:
            one = landed(spark, body, kind)
            rows = one if rows is None else rows.unionByName(one)
        assert parse.parse_records(rows).collect() == alone(rows).collect()


def test_conform_narrows_and_fills(spark):
    got = conform(spark.sql("SELECT 12.345 AS temperature, -12.345 AS feels_like, 1e9 AS temp_min"))
    assert got.schema == RECORD
    row = got.first()
    assert (str(row["temperature"]), str(row["feels_like"]), row["temp_min"]) == ("12.35", "-12.35", None)


def test_url_parameter(spark):
    cases = {
        "https://a/b?q=London&x=1": "London",
        "https://a/b?x=1&q=São Paulo": "São Paulo",
        "https://a/b?x=1": "unknown",
        "https://a/b?q=": "unknown",
        "https://a/b?q=&x=1": "",
        None: "unknown",
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    got = rows.select("url", text.url_param(F.col("url"), "q").alias("v")).collect()
    assert {r["url"]: r["v"] for r in got} == cases


def test_redaction(spark):
    row = spark.sql("SELECT 'https://a/b?appid=secret&q=x&appid=more' AS url")
    assert row.select(text.redact_param(F.col("url"), "appid")).first()[0] == (
        "https://a/b?appid=***&q=x&appid=***"
    )


def test_city_list(spark):
    def listed(value):
        return [r["city"] for r in cities.city_dimension(spark, value).collect()]

    assert listed(" London , Delhi") == ["London", "Delhi"] == cities.names(" London , Delhi")
    assert listed("A,,B,,") == ["A", "", "B"] == cities.names("A,,B,,")
    assert len(listed(cities.DEPLOYED_CITIES)) == 10


def test_now_is_utc(spark):
    row = spark.range(3).select(casts.utc_now().alias("t")).distinct().collect()
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert len(row) == 1 and abs((now - row[0]["t"]).total_seconds()) < 60


def test_documents_of_any_shape(spark):
    """Kinds in one pass; what nobody asked for is kept."""
    bodies = [
        ("current", '{"name":"A","main":{"temp":"1.5","humidity":"40.9"},"extra":{"depth":[7,8]}}'),
        ("forecast", '{"city":{"name":"B","coord":{"lat":1,"lon":2}},"list":[{"main":{"temp":3}},{"main":{"temp":9}}]}'),
        ("current", '{"name":"C","coord":{"lat":5},"city":{"coord":{"lat":1,"lon":2}},"sys":7}'),
        ("uv", '{"value":4.25}'), ("current", "[1,"), ("current", None), ("current", "null"), ("current", "5"),
        ("current", '{"name":"D","name":"E"}'),
    ]
    rows = [(k, "x", "https://x/?lat=1.25&lon=2.5", 200, b, None, str(n)) for n, (k, b) in enumerate(bodies)]
    found = parse_documents(spark.createDataFrame(rows, LANDING))
    got = {int(r["cycle"]): r for r in found.collect()}
    assert (got[0]["city"], float(got[0]["temperature"]), got[0]["humidity"]) == ("A", 1.5, 40)
    assert (got[1]["city"], float(got[1]["latitude"]), float(got[1]["temperature"])) == ("B", 1, 3)
    # An own place hides the other even if it lacks a part.
    assert got[2]["latitude"] is None and got[2]["parse_error"] is None
    assert (float(got[3]["latitude"]), float(got[3]["uv_index"]), got[3]["city"]) == (1.25, 4.25, None)
    assert [got[k]["parse_error"] for k in range(4, 9)] == ["malformed body", "malformed body", None, None, "malformed body"]
    depth = found.filter("city = 'A'").select(F.variant_get("document", "$.extra.depth[1]", "int"))
    assert depth.first()[0] == 8


def test_whole_numbers_are_cut_off(spark):
    """Also those that a double would round up."""
    numbers = "'12.999999999999999999', '-12.999999999999999999', '0.5', '2147483647.9', '2147483648', NULL"
    rows = spark.sql(f"SELECT EXPLODE(ARRAY({numbers})) AS t").select(F.col("t").cast("decimal(38,18)").alias("n"))
    assert [r[0] for r in rows.select(casts.to_whole(F.col("n"))).collect()] == [12, -12, 0, 2147483647, None, None]


def test_documents_are_walked_once(spark):
    """One read of a document per object, not per leaf; misfits spoil no sibling."""
    body = '{"name":"A","main":{"temp":"x","humidity":7,"pressure":{}},"wind":3,"weather":[5],"sys":{},"city":{"sunset":9}}'
    rows = [("current", "x", "https://x", 200, body, None, "c"), (None, "x", "https://x", 200, body, None, "c")]
    found = parse_documents(spark.createDataFrame(rows, LANDING))
    got = found.collect()[0]
    assert (got["temperature"], got["humidity"], got["pressure"], got["wind_speed"]) == (None, 7, None, None)
    assert (got["weather_main"], got["sunset_time"], found.collect()[1]["city"]) == (None, None, None)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("variant_get(") < 10
