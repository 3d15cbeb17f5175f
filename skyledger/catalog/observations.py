"""Observation records and raw responses derived from the driver's tables.

``OBS`` is plain SQL that Spark and DuckDB read alike; everything else here is
built from it, so the work of each query grows with the ``events`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# City, country, latitude, longitude by user_id % 10.
PLACES = (
    ("London", "GB", "51.5074", "-0.1278"),
    ("Delhi", "IN", "28.6139", "77.2090"),
    ("Tokyo", "JP", "35.6762", "139.6503"),
    ("Paris", "FR", "48.8566", "2.3522"),
    ("Sydney", "AU", "-33.8688", "151.2093"),
    ("Mumbai", "IN", "19.0760", "72.8777"),
    ("Berlin", "DE", "52.5200", "13.4050"),
    ("Toronto", "CA", "43.6532", "-79.3832"),
    ("Singapore", "SG", "1.3521", "103.8198"),
    ("Dubai", "AE", "25.2048", "55.2708"),
)


def _by_place(part: int, quote: str = "") -> str:
    arms = " ".join(
        f"WHEN {i} THEN {quote}{place[part]}{quote}" for i, place in enumerate(PLACES[:-1])
    )
    return f"CASE user_id % 10 {arms} ELSE {quote}{PLACES[-1][part]}{quote} END"


def _hundredths(cents: str) -> str:
    return f"CAST(CAST({cents} AS DOUBLE)/100 AS DECIMAL(5,2))"


OBS = f"""
SELECT event_id AS obs_id,
 {_by_place(0, "'")} AS city,
 CASE WHEN event_id % 17 = 0 THEN NULL ELSE {_hundredths("(event_id*37) % 6500 - 1500")} END AS temperature,
 CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST((event_id*13) % 101 AS INT) END AS humidity,
 CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(980 + (event_id*7) % 60 AS INT) END AS pressure,
 CASE WHEN event_id % 23 = 0 THEN NULL ELSE {_hundredths("(event_id*11) % 3000")} END AS wind_speed,
 CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_type='view' THEN 'clear sky'
   WHEN event_type='click' THEN 'light rain' WHEN event_type='purchase' THEN 'heavy rain'
   WHEN event_type='signup' THEN 'mist' ELSE 'thunderstorm with rain' END AS weather_description,
 ts AS api_timestamp,
 {_by_place(1, "'")} AS country,
 CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST({_by_place(2)} AS DECIMAL(10,8)) END AS latitude,
 CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST({_by_place(3)} AS DECIMAL(11,8)) END AS longitude,
 {_hundredths("(event_id*37) % 6500 - 1700")} AS feels_like,
 {_hundredths("(event_id*37) % 6500 - 1900")} AS temp_min,
 {_hundredths("(event_id*37) % 6500 - 1200")} AS temp_max,
 CAST(1000 + event_id % 40 AS INT) AS sea_level,
 CAST(990 + event_id % 40 AS INT) AS ground_level,
 CAST((event_id*29) % 365 AS INT) AS wind_direction,
 {_hundredths("(event_id*11) % 3000 + 250")} AS wind_gust,
 CASE WHEN event_type='view' THEN 'Clear' WHEN event_type='signup' THEN 'Mist'
   WHEN event_type='error' THEN 'Thunderstorm' ELSE 'Rain' END AS weather_main,
 CAST((event_id*31) % 104 AS INT) AS cloudiness,
 CAST((event_id*101) % 10001 AS INT) AS visibility
FROM events
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_events(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(OBS.replace("FROM events", "FROM {events}"), events=events)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event; unused columns are pruned from the scan."""
    return from_events(table(spark, sf_dir, "events"))


def spread_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records dealt out evenly, for work that is heavy per row: the narrow
    event rows are moved, not the bodies made from them."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return from_events(events.repartition(spark.sparkContext.defaultParallelism))


def _epoch(at: str) -> str:
    return f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {at})"


def responses(obs: DataFrame, kind: str) -> DataFrame:
    """Landing rows of one kind, one per observation, with some of the faults
    real responses have:

    * every 53rd body is cut short, some requests fail (401, 404, 429, 500);
    * every 5th body gives numbers as text, humidity with a fraction;
    * every 41st of those has an unreadable temperature;
    * every 7th current body has its coordinates below ``city``;
    * forecasts hold two later entries that must not be used.
    """
    rows = obs.selectExpr(
        "*",
        f"{_epoch('api_timestamp')} AS _dt",
        "obs_id % 5 = 0 AS _texts",
    )
    number_main = """named_struct('temp', temperature, 'feels_like', feels_like,
        'temp_min', temp_min, 'temp_max', temp_max, 'humidity', humidity, 'pressure', pressure,
        'sea_level', sea_level, 'grnd_level', ground_level)"""
    text_main = """named_struct('temp', CASE WHEN obs_id % 41 = 0 THEN 'abc'
          ELSE CAST(temperature AS STRING) END,
        'feels_like', CAST(feels_like AS STRING), 'temp_min', CAST(temp_min AS STRING),
        'temp_max', CAST(temp_max AS STRING), 'humidity', CAST(humidity AS STRING) || '.9',
        'pressure', CAST(pressure AS STRING), 'sea_level', CAST(sea_level AS STRING),
        'grnd_level', CAST(ground_level AS STRING))"""
    rest = """'wind', named_struct('speed', wind_speed, 'deg', wind_direction, 'gust', wind_gust),
        'weather', array(named_struct('main', weather_main, 'description', weather_description)),
        'clouds', named_struct('all', cloudiness), 'visibility', visibility, 'dt', _dt"""
    later = """named_struct('main', named_struct('temp', 99.99, 'humidity', 1),
        'wind', named_struct('speed', 99.99), 'dt', _dt + 10800)"""
    coord = "named_struct('lat', latitude, 'lon', longitude)"
    sun = "'sunrise', _dt - 21600, 'sunset', _dt + 21600"

    if kind == "uv":
        body = "to_json(named_struct('value', CAST((obs_id * 3) % 120 AS DECIMAL(5,1)) / 10))"
    elif kind == "forecast":
        place = f"'city', named_struct('name', city, 'country', country, 'coord', {coord}, {sun})"
        texts, numbers = (
            f"""concat('{{"list":[', to_json(named_struct('main', {main}, {rest})), ',',
                to_json({later}), '],', substr(to_json(named_struct({place})), 2))"""
            for main in (text_main, number_main)
        )
        body = f"CASE WHEN _texts THEN {texts} ELSE {numbers} END"
    else:
        own = f"'coord', {coord}"
        below = f"'city', named_struct('coord', {coord})"
        place = f"'name', city, 'sys', named_struct('country', country, {sun})"
        texts, numbers = (
            f"""CASE WHEN obs_id % 7 = 0
                THEN to_json(named_struct({place}, {below}, 'main', {main}, {rest}))
                ELSE to_json(named_struct({place}, {own}, 'main', {main}, {rest})) END"""
            for main in (text_main, number_main)
        )
        body = f"CASE WHEN _texts THEN {texts} ELSE {numbers} END"

    by_coordinates = kind in ("uv", "current_by_coord")
    url = (
        """concat('https://api.example/data?lat=', CAST(CAST(latitude AS DECIMAL(10,6)) AS STRING),
           '&lon=', CAST(CAST(longitude AS DECIMAL(10,6)) AS STRING), '&appid=k', obs_id)"""
        if by_coordinates
        else "concat('https://api.example/data?q=', city, '&appid=k', obs_id, '&units=metric')"
    )
    return rows.withColumn("_body", F.expr(body)).selectExpr(
        "obs_id",
        f"'{kind}' AS kind",
        "CAST(NULL AS STRING) AS city" if by_coordinates else "city",
        f"{url} AS request_url",
        """CASE WHEN obs_id % 101 = 0 THEN 401 WHEN obs_id % 103 = 0 THEN 404
             WHEN obs_id % 107 = 0 THEN 429 WHEN obs_id % 109 = 0 THEN 500 ELSE 200 END AS status""",
        "CASE WHEN obs_id % 53 = 0 THEN substr(_body, 1, length(_body) - 1) ELSE _body END AS body",
        "api_timestamp AS fetched_at",
        # Each observation is a fetch cycle of its own: a place has many.
        "CAST(api_timestamp AS STRING) AS cycle",
    )
