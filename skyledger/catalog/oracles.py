"""The same answers in plain SQL, written apart from the DataFrame code."""

from __future__ import annotations

from skyledger.catalog.observations import OBS

# Fixed values in what follows: bounds and labels of the categories, texts of the reports.

# Rows the stored table refuses (NULL breaks no range).
_REASONS = """concat_ws(',',
  CASE WHEN wind_direction NOT BETWEEN 0 AND 360 THEN 'wind_direction out of range' END,
  CASE WHEN cloudiness NOT BETWEEN 0 AND 100 THEN 'cloudiness out of range' END)"""

_TEMPERATURE = """CASE WHEN temperature < 0 THEN 'Freezing'
  WHEN temperature BETWEEN 0 AND 10 THEN 'Cold' WHEN temperature BETWEEN 10 AND 20 THEN 'Mild'
  WHEN temperature BETWEEN 20 AND 30 THEN 'Warm' ELSE 'Hot' END"""
_HEAT = """CASE WHEN temperature >= 27 AND humidity >= 40 THEN
  CAST(ROUND(temperature + CAST(0.5 AS DECIMAL(2,1)) * (temperature - 27)
    + CAST(humidity AS DECIMAL(5,0)) * CAST(0.02 AS DECIMAL(3,2)), 2) AS DOUBLE)
  ELSE CAST(temperature AS DOUBLE) END"""
_WIND = """CASE WHEN wind_speed < 5 THEN 'Light' WHEN wind_speed BETWEEN 5 AND 15 THEN 'Moderate'
  WHEN wind_speed BETWEEN 15 AND 25 THEN 'Strong' ELSE 'Very Strong' END"""
_COMFORT = """CASE
  WHEN temperature BETWEEN 18 AND 24 AND humidity BETWEEN 40 AND 60 THEN 'Comfortable'
  WHEN temperature < 5 OR temperature > 35 THEN 'Uncomfortable'
  WHEN humidity > 80 OR humidity < 20 THEN 'Humid/Dry' ELSE 'Moderate' END"""
_QUALITY = """CASE WHEN temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL
  THEN 100 ELSE 75 END"""
_FAHRENHEIT = "CAST(ROUND(temperature * CAST(1.8 AS DECIMAL(2,1)) + 32, 2) AS DOUBLE)"

_O = f"WITH o AS ({OBS})"
_STRICT = f"""{_O}, s AS (SELECT *, city AS city_name, {_TEMPERATURE} AS temperature_category,
  {_HEAT} AS heat_index, {_WIND} AS wind_category, {_COMFORT} AS comfort_level,
  {_QUALITY} AS data_quality_score, {_FAHRENHEIT} AS temperature_fahrenheit FROM o)"""

# The second profile: missing measures count as zero, scores see what is missing.
_ZERO = f"""{_O}, z0 AS (SELECT obs_id, city, country, feels_like, pressure, wind_direction,
    visibility, api_timestamp, weather_description,
    temperature AS raw_t, humidity AS raw_h, wind_speed AS raw_w,
    COALESCE(temperature, 0) AS temperature, COALESCE(humidity, 0) AS humidity,
    COALESCE(wind_speed, 0) AS wind_speed, lower(weather_description) AS d FROM o),
  z AS (SELECT *, {_TEMPERATURE} AS temperature_category, {_HEAT} AS heat_index,
    {_WIND} AS wind_category, {_COMFORT} AS comfort_level,
    100 - CASE WHEN raw_t IS NULL THEN 20 ELSE 0 END - CASE WHEN raw_h IS NULL THEN 15 ELSE 0 END
      - CASE WHEN pressure IS NULL THEN 15 ELSE 0 END - CASE WHEN raw_w IS NULL THEN 10 ELSE 0 END
      - CASE WHEN weather_description IS NULL OR weather_description = '' THEN 10 ELSE 0 END
      AS data_quality_score,
    LEAST(10, CASE WHEN raw_t < -10 OR raw_t > 40 THEN 3 WHEN raw_t < 0 OR raw_t > 35 THEN 2
        WHEN raw_t < 5 OR raw_t > 30 THEN 1 ELSE 0 END
      + CASE WHEN raw_w > 25 THEN 3 WHEN raw_w > 15 THEN 2 WHEN raw_w > 10 THEN 1 ELSE 0 END
      + CASE WHEN d LIKE '%storm%' OR d LIKE '%tornado%' OR d LIKE '%hurricane%' THEN 5
        WHEN d LIKE '%heavy rain%' OR d LIKE '%snow%' THEN 3 WHEN d LIKE '%rain%' THEN 2
        WHEN d LIKE '%fog%' OR d LIKE '%mist%' THEN 1 ELSE 0 END) AS weather_severity_index,
    (temperature < -5 OR temperature > 40 OR wind_speed > 20 OR humidity > 90 OR humidity < 10)
      AS is_extreme,
    CASE WHEN temperature > 35 THEN '🌡️ Stay hydrated and avoid direct sunlight'
      WHEN temperature < 0 THEN '🧥 Dress warmly and be careful of ice'
      WHEN wind_speed > 20 THEN '💨 Strong winds - secure loose objects'
      WHEN humidity > 80 THEN '💧 High humidity - stay cool and hydrated'
      WHEN d LIKE '%rain%' THEN '☔ Carry an umbrella'
      ELSE '😊 Pleasant weather conditions' END AS recommendation,
    {_FAHRENHEIT} AS temperature_fahrenheit FROM z0)"""

# What a parsed response holds: every 53rd body is unreadable as a whole,
# every 41st of the text bodies (each 5th) has an unreadable temperature.
_CUT = "obs_id % 53 = 0"
_STATUS_OK = "obs_id % 101 <> 0 AND obs_id % 103 <> 0 AND obs_id % 107 <> 0 AND obs_id % 109 <> 0"
_READ_TEMPERATURE = "CASE WHEN obs_id % 205 = 0 THEN NULL ELSE temperature END"
_SECOND = "date_trunc('second', api_timestamp)"


def _parsed(kinds: bool = False) -> str:
    values = {
        "city": "city",
        "country": "country",
        "latitude": "CAST(latitude AS DOUBLE)",
        "longitude": "CAST(longitude AS DOUBLE)",
        "temperature": f"CAST({_READ_TEMPERATURE} AS DOUBLE)",
        **{
            name: f"CAST({name} AS DOUBLE)"
            for name in ("feels_like", "temp_min", "temp_max", "wind_speed", "wind_gust")
        },
        **{
            name: name
            for name in (
                "humidity", "pressure", "sea_level", "ground_level", "wind_direction",
                "weather_main", "weather_description", "cloudiness", "visibility",
            )
        },
        "sunrise_time": f"{_SECOND} - INTERVAL 6 HOUR",
        "sunset_time": f"{_SECOND} + INTERVAL 6 HOUR",
        "api_timestamp": _SECOND,
    }
    if kinds:
        place = "CAST(CAST({0} AS DECIMAL(10,6)) AS DOUBLE)"
        asked = {c: place.format(c) for c in ("latitude", "longitude")}
        cells = ", ".join(
            f"CASE WHEN kind = 'uv' THEN {asked.get(k, 'NULL')} WHEN {_CUT} THEN NULL ELSE {v} END AS {k}"
            for k, v in values.items()
        )
        return f"""{_O} SELECT kind, obs_id, {cells},
          CASE WHEN {_CUT} THEN 'malformed body' END AS parse_error,
          CASE WHEN kind = 'uv' AND NOT ({_CUT}) THEN {_UV_VALUE} END AS uv_index
          FROM o, (SELECT unnest(['current', 'forecast', 'current_by_coord', 'uv']) AS kind) k"""
    cells = ", ".join(f"CASE WHEN {_CUT} THEN NULL ELSE {v} END AS {k}" for k, v in values.items())
    return f"""{_O} SELECT obs_id, {cells},
      CASE WHEN {_CUT} THEN 'malformed body' END AS parse_error FROM o"""


# Latest readable UV value per place and cycle (here the time of a fetch); ties go to the higher value.
_UV_VALUE = "CAST((obs_id * 3) % 120 AS DOUBLE) / 10"
_CYCLE = "CAST({} AS VARCHAR)"


def _uv(where: str, cycle: str = "''") -> str:
    return f"""SELECT lat, lon, cycle, v FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY lat, lon, cycle ORDER BY api_timestamp DESC, v DESC) AS place
      FROM (SELECT CAST(latitude AS DECIMAL(10,6)) AS lat, CAST(longitude AS DECIMAL(10,6)) AS lon,
          {cycle} AS cycle, api_timestamp, {_UV_VALUE} AS v FROM o
        WHERE latitude IS NOT NULL AND {where}) r) w WHERE place = 1"""


_JOIN_UV = """LEFT JOIN u ON u.lat = CAST(latitude AS DECIMAL(10,6))
  AND u.lon = CAST(longitude AS DECIMAL(10,6))"""
# Records of a job carry the fetch time in recorded_at.
_JOIN_UV_CYCLE = f"{_JOIN_UV} AND u.cycle = {_CYCLE.format('recorded_at')}"

# Percentage rounded half-up to two places, in whole numbers.
_SHARE = "CAST((20000 * n + total) // (2 * total) AS DOUBLE) / 100"


def _mean(value: str) -> str:
    return f"ROUND(CAST(SUM({value}) AS DOUBLE) / NULLIF(COUNT({value}), 0), 6)"


def _distribution(source: str, label: str) -> str:
    return f"{source} SELECT {label}, COUNT(*) AS row_count FROM s GROUP BY {label}"


def _shares(source: str, table: str, label: str) -> str:
    return f"""{source} SELECT {label}, n AS row_count, {_SHARE} AS percentage
      FROM (SELECT {label}, COUNT(*) AS n FROM {table} GROUP BY 1) g,
           (SELECT COUNT(*) AS total FROM {table}) t"""


def _summary(source: str, table: str) -> str:
    def part(section: str, label: str) -> str:
        return f"""SELECT '{section}' AS section, {label} AS label, COUNT(*) AS n,
            CAST(NULL AS DOUBLE) AS mean_value, CAST(NULL AS DOUBLE) AS min_value,
            CAST(NULL AS DOUBLE) AS max_value FROM {table} GROUP BY {label}"""

    return f"""{source}, parts AS ({part('temperature_category', 'temperature_category')}
        UNION ALL {part('comfort_level', 'comfort_level')}
        UNION ALL {part('wind_category', 'wind_category')}
        UNION ALL SELECT 'quality_score', 'all', COUNT(*), {_mean('data_quality_score')},
          CAST(MIN(data_quality_score) AS DOUBLE), CAST(MAX(data_quality_score) AS DOUBLE) FROM {table})
      SELECT section, label, CAST(n AS BIGINT) AS row_count, mean_value, min_value, max_value,
        {_SHARE} AS percentage FROM parts, (SELECT COUNT(*) AS total FROM {table}) t"""


def _city_stats(source: str, table: str) -> str:
    return f"""{source} SELECT city_name, {_mean('temperature')} AS avg_temperature,
      CAST(MIN(temperature) AS DOUBLE) AS min_temperature,
      CAST(MAX(temperature) AS DOUBLE) AS max_temperature,
      ROUND(STDDEV_SAMP(CAST(temperature AS DOUBLE)), 6) AS temp_stddev
      FROM {table} GROUP BY city_name"""


# Records a job reads from the forecast responses, enriched; "stored" marks the
# ones the table takes.
_READ = f"""{_O}, f AS (SELECT obs_id, city, city AS city_name, country, latitude, longitude,
    {_READ_TEMPERATURE} AS temperature, feels_like, temp_min, temp_max, humidity, pressure,
    sea_level, ground_level, wind_speed, wind_direction, wind_gust, weather_main,
    weather_description, cloudiness, visibility, {_SECOND} - INTERVAL 6 HOUR AS sunrise_time,
    {_SECOND} + INTERVAL 6 HOUR AS sunset_time, {_SECOND} AS api_timestamp,
    api_timestamp AS recorded_at, {_REASONS} = '' AS stored
  FROM o WHERE NOT ({_CUT}) AND {_STATUS_OK}),
  u AS ({_uv(f"NOT ({_CUT}) AND {_STATUS_OK}", _CYCLE.format("api_timestamp"))}),
  j AS (SELECT *, {_TEMPERATURE} AS temperature_category, {_HEAT} AS heat_index,
    {_WIND} AS wind_category, {_COMFORT} AS comfort_level, {_QUALITY} AS data_quality_score,
    {_FAHRENHEIT} AS temperature_fahrenheit FROM f)"""

_DOUBLES = (
    "latitude", "longitude", "temperature", "feels_like", "temp_min", "temp_max", "wind_speed",
    "wind_gust", "heat_index", "temperature_fahrenheit",
)
_STORED = (
    "city", "country", "latitude", "longitude", "temperature", "feels_like", "temp_min",
    "temp_max", "humidity", "pressure", "sea_level", "ground_level", "wind_speed",
    "wind_direction", "wind_gust", "weather_main", "weather_description", "cloudiness",
    "visibility", "api_timestamp", "temperature_category", "heat_index", "wind_category",
    "comfort_level", "data_quality_score", "temperature_fahrenheit",
)
_NEVER_SET = """CAST(NULL AS INTEGER) AS weather_severity_index, CAST(NULL AS BOOLEAN) AS is_extreme,
  CAST(NULL AS VARCHAR) AS recommendation"""


def _cells(names) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if n in _DOUBLES else n for n in names)


def _rule(column: str, source: str = _STRICT, table: str = "s") -> str:
    return f"{source} SELECT obs_id, {column} FROM {table}"


_STREAMED = f"""{_READ} SELECT {_cells(_STORED)}, v AS uv_index, sunrise_time, sunset_time,
  recorded_at, {_NEVER_SET} FROM j {_JOIN_UV_CYCLE} WHERE stored"""

# Columns of each report, in name order, as they are told in long form.
_REPORT_COLUMNS = {
    "total_count": ("total_records",),
    "city_coverage": ("city", "row_count"),
    "data_quality": ("quality_percentage", "total_records", "valid_records"),
    "describe": ("max", "mean", "measure", "min", "n", "stddev"),
    "temperature_stats": (
        "avg_temperature", "city_name", "max_temperature", "min_temperature", "temp_stddev",
    ),
    "patterns": ("row_count", "temperature_category", "weather_description"),
    "comfort_distribution": ("comfort_level", "percentage", "row_count"),
    "batch_summary": (
        "label", "max_value", "mean_value", "min_value", "percentage", "row_count", "section",
    ),
}
_REPORTS = {
    "total_count": "SELECT COUNT(*) AS total_records FROM j WHERE stored",
    "city_coverage": """SELECT c.city, COUNT(t.city) AS row_count
      FROM (SELECT unnest(['London', 'Delhi', 'Tokyo', 'Paris', 'Sydney', 'Mumbai', 'Berlin',
        'Toronto', 'Singapore', 'Dubai']) AS city) c
      LEFT JOIN (SELECT city FROM j WHERE stored) t ON t.city = c.city GROUP BY c.city""",
    "data_quality": """SELECT valid AS valid_records, total AS total_records,
        CAST(valid AS DOUBLE) / total * 100.0 AS quality_percentage
      FROM (SELECT COUNT(CASE WHEN temperature IS NOT NULL AND humidity IS NOT NULL
          AND city IS NOT NULL THEN 1 END) AS valid, COUNT(*) AS total FROM j) c""",
    "describe": " UNION ALL ".join(
        f"""SELECT '{name}' AS measure, COUNT({name}) AS n, {_mean(name)} AS mean,
          ROUND(STDDEV_SAMP(CAST({name} AS DOUBLE)), 6) AS stddev,
          CAST(MIN({name}) AS DOUBLE) AS min, CAST(MAX({name}) AS DOUBLE) AS max FROM j"""
        for name in ("temperature", "humidity", "pressure", "wind_speed")
    ),
    "temperature_stats": _city_stats("", "j"),
    "patterns": """SELECT weather_description, temperature_category, COUNT(*) AS row_count
      FROM j GROUP BY 1, 2""",
    "comfort_distribution": _shares("", "j", "comfort_level"),
}


def _long(reports: dict[str, str]) -> str:
    """Reports one below the other, each row as name=value pairs."""
    parts = []
    for name, sql in reports.items():
        cells = " || ';' || ".join(
            f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'null')" for c in _REPORT_COLUMNS[name]
        )
        body = sql if not sql.lstrip().startswith(",") else f"WITH {sql.lstrip()[1:]}"
        parts.append(f"SELECT '{name}' AS report, {cells} AS cells FROM ({body}) r")
    return f"{_READ} " + " UNION ALL ".join(parts)


ORACLES: dict[str, str] = {
    "parse_current": _parsed(),
    "parse_forecast_first": _parsed(),
    "parse_variant": _parsed(kinds=True),
    "parse_uv": f"""{_O} SELECT obs_id, CAST(CAST(latitude AS DECIMAL(10,6)) AS DOUBLE) AS latitude,
        CAST(CAST(longitude AS DECIMAL(10,6)) AS DOUBLE) AS longitude,
        CASE WHEN {_CUT} THEN NULL ELSE {_UV_VALUE} END AS uv_index,
        CASE WHEN {_CUT} THEN 'malformed body' END AS parse_error FROM o""",
    "payload_kinds": f"""{_O} SELECT kind, COUNT(*) AS row_count,
        COUNT(CASE WHEN {_CUT} THEN 1 END) AS unreadable, COUNT(value) AS measured,
        ROUND(CAST(SUM(value) AS DOUBLE) / COUNT(value), 6) AS mean_value
      FROM (SELECT obs_id, kind, CASE WHEN {_CUT} THEN NULL
          WHEN kind = 'uv' THEN CAST({_UV_VALUE} AS DECIMAL(10,2))
          ELSE {_READ_TEMPERATURE} END AS value
        FROM o, (SELECT unnest(['current', 'forecast', 'current_by_coord', 'uv']) AS kind) k) r
      GROUP BY kind""",
    "city_dimension": f"""{_O} SELECT city, COUNT(*) AS row_count
      FROM (SELECT unnest([city, country, weather_main]) AS city FROM o) e GROUP BY city""",
    "landing_files": f"""{_O} SELECT kind,
        CASE WHEN obs_id % 101 = 0 THEN 'invalid_key' WHEN obs_id % 103 = 0 THEN 'city_not_found'
          WHEN obs_id % 107 = 0 THEN 'rate_limited' WHEN obs_id % 109 = 0 THEN 'failed'
          ELSE 'ok' END AS outcome,
        COUNT(*) AS row_count, COUNT(CASE WHEN kind = 'forecast' THEN city END) AS with_city,
        MAX(api_timestamp) AS last_fetch, COUNT(*) AS with_body
      FROM o, (SELECT unnest(['forecast', 'uv']) AS kind) k GROUP BY 1, 2""",
    "raw_view": f"""{_STRICT} SELECT obs_id, city_name, country,
        CAST(temperature AS DOUBLE) AS temperature, CAST(feels_like AS DOUBLE) AS feels_like,
        humidity, pressure, weather_description, CAST(wind_speed AS DOUBLE) AS wind_speed,
        wind_direction, visibility, api_timestamp AS "timestamp", temperature_category,
        wind_category, comfort_level FROM s""",
    "response_triage": f"""{_O} SELECT obs_id,
        CASE WHEN obs_id % 101 = 0 THEN 'invalid_key' WHEN obs_id % 103 = 0 THEN 'city_not_found'
          WHEN obs_id % 107 = 0 THEN 'rate_limited' WHEN obs_id % 109 = 0 THEN 'failed'
          ELSE 'ok' END AS outcome,
        CASE WHEN obs_id % 101 = 0 THEN 'invalid API key'
          WHEN obs_id % 103 = 0 THEN 'city not found: ' || city
          WHEN obs_id % 107 = 0 THEN 'rate limit exceeded'
          WHEN obs_id % 109 = 0 THEN 'request failed with status 500' END AS fetch_error FROM o""",
    "parse_reject_split": f"""{_O} SELECT obs_id,
        CASE WHEN {_CUT} THEN 'rejected' ELSE 'kept' END AS part FROM o""",
    "sink_valid_split": f"""{_O} SELECT obs_id, reasons = '' AS is_valid,
        NULLIF(reasons, '') AS reasons FROM (SELECT obs_id, {_REASONS} AS reasons FROM o) r""",
    "sink_conform": f"{_O} SELECT {_cells(_STORED[:20])} FROM o",
    "storage_projection": f"""{_ZERO} SELECT city, country, CAST(raw_t AS DOUBLE) AS temperature,
        CAST(feels_like AS DOUBLE) AS feels_like, raw_h AS humidity, pressure,
        CAST(raw_w AS DOUBLE) AS wind_speed, wind_direction, weather_description, visibility,
        api_timestamp FROM z""",
    "conform_missing_columns": f"""{_O} SELECT city, CAST(NULL AS VARCHAR) AS country,
        CAST(NULL AS DOUBLE) AS latitude, CAST(temperature AS DOUBLE) AS temperature, humidity,
        CAST(NULL AS INTEGER) AS pressure, CAST(NULL AS TIMESTAMP) AS sunrise_time FROM o""",
    "sample_projection": f"""{_STRICT} SELECT obs_id, city_name,
        CAST(temperature AS DOUBLE) AS temperature, temperature_category, heat_index,
        comfort_level, wind_category, data_quality_score FROM s ORDER BY obs_id LIMIT 20""",
    "sink_roundtrip": f"""{_STRICT} SELECT {_cells(_STORED)}, CAST(NULL AS DOUBLE) AS uv_index,
        CAST(NULL AS TIMESTAMP) AS sunrise_time, CAST(NULL AS TIMESTAMP) AS sunset_time,
        api_timestamp AS recorded_at, {_NEVER_SET} FROM s WHERE {_REASONS} = ''""",
    "sink_quarantine": f"""{_O} SELECT obs_id, 'rejected' AS outcome, {_REASONS} AS reasons
      FROM o WHERE {_REASONS} <> ''""",
    "surrogate_keys": f"""{_O} SELECT CAST(2 * n AS BIGINT) AS row_count,
        CAST(2 * n AS BIGINT) AS distinct_ids, TRUE AS batches_in_order
      FROM (SELECT COUNT(*) AS n FROM o WHERE {_REASONS} = '') c""",
    "run_counts": f"""{_READ} SELECT 'only' AS batch, COUNT(*) AS stored,
        (SELECT COUNT(*) FROM o) - COUNT(*) AS errors FROM j WHERE stored""",
    "enrich_projection": f"""{_STRICT}, u AS ({_uv(f"NOT ({_CUT})")})
      SELECT city_name, country, CAST(temperature AS DOUBLE) AS temperature,
        CAST(feels_like AS DOUBLE) AS feels_like, humidity, pressure, weather_description,
        CAST(wind_speed AS DOUBLE) AS wind_speed, wind_direction, visibility, v AS uv_index,
        api_timestamp AS "timestamp", temperature_category, heat_index, wind_category,
        comfort_level, data_quality_score, CAST(temperature AS DOUBLE) AS temperature_celsius,
        temperature_fahrenheit FROM s {_JOIN_UV}""",
    "temperature_category": _rule("temperature_category"),
    "heat_index": _rule("heat_index"),
    "wind_category": _rule("wind_category"),
    "comfort_level": _rule("comfort_level"),
    "quality_score_binary": _rule("data_quality_score"),
    "temperature_fahrenheit": _rule("temperature_fahrenheit"),
    "processing_time": f"""{_O} SELECT COUNT(*) AS stamped, TRUE AS same_for_all,
        TRUE AS not_in_future FROM o""",
    "zero_default_profile": _rule(
        "temperature_category, heat_index, wind_category, comfort_level, data_quality_score,"
        " weather_severity_index, is_extreme, recommendation, temperature_fahrenheit",
        _ZERO,
        "z",
    ),
    "quality_score_weighted": _rule("data_quality_score", _ZERO, "z"),
    "severity_index": _rule("weather_severity_index", _ZERO, "z"),
    "is_extreme": _rule("is_extreme", _ZERO, "z"),
    "recommendation": _rule("recommendation", _ZERO, "z"),
    "valid_records": f"""{_O} SELECT obs_id, city, CAST(temperature AS DOUBLE) AS temperature,
        humidity FROM o WHERE temperature IS NOT NULL AND humidity IS NOT NULL
        AND city IS NOT NULL""",
    "uv_enrich": f"""{_O}, u AS ({_uv(f"NOT ({_CUT})")})
      SELECT obs_id, city, v AS uv_index FROM o {_JOIN_UV}""",
    "uv_enrich_by_cycle": f"""{_O}, u AS ({_uv(f"NOT ({_CUT})", _CYCLE.format("api_timestamp"))})
      SELECT obs_id, city, v AS uv_index FROM o {_JOIN_UV}
        AND u.cycle = {_CYCLE.format("api_timestamp")}""",
    "uv_enrich_salted": f"""{_O}, u AS ({_uv(f"NOT ({_CUT})")})
      SELECT obs_id, city, v AS uv_index FROM o {_JOIN_UV}""",
    "city_coverage": f"""{_O} SELECT c.city, COUNT(o.city) AS row_count
      FROM (SELECT unnest(['London', 'Delhi', 'Tokyo', 'Paris', 'Sydney', 'Mumbai', 'Berlin',
        'Toronto', 'Singapore', 'Dubai', 'Oslo']) AS city) c
      LEFT JOIN o ON o.city = c.city GROUP BY c.city""",
    "latest_by_city": f"""{_O} SELECT obs_id, city, CAST(temperature AS DOUBLE) AS temperature,
        weather_description, api_timestamp FROM o WHERE city = 'London'
      ORDER BY api_timestamp DESC NULLS FIRST, obs_id DESC LIMIT 25""",
    "latest_overall": f"""{_O} SELECT obs_id, city, CAST(temperature AS DOUBLE) AS temperature,
        weather_description, api_timestamp FROM o
      ORDER BY api_timestamp DESC NULLS FIRST, obs_id DESC LIMIT 10""",
    "url_param": """SELECT page_id, COALESCE(
        NULLIF(split_part(split_part(url, 'page=', 2), '&', 1), ''), 'unknown') AS page_param
      FROM pages""",
    "url_redact": """SELECT page_id,
        regexp_replace(url, 'utm_source=[^&]*', 'utm_source=***', 'g') AS redacted_url
      FROM pages""",
    "temp_stats_by_city": _city_stats(_STRICT, "s"),
    "weather_patterns": f"""{_STRICT} SELECT weather_description, temperature_category,
        COUNT(*) AS row_count FROM s GROUP BY 1, 2""",
    "comfort_distribution": _shares(_STRICT, "s", "comfort_level"),
    "comfort_pct_scalar_total": _shares(_STRICT, "s", "comfort_level"),
    "temperature_distribution": _distribution(_STRICT, "temperature_category"),
    "wind_distribution": _distribution(_STRICT, "wind_category"),
    "quality_metrics": f"""{_STRICT} SELECT {_mean('data_quality_score')} AS avg_quality_score,
        MIN(data_quality_score) AS min_quality_score, MAX(data_quality_score) AS max_quality_score
      FROM s""",
    "describe_numeric": f"{_O} "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS measure, COUNT({name}) AS n, {_mean(name)} AS mean,
          ROUND(STDDEV_SAMP(CAST({name} AS DOUBLE)), 6) AS stddev,
          CAST(MIN({name}) AS DOUBLE) AS min, CAST(MAX({name}) AS DOUBLE) AS max FROM o"""
        for name in ("temperature", "humidity", "pressure", "wind_speed")
    ),
    "total_count": f"{_O} SELECT COUNT(*) AS total_records FROM o",
    "data_quality_pct": f"""{_O} SELECT valid AS valid_records, total AS total_records,
        CAST(valid AS DOUBLE) / total * 100.0 AS quality_percentage
      FROM (SELECT COUNT(CASE WHEN temperature IS NOT NULL AND humidity IS NOT NULL
          AND city IS NOT NULL THEN 1 END) AS valid, COUNT(*) AS total FROM o) c""",
    "count_by_city": f"{_O} SELECT COUNT(*) AS city_records FROM o WHERE city = 'Tokyo'",
    "profile_distributions": f"""{_ZERO}
      SELECT 'temperature_category' AS dimension, temperature_category AS label,
        COUNT(*) AS row_count FROM z GROUP BY 1, 2
      UNION ALL SELECT 'comfort_level', comfort_level, COUNT(*) FROM z GROUP BY 1, 2
      UNION ALL SELECT 'wind_category', wind_category, COUNT(*) FROM z GROUP BY 1, 2""",
    "extreme_count": f"""{_ZERO} SELECT COUNT(CASE WHEN is_extreme THEN 1 END) AS extreme_records,
        COUNT(*) AS total_records FROM z""",
    "avg_quality": f"""{_ZERO} SELECT COALESCE({_mean('data_quality_score')}, 0) AS avg_quality
      FROM z""",
    "growth_summary": f"""{_O} SELECT COUNT(*) AS total_records, COUNT(DISTINCT city) AS cities,
        MIN(api_timestamp) AS first_record, MAX(api_timestamp) AS latest_record FROM o""",
    "batch_summary": _summary(_STRICT, "s"),
    "job_single": _long(_REPORTS),
    "job_with_summary": _long(_REPORTS | {"batch_summary": _summary("", "j")}),
    "job_unknown_kinds": f"""{_READ}, k AS (SELECT obs_id, kind, CASE
          WHEN obs_id % 11 = 0 THEN 'tides' WHEN obs_id % 13 = 0 THEN 'none' ELSE kind END AS told
        FROM o, (SELECT unnest(['forecast', 'uv']) AS kind) x),
      r AS (SELECT CASE WHEN told IN ('tides', 'none') THEN 'unknown kind'
          WHEN obs_id % 101 = 0 THEN 'invalid API key' WHEN obs_id % 103 = 0 THEN 'city not found'
          WHEN obs_id % 107 = 0 THEN 'rate limit exceeded'
          WHEN obs_id % 109 = 0 THEN 'request failed with status 500'
          WHEN {_CUT} THEN 'malformed body' END AS reason, obs_id
        FROM k WHERE told <> 'uv')
      SELECT CASE WHEN reason IS NOT NULL THEN 'failed' WHEN f.stored THEN 'valid'
          ELSE 'rejected' END AS outcome, reason, COUNT(*) AS row_count
      FROM r LEFT JOIN f USING (obs_id) GROUP BY 1, 2""",
    "job_plain": f"""{_READ} SELECT city, CAST(temperature AS DOUBLE) AS temperature, humidity,
        v AS uv_index, recorded_at, CAST(NULL AS VARCHAR) AS comfort_level
      FROM f {_JOIN_UV_CYCLE} WHERE stored""",
    "job_round_trip": f"""{_READ} SELECT city, CAST(temperature AS DOUBLE) AS temperature,
        recorded_at FROM f WHERE stored AND city = 'London'
      ORDER BY recorded_at DESC, obs_id DESC LIMIT 1""",
    "stream_available_now": _STREAMED,
    "stream_failures": f"""{_READ} SELECT outcome, CAST(n AS BIGINT) AS row_count FROM (
        SELECT 'valid' AS outcome, COUNT(*) AS n FROM f WHERE stored
        UNION ALL SELECT 'rejected', COUNT(*) FROM f WHERE NOT stored
        UNION ALL SELECT 'failed', (SELECT COUNT(*) FROM o) - (SELECT COUNT(*) FROM f)) c""",
    "stream_cycle_report": f"""{_READ} SELECT comfort_level, CAST(COUNT(*) AS BIGINT) AS row_count
      FROM j GROUP BY 1""",
    "stream_landed_cycles": f"""{_READ} SELECT city, CAST(recorded_at AS DATE) AS cycle,
        v AS uv_index, COUNT(*) AS row_count FROM f {_JOIN_UV_CYCLE} WHERE stored GROUP BY 1, 2, 3""",
    "dense_ids": f"""{_O} SELECT COUNT(*) AS row_count, CAST(1 AS BIGINT) AS first_id, COUNT(*) AS last_id
      FROM o WHERE {_REASONS} = ''""",
    "summary_total": f"{_O} SELECT COUNT(*) AS total_records FROM o WHERE {_REASONS} = ''",
    "summary_city_coverage": f"""{_O} SELECT c.city, COUNT(t.city) AS row_count
      FROM (SELECT unnest(['London', 'Delhi', 'Tokyo', 'Paris', 'Sydney', 'Mumbai', 'Berlin',
        'Toronto', 'Singapore', 'Dubai', 'Oslo']) AS city) c
      LEFT JOIN (SELECT city FROM o WHERE {_REASONS} = '') t ON t.city = c.city GROUP BY c.city""",
    "summary_count_by_city": f"""{_O} SELECT COUNT(*) AS city_records FROM o
      WHERE city = 'Tokyo' AND {_REASONS} = ''""",
    "stored_temp_stats": f"""{_O} SELECT city, {_mean('temperature')} AS avg_temperature,
        CAST(MIN(temperature) AS DOUBLE) AS min_temperature,
        CAST(MAX(temperature) AS DOUBLE) AS max_temperature,
        ROUND(STDDEV_SAMP(CAST(temperature AS DOUBLE)), 6) AS temp_stddev
      FROM o WHERE {_REASONS} = '' GROUP BY city""",
    "stored_describe": f"{_O}, v AS (SELECT * FROM o WHERE {_REASONS} = '') "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS measure, COUNT({name}) AS n, {_mean(name)} AS mean,
          ROUND(STDDEV_SAMP(CAST({name} AS DOUBLE)), 6) AS stddev,
          CAST(MIN({name}) AS DOUBLE) AS min, CAST(MAX({name}) AS DOUBLE) AS max FROM v"""
        for name in ("temperature", "humidity", "pressure", "wind_speed")
    ),
    "stored_latest_per_city": f"""{_O} SELECT city, CAST(temperature AS DOUBLE) AS temperature,
        weather_description, api_timestamp AS recorded_at FROM o WHERE {_REASONS} = ''
      QUALIFY ROW_NUMBER() OVER (PARTITION BY city ORDER BY api_timestamp DESC, obs_id DESC) <= 3""",
    "stream_cycle_stats": f"""{_READ} SELECT CAST(CAST(recorded_at AS DATE) AS VARCHAR) AS day, city,
        CAST(COUNT(*) AS BIGINT) AS row_count, {_mean('temperature')} AS avg_temperature,
        CAST(MIN(temperature) AS DOUBLE) AS min_temperature,
        CAST(MAX(temperature) AS DOUBLE) AS max_temperature,
        ROUND(STDDEV_SAMP(CAST(temperature AS DOUBLE)), 6) AS temp_stddev FROM j GROUP BY 1, 2""",
    "stream_dead_letters": f"""{_READ} SELECT outcome, CAST(n AS BIGINT) AS row_count FROM (
        SELECT 'dead' AS outcome, COUNT(*) AS n FROM o WHERE city = 'Tokyo'
        UNION ALL SELECT 'valid', COUNT(*) FROM f WHERE stored AND city <> 'Tokyo'
        UNION ALL SELECT 'rejected', COUNT(*) FROM f WHERE NOT stored AND city <> 'Tokyo'
        UNION ALL SELECT 'failed', (SELECT COUNT(*) FROM o WHERE city <> 'Tokyo')
          - (SELECT COUNT(*) FROM f WHERE city <> 'Tokyo')) c""",
    "stored_latest_by_city": f"""{_O} SELECT city, CAST(temperature AS DOUBLE) AS temperature,
        weather_description, api_timestamp AS recorded_at FROM o
      WHERE city = 'London' AND {_REASONS} = ''
      ORDER BY api_timestamp DESC, obs_id DESC LIMIT 25""",
    "stored_count_by_city": f"""{_O} SELECT COUNT(*) AS city_records FROM o
      WHERE city = 'Tokyo' AND {_REASONS} = ''""",
}
