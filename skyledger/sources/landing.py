"""Landing area of raw responses, and what each response is good for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.functions.text import url_param
from skyledger.schemas import LANDING

# --- fixed values -----------------------------------------------------------
CURRENT = "current"
CURRENT_BY_COORD = "current_by_coord"
FORECAST = "forecast"
UV = "uv"
RECORD_KINDS = (FORECAST, CURRENT, CURRENT_BY_COORD)

OK = 200
INVALID_KEY = 401
NOT_FOUND = 404
RATE_LIMITED = 429
# ----------------------------------------------------------------------------


def read_landing(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """All landed responses.  With ``kind=…`` folders a filter on kind prunes files."""
    return spark.read.schema(LANDING).format(fmt).load(path)


def write_landing(responses: DataFrame, path: str, fmt: str = "json") -> None:
    """Append responses in the layout :func:`read_landing` prunes best."""
    (
        responses.select(*LANDING.fieldNames())
        .write.mode("append")
        .partitionBy("kind")
        .format(fmt)
        # JSON text would otherwise lose the microseconds.
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .save(path)
    )


def stream_landing(
    spark: SparkSession, path: str, fmt: str = "json", files_per_batch: int = 1000
) -> DataFrame:
    """The same area as a stream of the files not seen before; each row names its file."""
    return (
        spark.readStream.schema(LANDING)
        .format(fmt)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )


def of_kind(landing: DataFrame, *kinds: str) -> DataFrame:
    return landing.filter(F.col("kind").isin(*kinds))


def record_bearing(landing: DataFrame) -> DataFrame:
    """All but UV responses: those of no or an unknown kind are failures to be kept."""
    return landing.filter(~F.col("kind").eqNullSafe(UV))


def outcome(status: Column) -> Column:
    return (
        F.when(status == OK, "ok")
        .when(status == INVALID_KEY, "invalid_key")
        .when(status == NOT_FOUND, "city_not_found")
        .when(status == RATE_LIMITED, "rate_limited")
        .otherwise("failed")
    )


def triage(landing: DataFrame) -> DataFrame:
    """Add ``outcome`` and, for failures, ``fetch_error``.  A kind nobody can read is
    one, whatever its status."""
    status, url, kind = F.col("status"), F.col("request_url"), F.col("kind")
    unknown = ~F.coalesce(kind.isin(*RECORD_KINDS, UV), F.lit(False))
    message = (
        F.when(status == OK, F.lit(None).cast("string"))
        .when(status == INVALID_KEY, F.lit("invalid API key"))
        .when(status == NOT_FOUND, F.concat(F.lit("city not found: "), url_param(url, "q")))
        .when(status == RATE_LIMITED, F.lit("rate limit exceeded"))
        .otherwise(
            F.concat(F.lit("request failed with status "), F.coalesce(status.cast("string"), F.lit("?")))
        )
    )
    message = F.when(unknown, F.concat(F.lit("unknown kind: "), F.coalesce(kind, F.lit("none")))).otherwise(message)
    found = F.when(unknown, "failed").otherwise(outcome(status))
    return landing.withColumns({"outcome": found, "fetch_error": message})
