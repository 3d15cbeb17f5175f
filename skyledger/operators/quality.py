"""Validity of records and the metrics about it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.schemas import RANGES, RECORD, TEXT_LIMITS

REQUIRED = ("temperature", "humidity", "city")


def is_valid(required: Sequence[str] = REQUIRED) -> Column:
    present = F.col(required[0]).isNotNull()
    for name in required[1:]:
        present = present & F.col(name).isNotNull()
    return present


def valid_records(records: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    return records.filter(is_valid(required))


def integrity_rules(columns: Sequence[str]) -> dict[str, Column]:
    """Reason → condition that holds for a broken row.  NULL breaks no range."""
    rules = {}
    if "city" in columns:
        rules["city missing"] = F.col("city").isNull()
    for name, (low, high) in RANGES.items():
        if name in columns:
            rules[f"{name} out of range"] = ~F.col(name).between(low, high)
    for name, limit in TEXT_LIMITS.items():
        if name in columns:
            rules[f"{name} too long"] = F.length(name) > limit
    for field in RECORD.fields:
        # A value that is there but does not fit its stored type.
        if field.name in columns and field.dataType.typeName() in ("decimal", "integer"):
            value = F.col(field.name)
            rules[f"{field.name} does not fit"] = (
                value.isNotNull() & value.try_cast(field.dataType).isNull()
            )
    return rules


def broken_rules(rules: dict[str, Column]) -> Column:
    """Comma-separated reasons, empty for a sound row."""
    return F.concat_ws(",", *(F.when(broken, F.lit(reason)) for reason, broken in rules.items()))


def split_reasons(joined: Column) -> Column:
    """Array of reasons, NULL for a sound row."""
    return F.when(joined != "", F.split(joined, ","))


def check(records: DataFrame) -> DataFrame:
    """Add ``reasons`` and ``is_valid`` against the stored table's rules."""
    joined = broken_rules(integrity_rules(records.columns))
    return (
        records.withColumn("_broken", joined)
        .withColumns({"reasons": split_reasons(F.col("_broken")), "is_valid": F.col("_broken") == ""})
        .drop("_broken")
    )


def data_quality(records: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Valid rows, all rows and the percentage, in one pass; NULL on no rows."""
    valid = F.count_if(is_valid(required))
    total = F.count(F.lit(1))
    return records.agg(
        valid.alias("valid_records"),
        total.alias("total_records"),
        (F.try_divide(valid, total) * F.lit(100.0)).alias("quality_percentage"),
    )
