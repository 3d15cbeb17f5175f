"""Bring any record set into a stored schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.schemas import RECORD


def conformed(columns: list[str], schema: T.StructType = RECORD) -> dict[str, Column]:
    """Each stored column, cast; absent ones as typed NULL, misfits as NULL."""
    return {
        field.name: (
            F.col(field.name).try_cast(field.dataType)
            if field.name in columns
            else F.lit(None).cast(field.dataType)
        )
        for field in schema.fields
    }


def conform(records: DataFrame, schema: T.StructType = RECORD) -> DataFrame:
    """Exactly the schema's columns, in its order."""
    return records.select(
        *(value.alias(name) for name, value in conformed(records.columns, schema).items())
    )
