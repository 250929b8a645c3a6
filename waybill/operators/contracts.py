"""Layer contracts: required columns, types, and quarantine of rows that break them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.geo import no_nan
from waybill.schemas import BRONZE_REQUIRED, SILVER_REQUIRED

REASON = "quarantine_reason"


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def meets_bronze(df: DataFrame) -> bool:
    return not missing_columns(df, BRONZE_REQUIRED)


def meets_silver(df: DataFrame, dataset: str) -> bool:
    """Datasets without a contract pass."""
    return not missing_columns(df, SILVER_REQUIRED.get(dataset, []))


def schema_report(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def keep_existing(df: DataFrame, names: list[str]) -> DataFrame:
    """Project to the listed columns that exist."""
    return df.select(*(name for name in names if name in df.columns))


def tagged(df: DataFrame, schema: T.StructType, required: list[str]) -> DataFrame:
    """Cast to the contract types and name each row's first fault, null when it has none.

    A fault is a required value that is missing or a value that its type cannot hold. NaN is
    made null on the way. Columns outside the contract pass through.
    """
    kinds = {field.name: field.dataType for field in schema.fields if field.name in df.columns}
    faults, casts = [], []
    for name in df.columns:
        if name not in kinds:
            casts.append(F.col(name))
            continue
        value = F.col(name).try_cast(kinds[name])
        faults.append(F.when(F.col(name).isNotNull() & value.isNull(), F.lit(f"bad {name}")))
        if isinstance(kinds[name], T.DoubleType):
            value = no_nan(value)
        if name in required:
            faults.append(F.when(value.isNull(), F.lit(f"no {name}")))
        casts.append(value.alias(name))
    known = [F.col(REASON)] if REASON in df.columns else []  # a stream has tagged what it could not read
    casts = [c for c, name in zip(casts, df.columns, strict=True) if name != REASON]
    reason = F.coalesce(*known, *faults) if known or faults else F.lit(None).cast("string")
    return df.select(*casts, reason.alias(REASON))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).drop(REASON)


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNotNull())
