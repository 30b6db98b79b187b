"""Line and JSON records -> typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlytics import schemas
from streamlytics.functions.text import split_fields


def _fields(
    line: Column, schema: T.StructType, delimiter: str, trim: bool, strict: bool
) -> list[Column]:
    parts = split_fields(line, delimiter)
    columns = []
    for i, field in enumerate(schema.fields):
        raw = parts.getItem(i) if strict else F.get(parts, i)
        raw = F.trim(raw) if trim else raw
        typed = raw.cast(field.dataType) if strict else raw.try_cast(field.dataType)
        columns.append(typed.alias(field.name))
    return columns


def parse_delimited(
    df: DataFrame,
    schema: T.StructType,
    line: str = "value",
    delimiter: str = ",",
    trim: bool = True,
    skip_blank: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Strict: a bad line fails the job, as ANSI casts and array access raise."""
    rows = df.where(F.trim(F.col(line)) != "") if skip_blank else df
    return rows.select(*keep, *_fields(F.col(line), schema, delimiter, trim, strict=True))


def parse_delimited_lenient(
    df: DataFrame,
    schema: T.StructType,
    line: str = "value",
    delimiter: str = ",",
    trim: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Permissive: (records, rejected lines). A line is rejected if any field is missing or bad."""
    record = F.struct(*_fields(F.col(line), schema, delimiter, trim, strict=False))
    tried = df.withColumn("_record", record)
    good = F.lit(True)
    for name in schema.fieldNames():
        good = good & F.col(f"_record.{name}").isNotNull()
    return (
        tried.where(good).select("_record.*"),
        tried.where(~good).drop("_record"),
    )


def parse_ads_log(df: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``timestamp area city userid adid`` separated by single blanks."""
    return parse_delimited(
        df, schemas.ADS_LOG, line, delimiter=" ", trim=False, skip_blank=False, keep=keep
    )


def parse_json(
    df: DataFrame,
    schema: T.StructType = schemas.USER_JSON,
    value: str = "value",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    return df.withColumn("_json", F.from_json(value, schema)).select(*keep, "_json.*")
