"""Contacts: cleaned nested records as flat text rows, by creation day."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import DayRange, day_path
from ..operators.reshape import clean_records, text_columns
from ..session import scratch_path
from ..sources.slices import updated_within


def contact_pages(objects: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Landed page objects (column ``raw``) as contact records.

    Contacts have no fixed fields. Without a schema the objects are parsed once, into the shared folder, and the
    same pass finds their fields. A field of changing type is text, containers in it as JSON; one that is never
    anything but NULL or an empty object is left out or NULL. An object that is none, or repeats a name, fails the job.
    """
    if schema is not None:
        return objects.select(F.from_json("raw", schema).alias("r")).select("r.*")
    spark, path = objects.sparkSession, scratch_path(objects.sparkSession, "contacts")
    fields = Observation()
    parsed = objects.select(_parsed_object("raw").alias("v")).observe(fields, F.schema_of_variant_agg("v").alias("found"))
    parsed.write.parquet(path)
    records = _record_type(fields.get["found"])
    stored = spark.read.schema("v variant").parquet(path)
    if records is None:
        return stored.select()
    return stored.select(F.col("v").cast(records).alias("r")).select("r.*")


def _parsed_object(raw: str) -> Column:
    value = F.try_parse_json(raw)
    failed = F.raise_error(F.concat(F.lit("landed object does not parse: "), F.left(raw, F.lit(200))))
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), value).otherwise(failed.cast("variant"))


def _record_type(found: str) -> T.StructType | None:
    """The type of records from the schema of their variants; None if there is no field."""
    # names in backquotes may hold anything
    ddl = re.sub(r"(`(?:[^`]|``)*`)|OBJECT<", lambda m: m[1] or "STRUCT<", found)
    records = _column_type(T.DataType.fromDDL(ddl))
    return records if isinstance(records, T.StructType) else None


def _column_type(found: T.DataType) -> T.DataType | None:
    """A found type as the JSON reader would take it; None for objects without fields."""
    if isinstance(found, T.StructType):
        inner = [(f.name, _column_type(f.dataType)) for f in found.fields]
        kept = [T.StructField(name, dtype) for name, dtype in inner if dtype is not None]
        return T.StructType(kept) if kept else None
    if isinstance(found, T.ArrayType):
        element = _column_type(found.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(found, (T.NullType, T.VariantType)):
        return T.StringType()
    # whole numbers are decimals only beyond the longs
    fraction = isinstance(found, T.DecimalType) and (found.scale > 0 or found.precision < 19)
    return T.DoubleType() if fraction else found


def contacts(records: DataFrame, days: DayRange | None = None) -> DataFrame:
    """Contacts changed on the days, every column text, with their ``created_path`` folder."""
    if days is not None:
        records = updated_within(records, "updated_at", days)
    created = F.nullif(F.col("created_at").try_cast("bigint"), F.lit(0))
    flat = text_columns(clean_records(records))
    return flat.withColumn("created_path", day_path(F.timestamp_seconds(created)))


def contact_objects(records: DataFrame, days: DayRange | None = None) -> DataFrame:
    """Contacts changed on the days as objects: ``day, id, body`` (the cleaned record as JSON) and ``updated_at``."""
    if days is not None:
        records = updated_within(records, "updated_at", days)
    created = F.nullif(F.col("created_at").try_cast("bigint"), F.lit(0))
    cleaned = clean_records(records.withColumn("_day", day_path(F.timestamp_seconds(created))))
    body = F.to_json(F.struct(*(F.col(f"`{c}`") for c in cleaned.columns if c != "_day")))
    return cleaned.select(F.col("_day").alias("day"), F.col("id").cast("string").alias("id"), body.alias("body"), "updated_at")
