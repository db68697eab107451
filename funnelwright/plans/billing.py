"""Raw billing objects and events: landed pages to one JSON envelope per id."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import present
from ..functions.times import DayRange, epoch_day
from ..operators.dedupe import first_seen, load_audit
from ..schemas import BILLING_EVENTS, billing_object
from ..sources.readers import BROKEN
from ..sources.slices import EVENT_TYPES, created_within, of_types


def _heads(objects: DataFrame, days: DayRange | None, *fields: str) -> DataFrame:
    """Landed objects (page, pos, raw) with id, creation time and other top-level fields.

    ``json_tuple`` parses an object once, and filters on its columns are not pushed below it,
    where they would parse again.
    """
    names = ["id", "created", *fields]
    landed = [c for c in ("fetch", "page", "pos") if c in objects.columns]
    parsed = objects.select(*landed, "raw", F.json_tuple("raw", *names).alias(*names)).withColumns(
        {
            "id": F.nullif(F.col("id"), F.lit("")),
            "created": F.nullif(F.col("created").try_cast("bigint"), F.lit(0)),
        }
    )
    return parsed if days is None else created_within(parsed, "created", days)


def _landing_order(objects: DataFrame) -> list[Column]:
    """The newest landed file first, inside a file by page and place."""
    newest = [F.desc("fetch")] if "fetch" in objects.columns else []
    return [*newest, F.asc("page"), F.asc("pos")]


def billing_heads(objects: DataFrame, days: DayRange | None = None) -> DataFrame:
    """Landed objects with id and creation time, parsed once for the plans below: those created on the
    days, and those without a creation time."""
    heads = _heads(objects, None)
    return heads if days is None else heads.where(days.holds_epoch("created") | F.col("created").isNull())


def billing_objects(objects: DataFrame, load_time: datetime, days: DayRange | None = None) -> DataFrame:
    """One envelope per id: the first copy of the newest landed file, with its creation day and full JSON."""
    return objects_of_heads(_heads(objects, days), load_time)


def objects_of_heads(heads: DataFrame, load_time: datetime) -> DataFrame:
    """As ``billing_objects``, from parsed heads."""
    return (
        first_seen(heads, ["id"], _landing_order(heads))
        .where(F.col("created").isNotNull())
        .select(
            "id",
            epoch_day("created").alias("created_at"),
            F.col("raw").alias("data"),
            F.lit(load_time).cast("timestamp").alias("etl_load_date"),
        )
        .select(*billing_object("any").schema.names)
    )


def rejected_objects(heads: DataFrame, entity: str, load_time: datetime) -> DataFrame:
    """The landed texts that cannot become a row of the entity's table, each once, with the reason."""
    reason = F.when(F.col("pos") == BROKEN, "page does not parse").when(F.col("id").isNull(), "no id")
    reason = reason.when(F.col("created").isNull(), "no creation time")
    return (
        heads.select("raw", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .distinct()
        .select(
            F.lit(entity).alias("entity"),
            F.sha2("raw", 256).alias("digest"),
            "reason",
            F.col("raw").alias("data"),
            F.lit(load_time).cast("timestamp").alias("etl_load_date"),
        )
    )


def billing_events(
    objects: DataFrame,
    load_time: datetime,
    days: DayRange | None = None,
    types: Sequence[str] = EVENT_TYPES,
) -> DataFrame:
    """As ``billing_objects`` for events of the listed types; the payload is the inner object."""
    wanted = of_types(_heads(objects, days, "type", "data").drop("raw"), "type", types)
    inner = wanted.select("*", F.json_tuple("data", "object").alias("object"))
    return (
        first_seen(inner.drop("type", "data"), ["id"], _landing_order(objects))
        .select("*", F.json_tuple("object", "id").alias("object_id"))
        .where(F.col("created").isNotNull() & present("object_id"))
        .select(
            "id",
            F.col("created").alias("event_timestamp"),
            "object_id",
            epoch_day("created").alias("created_at"),
            F.col("object").alias("data"),
            F.lit(load_time).cast("timestamp").alias("etl_load_date"),
        )
        .select(*BILLING_EVENTS.schema.names)
    )


def event_heads(objects: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Landed events of the listed types that can be stored, with their id."""
    wanted = of_types(_heads(objects, None, "type", "data"), "type", types)
    inner = wanted.select("*", F.json_tuple("data", "object").alias("object"))
    named = inner.select("*", F.json_tuple("object", "id").alias("object_id"))
    usable = named.where(F.col("created").isNotNull() & present("object_id"))
    return usable.select(*(c for c in ("fetch", "page", "pos") if c in objects.columns), "raw", "id")


def billing_audit(objects: DataFrame, days: DayRange | None = None) -> DataFrame:
    """Fetched, keyless, duplicate, rejected and loaded objects per creation day."""
    return audit_of_heads(_heads(objects, days))


def audit_of_heads(heads: DataFrame) -> DataFrame:
    """As ``billing_audit``, from parsed heads; pages that do not parse are no objects."""
    known = heads.where(F.col("pos") != BROKEN).withColumn("created_at", epoch_day("created"))
    return load_audit(known, ["created_at"], "id", [F.col("created").isNotNull()])
