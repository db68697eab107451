"""Slices of a source: days, type lists, fixed fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..functions.keys import as_column
from ..functions.times import DayRange

# Event types that are loaded, in the two batches they are asked for.
OBJECT_EVENT_TYPES = [
    "charge.captured",
    "charge.expired",
    "charge.failed",
    "charge.pending",
    "charge.refunded",
    "charge.succeeded",
    "charge.updated",
    "customer.created",
    "customer.deleted",
    "customer.subscription.created",
    "customer.subscription.deleted",
    "customer.subscription.updated",
    "customer.updated",
    "invoice.finalized",
    "invoice.overdue",
    "invoice.paid",
    "invoice.payment_failed",
    "invoice.payment_succeeded",
    "invoice.updated",
    "invoice.voided",
]
INTENT_EVENT_TYPES = [
    "payment_intent.amount_capturable_updated",
    "payment_intent.canceled",
    "payment_intent.created",
    "payment_intent.partially_funded",
    "payment_intent.payment_failed",
    "payment_intent.processing",
    "payment_intent.requires_action",
    "payment_intent.succeeded",
]
EVENT_TYPES = OBJECT_EVENT_TYPES + INTENT_EVENT_TYPES


def created_within(df: DataFrame, epoch: str | Column, days: DayRange) -> DataFrame:
    """Rows created on the days, by epoch seconds, half open at the end."""
    return df.where(days.holds_epoch(epoch))


def updated_within(df: DataFrame, epoch: str | Column, days: DayRange) -> DataFrame:
    """Rows last changed on the days."""
    return df.where(days.holds_epoch(epoch))


def dated_within(df: DataFrame, day: str | Column, days: DayRange) -> DataFrame:
    """Rows of a report whose date is in the closed range."""
    return df.where(days.holds_day(day))


def loaded_since(df: DataFrame, load_day: str, days: DayRange) -> DataFrame:
    """Rows whose load-day partition is not older than the range: prunes folders."""
    return df.where(as_column(load_day) >= days.first)


def shards(df: DataFrame, shard: str, days: DayRange) -> DataFrame:
    """Shards of a day-sharded table, by its ``yyyyMMdd`` partition column."""
    return df.where(days.holds_key(shard))


def of_types(df: DataFrame, column: str | Column, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    return df.where(as_column(column).isin(*types))
