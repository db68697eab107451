"""The scheduled runs: read the sources of a lookback, build the rows, change the stored table.

Every run re-reads the trailing days it is given and writes so that repeating it changes
nothing: late rows are picked up, known ones replaced or skipped. ``refresh_funnel``,
``refresh_campaigns`` and ``load_precheckouts`` come before ``refresh_conversion``, which
reads their tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession

from . import schemas
from .functions.times import DayRange, lookback, named_range
from .plans.ads import SEARCH_UPDATES, newest_hours, search_ads_hourly, social_ads_hourly, social_pages
from .plans.billing import (
    audit_of_heads,
    billing_audit,
    billing_events,
    billing_heads,
    billing_objects,
    event_heads,
    objects_of_heads,
    rejected_objects,
)
from .plans.contacts import contact_objects, contact_pages, contacts
from .plans.conversion import ChannelRules, campaign_conversion, late_days
from .plans.funnel import Site, session_funnel
from .plans.precheckout import precheckout_rows
from .plans.reports import payment_report
from .plans.utm import campaign_rows, refreshed_dimension
from .sinks import objects as stored_objects
from .sinks import tables
from .sources.readers import read_pages, read_report
from .streaming.landed import load_first_seen, load_new_files, load_new_pages


def refresh_funnel(
    spark: SparkSession,
    root: str,
    web_events: DataFrame,
    as_of: date,
    days_from: int = 3,
    days_to: int = 1,
    site: Site = Site(),
    rebuild: bool = False,
) -> None:
    """Append the new funnel rows; with ``rebuild`` the table holds the lookback only.

    Events without a session have no id; they are new if no equal row is stored.
    """
    rows = session_funnel(web_events, lookback(as_of, days_from, days_to), site)
    if rebuild:
        tables.rebuild(spark, root, schemas.HISTORICAL_FUNNEL, rows)
    else:
        tables.append_new(spark, root, schemas.HISTORICAL_FUNNEL, rows, compare_keyless=True)


def refresh_campaigns(
    spark: SparkSession,
    root: str,
    web_events: DataFrame,
    precheckouts: DataFrame,
    transactions: DataFrame,
    as_of: date,
    days_from: int = 2,
    days_to: int = 0,
    site: Site = Site(),
    internal_email: str = "%@shop.example%",
) -> None:
    """Add new campaigns to the dimension and update changed channels."""
    days = lookback(as_of, days_from, days_to)
    rows = campaign_rows(web_events, precheckouts, transactions, days, site, internal_email)
    with tables.staging(rows, "campaigns") as campaigns:
        dim = tables.read_table(spark, root, schemas.DIM_UTM)
        tables.rebuild(spark, root, schemas.DIM_UTM, refreshed_dimension(dim, campaigns))


def load_precheckouts(
    spark: SparkSession,
    root: str,
    raw: DataFrame,
    as_of: date,
    days_from: int = 2,
    days_to: int = 0,
    internal_email: str = "%@shop.example%",
    dedup_batch: bool = False,
) -> None:
    """Append the cleaned forms whose id is not stored."""
    rows = precheckout_rows(raw, lookback(as_of, days_from, days_to), internal_email)
    tables.append_new(spark, root, schemas.PRECHECKOUT, rows, dedup_batch)


def refresh_conversion(
    spark: SparkSession,
    root: str,
    transactions: DataFrame,
    search_stats: DataFrame,
    social_insights: DataFrame,
    as_of: date,
    days_from: int = 3,
    days_to: int = 1,
    rules: ChannelRules = ChannelRules(),
) -> None:
    """Replace the mart from the first day of the lookback on, and every earlier day of which ads came in since."""
    days = lookback(as_of, days_from, days_to)
    late = late_days(social_insights, days)
    rows = campaign_conversion(
        tables.read_table(spark, root, schemas.HISTORICAL_FUNNEL),
        tables.read_table(spark, root, schemas.PRECHECKOUT),
        transactions,
        tables.read_table(spark, root, schemas.DIM_UTM),
        search_stats,
        social_insights,
        days,
        rules,
        late,
    )
    keys = [day.strftime("%Y%m%d") for day in late]
    tables.replace_range(spark, root, schemas.CAMPAIGN_CONVERSION, rows, days.first_key, keys)


def load_billing(
    spark: SparkSession,
    root: str,
    pages: str,
    entity: str,
    as_of: date,
    load_time: datetime,
    days_from: int = 1,
    days_to: int = 0,
    on_broken: str = "error",
    later: bool = False,
) -> list[Row]:
    """Upsert the landed objects of one billing entity, all days in one go; returns the audit,
    one row per creation day: fetched, without key, duplicates, rejected, loaded.

    The pages are read and parsed once. Objects that cannot be stored, and with ``on_broken="skip"`` pages that do not
    parse, go to ``rejected_objects`` with the reason. With ``later`` the objects are stored as change files, which ``compact_billing`` folds in: for objects that
    change all over the past.
    """
    if entity not in schemas.BILLING_ENTITIES:
        raise ValueError(f"unknown billing entity {entity!r}; known: {schemas.BILLING_ENTITIES}")
    days = lookback(as_of, days_from, days_to)
    objects = read_pages(spark, pages, on_broken="keep" if on_broken == "skip" else on_broken)
    with tables.staging(billing_heads(objects, days), "billing") as heads:
        change = tables.upsert_later if later else tables.upsert
        change(spark, root, schemas.billing_object(entity), objects_of_heads(heads.where(days.holds_epoch("created")), load_time))
        rejected = rejected_objects(heads, entity, load_time)
        tables.append_new(spark, root, schemas.REJECTED_OBJECTS, rejected, dedup_batch=True)
        return audit_of_heads(heads.where(days.holds_epoch("created"))).orderBy("created_at").collect()


def compact_billing(spark: SparkSession, root: str, entity: str, buckets: Sequence[int] | None = None) -> None:
    """Fold the change files of an entity, or those of some buckets, into its table."""
    tables.compact(spark, root, schemas.billing_object(entity), buckets)


def follow_billing(
    spark: SparkSession,
    root: str,
    folder: str,
    checkpoint: str,
    entity: str,
    load_time: datetime,
    files_per_batch: int = 1000,
    on_broken: str = "error",
) -> None:
    """Upsert the pages of an entity landed since the last run, each file once."""
    spec = schemas.billing_object(entity)

    def load(objects: DataFrame) -> None:
        tables.upsert(spark, root, spec, billing_objects(objects, load_time))

    load_new_pages(spark, folder, checkpoint, load, files_per_batch, on_broken).awaitTermination()


def load_billing_events(
    spark: SparkSession,
    root: str,
    pages: str,
    as_of: date,
    load_time: datetime,
    days_from: int = 1,
    days_to: int = 0,
    on_broken: str = "error",
) -> list[Row]:
    """Upsert the landed billing events; returns the audit of the days' objects of all types."""
    days = lookback(as_of, days_from, days_to)
    objects = read_pages(spark, pages, on_broken=on_broken)
    tables.upsert(spark, root, schemas.BILLING_EVENTS, billing_events(objects, load_time, days))
    return billing_audit(objects, days).orderBy("created_at").collect()


def follow_billing_events(
    spark: SparkSession,
    root: str,
    folder: str,
    checkpoint: str,
    load_time: datetime,
    files_per_batch: int = 1000,
    on_broken: str = "error",
    remember: str | None = None,
) -> None:
    """Append the billing events landed since the last run; an event never changes, so its first copy stays.

    Files that land again, or are replayed, change no file of the table.
    """

    def load(objects: DataFrame) -> None:
        tables.append_new(spark, root, schemas.BILLING_EVENTS, billing_events(objects, load_time))

    load_first_seen(spark, folder, checkpoint, event_heads, load, files_per_batch, on_broken, remember).awaitTermination()


def load_payment_report(
    spark: SparkSession,
    root: str,
    reports: Sequence[str],
    load_time: datetime,
    history: bool = False,
    on_duplicate: str = "error",
    days: DayRange | None = None,
    multi_line: bool = True,
) -> None:
    """Upsert payment reports, or their history variant with its own key; of the ``days`` if given."""
    spec = schemas.PAYMENT_REPORT_HISTORY if history else schemas.PAYMENT_REPORT
    rows = payment_report(read_report(spark, reports, multi_line), load_time, spec, days)
    tables.upsert(spark, root, spec, rows, on_duplicate, order_by=["created_at"])


def follow_payment_reports(
    spark: SparkSession,
    root: str,
    folder: str,
    checkpoint: str,
    load_time: datetime,
    history: bool = False,
    multi_line: bool = True,
    files_per_batch: int = 100,
) -> None:
    """Upsert the payment reports landed since the last run, each file once; of a repeated key the latest row."""

    def load(paths: list[str]) -> None:
        load_payment_report(spark, root, paths, load_time, history, on_duplicate="latest", multi_line=multi_line)

    load_new_files(spark, folder, checkpoint, load, files_per_batch).awaitTermination()


def load_social_ads(
    spark: SparkSession, root: str, batches: DataFrame, load_time: datetime, on_duplicate: str = "error"
) -> None:
    """Upsert the hours of all accounts and days landed, in one merge; ``social_pages`` reads landed pages."""
    rows = social_ads_hourly(batches, load_time)
    tables.upsert(spark, root, schemas.SOCIAL_ADS_HOURLY, rows, on_duplicate, order_by=["etl_load_date"])


def follow_social_ads(
    spark: SparkSession,
    root: str,
    folder: str,
    checkpoint: str,
    load_time: datetime,
    files_per_batch: int = 1000,
    on_broken: str = "error",
) -> None:
    """Upsert the ads' hours landed since the last run, each file once; the newest file's copy of an hour wins."""

    def load(objects: DataFrame) -> None:
        load_social_ads(spark, root, social_pages(newest_hours(objects)), load_time)

    load_new_pages(spark, folder, checkpoint, load, files_per_batch, on_broken).awaitTermination()


def load_search_ads(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    as_of: date,
    load_time: datetime,
    days_from: int = 1,
    days_to: int = 0,
    date_range: str | None = None,
) -> None:
    """Upsert search-ad hours; a known hour keeps its date and campaign name.

    The days are the lookback, or ``date_range``: a range name or ``first,last``.
    """
    days = lookback(as_of, days_from, days_to) if date_range is None else named_range(date_range, as_of)
    hours = search_ads_hourly(rows, load_time, days)
    tables.upsert(spark, root, schemas.SEARCH_ADS_HOURLY, hours, update_cols=SEARCH_UPDATES)


def load_contacts(
    spark: SparkSession, root: str, records: DataFrame, as_of: date, days_from: int = 0, days_to: int = 0
) -> None:
    """Upsert the contacts changed on the days; ``contact_pages`` reads landed pages."""
    tables.write_contacts(spark, root, contacts(records, lookback(as_of, days_from, days_to, swap_ok=True)))


def store_contacts(
    spark: SparkSession, path: str, records: DataFrame, as_of: date, days_from: int = 0, days_to: int = 0
) -> None:
    """Store the contacts changed on the days as one object each, by creation day."""
    rows = contact_objects(records, lookback(as_of, days_from, days_to, swap_ok=True))
    stored_objects.write_objects(spark, path, rows, ["updated_at"])


def follow_contacts(
    spark: SparkSession,
    root: str,
    folder: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    on_broken: str = "error",
) -> None:
    """Upsert the contacts landed since the last run, each file once; of a batch's copies the one updated last."""

    def load(objects: DataFrame) -> None:
        records = contact_pages(objects)
        if "id" in records.columns:
            tables.write_contacts(spark, root, contacts(records))

    load_new_pages(spark, folder, checkpoint, load, files_per_batch, on_broken).awaitTermination()
