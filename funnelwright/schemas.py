"""Declared schemas of all stored tables, and how each is laid out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """Schema of flat columns, each given as ``name type`` or ``name type not null``."""
    columns = [column.split(" ", 2) for column in text.split(", ")]
    return T.StructType([T.StructField(c[0], _TYPES[c[1]], len(c) == 2) for c in columns])


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


@dataclass(frozen=True)
class TableSpec:
    """A stored table: its columns, keys, partition column and sort order inside files.

    ``partition_from_key``: rows of equal key are always in the same partition.
    ``partition_expr``: SQL for a partition column that is not one of the table's columns.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    partition_from_key: bool = False
    partition_expr: str | None = None

    @property
    def stored_schema(self) -> T.StructType:
        if self.partition_expr is None:
            return self.schema
        return T.StructType([*self.schema.fields, T.StructField(self.partition, T.DateType())])


HISTORICAL_FUNNEL = TableSpec(
    "historical_funnel",
    _schema(
        "unique_event_id string, id_date string, event_timestamp timestamp, event_name string, user_id string, "
        "session_hash string, promo string, discount string, referral_code string, landing_page string, "
        "checkout_page string, utm_hash string, transaction_id string, purchase_revenue double"
    ),
    keys=("unique_event_id",),
    partition="id_date",
    cluster=("unique_event_id",),
    partition_from_key=True,
)

PRECHECKOUT = TableSpec(
    "precheckout",
    _schema(
        "id string, id_date string, created_at timestamp, utm_hash string, email string, phone string, name string, "
        "selected_plan string, checkout_system string, promo string, referral_code string, user_agent string, "
        "path string"
    ),
    keys=("id",),
    partition="id_date",
    cluster=("id",),
)

DIM_UTM = TableSpec(
    "dim_utm",
    _schema(
        "utm_hash string, channel string, source string, medium string, campaign string, term string, content string"
    ),
    keys=("utm_hash",),
    cluster=("utm_hash",),
)

CAMPAIGN_CONVERSION = TableSpec(
    "campaign_conversion",
    _schema(
        "id_date string, channel string, campaign string, impressions bigint, clicks bigint, cost double, "
        "sessions bigint, pre_checkouts bigint, purchases bigint, revenue double"
    ),
    partition="id_date",
    cluster=("channel",),
)

_OBJECT = _schema("id string not null, created_at date, data string, etl_load_date timestamp")


def billing_object(entity: str) -> TableSpec:
    """Raw table of one billing entity; they all share one layout."""
    return TableSpec(f"billing_{entity}", _OBJECT, keys=("id",), partition="created_at", cluster=("id",))


BILLING_ENTITIES = ["charges", "customers", "invoices", "payment_intents", "subscriptions"]

BILLING_EVENTS = TableSpec(
    "billing_events",
    _schema(
        "id string not null, event_timestamp bigint, object_id string, created_at date, data string not null, "
        "etl_load_date timestamp"
    ),
    keys=("id",),
    partition="created_at",
    cluster=("id",),
)

REJECTED_OBJECTS = TableSpec(
    "rejected_objects",
    _schema("entity string not null, digest string not null, reason string, data string, etl_load_date timestamp"),
    keys=("entity", "digest"),
    partition="entity",
    cluster=("digest",),
    partition_from_key=True,
)

PAYMENT_REPORT = TableSpec(
    "payment_report",
    _schema("charge_id string, created_at timestamp, data string, etl_load_date timestamp"),
    keys=("charge_id",),
    partition="created_day",
    cluster=("charge_id",),
    partition_expr="to_date(created_at)",
)

PAYMENT_REPORT_HISTORY = TableSpec(
    "payment_report_history",
    _schema(
        "transaction_request_id string, charge_id string, created_at timestamp, data string, etl_load_date timestamp"
    ),
    keys=("transaction_request_id",),
    partition="created_day",
    cluster=("transaction_request_id",),
    partition_expr="to_date(created_at)",
)

SOCIAL_ADS_HOURLY = TableSpec(
    "social_ads_hourly",
    _schema(
        "id_date string, hour string, account_name string, account_id string, campaign_name string, "
        "campaign_id string, adset_name string, adset_id string, ad_name string, ad_id string, cost double, "
        "impressions bigint, inline_link_clicks bigint, act_link_click bigint, act_omni_add_to_cart bigint, "
        "act_add_to_cart bigint, act_lead bigint, act_add_payment_info bigint, act_omni_purchase bigint, "
        "act_purchase bigint, etl_load_date timestamp"
    ),
    keys=("id_date", "hour", "account_id", "campaign_id", "adset_id", "ad_id"),
    partition="id_date",
    cluster=("campaign_id",),
    partition_from_key=True,
)

SEARCH_ADS_HOURLY = TableSpec(
    "search_ads_hourly",
    _schema(
        "id_date string, date date, hour bigint, campaign_id bigint, campaign_name string, impressions bigint, "
        "clicks bigint, cost double, conversions double, all_conversions double, etl_load_date timestamp"
    ),
    keys=("id_date", "hour", "campaign_id"),
    partition="id_date",
    cluster=("campaign_id",),
    partition_from_key=True,
)

# Input shapes that are nested.
_TEXT, _INT = T.StringType(), T.LongType()

WEB_EVENTS = _struct(
    event_date=_TEXT,
    event_timestamp=_INT,
    event_name=_TEXT,
    user_pseudo_id=_TEXT,
    user_id=_TEXT,
    event_params=T.ArrayType(_struct(key=_TEXT, value=_struct(string_value=_TEXT, int_value=_INT))),
    session_traffic_source_last_click=_struct(
        manual_campaign=_struct(source=_TEXT, medium=_TEXT, campaign_name=_TEXT, term=_TEXT, content=_TEXT)
    ),
    ecommerce=_struct(transaction_id=_TEXT, purchase_revenue=T.DoubleType()),
)

SOCIAL_ADS_ROWS = T.StructType(
    _schema(
        "date_start string, account_name string, account_id string, campaign_name string, campaign_id string, "
        "adset_name string, adset_id string, ad_name string, ad_id string, spend string, impressions string, "
        "inline_link_clicks string, hourly_stats_aggregated_by_advertiser_time_zone string"
    ).fields
    + [T.StructField("actions", T.ArrayType(_struct(action_type=_TEXT, value=_TEXT)))]
)
