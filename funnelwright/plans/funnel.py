"""Session funnel: one row per web event with its session's campaign and page context."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import joined, sha_key, utm_key
from ..functions.records import param
from ..functions.rules import classify, remap
from ..functions.times import DayRange, day_key, from_micros, micros_text, shift_zone
from ..functions.urls import bare_page, host_part, is_not_matching, query_value
from ..operators.sessions import HOT_ROWS, LAYOUT, session_columns
from ..schemas import HISTORICAL_FUNNEL
from ..sources.slices import shards

# The events the funnel keeps.
FUNNEL_EVENTS = [
    "first_visit",
    "page_view",
    "session_start",
    "login",
    "pre_checkout_loaded",
    "pre_checkout_submitted",
    "add_to_cart",
    "sign_up",
    "add_payment_info",
    "purchase",
    "begin_checkout",
]

# Fixed value: events reported under another name.
EVENT_NAMES = {"begin_checkout": "add_payment_info"}

# Fixed value: landing page of sessions that never left the product.
PRODUCT_ONLY = "only app or platform"


@dataclass(frozen=True)
class Site:
    """The web site being measured."""

    domain: str = "shop.example"
    excluded_pages: str = "staging.*shop|pay/test"
    zone: str = "UTC"
    zone_mode: str = "relabel"
    product_hosts: tuple[str, ...] = ("v_", "app", "platform", "docs", "forms")
    checkout_hosts: tuple[str, ...] = ("checkout", "buy")
    landing_hosts: dict[str, str] = field(
        default_factory=lambda: {
            "checkout": "checkout",
            "buy": "buy",
            "app": "app",
            "v_": "app",
        }
    )
    languages: tuple[str, ...] = ("pt", "en", "es")


def outside_product(page: Column, site: Site) -> Column:
    """1 for pages that are neither product, language home, login nor legal pages."""
    home = site.domain
    rules: list[tuple[Column, object]] = [(page.like(f"%{host}.{home}%"), 0) for host in site.product_hosts]
    for lang in site.languages:
        is_home = page.like(f"%/{lang}/") | page.like(f"%/{lang}")
        rules.append((page.like(f"%{home}/{lang}%"), F.when(is_home, 0).otherwise(1)))
    rules += [(page.like(f"%{home}%login"), 0), (page.like(f"%{home}%/legal%"), 0)]
    return classify(rules, default=1)


def landing_label(page: Column, site: Site) -> Column:
    """Page grouped to a host's front page where it is one of the known kinds."""
    home = site.domain
    rules: list[tuple[Column, object]] = [
        (page.like(f"%{host}.{home}%"), f"{label}.{home}/") for host, label in site.landing_hosts.items()
    ]
    for lang in site.languages:
        rules.append((page.like(f"{home}%{lang}") | page.like(f"{home}%{lang}/"), f"{home}/"))
    rules += [(page == f"{home}/", f"{home}/"), (page.like(f"%platform.{home}%"), f"platform.{home}/")]
    return classify(rules, default=page)


def checkout_host(page: Column, site: Site) -> Column:
    """Host of a checkout page, NULL for other pages."""
    is_checkout = F.lit(False)
    for host in site.checkout_hosts:
        is_checkout = is_checkout | page.like(f"{host}%")
    return F.when(is_checkout, host_part(page))


def on_site(web_events: DataFrame, days: DayRange, site: Site) -> DataFrame:
    """Events of the shards on the site's own pages, their address as ``url``.

    Exploding the one wanted parameter looks it up once per event; as a plain expression it
    would be evaluated again in every filter. Events without an address drop out, as they
    would in the LIKE.
    """
    address = F.slice(F.filter("event_params", lambda p: p["key"] == "page_location"), 1, 1)
    located = shards(web_events, "event_date", days).select("*", F.explode(address).alias("_page"))
    return located.withColumn("url", F.col("_page.value.string_value")).where(F.col("url").like(f"%{site.domain}%"))


def funnel_events(web_events: DataFrame, days: DayRange, site: Site = Site()) -> DataFrame:
    """Wanted events of the shards, keys and address parts derived, exact copies removed.

    ``session`` is the text the session hash is made of. The hashes follow from other
    columns and are long, so ``with_hashes`` adds them only after the last shuffle.
    """
    url = F.col("url")
    campaign = F.col("session_traffic_source_last_click.manual_campaign")
    wanted = on_site(web_events.where(F.col("event_name").isin(*FUNNEL_EVENTS)), days, site)
    rows = (
        wanted.where(is_not_matching(url, site.excluded_pages))
        .select(
            "event_timestamp",
            remap("event_name", EVENT_NAMES).alias("event_name"),
            "user_pseudo_id",
            "user_id",
            param("event_params", "ga_session_id", "int_value").cast("string").alias("session_id"),
            bare_page(url).alias("page_location"),
            query_value(url, "promo").alias("promo"),
            query_value(url, "discount").alias("discount"),
            query_value(url, "referral_code").alias("referral_code"),
            utm_key(*(campaign[c] for c in ("source", "medium", "campaign_name", "term", "content"))).alias("utm_hash"),
            F.col("ecommerce.transaction_id").alias("transaction_id"),
            F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        )
        .distinct()
    )
    at = shift_zone(from_micros("event_timestamp"), site.zone, site.zone_mode)
    return rows.withColumns({"event_timestamp": at, "session": joined("user_pseudo_id", "session_id")})


def with_hashes(rows: DataFrame) -> DataFrame:
    """Add the day, the session hash and the event id of funnel events."""
    return rows.withColumns(
        {
            "id_date": day_key("event_timestamp"),
            "session_hash": F.sha2("session", 256),
            "unique_event_id": sha_key(
                "user_pseudo_id", micros_text("event_timestamp"), "event_name", "session_id"
            ),
        }
    )


def session_funnel(
    web_events: DataFrame,
    days: DayRange,
    site: Site = Site(),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The funnel rows of the days, ready to be appended to the stored funnel.

    The closing distinct includes the columns the rows are already distributed by, so it
    needs no shuffle of its own.
    """
    page = F.col("page_location")
    rows = session_columns(
        funnel_events(web_events, days, site),
        session="session",
        ts="event_timestamp",
        ties=["event_name", "page_location"],
        latest={
            "promo": "promo",
            "discount": "discount",
            "referral_code": "referral_code",
            "checkout_page": checkout_host(page, site),
        },
        first={"landing_page": landing_label(page, site)},
        peak={"seen_outside": outside_product(page, site)},
        hot_rows=hot_rows,
        keep_layout=True,
    )
    landing = F.when(F.col("seen_outside") == 0, F.lit(PRODUCT_ONLY)).otherwise(F.col("landing_page"))
    columns = HISTORICAL_FUNNEL.schema.names
    hashed = with_hashes(rows.withColumn("landing_page", landing))
    return hashed.select(*columns, *LAYOUT).distinct().select(*columns)
