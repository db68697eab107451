"""Pre-checkout forms without tests and own staff, keyed to their campaign."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import utm_key
from ..functions.times import DayRange, day_key
from ..schemas import PRECHECKOUT

# Fixed value: campaign text that marks a trial run.
TEST_TEXT = "%test%"


def precheckout_rows(raw: DataFrame, days: DayRange, internal_email: str = "%@shop.example%") -> DataFrame:
    """Cleaned rows of the days. A missing e-mail, source, medium or campaign drops the row,
    because NOT LIKE is not true for NULL."""
    kept = raw.where(days.holds_ts("created_at") & ~F.col("email").like(internal_email))
    for field in ("utm_source", "utm_medium", "utm_campaign"):
        kept = kept.where(~F.col(field).like(TEST_TEXT))
    derived = {
        "id_date": day_key("created_at"),
        "created_at": F.to_timestamp("created_at"),
        "utm_hash": utm_key("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content"),
        "phone": F.col("phone").cast("string"),
    }
    return kept.select(*(derived.get(c, F.col(c)).alias(c) for c in PRECHECKOUT.schema.names))
