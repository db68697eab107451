"""Payment reports: key columns plus everything else as JSON."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import timestamp_or_null
from ..functions.times import DayRange
from ..operators.reshape import keys_and_rest
from ..schemas import PAYMENT_REPORT, PAYMENT_REPORT_HISTORY, TableSpec


def payment_report(
    report: DataFrame, load_time: datetime, spec: TableSpec = PAYMENT_REPORT, days: DayRange | None = None
) -> DataFrame:
    """Rows of a text report in the layout of ``spec``.

    The load time is one value per run. An own ``etl_load_date`` column of the report is
    neither kept nor put into the JSON.
    """
    keys = [c for c in spec.schema.names if c not in ("data", "etl_load_date")]
    rows = keys_and_rest(report.drop("etl_load_date"), keys)
    rows = rows.withColumn("created_at", timestamp_or_null("created_at"))
    if days is not None:
        rows = rows.where(days.holds_ts("created_at"))
    return rows.withColumn("etl_load_date", F.lit(load_time).cast("timestamp")).select(*spec.schema.names)


def payment_report_history(report: DataFrame, load_time: datetime, days: DayRange | None = None) -> DataFrame:
    return payment_report(report, load_time, PAYMENT_REPORT_HISTORY, days)
