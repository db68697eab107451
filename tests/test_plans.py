"""Physical plans: filters reach the files, columns are pruned, nothing runs in Python."""

import pytest

from funnelwright.plans.precheckout import precheckout_rows
from funnelwright.queries import inputs, queries
from funnelwright.queries.registry import Tables
from funnelwright.sources.slices import created_within, loaded_since

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_lookback_reaches_the_scan(spark, tmp_path):
    inputs.raw_forms(Tables(spark, FOLDER)).write.parquet(str(tmp_path / "forms"))
    text = plan(precheckout_rows(spark.read.parquet(str(tmp_path / "forms")), inputs.EVENT_DAYS))
    assert "GreaterThanOrEqual(created_at,2024-01-04" in text and "LessThan(created_at,2024-01-25" in text
    assert "referrer" not in text.split("ReadSchema:")[1]


def test_epoch_slice_is_a_constant_range(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "created").write.parquet(str(tmp_path / "x"))
    text = plan(created_within(spark.read.parquet(str(tmp_path / "x")), "created", inputs.EVENT_DAYS))
    assert "GreaterThanOrEqual(created,1704326400), LessThan(created,1706140800)" in text


def test_load_day_prunes_folders(spark, tmp_path):
    insights = inputs.social_insights(Tables(spark, FOLDER))
    insights.write.partitionBy("_load_date").parquet(str(tmp_path / "x"))
    text = plan(loaded_since(spark.read.parquet(str(tmp_path / "x")), "_load_date", inputs.EVENT_DAYS))
    assert "(_load_date" in text.split("PartitionFilters:")[1].split("]")[0]


@pytest.mark.parametrize("name", sorted(set(queries()) - {"csv_rest_json", "format_read", "conversion_mart"}))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for node in ("Python", "CartesianProduct", "NestedLoop"):
        assert node not in text
