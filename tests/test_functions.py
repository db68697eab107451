from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from funnelwright.functions.casts import float_or_zero, int_or_zero, rounded_int, timestamp_or_null
from funnelwright.functions.keys import joined, sha_key, utm_key
from funnelwright.functions.names import clean_name
from funnelwright.functions.records import action_count, action_map, param
from funnelwright.functions.rules import capped, classify, present, remap
from funnelwright.functions.times import (
    DayRange,
    day_from_key,
    day_list,
    day_path,
    epoch_day,
    iso_epoch,
    iso_text,
    lookback,
    named_range,
    shift_zone,
)
from funnelwright.functions.urls import bare_page, host_part, is_not_matching, query_value


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def text(value):
    return F.lit(value).cast("string")


def test_text_keys_propagate_null(spark):
    assert one(spark, joined(text("a"), text(None))) == (None,)
    assert one(spark, sha_key(text("a"), text(None))) == (None,)
    assert one(spark, joined(text("a"), text("b"), text("c"), delimiter="|")) == ("a|b|c",)


def test_hash_without_delimiter_may_collide(spark):
    same = one(spark, utm_key(*map(text, ("ab", "c", "d", "e", "f"))), utm_key(*map(text, ("a", "bc", "d", "e", "f"))))
    assert same[0] == same[1]
    apart = one(
        spark,
        utm_key(*map(text, ("ab", "c", "d", "e", "f")), delimiter="|"),
        utm_key(*map(text, ("a", "bc", "d", "e", "f")), delimiter="|"),
    )
    assert apart[0] != apart[1]


@pytest.mark.parametrize(
    "url, page, promo",
    [
        ("https://www.x.example/a?b=1", "x.example/a", None),
        ("http://x.example/p?promo=AB1-2", "x.example/p", "AB1"),
        ("x.example/p", "x.example/p", None),
        ("https://x.example/?promo=&promo=Z9", "x.example/", "Z9"),
        (None, None, None),
    ],
)
def test_urls(spark, url, page, promo):
    assert one(spark, bare_page(text(url)), query_value(text(url), "promo")) == (page, promo)


def test_not_matching_is_false_for_null(spark):
    assert one(spark, *(is_not_matching(text(v), "stag") for v in ("a stage", "b", None))) == (False, True, False)
    assert one(spark, host_part(text("h.example/a/b")), host_part(text("h"))) == ("h.example", "h")


def test_numbers(spark):
    given = ["1.9", "-1.9", "x", None, "nan", "inf", " 7 ", "1e30"]
    assert one(spark, *(int_or_zero(text(v)) for v in given)) == (1, -1, 0, 0, 0, 0, 7, 0)
    assert one(spark, *(float_or_zero(text(v)) for v in ("1.5", "bad", None, "nan"))) == (1.5, 0.0, 0.0, 0.0)
    assert one(spark, rounded_int(F.lit(2.5)), rounded_int(F.lit(-2.5))) == (3, -3)


def test_times(spark):
    assert one(spark, epoch_day(F.lit(1700000000))) == (date(2023, 11, 14),)
    at = F.timestamp_micros(F.lit(1700000000000000))
    assert one(spark, shift_zone(at, "America/Sao_Paulo")) == (datetime(2023, 11, 15, 1, 13, 20),)
    assert one(spark, shift_zone(at, "America/Sao_Paulo", "convert")) == (datetime(2023, 11, 14, 19, 13, 20),)
    assert one(spark, iso_text(F.lit(0)), iso_epoch(text("1970-01-02T00:00:00Z"))) == ("1970-01-01T00:00:00+00:00", 86400)
    assert one(spark, day_path(at), day_path(F.lit(None).cast("timestamp"))) == ("2023/11/14", "unknown")
    assert one(spark, day_from_key(text("20241231"))) == (date(2024, 12, 31),)
    assert one(spark, timestamp_or_null(text("bad"))) == (None,)
    with pytest.raises(ValueError):
        shift_zone(at, "UTC", "other")


def test_lookbacks(spark):
    today = date(2024, 12, 10)
    assert lookback(today, 3, 1).days() == [date(2024, 12, 7), date(2024, 12, 8), date(2024, 12, 9)]
    assert lookback(today, 1, 3).days() == []
    assert lookback(today, 1, 3, swap_ok=True) == lookback(today, 3, 1)
    assert lookback(today, 3, 1).first_key == "20241207"
    listed = one(spark, day_list(F.lit(today), 3, 1), day_list(F.lit(today), 1, 3), day_list(F.lit(today), 1, 3, True))
    assert listed == (lookback(today, 3, 1).days(), [], lookback(today, 3, 1).days())


def test_named_ranges():
    day = date(2024, 12, 10)  # a Tuesday
    assert named_range("2024-01-01, 2024-01-31", day) == DayRange(date(2024, 1, 1), date(2024, 1, 31))
    assert named_range("last_7_days", day) == DayRange(date(2024, 12, 3), date(2024, 12, 9))
    assert named_range("LAST_WEEK_MON_SUN", day) == DayRange(date(2024, 12, 2), date(2024, 12, 8))
    assert named_range("LAST_WEEK_SUN_SAT", day) == DayRange(date(2024, 12, 1), date(2024, 12, 7))
    assert named_range("LAST_MONTH", day) == DayRange(date(2024, 11, 1), date(2024, 11, 30))
    with pytest.raises(ValueError):
        named_range("SOMETIME", day)


def test_day_bounds(spark):
    days = DayRange(date(2024, 1, 1), date(2024, 1, 1))
    at = [F.lit(t).cast("timestamp") for t in ("2024-01-01 00:00:00", "2024-01-01 23:59:59.999", "2024-01-02 00:00:00")]
    assert one(spark, *map(days.holds_ts, at)) == (True, True, False)
    assert one(spark, *(days.holds_epoch(F.unix_timestamp(t)) for t in at)) == (True, True, False)


def test_rules(spark):
    a = F.lit(5)
    assert one(spark, classify([(a > 9, "big"), (a > 3, "mid"), (a > 1, "low")], default="none")) == ("mid",)
    assert one(spark, classify([(F.lit(None).cast("boolean"), "x")], default="d"), classify([], default="d")) == ("d", "d")
    assert one(spark, remap(text("a"), {"a": "b"}), remap(text("z"), {"a": "b"})) == ("b", "z")
    cap = lambda n, c: capped(F.lit(n).cast("bigint"), 10, F.lit(c))
    assert one(spark, cap(11, True), cap(11, False), cap(10, True)) == (10, 11, 10)
    assert one(spark, *(present(text(v)) for v in ("a", "", None))) == (True, False, False)


def test_repeated_records(spark):
    params = spark.sql(
        """SELECT array(named_struct('key', 'a', 'value', named_struct('s', 'first', 'i', 1L)),
        named_struct('key', 'a', 'value', named_struct('s', 'second', 'i', 2L))) AS p"""
    )
    assert tuple(params.select(param("p", "a", "s"), param("p", "b", "s")).first()) == ("first", None)
    actions = spark.createDataFrame(
        [([("x", "1.9"), ("x", "-1.9"), (None, "4"), ("", "5"), ("y", "bad"), ("z", None)],), (None,), ([],)],
        "a array<struct<action_type: string, value: string>>",
    )
    counted = actions.select(action_count("a", "x"), action_count("a", "y"), action_count("a", "none"))
    assert [tuple(r) for r in counted.collect()] == [(-1, 0, 0), (0, 0, 0), (0, 0, 0)]
    assert [r[0] for r in actions.select(action_map("a")).collect()] == [{"x": -1, "y": 0, "z": 0}, None, {}]


@pytest.mark.parametrize(
    "style, given, expected",
    [
        ("report", " Charge ID (x)", "charge_id_x_"),
        ("contact", "9 Lives-x!", "_9_lives_x"),
        ("contact", "a - b", "a_b"),
        ("snake", "billingDetails.postal-code", "billing_details_postal_code"),
        ("snake", "a__b..c", "a_b_c"),
    ],
)
def test_names(style, given, expected):
    assert clean_name(given, style) == expected
