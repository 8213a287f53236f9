from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelake.functions.keys import composite_key, concat_key, stable_id
from quotelake.functions.text import missing_to_null, parse_percent, to_number
from quotelake.functions.times import day_text, epoch_to_timestamp, second_text, text_to_day


def one(spark, ddl, row, column):
    return spark.createDataFrame([row], ddl).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text", ["", " ", "NaN", "nan", "None", None])
def test_missing_texts_become_null(spark, text):
    assert one(spark, "s string", (text,), missing_to_null("s")) is None
    assert one(spark, "s string", (text,), to_number("s")) is None


def test_text_is_kept_as_it_is(spark):
    assert one(spark, "s string", (" NaN x ",), missing_to_null("s")) == " NaN x "


def test_bad_numbers_do_not_stop_the_job(spark):
    assert one(spark, "s string", ("abc",), to_number("s")) is None
    assert one(spark, "s string", ("12.5",), to_number("s", "int")) is None
    assert one(spark, "s string", (" 7 ",), to_number("s", "bigint")) == 7
    assert one(spark, "s string", ("1e30",), to_number("s", "decimal(20,2)")) is None


@pytest.mark.parametrize("text, value", [("0.12%", "0.12"), ("%5%", "5.00"), ("2632", "2632.00"), ("bad%", None)])
def test_percent(spark, text, value):
    found = one(spark, "s string", (text,), parse_percent("s", "decimal(20,2)"))
    assert found == (None if value is None else Decimal(value))


def test_half_up_rounding(spark):
    assert one(spark, "s string", ("2.675",), to_number("s", "decimal(20,2)")) == Decimal("2.68")
    assert one(spark, "v double", (2.675,), F.col("v").try_cast("decimal(20,2)")) == Decimal("2.68")
    assert one(spark, "v double", (float("nan"),), F.col("v").try_cast("decimal(20,2)")) is None


def test_composite_key_skips_null_parts_unless_strict(spark):
    row, ddl = ("MMM", None, "year"), "a string, b string, c string"
    assert one(spark, ddl, row, composite_key("a", "b", "c")) == "MMM_year"
    assert one(spark, ddl, row, composite_key("a", "b", "c", strict=True)) is None
    assert one(spark, ddl, row, concat_key("a", "b")) is None
    assert one(spark, ddl, row, concat_key("a", F.lit("_market"))) == "MMM_market"


def test_stable_id_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).selectExpr("id", "concat('tag', id % 10) tag")
    first = {(r[0], r[1]): r[2] for r in df.repartition(1).select("id", "tag", stable_id("tag", "id")).collect()}
    second = {(r[0], r[1]): r[2] for r in df.repartition(8).select("id", "tag", stable_id("tag", "id")).collect()}
    assert first == second
    assert len(set(first.values())) == 1000


def test_times(spark):
    at = datetime(2022, 12, 25, 9, 8, 7, 654321)
    assert one(spark, "t timestamp_ntz", (at,), day_text("t")) == "2022-12-25"
    assert one(spark, "t timestamp_ntz", (at,), second_text("t")) == "2022-12-25 09:08:07"
    assert one(spark, "t string", ("2022-12-25T23:30:00-05:00",), second_text("t")) == "2022-12-25 23:30:00"
    assert one(spark, "t string", ("Tue Oct 10 20:19:24 +0000 2018",), second_text("t")) is None
    assert one(spark, "t string", ("garbage text that is long",), second_text("t")) is None
    assert one(spark, "t string", ("2022-12-25 23:30:00-05:00",), day_text("t")) == "2022-12-25"
    assert one(spark, "t string", ("garbage",), day_text("t")) is None
    assert one(spark, "t string", ("2022-12-25 09:08:07",), text_to_day("t")) == "2022-12-25"
    assert one(spark, "t string", ("garbage",), text_to_day("t")) is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, "e string", ("1672000000",), epoch_to_timestamp("e")) == datetime(2022, 12, 25, 20, 26, 40)
        assert one(spark, "e bigint", (1672000000,), epoch_to_timestamp("e")) == datetime(2022, 12, 25, 20, 26, 40)
        assert one(spark, "e string", ("None",), epoch_to_timestamp("e")) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
