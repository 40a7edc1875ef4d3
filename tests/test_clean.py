import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesflow.functions import (
    date_key,
    is_non_numeric,
    money_text,
    normalise_bool,
    parse_date,
    safe_double,
)

GOOD_NUMBERS = {
    "12.3": 12.3,
    "12,3": 12.3,
    " 7 ": 7.0,
    "+4": 4.0,
    "-.5": -0.5,
    ".5": 0.5,
    "\t3\n": 3.0,
    "007": 7.0,
}
BAD_NUMBERS = ["5.", "1e5", "1,234.5", "error", "", "NaN", "Infinity", "0x1F", "1_000", "12d", "٣", "1 2", "--1"]


def one(spark, value, type_, column):
    return spark.createDataFrame([(value,)], f"v {type_}").select(column).first()[0]


@pytest.mark.parametrize("text,number", GOOD_NUMBERS.items())
def test_good_numbers(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(safe_double("v"), is_non_numeric("v")).first()[:] == (number, False)


def test_bad_numbers_become_zero_and_are_counted(spark):
    df = spark.createDataFrame([(t,) for t in BAD_NUMBERS] + [(None,)], "v string")
    assert {r[0] for r in df.select(safe_double("v")).collect()} == {0.0}
    assert df.agg(F.count_if(is_non_numeric("v"))).first()[0] == len(BAD_NUMBERS)  # null is not bad


def test_no_rows_count_as_no_bad_numbers(spark):
    assert spark.createDataFrame([], "v string").agg(F.count_if(is_non_numeric("v"))).first()[0] == 0


@pytest.mark.parametrize(
    "value,type_,number,bad",
    [
        (12345678.9, "double", 12345678.9, False),
        (0.0005, "double", 0.0005, False),
        (5, "int", 5.0, False),
        (2**40, "long", float(2**40), False),
        (float("nan"), "double", 0.0, True),
        (float("inf"), "double", 0.0, True),
        (None, "double", 0.0, None),
        (True, "boolean", 0.0, True),
    ],
)
def test_columns_that_hold_numbers(spark, value, type_, number, bad):
    assert one(spark, value, type_, safe_double("v")) == number
    assert one(spark, value, type_, is_non_numeric("v")) is bad


def test_type_test_leaves_no_trace_in_the_plan(spark):
    plan = spark.range(3).select(safe_double("id").alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "typeof" not in plan and "RLIKE" not in plan


@pytest.mark.parametrize(
    "text,expected",
    [("1", True), ("TRUE", True), ("Y", True), ("t", True), ("yes", True)]
    + [(" yes", False), ("0", False), ("", False), ("1.0", False), ("no", False), (None, None)],
)
def test_bool(spark, text, expected):
    assert one(spark, text, "string", normalise_bool("v")) is expected


def test_bool_trim_and_native(spark):
    assert one(spark, " Yes ", "string", normalise_bool("v", trim=True)) is True
    assert one(spark, True, "boolean", normalise_bool("v")) is True
    assert one(spark, 1, "int", normalise_bool("v")) is True


@pytest.mark.parametrize(
    "text,expected",
    [("2025-03-01 10:00:00", "2025-03-01"), ("2025-03-02", "2025-03-02")]
    + [(t, None) for t in ("bad", "2025-02-30", "2025-3-1", "2025-03-01 25:00:00", "", None)]
    + [("2025-03-01T10:00:00", None), ("2025-03-01 10:00", None), ("2025-03-01 10:00:00 x", None)],
)
def test_dates(spark, text, expected):
    assert one(spark, text, "string", parse_date("v")) == expected


def test_dates_equal_trying_both_formats(spark):
    texts = ["2025-03-01 10:00:00", "2024-02-29", "2023-02-29", "x" * 19, "1582-10-10", "9999-12-31 23:59:59"]
    texts += ["+12345-01-01", "+12345-01-01 00:00:00", "0001-01-01", "0000-01-01", "-001-01-01", " 2025-01-01"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    tried = F.coalesce(
        F.try_to_timestamp("v", F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp("v", F.lit("yyyy-MM-dd"))
    )
    both = df.select("v", parse_date("v").alias("a"), F.date_format(tried, "yyyy-MM-dd").alias("b")).collect()
    assert [r for r in both if r.a != r.b] == []


def test_bad_date_can_fail_the_job(spark):
    with pytest.raises(Exception, match="not a date: bad"):
        one(spark, "bad", "string", parse_date("v", "error"))
    assert one(spark, None, "string", parse_date("v", "error")) is None
    assert one(spark, "2025-03-02", "string", parse_date("v", "error")) == "2025-03-02"
    with pytest.raises(ValueError):
        parse_date("v", "ignore")


def test_date_key_and_money(spark):
    assert one(spark, "2025-03-01", "string", date_key("v")) == "20250301"
    df = spark.createDataFrame([(1.2281683328999993e8,), (136.79999999999998,), (-25.55,), (None,)], "v double")
    assert rows(df.select(money_text("v"))) == [(None,), ("-25.55",), ("122816833.29",), ("136.80",)]
