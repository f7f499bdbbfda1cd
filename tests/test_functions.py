import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crewlens import functions as fn

TS = dt.datetime


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "clock"),
    [
        ("7:05 AM", "07:05:00"),
        ("07:05 pm", "19:05:00"),
        ("7:05 AM", "07:05:00"),
        ("12:00 AM", "00:00:00"),
        ("12:00 PM", "12:00:00"),
        ("  7:05AM ", "07:05:00"),
        ("7:05  Am", "07:05:00"),
        ("7:5 AM", "07:05:00"),
        ("13:00 PM", None),
        ("0:30 AM", None),
        ("7:60 AM", None),
        ("007:05 AM", None),
        ("007:5 AM", None),
        ("7:005 AM", None),
        ("7:05 a.m.", None),
        ("7:05", None),
        ("bogus", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_clock(spark, text, clock):
    assert one(spark, fn.parse_clock(F.lit(text).cast("string"))) == clock


def test_parse_clock_as_time(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        assert one(spark, fn.parse_clock(F.lit("7:05 PM"), as_time=True).cast("string")) == "19:05:00"
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


@pytest.mark.parametrize(
    ("text", "ts"),
    [
        ("2025-01-02T03:04:05.5Z", TS(2025, 1, 2, 3, 4, 5, 500000)),
        ("2025-01-02T03:04:05Z", TS(2025, 1, 2, 3, 4, 5)),
        ("2025-01-02T03:04:05.123456789Z", TS(2025, 1, 2, 3, 4, 5, 123456)),
        ("2025-01-02 03:04:05", TS(2025, 1, 2, 3, 4, 5)),
        ("2025-01-02T03:04:05+02:00", TS(2025, 1, 2, 1, 4, 5)),
        ("x", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, ts):
    assert one(spark, fn.parse_ts(F.lit(text).cast("string"))) == ts


def test_parse_ts_takes_timestamps(spark):
    value = TS(2025, 1, 2, 3, 4, 5, 250000)
    assert one(spark, fn.parse_ts(F.lit(value).cast("timestamp_ntz"))) == value


def test_minutes_between_counts_boundaries(rows):
    df = rows(
        "a timestamp_ntz, b timestamp_ntz",
        [
            (TS(2025, 1, 1, 10, 0, 59), TS(2025, 1, 1, 10, 1, 0)),
            (TS(2025, 1, 1, 10, 0, 0), TS(2025, 1, 1, 10, 0, 59)),
            (TS(2025, 1, 1, 10, 1, 0), TS(2025, 1, 1, 10, 0, 59)),
            (TS(2025, 1, 1, 10, 0, 0), None),
        ],
    )
    minutes = df.select(fn.minutes_between(F.col("a"), F.col("b"))).collect()
    assert [m[0] for m in minutes] == [1, 0, -1, None]


def test_local_time_follows_the_tenant(rows):
    zones = {1: "America/Phoenix", 2: "America/New_York", 3: "America/New_York"}
    df = rows(
        "company_id bigint, ts timestamp_ntz",
        [
            (1, TS(2025, 1, 1, 3)),
            (2, TS(2025, 7, 1, 3)),
            (3, TS(2025, 1, 1, 3)),
            (9, None),
            (1, None),
        ],
    )
    args = (F.col("ts"), F.col("company_id"), zones)
    found = df.select(fn.to_local(*args), fn.local_date(*args)).collect()
    assert [tuple(r) for r in found] == [
        (TS(2024, 12, 31, 20), dt.date(2024, 12, 31)),
        (TS(2025, 6, 30, 23), dt.date(2025, 6, 30)),
        (TS(2024, 12, 31, 22), dt.date(2024, 12, 31)),
        (None, None),
        (None, None),
    ]


def test_a_time_of_an_unknown_tenant_is_an_error(spark, rows):
    zones = {1: "America/Phoenix"}
    for company in (9, None):
        df = rows("company_id bigint, ts timestamp_ntz", [(1, TS(2025, 6, 1, 3)), (company, TS(2025, 6, 1, 3))])
        args = (F.col("ts"), F.col("company_id"), zones)
        for column in (fn.to_local(*args), fn.in_local_years(*args, 2024, 2025), fn.local_year_from(*args, 2024)):
            with pytest.raises(Exception, match="no time zone for company_id"):
                df.select(column.alias("x")).collect()


def test_local_year_tests_agree_with_the_plain_year(spark):
    zones = {1: "America/Phoenix", 2: "Pacific/Kiritimati", 3: "Pacific/Pago_Pago"}
    hours = spark.range(0, 24 * 365 * 3, 1).select(
        (F.col("id") % 3 + 1).alias("company_id"),
        F.expr("timestamp_ntz'2023-12-01 00:30:00' + make_interval(0, 0, 0, 0, cast(id as int))").alias("ts"),
    )
    args = (F.col("ts"), F.col("company_id"), zones)
    year = F.year(fn.to_local(*args))
    wrong = hours.where(
        (fn.in_local_years(*args, 2024, 2025) != year.between(2024, 2025))
        | (fn.local_year_from(*args, 2025) != (year >= 2025))
    )
    assert wrong.count() == 0


def test_today_is_a_parameter_or_the_utc_day(spark):
    assert one(spark, fn.today_utc(dt.date(2025, 1, 2))) == dt.date(2025, 1, 2)
    days = {dt.datetime.now(dt.UTC).date()}
    today = one(spark, fn.today_utc())
    assert today in days | {dt.datetime.now(dt.UTC).date()}


def test_utrim_strips_all_blanks(spark):
    for text in ("\ta", " a ", "　 a\r\n", " a\x85"):
        assert one(spark, fn.utrim(F.lit(text))) == "a"
    assert one(spark, fn.utrim(F.lit(" a b "))) == "a b"


def test_clean_text(spark):
    assert one(spark, fn.clean_text(F.lit("7:05 AM/x"))) == "7:05 AM x"


def test_labelled_list(spark):
    none = F.lit(None).cast("string")
    assert one(spark, fn.labelled_list([("L1", none), ("L2", none)], default="0h 00m")) == "L1: 0h 00m | L2: 0h 00m"
    assert one(spark, fn.labelled_list([("L1", none), ("L2", none)])) == "-"
    assert one(spark, fn.labelled_list([("L1", none), ("L2", F.lit("x"))])) == "L2: x"
    assert one(spark, fn.labelled("L", none)) is None


def test_join_text(spark):
    items = F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))
    assert one(spark, fn.join_text(items)) == "a, b"
    assert one(spark, fn.join_text(F.lit(None).cast("array<string>"))) == ""


def test_money_rounds_halves_away_from_zero(spark):
    assert one(spark, fn.money(F.lit(Decimal("2.345")))) == Decimal("2.35")
    assert one(spark, fn.money(F.lit(Decimal("-2.345")))) == Decimal("-2.35")
    assert one(spark, fn.hours_from_minutes(F.lit(50))) == Decimal("0.83")


def test_optional_column(rows):
    df = rows("id bigint, unit string", [(1, "7")])
    bad = rows("id bigint, unit string", [(1, "x")])
    assert df.select(fn.optional_column(df, "unit", "bigint")).first()[0] == 7
    missing = df.select(fn.optional_column(df, "none", "bigint").alias("n"))
    assert missing.dtypes == [("n", "bigint")] and missing.first()["n"] is None
    assert bad.select(fn.optional_column(bad, "unit", "bigint", lenient=True)).first()[0] is None
    with pytest.raises(PySparkException):
        bad.select(fn.optional_column(bad, "unit", "bigint")).collect()


def test_json_value(spark):
    assert one(spark, fn.json_value(F.lit('{"k": 69}'), "$.k", "bigint")) == 69
    assert one(spark, fn.json_value(F.lit('{"k": 69}'), "$.z")) is None
