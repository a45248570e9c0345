import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspan.functions.dates import load_time, parse_date, parse_day, round_to_second
from tallyspan.functions.numbers import joined_amount, parse_number, ratio, split_amount
from tallyspan.functions.text import blank_to, canon_platform, initcap_alnum


def apply(spark, values, fn, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_initcap_starts_a_word_after_any_other_character(spark):
    cases = {
        "BING_ads/x tik-tok": "Bing_Ads/X Tik-Tok",
        "x1y-2z  q": "X1y-2z  Q",
        "élan VITAL": "Élan Vital",
        "a\u0001 b\u0001c": "A\u0001 B\u0001C",
        "it's": "It'S",
        "$1 \\ x": "$1 \\ X",
        "": "",
        None: None,
    }
    assert apply(spark, list(cases), initcap_alnum) == list(cases.values())


def test_platform_spellings(spark):
    cases = {
        " Google Ads ": "Google",
        "ADWORDS": "Google",
        "googleads": "Google",
        "google": "Google",
        "fb": "Meta",
        "Facebook Ads": "Meta",
        " META ": "Meta",
        "tik-tok ads": "Tik-Tok Ads",
        "\tgoogle": "\tGoogle",
        "": "",
        None: None,
    }
    assert apply(spark, list(cases), canon_platform) == list(cases.values())
    own = {"TikTok": ("tik-tok ads",)}
    assert apply(spark, ["Tik-Tok ads", "fb"], lambda c: canon_platform(c, own)) == ["TikTok", "Fb"]
    assert apply(spark, ["fb x"], lambda c: canon_platform(c, {})) == ["Fb X"]


def test_blank_text(spark):
    assert apply(spark, ["", None, " "], lambda c: blank_to(c, "d")) == ["d", "d", " "]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1,234.50", 1234.5),
        (" 7 ", 7.0),
        (" 7\t", 7.0),
        ("1e3", 1000.0),
        ("+.5", 0.5),
        ("5.", 5.0),
        ("-5", -5.0),
        ("", 0.0),
        (" , ", 0.0),
        (None, 0.0),
        ("abc", None),
        ("12d", None),
        ("1f", None),
        ("0x1p3", None),
        ("NaN", None),
        ("Infinity", None),
        ("1e400", None),
        (".", None),
        ("1 2", None),
    ],
)
def test_number_text(spark, text, number):
    assert apply(spark, [text], parse_number) == [number]


def test_blank_number_can_be_null(spark):
    assert apply(spark, ["", None, "0"], lambda c: parse_number(c, "null")) == [None, None, 0.0]
    with pytest.raises(ValueError):
        parse_number(F.col("v"), "one")


def test_negative_zero_is_zero(spark):
    assert str(apply(spark, ["-0"], parse_number)[0]) == "0.0"


def test_date_text(spark):
    cases = {
        "2025-06-30": dt.date(2025, 6, 30),
        "2025-6-1": dt.date(2025, 6, 1),
        "2025/6/1": dt.date(2025, 6, 1),
        "20250601": dt.date(2025, 6, 1),
        "6/30/2025": dt.date(2025, 6, 30),
        " 2025-06-30 12:00:00": dt.date(2025, 6, 30),
        "2025-06-30T12:00:00Z": dt.date(2025, 6, 30),
        "2025": None,
        "2025-06": None,
        "2025-02-30": None,
        "30/6/2025": None,
        "2025-06-30 x": None,
        "": None,
        None: None,
    }
    assert apply(spark, list(cases), parse_date) == list(cases.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_are_rounded_not_cut(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day.
        times = [
            dt.datetime(2025, 3, 9, 2, 30, 0, 499_999),
            dt.datetime(2025, 3, 9, 2, 30, 59, 500_000),
            dt.datetime(1969, 12, 31, 23, 59, 58, 500_000),
            None,
        ]
        got = apply(spark, times, round_to_second, "timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        dt.datetime(2025, 3, 9, 2, 30, 0),
        dt.datetime(2025, 3, 9, 2, 31, 0),
        dt.datetime(1969, 12, 31, 23, 59, 59),
        None,
    ]


def test_load_time_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        east = dt.timezone(dt.timedelta(hours=2))
        times = dt.datetime(2025, 7, 1, 8, 0, 0, 5), dt.datetime(2025, 7, 1, 10, tzinfo=east)
        got = spark.range(1).select(*[load_time(t) for t in times]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == (dt.datetime(2025, 7, 1, 8, 0, 0, 5), dt.datetime(2025, 7, 1, 8))


def test_ratio_guards(spark):
    df = spark.createDataFrame([(6.0, 0.0), (6.0, -2.0), (6.0, 2.0), (6.0, None)], "n double, d double")
    assert [r[0] for r in df.selectExpr(ratio("n", "d")).collect()] == [None, -3.0, 3.0, None]
    got = df.selectExpr(ratio("n", "d", "positive")).collect()
    assert [r[0] for r in got] == [None, None, 3.0, None]
    with pytest.raises(ValueError):
        ratio("n", "d", "any")


def test_amounts_add_up_exactly(spark):
    amounts = [0.1, 0.2, -1.55, 1e12 + 0.07, 38931837.17, -0.01, None]
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    whole, fraction = split_amount("a")
    sums = df.selectExpr(f"sum({whole}) AS w", f"sum({fraction}) AS f")
    assert sums.selectExpr(joined_amount("w", "f")).first()[0] == 1000038931835.98
    none = df.filter("a IS NULL").selectExpr(f"sum({whole}) AS w", f"sum({fraction}) AS f")
    assert none.selectExpr(joined_amount("w", "f")).first()[0] is None


def test_a_time_behind_a_date_must_be_one(spark):
    texts = ["2025-06-30 ::::", "2025-06-30T", "2025-06-30 12:00", "2025-06-30T00:00:00Z", "2025-06-30 1:02:03.5 +02:00", "2025-06-30 Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    days = [r[0] for r in df.select(parse_date(F.col("t"))).collect()]
    assert [d is not None for d in days] == [False, False, True, True, True, False]


@pytest.mark.parametrize("text", ["2025/06/01", "6/1/2025", "2025-06-01T00:00:00Z", "20250601", " 2025-6-1 ", "06-01-2025", "x", "", "2025-6", "2025-06-01\n"])
def test_requests_take_the_dates_that_files_take(spark, text):
    in_files = spark.createDataFrame([(text,)], "t string").select(parse_date(F.col("t"))).first()[0]
    try:
        asked = parse_day(text)
    except ValueError:
        asked = None
    assert asked == in_files
