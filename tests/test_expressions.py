import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from debutline.functions import dates, gain, series, text
from debutline.schema import GAIN_BANDS, NUMERIC_COLUMNS, OFFERING_COLUMNS, PAIR_TYPE

FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression("v").alias("out")).first()["out"]


def test_schema_sizes():
    assert len(OFFERING_COLUMNS) == 104 and len(set(OFFERING_COLUMNS)) == 104
    assert len(NUMERIC_COLUMNS) == 54


@pytest.mark.parametrize(
    ("raw", "opened", "closed"),
    [
        ("29 to 31 Jul 2025", dt.date(2025, 7, 29), dt.date(2025, 7, 31)),
        ("1 to 2 Feb 2022", dt.date(2022, 2, 1), dt.date(2022, 2, 2)),
        ("30 Jul to 1 Aug 2025", dt.date(2025, 7, 30), dt.date(2025, 8, 1)),
        ("30 Dec to 2 Jan 2026", dt.date(2025, 12, 30), dt.date(2026, 1, 2)),
        ("soon", None, None),
        (None, None, None),
    ],
)
def test_range_dates(spark, raw, opened, closed):
    span = one(spark, raw, "string", dates.range_dates)
    assert (span and (span["open"], span["close"])) in ((opened, closed), None)


@pytest.mark.parametrize(
    "raw", ["Wed, Jul 16, 2025", "Wed Jul 16 2025", "16 Jul 2025", "Jul 16 2025", "16-07-2025", "16-7-2025"]
)
def test_page_dates(spark, raw):
    assert one(spark, raw, "string", dates.parse_date) == dt.date(2025, 7, 16)


def test_unreadable_dates_are_null(spark):
    for raw in ("error", "[.]", "", "32-01-2025", None):
        assert one(spark, raw, "string", dates.parse_date) is None


@pytest.mark.parametrize(
    ("listing", "issue", "percent", "bucket"),
    [
        (100.0, "100", 0.0, "Cat_2"),
        (100.0, "90", 10.0, "Cat_3"),
        (100.0, "120", -20.0, "Cat_1"),
        (100.0, "350", -250.0, None),
        (800.0, "799", 0.12, "Cat_3"),
        (0.0, "10", None, None),
        (100.0, "error", None, None),
        (None, "10", None, None),
        (100.0, None, None, None),
        (100.0, "80", 20.0, "Cat_4"),
        (100.0, "0", 100.0, "Cat_6"),
    ],
)
def test_gain(spark, listing, issue, percent, bucket):
    df = spark.createDataFrame([(listing, issue)], "l double, i string")
    row = df.select(gain.listing_gain("l", "i").alias("g")).withColumn("b", gain.gain_bucket("g")).first()
    assert (row["g"], row["b"]) == (percent, bucket)


def test_band_text(spark):
    df = spark.createDataFrame([("Cat_1", 0.0), ("Cat_6", 5.0), ("Cat_9", 6.0), (None, None)], "b string, c double")
    rows = df.select(gain.band_text("b"), gain.class_text("c"), gain.bucket_class("b")).collect()
    assert [tuple(row) for row in rows] == [
        ("-100 to -20", "-100 to -20", 0),
        ("40 to 100", "40 to 100", 5),
        (None, None, 8),
        (None, None, None),
    ]


@FEW
@given(st.lists(st.floats(-150, 150), min_size=1, max_size=20))
def test_bucket_is_first_closed_band(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [row["b"] for row in df.select(gain.gain_bucket("v").alias("b")).collect()]
    assert got == [next((name for name, low, high in GAIN_BANDS if low <= v <= high), None) for v in values]


PRICE = st.one_of(st.none(), st.just(0.0), st.floats(1, 9).map(lambda v: round(v, 1)))
DAY = st.one_of(st.none(), st.integers(1, 28).map(lambda d: dt.date(2025, 1, d)))
PAIRS = st.lists(st.tuples(DAY, PRICE), max_size=8)


def run_pairs(spark, batches, expression):
    df = spark.createDataFrame([(at, b) for at, b in enumerate(batches)], f"at int, v array<{PAIR_TYPE.simpleString()}>")
    rows = df.select("at", expression("v").alias("out")).orderBy("at").collect()
    return [None if row["out"] is None else [tuple(pair) for pair in row["out"]] for row in rows]


@FEW
@given(st.lists(PAIRS, min_size=1, max_size=15))
def test_trim_leading_zeros(spark, batches):
    def model(pairs):
        first = next((at for at, (_, price) in enumerate(pairs) if price != 0), None)
        if first is None:
            return pairs if not pairs else None
        return pairs[first:] + [(None, None)] * first

    assert run_pairs(spark, batches, series.trim_leading_zeros) == [model(b) for b in batches]


@FEW
@given(st.lists(PAIRS, min_size=1, max_size=15))
def test_sort_pairs(spark, batches):
    def model(pairs):
        return sorted(pairs, key=lambda p: (p[0] is None, p[0] or dt.date.min))

    assert run_pairs(spark, batches, series.sort_pairs) == [model(b) for b in batches]


@FEW
@given(st.lists(st.lists(PRICE, min_size=1, max_size=7), min_size=1, max_size=15))
def test_squeeze_and_change(spark, batches):
    def squeezed(values):
        later = [v for v in values[1:] if v is not None]
        last = later[-1] if later else None
        return values[0], later[-2] if len(later) > 1 else last, last

    def change(values):
        known = [v for v in values if v is not None]
        if len(known) < 2:
            return None, None
        if 0 in known[:-1]:
            return None, known[-1]
        return sum((b - a) / a * 100 for a, b in zip(known, known[1:])), known[-1]

    df = spark.createDataFrame([(at, b) for at, b in enumerate(batches)], "at int, v array<double>")
    out = df.select("at", series.squeeze_days("v").alias("s"), series.change_and_last("v").alias("c")).orderBy("at").collect()
    assert [tuple(row["s"]) for row in out] == [squeezed(b) for b in batches]
    for row, values in zip(out, batches):
        expected = change(values)
        assert row["c"]["last_value"] == expected[1]
        assert row["c"]["sum_roc"] == (expected[0] if expected[0] is None else pytest.approx(expected[0]))


def test_prices_until_needs_a_date(spark):
    pairs = [(dt.date(2025, 1, 1), 1.0), (None, 2.0), (dt.date(2025, 1, 3), 3.0)]
    df = spark.createDataFrame([(pairs,)], f"v array<{PAIR_TYPE.simpleString()}>")
    assert df.select(series.prices_until("v", F.lit(dt.date(2025, 1, 2)))).first()[0] == [1.0, None, None]


def test_text_cleaning(spark):
    cases = [
        (text.clean_name, "A & B Co. Ltd. IPO", "A & B Company  Limited"),
        (text.clean_name, "X Corp. IPO", "X Corporation "),
        (text.clean_cell, "  ₹1,234.5 € ", "₹1234.5 "),
        (text.first_number, "₹95 to ₹100.5 per share", 95.0),
        (text.last_number, "₹95 to ₹100.5 per share", 100.5),
        (text.first_integer, "₹95.7", 95),
        (text.first_integer, "none", None),
        (text.issue_size, "1000 shares (aggregating up to ₹1250.45 Cr)", 1250.45),
        (text.issue_size, "nothing", None),
        (text.to_number, "nan", None),
        (text.to_number, "error", None),
        (text.rupees, "₹60", 60.0),
        (text.null_sentinels, "[.]", None),
        (text.null_sentinels, "EQ", "EQ"),
        (text.link_symbol, "https://www.bseindia.com/stock-share-price/a-b/ABC/500001/", "ABC"),
        (text.link_symbol, "https://www.bseindia.com/stock-share-price/a-b/500001", "500001"),
        (text.query_symbol, "https://www.nseindia.com/get-quotes/equity?symbol=ABC", "ABC"),
        (text.bracket_symbol, " (ABC | 500001) ", "ABC"),
        (text.searched_name, "https://www.google.co.in/search?q=screener.in+mainpage+A+and+B&pws=0&hl=en", "A and B"),
    ]
    for function, raw, expected in cases:
        assert one(spark, raw, "string", function) == expected, (function.__name__, raw)
    assert one(spark, "X Corp. IPO", "string", lambda c: F.length(text.clean_name(c))) == len("X Corporation ")
