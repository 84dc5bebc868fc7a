"""Small hand-computed cases for expressions whose rules are easy to get wrong."""

import datetime

import pytest
from pyspark.sql import functions as F

from tablework.functions import dates, numbers, text
from tablework.operators import aggs

DAY = datetime.date


@pytest.fixture
def one(spark):
    """Evaluate expressions over a single row of named text columns."""
    def evaluate(expression, **values):
        df = spark.range(1)
        for name, value in values.items():
            df = df.withColumn(name, F.lit(value))
        return df.select(expression).first()[0]
    return evaluate


@pytest.mark.parametrize("start, months, expected", [
    (DAY(2023, 2, 28), 12, DAY(2024, 2, 29)), (DAY(2024, 2, 29), -12, DAY(2023, 2, 28)),
    (DAY(2023, 3, 31), 3, DAY(2023, 6, 30)), (DAY(2023, 6, 30), 3, DAY(2023, 9, 30)), (DAY(2023, 6, 15), 1, DAY(2023, 7, 15)),
])
def test_shift_months_keeps_month_end(one, start, months, expected):
    assert one(dates.shift_months("d", months), d=start) == expected


def test_dates(one):
    assert one(dates.season("d"), d=DAY(2023, 6, 30)) == 2022
    assert one(dates.season("d"), d=DAY(2023, 7, 1)) == 2023
    assert one(dates.decade("d"), d=DAY(1969, 1, 1)) == 1960
    assert one(dates.window_date(F.lit(2022), F.lit(1), F.lit(5))) == DAY(2023, 1, 5)
    assert one(dates.window_date(F.lit(2022), F.lit(7), F.lit(1))) == DAY(2022, 7, 1)
    assert one(dates.try_date("t", "yyyy-MM-dd", "d.M.yyyy"), t="14.6.2023") == DAY(2023, 6, 14)
    assert one(dates.try_date("t", "yyyy-MM-dd", "d.M.yyyy"), t="soon") is None
    a, b = datetime.datetime(2024, 1, 2, 12), datetime.datetime(2024, 1, 1)
    assert one(dates.frac_days("a", "b"), a=a, b=b) == 1.5


@pytest.mark.parametrize("words, expected", [
    ("Opublikowano 9 minut temu", datetime.datetime(2025, 1, 10, 11, 51)),
    ("1 minutę temu", datetime.datetime(2025, 1, 10, 11, 59)), ("3 godziny temu", datetime.datetime(2025, 1, 10, 9)),
    ("wczoraj", datetime.datetime(2025, 1, 9, 12)), ("2 dni temu", datetime.datetime(2025, 1, 8, 12)), ("dawno", None), ("dni", None), (None, None), ("9" * 30 + " dni", None),
])
def test_relative_time(one, words, expected):
    anchor = F.lit("2025-01-10 12:00:00").cast("timestamp_ntz")
    assert one(dates.relative_time("w", anchor), w=words) == expected


def test_text(one):
    assert one(text.concat_blank(F.lit("a"), F.lit(None), F.lit(3))) == "a3"
    assert one(text.strip_controls("t"), t="a\nb\r\tc") == "abc"
    assert one(text.money("t"), t="$1,234.50") == 1234.5
    assert one(text.money("t"), t="n/a") is None
    assert one(text.strip_unit("t", "km"), t="1 234 km") == 1234
    assert one(text.ascii_upper("t"), t="ażb") == "AżB"
    assert one(text.repair_utf8("t"), t="żółw".encode().decode("latin-1")) == "żółw"
    assert one(text.repair_utf8("t"), t="żółw café") == "żółw café"
    assert one(text.repair_utf8("t"), t="Â at the end Ã") == "Â at the end Ã"
    assert one(text.unescape_unicode("t"), t='z\\u0142oty "x"\n') == 'złoty "x"\n'
    assert one(text.translate_each("t", text.MORSE), t="SOS") == "... --- ..."
    line = "1 234 cm3 • 99 KM • Roomy estate"
    assert one(text.extract_or("t", text.ENGINE_CAPACITY, "-"), t=line) == "1 234 cm3 "
    assert one(text.extract_or("t", text.ENGINE_POWER, "-"), t=line) == " 99 KM "
    assert one(text.extract_or("t", text.LAST_PART, "-", 2), t=line) == "Roomy estate"
    assert one(text.extract_or("t", text.ENGINE_POWER, "-"), t="electric") == "-"


@pytest.mark.parametrize("url, expected", [
    ("http://x/y?a=1&page=2&b=3#top", "http://x/y?a=1&page=9&b=3#top"), ("http://x/y#top", "http://x/y?page=9#top"),
    ("http://x/y?a=1", "http://x/y?a=1&page=9"), ("http://x/y?page=1&page=2", "http://x/y?page=9"),
    ("http://x/y?xpage=1", "http://x/y?xpage=1&page=9"),
])
def test_url_set(one, url, expected):
    assert one(text.url_set("u", "page", "9"), u=url) == expected


def test_url_get(one):
    assert one(text.url_get("u", "a"), u="http://x/y?a=1&b=2") == "1"
    assert one(text.url_get("u", "c"), u="http://x/y?a=1&b=2") is None


def test_numbers(one):
    assert one(numbers.safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(numbers.leverage(F.lit(25.0))) == 3.0
    assert one(numbers.leverage(F.lit(0.0))) is None
    assert one(numbers.reverse_bits(F.lit(1))) == 2 ** 31
    assert one(numbers.weighted_sum(F.array(F.lit(1.0), F.lit(2.0)), [0.5, 0.25])) == 1.0
    assert one(numbers.grid(0, 1, 5)) == [0, 0.25, 0.5, 0.75, 1]
    assert one(numbers.every_nth(F.array(*[F.lit(i) for i in range(5)]), 2)) == [0, 2, 4]


def test_keep_last_ranks_null_last(spark):
    """A null order counts as last; ties are resolved by MIN or MAX of the value, nulls ignored."""
    df = spark.sql("""VALUES ('a', 1, 10, DATE '2020-01-01'), ('a', 2, 30, DATE '2020-01-05'), ('a', 2, 20, DATE '2020-01-03'),
                      ('a', 2, NULL, NULL), ('b', 1, 5, DATE '2021-01-01'), ('b', NULL, 7, DATE '2021-01-02') AS t(k, o, v, d)""")
    out = df.groupBy("k").agg(
        aggs.keep_last(F.col("v"), F.col("o"), "min").alias("low"), aggs.keep_last(F.col("v"), F.col("o")).alias("high"),
        aggs.keep_last(F.col("d"), F.col("o"), "min", date=True).alias("day"))
    assert {tuple(r) for r in out.collect()} == {("a", 20, 30, DAY(2020, 1, 3)), ("b", 7, 7, DAY(2021, 1, 2))}


def test_product_of_others_zero_rules(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 0), (2, 5), (3, 0), (3, 0), (3, 7), (4, 6)], "k int, v int")
    out = {(r["k"], r["v"]): r["p"] for r in aggs.product_of_others(df, ["k"], "v", "p").collect()}
    assert out == {(1, 2): 12, (1, 3): 8, (1, 4): 6, (2, 0): 5, (2, 5): 0, (3, 0): 0, (3, 7): 0, (4, 6): 1}


def test_encoded_url_parameters(one):
    url = "http://x/y?search%5Border%5D=a%3Ab&q=a+b&z"
    assert one(text.url_get("u", "search[order]"), u=url) == "a:b" and one(text.url_get("u", "q"), u=url) == "a b"
    assert one(text.url_get("u", "z"), u=url) == "" and one(text.url_get("u", "no"), u="http://x/y") is None
    assert one(text.url_set("u", "q", "a&b=1"), u=url) == "http://x/y?search%5Border%5D=a%3Ab&q=a%26b%3D1&z"
    assert one(text.next_page("u"), u="http://x/y?page=9#top") == "http://x/y?page=10#top"
    assert one(text.next_page("u"), u="http://x/y") == "http://x/y?page=2"


def test_years_of_any_width_and_large_numbers(one):
    assert one(dates.try_date("t", "d.M.y"), t="14.6.2023") == datetime.date(2023, 6, 14)
    assert one(text.strip_unit("t", "km"), t="3 000 000 000 km") == 3_000_000_000


def test_codes_keep_every_character(one):
    coded = text.translate_each("t", text.MORSE)
    assert one(coded, t="AB 7") == ".- -... / 7"
    assert one(text.translate_back(coded, text.MORSE), t="COLD WIDGET 7") == "COLD WIDGET 7"
