import datetime as dt

import duckdb
from pyspark.sql import functions as F

from tallyforge.functions import arrays, dates, text


def _one(spark, value, rule, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(rule(F.col("c"))).first()[0]


def test_titles(spark):
    assert _one(spark, "A (1995) B (12)", text.title_without_year) == "A  B (12)"
    assert _one(spark, "no year", text.title_without_year) == "no year"
    assert _one(spark, "Été (1995) (V)", text.title_before_bracket) == "Été"
    assert _one(spark, "Plain", text.title_before_bracket) == "Plain"
    assert _one(spark, "A, B: (C)", text.without_title_marks) == "A B C"


def test_release_year(spark):
    cases = {"01-Jan-1995": 1995, "": 1900, "95": 1900, "01-Jan-19x5": 1900, " 199": 1900, "1995": 1995}
    for value, year in cases.items():
        assert _one(spark, value, text.release_year) == year


def test_tokens(spark):
    assert _one(spark, "a b  c ", text.split_on_space) == ["a", "b", "", "c"]
    assert _one(spark, "", text.split_on_space) == [""]
    assert _one(spark, "   ", text.split_on_space) == []
    assert _one(spark, "To be, or not--to BE:", text.words) == ["to", "be", "or", "not", "to", "be"]


def test_numbers(spark):
    assert _one(spark, "?", text.number_or_zero) == 0.0
    assert _one(spark, "-1.5", text.number_or_zero) == -1.5
    assert _one(spark, '"q"', text.without_quotes) == "q"


def test_hours(spark):
    assert _one(spark, 881250949, dates.hour_of_day, "long") == 15
    assert _one(spark, 881250949, lambda c: dates.hour_of_day(c, "Asia/Tokyo"), "long") == 0
    parts = {0: "night", 7: "morning", 12: "lunch", 17: "afternoon", 18: "evening", 23: "night"}
    for hour, part in parts.items():
        assert _one(spark, hour, dates.part_of_day, "int") == part


def test_days_of_the_nearest_second(spark):
    con = duckdb.connect()
    times = ["2024-01-01 23:59:59.4", "2024-01-01 23:59:59.5", "2024-01-01 23:59:58.5", "2024-01-01 23:59:59.6", "1969-12-31 23:59:59.5", "1969-12-30 01:00:00"]
    for time in times:
        value = dt.datetime.fromisoformat(time)
        day = con.execute("SELECT CAST(epoch(?::TIMESTAMP) AS BIGINT) // 86400", [time]).fetchall()[0][0]
        assert _one(spark, value, dates.day_number, "timestamp_ntz") == day
    assert _one(spark, None, dates.day_number, "timestamp_ntz") is None


def test_arrays(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    got = row.select(arrays.norm(a), arrays.cosine(a, b), arrays.distance(a, b), arrays.unit(a), arrays.unit(b)).first()
    assert list(got) == [5.0, None, 5.0, [0.6, 0.8], [0.0, 0.0]]
