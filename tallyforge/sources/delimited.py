"""Delimited text with declared schemas; nothing is inferred and nothing is positional."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import text

USERS = "user_id long, age int, gender string, occupation string, zip string"
RATINGS = "user_id long, item_id long, rating double, ts long"
N_GENRES = 19
ITEMS = "item_id long, title string, release string, video_release string, url string, " + ", ".join(
    f"flag{i} int" for i in range(N_GENRES)
)
PURCHASES = "user string, product string, price double"
# The columns of an hourly rental file, in file order.
HOURLY = (
    "instant long, dteday string, season string, yr string, mnth string, hr string, holiday string, weekday string, "
    "workingday string, weathersit string, temp double, atemp double, hum double, windspeed double, "
    "casual double, registered double, cnt double"
)
HOURLY_CATEGORIES = ["season", "yr", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit"]
HOURLY_NUMBERS = ["temp", "atemp", "hum", "windspeed"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in ``value``."""
    return spark.read.text(path)


def read_columns(
    spark: SparkSession, path: str, schema: str, sep: str = ",", columns: Sequence[str] | None = None, **options: str
) -> DataFrame:
    """Delimited fields under a schema; only the named columns are parsed."""
    df = spark.read.options(**options).csv(path, schema=schema, sep=sep)
    return df.select(*columns) if columns else df


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_columns(spark, path, USERS, "|")


def read_ratings(spark: SparkSession, path: str, with_time: bool = False) -> DataFrame:
    names = ["user_id", "item_id", "rating"] + (["ts"] if with_time else [])
    return read_columns(spark, path, RATINGS, "\t", names)


def read_items(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Items with their indicator columns as one array; titles are not UTF-8."""
    df = read_columns(spark, path, ITEMS, "|", encoding=encoding, quote="")
    flags = F.array(*[f"flag{i}" for i in range(N_GENRES)])
    return df.select("item_id", "title", F.coalesce("release", F.lit("")).alias("release"), flags.alias("flags"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``name|index`` lines as ``(idx, name)``; blank lines are dropped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parts = F.split("value", r"\|")
    return lines.select(parts[1].cast("long").alias("idx"), parts[0].alias("name"))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Quoted tab-separated rows of any width: the last field is the label, the
    fourth the category, those between are numbers with ``?`` for missing."""
    fields = F.split(text.without_quotes(F.col("value")), "\t")
    rows = spark.read.text(path).where(F.col("value") != "").select(fields.alias("f"))
    numbers = F.slice("f", F.lit(5), F.size("f") - 5)
    return rows.select(
        F.element_at("f", -1).cast("double").alias("label"),
        F.col("f")[3].alias("category"),
        F.transform(numbers, text.number_or_zero).alias("numbers"),
    )


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return read_columns(spark, path, HOURLY)


def read_purchases(spark: SparkSession, path: str) -> DataFrame:
    return read_columns(spark, path, PURCHASES)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated ``x y``, as feature arrays."""
    df = read_columns(spark, path, "x double, y double", " ")
    return df.select(F.array("x", "y").alias("features"))


def read_centres(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated ``id x y``."""
    df = read_columns(spark, path, "id long, x double, y double", " ")
    return df.select("id", F.array("x", "y").alias("features"))


def from_rows(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """A small in-memory collection as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)
