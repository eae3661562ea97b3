"""Message sources: options for a broker, offset selection, JSON rows."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_SCHEMA = "rowKey string, rowData map<string, map<string, string>>"
MESSAGE_SCHEMA = "topic string, partition int, offset long, key string, value string"

Offsets = Mapping[str, Mapping[int, int]]


def _offsets_json(offsets: Offsets) -> str:
    return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in offsets.items()}, sort_keys=True)


def subscribe(servers: str, topics: list[str], starting: str | Offsets = "latest", per_trigger: int | None = None) -> dict:
    """Broker options: all partitions of the topics, from ``latest``, ``earliest`` or
    stated offsets (-1 latest, -2 earliest for a partition). ``per_trigger`` caps a batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting if isinstance(starting, str) else _offsets_json(starting),
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def assign(servers: str, offsets: Offsets) -> dict:
    """Broker options pinned to the given partitions and start offsets."""
    assigned = {t: sorted(parts) for t, parts in offsets.items()}
    return {
        "kafka.bootstrap.servers": servers,
        "assign": json.dumps(assigned, sort_keys=True),
        "startingOffsets": _offsets_json(offsets),
    }


def stream(spark: SparkSession, fmt: str, options: Mapping[str, str], schema=None, path: str | None = None) -> DataFrame:
    """A streaming source of any format, so that a broker and files are exchangeable."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decoded(df: DataFrame) -> DataFrame:
    """Broker records with key and value as text."""
    return df.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def from_offsets(messages: DataFrame, starts: Mapping[int, int]) -> DataFrame:
    """Replay all partitions; those named start at their offset, the others at 0."""
    others = ~F.col("partition").isin(list(starts)) & (F.col("offset") >= 0) if starts else F.col("offset") >= 0
    return messages.where(_at_or_after(starts, others)).where(F.col("offset") >= min([0, *starts.values()]))


def _at_or_after(starts: Mapping[int, int], rest: Column) -> Column:
    """One range of offsets per named partition, or ``rest``."""
    for partition, offset in starts.items():
        rest = rest | ((F.col("partition") == partition) & (F.col("offset") >= offset))
    return rest


def pinned(messages: DataFrame, starts: Mapping[int, int]) -> DataFrame:
    """Replay only the named partitions, each from its offset. The least offset is a filter
    of its own, which the scan gets too."""
    if not starts:
        return messages.where(F.lit(False))
    return messages.where(_at_or_after(starts, F.lit(False))).where(F.col("offset") >= min(starts.values()))


def offset_ranges(messages: DataFrame) -> DataFrame:
    """First offset and the one after the last, per partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("n"),
    )


def parsed_rows(messages: DataFrame, value: str | Column = "value") -> DataFrame:
    """Messages with ``row_key`` and ``row_data``; both null where the JSON is broken."""
    row = F.from_json(F.col(value) if isinstance(value, str) else value, ROW_SCHEMA, {"mode": "PERMISSIVE"})
    return messages.withColumn("__row", row).withColumns(
        {"row_key": F.col("__row.rowKey"), "row_data": F.col("__row.rowData")}
    ).drop("__row")


def good_and_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and those set aside because they have no key."""
    return parsed.where(F.col("row_key").isNotNull()), parsed.where(F.col("row_key").isNull())


def log_columns(rows: DataFrame) -> DataFrame:
    """The two log fields of each row; null where the message lacks them."""
    info = F.col("row_data")["loginfo"]
    return rows.withColumns({"content": info["content"], "level": info["level"]}).drop("row_data")
