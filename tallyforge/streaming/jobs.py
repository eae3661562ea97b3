"""Structured Streaming jobs.

Offsets, state and commits live in the checkpoint folder, so a restarted query goes
on where the last finished batch ended (a batch may run again; sinks are idempotent
per batch id).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyforge.functions import text
from tallyforge.sources import messages
from tallyforge.sources.sinks import KeyedTable

# Batch intervals in seconds, and the cap per partition and second.
INTERVALS = {"counts": 3, "receiver": 5, "logs": 1, "offsets": 1}
RATE_CAPS = {"logs": 3000, "offsets": 50000}


def trigger(seconds: int | None) -> dict[str, Any]:
    """Every ``seconds``; ``None`` works off what is there and stops."""
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def cap_per_trigger(rate: int, partitions: int, seconds: int) -> dict[str, str]:
    """A rate per partition and second as the broker's option per batch."""
    return {"maxOffsetsPerTrigger": str(rate * partitions * seconds)}


def start(
    df: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", seconds: int | None = None
) -> StreamingQuery:
    """Run ``action`` on every non-empty batch; a batch is computed once."""

    def act(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # the test for rows and the action read the same ones
        try:
            if not kept.isEmpty():
                action(kept, batch_id)
        finally:
            kept.unpersist()

    return (
        df.writeStream.foreachBatch(act)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(seconds))
        .start()
    )


def show(df: DataFrame, checkpoint: str, mode: str = "complete", seconds: int | None = 3, rows: int = 10) -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = df.writeStream.format("console").option("numRows", rows).outputMode(mode)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(seconds)).start()


def drain(query: StreamingQuery, timeout: float | None = None, grace: float = 30.0) -> bool:
    """Wait until the query has worked off its source and ended by itself.

    For endless sources ``timeout`` says when to let the running batch finish and stop; the
    result is then False. A batch still running after ``grace`` is interrupted and repeated
    at the next start.
    """
    if timeout is None:
        query.awaitTermination()
        return True
    ended = bool(query.awaitTermination(timeout))
    if not ended:
        deadline = time.monotonic() + grace
        while query.status["isTriggerActive"] and time.monotonic() < deadline:
            time.sleep(0.05)
        query.stop()
    return ended


def progress_offsets(query: StreamingQuery) -> list[tuple[int, Any, Any]]:
    """``(batch, start offset, end offset)`` of every recent batch."""
    return [
        (p["batchId"], s["startOffset"], s["endOffset"]) for p in query.recentProgress for s in p["sources"]
    ]


# ---- running counts


def word_counts(lines: DataFrame, column: str = "value", tokens: Callable[[Column], Column] = text.split_on_space) -> DataFrame:
    """Count per token; the same expression serves streams and batches.

    Counts are combined map-side. On a stream the state holds one row per distinct
    token for ever, as there is nothing to expire it by.
    """
    return lines.select(F.explode(tokens(F.col(column))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def write_states(counts: DataFrame, path: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Every batch writes the whole state to its own folder."""
    return start(
        counts,
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"),
        checkpoint, "complete", seconds,
    )


def last_state(spark: SparkSession, path: str) -> DataFrame:
    """The state after the newest batch; older folders are pruned."""
    states = spark.read.parquet(path)
    newest = states.select("batch_id").distinct().agg(F.max("batch_id")).first()[0]
    return states.where(F.col("batch_id") == newest).drop("batch_id")


# ---- arbitrary per-key state


def keyed_state(
    events: DataFrame,
    key: str,
    update: Callable[[list[Any], Any], Any],
    value: Column | None = None,
    kind: str = "long",
    combine: Callable[[pd.Series], Any] | None = None,
) -> DataFrame:
    """Per-key state ``update(new values, old state) -> new state`` over the column ``value``
    (1 for every row if there is none); values and state are of type ``kind``.

    ``update`` takes the Arrow frames of a key one after the other, each with the state
    after those before, so no list holds all values of a hot key. ``combine`` folds the values of a key
    per Arrow batch before the shuffle; give it where ``update`` allows that, as it lets a
    hot key cross as few rows.
    """
    given = F.lit(1) if value is None else value
    pairs = events.select(F.col(key).cast("string").alias("key"), given.cast(kind).alias("value"))

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.groupby("key", as_index=False, sort=False, dropna=False)["value"].agg(combine)

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = state.get[0] if state.exists else None
        for frame in frames:
            if len(frame):
                new = update(frame["value"].tolist(), new)
        state.update((new,))
        yield pd.DataFrame({"key": [k[0]], "state": [new]})

    if combine is not None:
        pairs = pairs.mapInPandas(fold, pairs.schema)
    return pairs.groupBy("key").applyInPandasWithState(
        step, f"key string, state {kind}", f"state {kind}", "update", GroupStateTimeout.NoTimeout
    )


def add_to_state(values: list[int], old: int | None) -> int:
    """Running total."""
    return sum(values) + (old or 0)


# ---- JSON log to keyed table


def log_upserts(stream: DataFrame, table: KeyedTable, rejects: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Parse JSON rows, keep the last per key, upsert; broken rows go to ``rejects``."""

    run = f"{crc32(checkpoint.encode()):08x}"

    def act(batch: DataFrame, batch_id: int) -> None:
        good, bad = messages.good_and_bad(messages.parsed_rows(batch))
        table.upsert(messages.log_columns(good), batch_id, F.struct("offset", "partition"), run)
        bad.write.mode("overwrite").parquet(f"{rejects}/run={run}/batch_id={batch_id}")

    return start(stream, act, checkpoint, "append", seconds)
