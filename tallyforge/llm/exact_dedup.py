"""Exact deduplication by a stream with keyed state on disk. Built-in functions only.

Documents are read as a stream of Parquet files. The state, kept by RocksDB without any
expiry, has one entry per digest: how many rows had it, and the row that stays, as its
stable identifier and the place of its content (file and row). Each batch sends out the
entries it changed, to a folder of its own, so a replayed batch overwrites what it wrote.
The same ``state`` folder given again goes on where the stream ended.

A digest that was met more than once is a hit. Its rows are compared byte by byte with the
content at the place that the state holds: equal texts of a task are one row before they
travel, so a group of any size is spread. Texts that differ from the retained one under the
same digest go through the same stream again with the next digest (``level`` + 1), so a
weak digest costs time and never a wrong group.

Of equal texts the row with the greatest identifier stays; of rows with that identifier the
one that stands last (by file and row), so exactly one row of a group is kept. Null text
counts as empty, null identifiers come before all others. Repeated rows are copies like any
other. An empty table has no rows. Other columns of the table, whatever their names, are
not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.joins import lookup_join
from tallyforge.session import fresh_path, written

Digest = Callable[[Column, int], Column]
#: Source bytes of one batch: a batch costs a commit of every state store, so few large ones.
PER_BATCH = 1 << 38
#: Memory of all state stores of an executor together, in MB; the rest is on its disk.
STATE_MB = 256
_STREAM = "spark.sql.streaming."
_SETTINGS = {
    _STREAM + "stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STREAM + "stateStore.rocksdb.boundedMemoryUsage": "true",
    _STREAM + "stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MB),
    # space reserved ahead is megabytes for each store, whatever it holds
    _STREAM + "stateStore.rocksdb.allowFAllocate": "false",
    _STREAM + "noDataMicroBatches.enabled": "false",
}


def sha256(text: Column, level: int) -> Column:
    """The digest of a text; the next levels differ in what stands before it."""
    # never null, and said so: else each join computes it once more to filter nulls
    return F.coalesce(F.sha2(text if level == 0 else F.concat(F.lit(f"{level}:"), text), 256), F.lit(""))


def _rows(source: DataFrame, key: str, text: str, normalise: Callable[[Column], Column], digest: Digest, level: int) -> DataFrame:
    """``id``, ``body``, ``digest`` and the place of every row."""
    place = source.metadataColumn("_metadata")
    body = normalise(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = source.select(
        F.col(f"`{key}`").alias("id"), body.alias("body"),
        place["file_path"].alias("file"), place["row_index"].alias("at"),
    )
    return rows.withColumn("digest", digest(F.col("body"), level))


def _consume(spark: SparkSession, rows: DataFrame, state: str) -> None:
    """Run the stream over what has arrived since the last time."""
    entries = rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "file", "at")).alias("keeper")
    )

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/entries/batch={number}")

    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    try:
        for k, v in _SETTINGS.items():
            spark.conf.set(k, v)
        job = (
            entries.writeStream.outputMode("update").option("checkpointLocation", f"{state}/checkpoint")
            .trigger(availableNow=True).foreachBatch(put).start()
        )
        job.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _entries(spark: SparkSession, rows: DataFrame, state: str) -> DataFrame:
    """The last entry of each digest: counts only grow."""
    schema = T.StructType(
        [
            T.StructField("digest", rows.schema["digest"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("keeper", T.StructType([rows.schema[c] for c in ("id", "file", "at")])),
        ]
    )
    put_out = spark.read.schema(schema).parquet(f"{state}/entries")
    return put_out.groupBy("digest").agg(F.max("n").alias("n"), F.max_by("keeper", "n").alias("keeper"))


def exact_duplicates(
    spark: SparkSession,
    path: str,
    state: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = lambda c: c,
    digest: Digest = sha256,
    per_batch: int = PER_BATCH,
    level: int = 0,
) -> DataFrame:
    """One row per document of the Parquet table at ``path``: ``key``, ``keep_id``,
    ``group_size``, ``kept``, ``body_digest`` (``digest`` of the first level) and the
    ``file`` and row (``at``) it stands in.

    ``state`` is the folder of the stream's checkpoint and entries in a place that all
    executors reach; a new one in the session's shared folder if it is left out.
    """
    state = state or fresh_path(spark, f"exact-dedup-{level}")
    given = spark.read.parquet(path)
    wanted = T.StructType([given.schema[c] for c in dict.fromkeys((key, text))])
    # a stream wants a folder or a pattern; a single file is a pattern that only it matches
    single = _status(spark, path, lambda files, at: files.getFileStatus(at).isFile())
    arriving = spark.readStream.schema(wanted).option("maxBytesPerTrigger", str(per_batch))
    arriving = arriving.parquet(f"{path[:-1]}[{path[-1]}]" if single else path)
    _consume(spark, _rows(arriving, key, text, normalise, digest, level), state)
    rows = _rows(given, key, text, normalise, digest, level)
    if not _status(spark, f"{state}/entries", lambda files, at: files.exists(at)):  # no batch was ever put out
        return _named(rows.where(F.lit(False)).select("id", F.col("id").alias("keep_id"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("kept"), "digest", "file", "at"), key)
    entries = written(_entries(spark, rows, state), f"entries-{level}")
    hits = lookup_join(rows, entries.where("n > 1"), "digest")
    content = hits.where((F.col("file") == F.col("keeper.file")) & (F.col("at") == F.col("keeper.at")))
    content = content.select("digest", F.col("body").alias("content"))
    texts = hits.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("copies"))
    other = texts.join(content, "digest").where("body <> content").select("digest", "body", "copies")
    other = written(other, f"other-texts-{level}")
    narrow = rows.select("id", "file", "at", "digest")
    if other.isEmpty():
        return _named(_resolved(narrow, entries), key)
    strangers = rows.join(other.drop("copies"), ["digest", "body"], "left_semi")
    again = fresh_path(spark, f"colliding-{level}")
    strangers.select(F.struct("id", "file", "at", "digest").alias("row"), "body").write.parquet(again)
    fewer = other.groupBy("digest").agg(F.sum("copies").alias("away"))
    entries = entries.join(fewer, "digest", "left").select("digest", (F.col("n") - F.coalesce("away", F.lit(0))).alias("n"), "keeper")
    here = narrow.join(spark.read.parquet(again).select("row.file", "row.at"), ["file", "at"], "left_anti")
    # rows are ordered by identifier first, so the greatest packed row is the one that stays
    rest = exact_duplicates(spark, again, None, "row", "body", lambda c: c, digest, per_batch, level + 1)
    rest = rest.select(
        F.col("row.id").alias("id"), F.col("keep_id.id").alias("keep_id"), F.col("group_size").alias("n"), "kept",
        F.col("row.digest").alias("digest"), F.col("row.file").alias("file"), F.col("row.at").alias("at"),
    )
    return _named(_resolved(here, entries).unionByName(rest), key)


def _status(spark: SparkSession, path: str, ask: Callable) -> bool:
    """What the file system of ``path`` says of it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return ask(at.getFileSystem(spark._jsc.hadoopConfiguration()), at)


def _resolved(narrow: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows next to the entry of their digest."""
    kept = (F.col("file") == F.col("keeper.file")) & (F.col("at") == F.col("keeper.at"))
    return narrow.join(entries, "digest").select("id", F.col("keeper.id").alias("keep_id"), "n", kept.alias("kept"), "digest", "file", "at")


def _named(found: DataFrame, key: str) -> DataFrame:
    return found.select(
        F.col("id").alias(key), "keep_id", F.col("n").alias("group_size"), "kept", F.col("digest").alias("body_digest"), "file", "at"
    )
