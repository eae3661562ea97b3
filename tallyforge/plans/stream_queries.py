"""Streams over the driver's tables, run to the end of the data, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import dates, text
from tallyforge.operators import describe
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables, with_views
from tallyforge.session import fresh_path
from tallyforge.sources import delimited, messages, sinks
from tallyforge.streaming import jobs


def _stream(t: Tables, table: str) -> DataFrame:
    """A table as a file stream."""
    schema = t.read(table).schema
    return messages.stream(
        t.spark, "parquet", {"maxFilesPerTrigger": "1000", "pathGlobFilter": "*.parquet"}, schema, f"{t.sf_dir}/{table}*.parquet"
    )


# ------------------------------------------------------------------------ counting

_SPACE_SQL = """SELECT word, count(*) AS n FROM (
  SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
                     ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents) GROUP BY word"""


@query("STR-3 FN-2", r"""SELECT word, count(*) AS n FROM (
    SELECT unnest(string_split_regex(lower(text), '\W+')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def word_count(t: Tables) -> DataFrame:
    return jobs.word_counts(t.documents, "text", text.words)


@query("STR-3 FN-2", r"""SELECT word, count(*) AS n FROM (
    SELECT unnest(string_split_regex(lower(text), '\W+')) AS word FROM conversations) WHERE word <> '' GROUP BY word""")
def conversation_word_count(t: Tables) -> DataFrame:
    return jobs.word_counts(t.conversations, "text", text.words)


@query("FN-1 STR-2", _SPACE_SQL)
def space_word_count(t: Tables) -> DataFrame:
    return jobs.word_counts(t.documents, "text")


@query("STR-1 STR-2 STR-5 STR-6 STR-8 STR-9", _SPACE_SQL)
def streamed_word_count(t: Tables) -> DataFrame:
    """Final state of the running count, over several batches and a restart: the documents
    arrive in slices, two at first; the job ends, the others arrive, and it goes on from its
    checkpoint. A slice is written by as many tasks as read the documents, and a batch takes
    as many files, so neither waits for one task."""
    out, inbox = fresh_path(t.spark, "word-states"), fresh_path(t.spark, "word-inbox")
    docs = t.documents.select("doc_id", "text")
    slices = 4
    number = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(slices)), F.lit(0))
    files = max(docs.rdd.getNumPartitions(), t.spark.sparkContext.defaultParallelism)
    for start in range(0, slices, 2):
        arrived = docs.where(number.between(start, start + 1))
        arrived.repartition(2 * files, F.xxhash64("doc_id", "text")).write.mode("append").parquet(inbox)
        lines = messages.stream(t.spark, "parquet", {"maxFilesPerTrigger": str(files)}, docs.schema, inbox)
        jobs.drain(jobs.write_states(jobs.word_counts(lines, "text"), out, f"{out}-checkpoint"))
    return jobs.last_state(t.spark, out)


@query(
    "STR-4 STR-5",
    "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS state FROM events GROUP BY user_id",
)
def streamed_user_state(t: Tables) -> DataFrame:
    out = fresh_path(t.spark, "user-state")
    table = sinks.KeyedTable(t.spark, out, "key", ["state"])
    state = jobs.keyed_state(_stream(t, "events"), "user_id", jobs.add_to_state, combine=lambda values: values.sum())
    query_ = jobs.start(
        state, lambda batch, i: table.upsert(batch, i, F.col("state")), f"{out}-checkpoint", "update"
    )
    jobs.drain(query_)
    return table.read()


def _greatest_so_far(values: list[int], old: int | None) -> int:
    """Greatest value so far: no sum of values would give it."""
    return max(values if old is None else [*values, old])


@query("STR-4", "SELECT CAST(user_id AS VARCHAR) AS key, max(event_id) AS state FROM events GROUP BY user_id")
def streamed_last_event(t: Tables) -> DataFrame:
    """A state that is no sum."""
    out = fresh_path(t.spark, "last-event")
    table = sinks.KeyedTable(t.spark, out, "key", ["state"])
    state = jobs.keyed_state(_stream(t, "events"), "user_id", _greatest_so_far, F.col("event_id"), combine=lambda values: values.max())
    jobs.drain(
        jobs.start(state, lambda batch, i: table.upsert(batch, i, F.col("state")), f"{out}-checkpoint", "update")
    )
    return table.read()


# ------------------------------------------------------------------------ messages


@query(
    "SRC-15 STR-7",
    with_views(
        "messages",
        """SELECT topic, partition, min("offset") AS from_offset, max("offset") + 1 AS until_offset, count(*) AS n
           FROM messages GROUP BY topic, partition""",
    ),
)
def offset_ranges(t: Tables) -> DataFrame:
    return messages.offset_ranges(t.messages)


@query(
    "SRC-16",
    with_views(
        "messages",
        """SELECT partition, "offset", key, value FROM messages
           WHERE "offset" >= CASE partition WHEN 1 THEN 500 WHEN 3 THEN 250 ELSE 0 END""",
    ),
)
def replay_from_offsets(t: Tables) -> DataFrame:
    return messages.from_offsets(t.messages, {1: 500, 3: 250}).select("partition", "offset", "key", "value")


@query(
    "SRC-17",
    with_views(
        "messages",
        """SELECT partition, "offset", key, value FROM messages
           WHERE (partition = 0 AND "offset" >= 100) OR (partition = 2 AND "offset" >= 300)""",
    ),
)
def replay_pinned_partitions(t: Tables) -> DataFrame:
    return messages.pinned(t.messages, {0: 100, 2: 300}).select("partition", "offset", "key", "value")


def _log_messages(events: DataFrame) -> DataFrame:
    """Events as JSON log rows keyed by user; one in fifty is broken."""
    info = F.create_map(F.lit("content"), F.col("props"), F.lit("level"), F.col("event_type"))
    row = F.struct(
        F.col("user_id").cast("string").alias("rowKey"), F.create_map(F.lit("loginfo"), info).alias("rowData")
    )
    value = F.when(F.col("event_id") % 50 == 0, F.lit('{"rowKey": ')).otherwise(F.to_json(row))
    return events.select(
        F.lit("logs").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.lit(None).cast("string").alias("key"), value.alias("value"),
    )


_LAST_LOG_SQL = """SELECT CAST(user_id AS VARCHAR) AS row_key, arg_max(props, event_id) AS content,
    arg_max(event_type, event_id) AS level FROM events WHERE event_id % 50 <> 0 GROUP BY user_id"""


@query("SNK-3 SRC-14", _LAST_LOG_SQL)
def last_log_per_user(t: Tables) -> DataFrame:
    good, _ = messages.good_and_bad(messages.parsed_rows(_log_messages(t.events)))
    rows = messages.log_columns(good)
    return sinks.latest_per_key(rows, "row_key", F.struct("offset", "partition"), ["content", "level"]).drop("version")


@query("STR-10 SNK-3 SRC-14 STR-6", _LAST_LOG_SQL)
def streamed_log_table(t: Tables) -> DataFrame:
    out = fresh_path(t.spark, "log-table")
    table = sinks.KeyedTable(t.spark, out, "row_key", ["content", "level"])
    jobs.drain(jobs.log_upserts(_log_messages(_stream(t, "events")), table, f"{out}-rejects", f"{out}-checkpoint"))
    return table.read()


@query("SRC-14", "SELECT event_id AS \"offset\" FROM events WHERE event_id % 50 = 0")
def broken_messages(t: Tables) -> DataFrame:
    _, bad = messages.good_and_bad(messages.parsed_rows(_log_messages(t.events)))
    return bad.select("offset")


# ------------------------------------------------- files: write with a sink, read back


@query("SRC-1 SNK-2", "SELECT count(*) AS n, CAST(sum(length(replace(text, chr(10), ' '))) AS BIGINT) AS chars FROM documents")
def text_lines_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "lines")
    one_line = F.regexp_replace("text", "\n", " ")
    t.documents.select(one_line).write.text(path)
    lines = delimited.read_lines(t.spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))


@query(
    "SRC-2 SNK-2",
    with_views("users", "SELECT user_id, CAST(user_id % 60 AS INTEGER) AS age, occupation, zip FROM users"),
)
def users_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "users")
    rows = t.users.select("user_id", F.col("user_id") % 60, F.lit("F"), "occupation", "zip")
    sinks.write_delimited(rows, path, "|")
    return delimited.read_users(t.spark, path).select("user_id", "age", "occupation", "zip")


@query("SRC-3 SNK-2", with_views("ratings", "SELECT user_id, item_id, rating, ts FROM ratings"))
def ratings_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "ratings")
    sinks.write_delimited(t.ratings.select("user_id", "item_id", F.col("rating").cast("int"), "ts"), path, "\t")
    return delimited.read_ratings(t.spark, path, with_time=True)


@query(
    "SRC-4 PRJ-11 SNK-2",
    with_views(
        "items",
        """SELECT item_id, raw_title || ' é' AS title, release, CAST((p_size & 1) + ((p_size >> 1) & 1) + ((p_size >> 2) & 1)
           + ((p_size >> 3) & 1) + ((p_size >> 4) & 1) + ((p_size >> 5) & 1) AS BIGINT) AS tags FROM items""",
    ),
)
def items_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "items")
    flags = [F.col("flags")[i] if i < 6 else F.lit(0) for i in range(delimited.N_GENRES)]
    title = F.concat("raw_title", F.lit(" é"))
    rows = t.items.select("item_id", title, "release", F.lit(""), F.lit(""), *[f.alias(f"f{i}") for i, f in enumerate(flags)])
    sinks.write_delimited(rows, path, "|", encoding="ISO-8859-1", emptyValue="")
    back = delimited.read_items(t.spark, path)
    return back.select("item_id", "title", "release", F.aggregate("flags", F.lit(0), lambda a, x: a + x).cast("long").alias("tags"))


@query(
    "SRC-5",
    """SELECT CAST(row_number() OVER (ORDER BY p_type) - 1 AS BIGINT) AS idx, p_type AS name
       FROM (SELECT DISTINCT p_type FROM part)""",
)
def dictionary_read_back(t: Tables) -> DataFrame:
    from tallyforge.operators.encode import dictionary

    path = fresh_path(t.spark, "kinds")
    kinds = dictionary(t.items, "kind").select(F.concat_ws("|", "value", "idx").alias("line"))
    kinds.unionByName(t.spark.createDataFrame([("",)], "line string")).write.text(path)
    return delimited.read_dictionary(t.spark, path)


@query(
    "SRC-6 PRJ-6 PRJ-8",
    """SELECT CAST(quality AS DOUBLE) AS label, lang AS category,
       CASE WHEN n_chars % 7 = 0 THEN 0.0 ELSE CAST(n_chars AS DOUBLE) END AS chars, CAST(toxic AS DOUBLE) AS toxic
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
)
def labelled_rows_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "labelled")
    docs = t.documents.select("doc_id", "lang", "n_chars")
    chars = F.when(F.col("n_chars") % 7 == 0, "?").otherwise(F.col("n_chars").cast("string"))
    fields = [F.lit("url"), F.col("doc_id"), F.lit("body"), F.col("lang"), chars, F.col("toxic"), F.col("quality")]
    quoted = [F.concat(F.lit('"'), f.cast("string"), F.lit('"')) for f in fields]
    t.labels.join(docs, "doc_id").select(F.concat_ws("\t", *quoted)).write.text(path)
    back = delimited.read_labelled(t.spark, path)
    return back.select("label", "category", F.col("numbers")[0].alias("chars"), F.col("numbers")[1].alias("toxic"))


@query(
    "SRC-7",
    """SELECT l_returnflag AS season, CAST(l_linenumber AS VARCHAR) AS hr, round(sum(l_discount), 2) AS temp,
       round(sum(l_extendedprice), 1) AS cnt, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def hourly_rows_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "hourly")
    rows = t.lineitem.select(
        "l_orderkey", F.lit("2011-01-01"), "l_returnflag", F.lit("0").alias("yr"), F.lit("1").alias("mnth"), "l_linenumber",
        F.lit("0").alias("holiday"), F.lit("6").alias("weekday"), F.lit("0").alias("workingday"), "l_linestatus",
        "l_discount", F.col("l_discount").alias("atemp"), "l_tax", F.col("l_tax").alias("windspeed"),
        F.lit(0).alias("casual"), F.lit(0).alias("registered"), "l_extendedprice",
    )
    sinks.write_delimited(rows, path, ",")
    return delimited.read_hourly(t.spark, path).groupBy("season", "hr").agg(
        F.round(F.sum("temp"), 2).alias("temp"), F.round(F.sum("cnt"), 1).alias("cnt"), F.count(F.lit(1)).alias("n")
    )


@query(
    "SRC-8 AGG-16",
    with_views(
        "purchases",
        """SELECT count(*) AS purchases, count(DISTINCT "user") AS buyers, round(sum(price), 2) AS revenue FROM purchases""",
    ),
)
def purchases_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "purchases")
    sinks.write_delimited(t.purchases, path, ",")
    back = delimited.read_purchases(t.spark, path)
    return back.agg(
        F.count(F.lit(1)).alias("purchases"), F.count_distinct("user").alias("buyers"), F.round(F.sum("price"), 2).alias("revenue")
    )


@query(
    "SRC-9 SNK-2",
    """SELECT CAST(label AS BIGINT) AS id, round(sum(embedding[1]::DOUBLE), 5) AS x, round(sum(embedding[64]::DOUBLE), 5) AS y
       FROM embeddings GROUP BY 1""",
)
def points_read_back(t: Tables) -> DataFrame:
    """All 64 positions are written; the typed reader takes three of the 65 columns."""
    path = fresh_path(t.spark, "points")
    names = [f"x{i}" for i in range(64)]
    flat = sinks.spread(t.vectors.select(F.col("label").cast("long").alias("id"), "features"), "features", names)
    sinks.write_delimited(flat, path, " ")
    schema = "id long, " + ", ".join(f"{n} double" for n in names)
    back = delimited.read_columns(t.spark, path, schema, " ").select("id", "x0", "x63")
    return back.groupBy("id").agg(F.round(F.sum("x0"), 5).alias("x"), F.round(F.sum("x63"), 5).alias("y"))


@query(
    "SNK-1",
    "SELECT CAST(label AS BIGINT) AS label, count(*) AS n FROM embeddings GROUP BY 1",
)
def single_file_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "single")
    counts = describe.count_by(t.vectors.select(F.col("label").cast("long").alias("label")), "label")
    sinks.write_single(counts, path)
    return delimited.read_columns(t.spark, path, "label long, n long")


@query(
    "FN-9 STR-7",
    """SELECT CAST(epoch(ts) AS BIGINT) // 86400 AS day, count(*) AS n, min(event_id) AS from_offset,
       max(event_id) + 1 AS until_offset FROM events GROUP BY 1""",
)
def daily_offset_ranges(t: Tables) -> DataFrame:
    day = dates.day_number(F.col("ts"))
    return t.events.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_id").alias("from_offset"),
        (F.max("event_id") + 1).alias("until_offset"),
    )
