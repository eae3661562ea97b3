import json

from pyspark.sql import functions as F

from tallyforge.functions import text
from tallyforge.sources import messages, sinks
from tallyforge.plans import stream_queries
from tallyforge.plans.views import Tables
from tallyforge.streaming import jobs


def _add(folder, name, lines):
    folder.mkdir(exist_ok=True)
    tmp = folder / f".{name}"
    tmp.write_text("\n".join(lines) + "\n")
    tmp.rename(folder / name)


def _lines(spark, folder):
    return messages.stream(spark, "text", {"maxFilesPerTrigger": "1"}, "value string", str(folder))


def test_counts_go_on_after_a_restart(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    _add(src, "1.txt", ["a b a", "b  c "])

    def run():
        query = jobs.write_states(jobs.word_counts(_lines(spark, src)), out, ckpt)
        assert jobs.drain(query)
        return {r.word: r.n for r in jobs.last_state(spark, out).collect()}, query

    assert run()[0] == {"a": 2, "b": 2, "": 1, "c": 1}
    _add(src, "2.txt", ["c a"])
    counts, query = run()
    assert counts == {"a": 3, "b": 2, "": 1, "c": 2}
    assert [b for b, _, _ in jobs.progress_offsets(query)][-1] >= 1
    batch = {r.word: r.n for r in jobs.word_counts(spark.read.text(str(src))).collect()}
    assert batch == counts
    clean = {r.word: r.n for r in jobs.word_counts(spark.read.text(str(src)), tokens=text.words).collect()}
    assert clean == {"a": 3, "b": 2, "c": 2}


def test_key_state_over_batches(spark, tmp_path):
    src = tmp_path / "in"
    table = sinks.KeyedTable(spark, str(tmp_path / "out"), "key", ["state"])
    for name, lines in (("1.txt", ["x", "x", "y"]), ("2.txt", ["x"])):
        _add(src, name, lines)
        state = jobs.keyed_state(_lines(spark, src), "value", jobs.add_to_state)
        query = jobs.start(state, lambda b, i: table.upsert(b, i, F.col("state")), str(tmp_path / "ckpt"), "update")
        assert jobs.drain(query)
    assert {r.key: r.state for r in table.read().collect()} == {"x": 3, "y": 1}


def test_state_sees_values_and_source_is_read_once(spark, tmp_path):
    src = tmp_path / "in"
    _add(src, "1.txt", ["x 5", "x 2", "y 7"])
    _add(src, "2.txt", ["x 3", "y 9"])
    rows = _lines(spark, src).select(F.split("value", " ")[0].alias("k"), F.split("value", " ")[1].alias("v"))
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    rows = rows.mapInPandas(counted, rows.schema)
    state = jobs.keyed_state(rows, "k", lambda values, old: max(values + ([] if old is None else [old])), F.col("v"))
    table = sinks.KeyedTable(spark, str(tmp_path / "out"), "key", ["state"])
    jobs.drain(jobs.start(state, lambda b, i: table.upsert(b, i, F.col("state")), str(tmp_path / "c"), "update"))
    assert {r.key: r.state for r in table.read().collect()} == {"x": 5, "y": 9}
    assert read.value == 5


def test_values_of_a_hot_key_are_never_one_list(spark, tmp_path):
    src = tmp_path / "in"
    _add(src, "1.txt", [f"x {i}" for i in range(500)])
    rows = _lines(spark, src).select(F.split("value", " ")[0].alias("k"), F.split("value", " ")[1].alias("v"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "50")
    try:
        longest = jobs.keyed_state(rows, "k", lambda values, old: max(len(values), old or 0), F.col("v"))
        table = sinks.KeyedTable(spark, str(tmp_path / "out"), "key", ["state"])
        jobs.drain(jobs.start(longest, lambda b, i: table.upsert(b, i, F.col("state")), str(tmp_path / "c"), "update"))
    finally:
        spark.conf.set(name, before)
    assert 0 < table.read().first().state <= 50


def test_new_checkpoint_keeps_old_batches(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), "k", ["v"])
    for run, v, o in (("a", "old", 1), ("b", "new", 2)):
        batch = spark.createDataFrame([("x", v, o), (run, v, o)], "k string, v string, o long")
        table.upsert(batch, 0, F.col("o"), run)
    assert {r.k: r.v for r in table.read().collect()} == {"x": "new", "a": "old", "b": "new"}


def _message(key, content, level="INFO"):
    return json.dumps({"rowKey": key, "rowData": {"loginfo": {"content": content, "level": level}}})


def test_log_table(spark, tmp_path):
    src, ckpt, rejects = tmp_path / "in", str(tmp_path / "ckpt"), str(tmp_path / "bad")
    table = sinks.KeyedTable(spark, str(tmp_path / "table"), "row_key", ["content", "level"])

    def run(lines, name):
        _add(src, name, lines)
        stream = _lines(spark, src).select(
            F.lit(0).alias("partition"), F.get_json_object("value", "$.o").cast("long").alias("offset"),
            F.get_json_object("value", "$.v").alias("value"),
        )
        assert jobs.drain(jobs.log_upserts(stream, table, rejects, ckpt))

    def wrap(offset, value):
        return json.dumps({"o": offset, "v": value})

    run([wrap(1, _message("a", "old")), wrap(2, _message("a", "new")), wrap(3, _message("b", "one")), wrap(4, '{"rowKey"')], "1.txt")
    assert {r.row_key: r.content for r in table.read().collect()} == {"a": "new", "b": "one"}
    run([wrap(5, _message("b", "two", "WARN"))], "2.txt")
    assert {r.row_key: (r.content, r.level) for r in table.read().collect()} == {"a": ("new", "INFO"), "b": ("two", "WARN")}
    assert spark.read.parquet(rejects).count() == 1
    before = sorted(table.read().collect())
    batch = spark.createDataFrame([("b", "two", "WARN", 5)], "row_key string, content string, level string, o long")
    table.upsert(batch, 1, F.struct(F.col("o").alias("offset"), F.lit(0).alias("partition")))
    assert sorted(table.read().collect()) == before
    assert sorted(table.compact(str(tmp_path / "compact")).read().collect()) == before


def test_settings():
    assert jobs.trigger(3) == {"processingTime": "3 seconds"}
    assert jobs.cap_per_trigger(3000, 4, 1) == {"maxOffsetsPerTrigger": "12000"}


def test_rate_source_and_stop(spark, tmp_path):
    stream = messages.stream(spark, "rate", {"rowsPerSecond": "50"})
    seen = []
    query = jobs.start(stream, lambda b, i: seen.append(b.count()), str(tmp_path / "c"), seconds=1)
    assert not jobs.drain(query, timeout=4)
    assert seen and not query.isActive


def test_a_slice_of_documents_is_many_files(spark, tmp_path, monkeypatch):
    """Each run of the word count has two batches, and no batch waits for a single task's file."""
    spark.createDataFrame([(i, f"w{i % 7} x") for i in range(2000)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(stream_queries, "fresh_path", lambda _, label: str(tmp_path / label))
    got = {r.word: r.n for r in stream_queries.streamed_word_count(Tables(spark, str(tmp_path))).collect()}
    assert got == {"x": 2000} | {f"w{i}": len(range(i, 2000, 7)) for i in range(7)}
    assert sorted(p.name for p in (tmp_path / "word-states").glob("batch_id=*")) == [f"batch_id={i}" for i in range(4)]
    assert len(list((tmp_path / "word-inbox").glob("*.parquet"))) >= 4 * spark.sparkContext.defaultParallelism
