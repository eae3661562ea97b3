"""``corpus_pipeline`` against its stages done by hand."""

import hashlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from tallyforge.llm import bpe, decontaminate, pii, quality_rules, simhash  # noqa: E402
from tallyforge.llm.queries import vocabulary  # noqa: E402

DATA = "/root/testdata/sf0.001"


def brute_groups(prints):
    """Least ``doc_id`` of each group of all pairs within four bits."""
    top = {d: d for d in prints}
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4 and top[a] != top[b]:
                low, high = sorted((top[a], top[b]))
                top = {d: low if t == high else t for d, t in top.items()}
    return top


def test_stages_are_declared():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "simhash near-dedup",
        "benchmark decontamination",
        "pii",
        "bpe",
    ]


def test_run_equals_its_parts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, DATA).select("doc_id").collect()}
    seen, first = {}, set()
    for d in sorted(good):  # exact copies at least: the least id stays
        seen.setdefault(simhash.fingerprint(rows[d]["text"]), d)
        first.add(seen[simhash.fingerprint(rows[d]["text"])])
    assert set(got) <= first
    leaked = {d for d in first if any(b in rows[d]["text"] for b in bench)}
    assert leaked and not leaked & set(got)
    model = pii.fit(docs)
    codec = bpe.decoder(vocabulary("byte_bpe_50k.json"))
    for d, row in got.items():
        text = codec.decode(bytes(row["ids"]))
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert not pii.base_spans(text)
        if not pii.spans_of(rows[d]["text"], model)[1]:
            assert text == rows[d]["text"]


def test_stages_keep_columns_and_take_odd_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    more = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", "x", 0)], docs.schema)
    given = docs.limit(5).union(more)
    for frame in (given, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, DATA).columns == docs.columns, name
            stage(spark, frame, DATA).count()


def leaked(text, item, others):
    """Plain template matching of one text and one item of eight tokens or more, next to
    the other items."""
    ours, theirs = decontaminate.Templates([text]), decontaminate.Templates([item])
    width = decontaminate.WIDTH
    windows = [(int(p), *theirs.template(int(p), width)) for p in theirs.windows(width)[0]]
    at = {}
    for opened in (False, True):
        for place in map(int, ours.windows(width, opened)[0]):
            shown, slots = ours.template(place, width, opened)
            at.setdefault(shown, []).append((place, slots))
    found = {}
    for place, shown, slots in windows:
        for where, values in at.get(shown, []):
            places, pairs = found.setdefault(where - place, (set(), set()))
            places.add(place)
            pairs.update(zip(slots, values, strict=True))
    matched = set().union(*(p for p, s in found.values() if len({a for a, _ in s}) == len(s)))
    common = set()
    for other in map(decontaminate.Templates, ([t] for t in others)):
        common |= {other.template(int(p), width)[0] for p in other.windows(width)[0]}
    own = {place for place, shown, _ in windows if shown not in common}
    if len(matched) < min(2, len(windows)) or own and not matched & own:
        return False
    return 100 * len(matched) >= decontaminate.SHARE_PERCENT * len(windows) or len(matched) >= decontaminate.ENOUGH


def test_rows_equal_brute_force(spark):
    import duckdb

    documents = spark.read.parquet(f"{DATA}/documents.parquet").toPandas()
    bench = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    con = duckdb.connect()
    con.register("documents", documents)
    good = {d for d, kept in con.sql(f"SELECT doc_id, kept FROM ({quality_rules.sql()})").fetchall() if kept}
    texts = {d: t for d, t in zip(documents.doc_id, documents.text, strict=True) if d in good}
    groups = brute_groups({d: simhash.fingerprint(t) for d, t in texts.items()})
    want = {d for d in set(groups.values()) if not any(leaked(texts[d], t, bench[:i] + bench[i + 1 :]) for i, t in enumerate(bench))}
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, DATA).collect()]
    assert sorted(got) == sorted(want) and 0 < len(want) < len(good)
