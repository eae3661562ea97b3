import os
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, connect  # noqa: E402

from tallyforge.llm import exact_dedup, hard_negatives, mining_queries, phrases  # noqa: E402


class Query:
    def __init__(self, name):
        self.build, self.sql = mining_queries.QUERIES[name], mining_queries.SQL[name]

    def __call__(self, spark, sf_dir):
        return self.build(spark, sf_dir)


@pytest.mark.parametrize("name", list(mining_queries.QUERIES))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(spark, name, Query(name), sf_dir, connect(sf_dir)) is None


# ---- phrases

TINY = {"burst": 2, "budget": 12, "words": 6}


def _plain_phrases(rows, least, top):
    """Collocations counted one by one."""
    f, n, out = Counter(), Counter(), []
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, 5):
                f.update((lang or "und", tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    found = {k: c for k, c in f.items() if c >= least and len(k[1]) > 1}
    for lang in n:
        kept = []
        for (own, words), a in found.items():
            if own != lang:
                continue
            inside = [
                c for (o, w), c in found.items()
                if o == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))
            ]
            if any(100 * c >= 80 * a for c in inside):
                continue
            score, k = min((2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
            kept.append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _found_phrases(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("limits", [{}, TINY])
def test_phrases_equal_plain_counts(spark, limits, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 7 if limits else phrases.CHUNK)
    monkeypatch.setattr(phrases, "HOT", 9 if limits else phrases.HOT)
    rng = np.random.default_rng(4)
    vocabulary = ["New", "york", "the", "aé", "of", "東京", "x-y", "Zed", "ok"]
    rows = []
    for i in range(120):
        words = [vocabulary[j] for j in rng.zipf(1.6, 30) % len(vocabulary)]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", "\n", "  "]) for w in words)
        rows.append((["en", "fr", None][i % 3], text))
    rows += [("en", None), ("en", ""), ("de", "only one"), ("en", "new york of the " * 50), *rows[:5]]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "lang string, text string, count int, size int, phrase int")
    got = _found_phrases(phrases.collocations(df.repartition(3), least=4, top=12, **limits))
    assert got and got == _plain_phrases(rows, 4, 12)


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(df).collect() == []
    lone = spark.createDataFrame([("en", None), (None, "a b c")], "lang string, text string")
    assert phrases.collocations(lone).collect() == []


def test_trie_takes_sorted_phrases_at_once():
    """Phrases of all first ids together give what one first id at a time gives, burst subtrees too."""
    rng, one, all_, want = np.random.default_rng(1), phrases.Trie(burst=3), phrases.Trie(burst=3), Counter()
    for _ in range(60):
        drawn = np.stack([rng.integers(1, 9, 12), rng.integers(0, 4, 12) << 2 * phrases.ID_BITS], axis=1)
        rows = np.unique(drawn, axis=0)
        counts = rng.integers(1, 5, len(rows))
        all_.extend(rows[:, 0], rows[:, 1], counts)
        for first in np.unique(rows[:, 0]):
            mine = rows[:, 0] == first
            one.add(int(first), rows[mine, 1], counts[mine])
        want.update({(int(f), int(k)): int(c) for (f, k), c in zip(rows, counts)})
    assert all_.root == one.root and all_.sizes == one.sizes and all_.entries == one.entries == len(want)
    of, keys, counts = all_.take(list(all_.root))
    assert dict(zip(zip(of.tolist(), keys.tolist()), counts.tolist())) == want


def test_trie_bursts_and_spills_whole_subtrees():
    rng, trie, want = np.random.default_rng(0), phrases.Trie(burst=3), Counter()
    for _ in range(40):
        first = int(rng.integers(1, 5))
        keys = np.unique(rng.integers(1, 6, 4) << 2 * phrases.ID_BITS | rng.integers(0, 9, 4))
        counts = rng.integers(1, 5, len(keys))
        trie.add(first, keys, counts)
        want.update({(first, int(k)): int(c) for k, c in zip(keys, counts)})
    assert any(node is not None for _, node in trie.root.values())
    assert trie.entries == len(want) == sum(trie.sizes.values())
    largest = trie.largest(0.3)
    got = {}
    for firsts in (largest, [f for f in list(trie.root) if f not in largest]):
        of, keys, counts = trie.take(firsts)
        assert set(of.tolist()) == set(firsts)
        got |= {(int(f), int(k)): int(c) for f, k, c in zip(of, keys, counts)}
    assert got == want and trie.entries == 0


# ---- exact duplicates


def _documents(spark, tmp_path, rows, name="docs", schema="doc_id long, text string"):
    path = f"{tmp_path}/{name}"
    spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(path)
    return path


def _check_copies(rows, found):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["keep_id"] if r["keep_id"] is not None else -1, r["group_size"]) for r in found)
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(-1 if i is None else i, -1 if keep is None else keep, len(ids)) for i in ids]
    assert got == sorted(want)
    assert sum(r["kept"] for r in found) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "x" * 300_000), (7, "x" * 300_000), (7, "a"), (3, "a"), (None, "b"), (None, "q"), (9, "A")]


@pytest.mark.parametrize("places", [None, 1, 3])
def test_exact_duplicates(spark, tmp_path, places):
    def weak(text, level):
        return F.crc32(F.concat(F.lit(f"{level}"), text)) % places

    path = _documents(spark, tmp_path, ROWS)
    found = exact_dedup.exact_duplicates(spark, path, **({} if places is None else {"digest": weak})).collect()
    _check_copies(ROWS, found)


def test_exact_duplicates_go_on_with_their_state(spark, tmp_path):
    path, state = _documents(spark, tmp_path, ROWS), f"{tmp_path}/state"
    exact_dedup.exact_duplicates(spark, path, state).collect()
    more = [(20, "a"), (0, "b"), (21, "new"), (22, None)]
    _documents(spark, tmp_path, more)
    found = exact_dedup.exact_duplicates(spark, path, state, per_batch=1).collect()  # a file a batch
    _check_copies(ROWS + more, found)
    assert len([x for x in os.listdir(f"{state}/entries") if x.startswith("batch=")]) > 1
    _check_copies(ROWS + more, exact_dedup.exact_duplicates(spark, path, state).collect())  # nothing new


def test_exact_duplicates_of_odd_tables(spark, tmp_path):
    empty = f"{tmp_path}/empty"
    spark.createDataFrame([], "doc_id long, text string").coalesce(1).write.parquet(empty)
    assert exact_dedup.exact_duplicates(spark, empty).collect() == []
    rows = [(1, "a", 1, "x", 2, 3), (2, "a", 1, "y", 2, 3)]
    path = _documents(spark, tmp_path, rows, "odd", "doc_id long, text string, id int, digest string, n int, _metadata int")
    _check_copies([(1, "a"), (2, "a")], exact_dedup.exact_duplicates(spark, path).collect())
    upper = exact_dedup.exact_duplicates(spark, _documents(spark, tmp_path, ROWS, "up"), normalise=F.lower).collect()
    _check_copies([(i, t and t.lower()) for i, t in ROWS], upper)


# ---- hard negatives


def _plain_negatives(rows, every, k_pos, k_neg):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [int(np.floor(256 * x)) for x in v])
        kept[i] = min(kept.get(i, row), row)

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-dot(v, w), i, other) for i, (other, w) in kept.items() if i != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:k_pos]:
            near = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:k_neg]
            out += [(a, pid, r, i, -p, -s) for r, (s, i, _) in enumerate(near, 1)]
    return sorted(out)


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<double>, label int, id int, score int")


@pytest.mark.parametrize("sizes", [{}, {"block": 20, "group": 3}])
def test_hard_negatives_equal_all_pairs(spark, sizes):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4, 6))
    rows = [(i, (centres[i % 4] + rng.normal(size=6)).round(1).tolist(), int(rng.integers(0, 4))) for i in range(150)]
    rows += [(200 + i, rows[0][1], i % 2) for i in range(40)]  # one vector, many times
    rows += [(300, None, 1), (301, [1.0, None], 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 2), (304, [1.0] * 6, None)]
    rows += [(None, [1.0] * 6, 1), (305, [1.0, 2.0], 1), (310, [], 2), (320, [0.0] * 6, 3), rows[10], (10, [9.0] * 6, 0)]
    found = hard_negatives.mine(_vectors(spark, rows), F.col("id") % 10 == 0, positives=3, negatives=4, **sizes)
    want = _plain_negatives(rows, 10, 3, 4)
    assert want and sorted(map(tuple, found.collect())) == want


def test_hard_negatives_of_odd_tables(spark):
    assert hard_negatives.mine(_vectors(spark, []), F.col("id") % 10 == 0).collect() == []
    alone = [(0, [1.0], 1), (1, [2.0], 2)]
    assert hard_negatives.mine(_vectors(spark, alone), F.col("id") % 10 == 0).collect() == []
    huge = [(0, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [1e30, 0.0], 2), (3, [3e6, 0.0], 2)]
    found = hard_negatives.mine(_vectors(spark, huge), F.col("id") == 0).collect()
    assert all(r.positive_score == 2**63 - 1 for r in found)


def test_threshold_stops_before_everything_is_read():
    rng = np.random.default_rng(1)
    rows = np.zeros((5000, 8))
    rows[:, 0] = rng.permutation(5000)
    rows[:, 1:] = rng.integers(0, 3, (5000, 7))
    lists = hard_negatives.Lists(rows, np.arange(5000))
    for anchor in (np.array([3.0, 1, 0, 0, 1, 0, 0, 2]), np.array([-3.0, 1, 0, 0, -1, 0, 0, 2])):
        read = []
        steps = hard_negatives.Lists.read

        class Watched(hard_negatives.Lists):
            def read(self, a):
                for step in steps(self, a):
                    read.append(len(step[0]))
                    yield step

        (places, scores), = hard_negatives.best_of(Watched(rows, lists.ids), anchor, 5, np.ones(5000, bool), [None])
        want = sorted(zip(-(rows @ anchor), range(5000)))[:5]
        assert [(-s, p) for p, s in zip(places.tolist(), scores.tolist())] == want
        assert sum(read) < 1000
