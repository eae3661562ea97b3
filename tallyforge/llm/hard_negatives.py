"""Hard negatives by Fagin's threshold algorithm.

Vectors become integers, ``floor(256 * x)`` of each component, and a score is an integer
inner product. Candidates are hashed into blocks of bounded size and anchors into groups;
each pair of a block and a group is one cell, so no task sees more than one of each however
many rows share a label or a vector. In a cell every dimension has the candidates sorted
by their value there. An anchor reads all lists at once, from the top where its own component
is positive and from the bottom where it is negative, fetches each row that comes up and
scores it whole. The threshold is the score of a row that had, in every list, the value read
last: nothing unread scores more. Reading stops once the threshold is strictly below the
last place that is asked for (ties go to the smaller id, so an equal score may still come)
or below what can be asked for at all.

There are two rounds. The first finds the best rows of the anchor's own label (its
positives) in lists of that label; the second the best rows of other labels whose score is
within a share of each positive's score. The best of all cells are merged by Spark.

Rows with a null id, label or vector, or a null or non-finite component take no part. An id
is one row: of several rows with it the least by label and vector. Vectors of different
length are filled up with zeros. Components saturate at 64 bits, scores that pass 64 bits
are computed exactly and saturate in the result. An anchor without positives, a positive with a
negative score, and an empty table give no rows. Columns other than the three are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import ship_package, written

#: Rows of a block of candidates and of a group of anchors.
CANDIDATES, ANCHORS = 16_384, 8_192
#: Rows of each list that are read in the first step; every further step doubles what was read.
FIRST_STEP = 8
_LIMIT = (1 << 63) - 1


def prepared(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``id``, ``label`` and the integer ``vector`` of the rows that take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    made = rows.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), x.alias("x")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = made.select("id", "label", F.transform("x", lambda v: F.floor(256 * v)).alias("vector"))
    return whole.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, short ones filled up with zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy()
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((int(n) for n in column.combine_chunks().value_lengths().to_numpy(zero_copy_only=False)), default=0)


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a number type in which their inner products are exact."""
    peak = max((abs(int(m.min())), abs(int(m.max()))) for m in (a, b) if m.size) if a.size and b.size else (0, 0)
    most = max(peak)
    kind = np.float64 if most * most * max(a.shape[1], 1) < 1 << 53 else object
    return a.astype(kind), b.astype(kind)


class Lists:
    """Candidates with, for every dimension, their places sorted by value, greatest first."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.order = np.argsort(-rows, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(rows.T, self.order, axis=1)

    def read(self, anchor: np.ndarray):
        """Steps of the signed sorted access: places that came up for the first time, their scores,
        and the threshold. The last step has read everything; its threshold is None."""
        count = len(self.ids)
        up, down = np.nonzero(anchor > 0)[0], np.nonzero(anchor < 0)[0]
        new, low, high = np.ones(count, bool), 0, min(FIRST_STEP, count)
        while True:
            came = np.concatenate([self.order[up, low:high].ravel(), self.order[down, count - high : count - low].ravel()])
            hit = np.zeros(count, bool)
            hit[came] = True
            done = high >= count or not len(up) + len(down)
            places = np.nonzero((hit | done) & new)[0]
            new[places] = False
            last = None
            if not done:
                last = self.sorted[up, high - 1] @ anchor[up] + self.sorted[down, count - high] @ anchor[down]
            yield places, self.rows[places] @ anchor, last
            if done:
                return
            low, high = high, min(2 * high, count)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first by score, greatest first, and id."""
    if len(scores) > 4 * k:
        kth = np.partition(-scores, k - 1)[k - 1] if scores.dtype != object else np.sort(-scores)[k - 1]
        near = np.nonzero(-scores <= kth)[0]
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def best_of(lists: Lists, anchor: np.ndarray, k: int, allowed: np.ndarray, windows: list[tuple[int, int] | None]):
    """For each window of scores (None: any) the first ``k`` allowed candidates: places and
    scores. Stops by the threshold."""
    places, scores = np.empty(0, np.int64), np.empty(0, lists.rows.dtype)
    open_windows, found = set(range(len(windows))), {}
    for came, values, threshold in lists.read(anchor):
        mine = allowed[came]
        places, scores = np.concatenate([places, came[mine]]), np.concatenate([scores, values[mine]])
        for w in sorted(open_windows):
            low, high = windows[w] or (None, None)
            inside = np.arange(len(places)) if low is None else np.nonzero((scores >= low) & (scores <= high))[0]
            chosen = inside[_first(scores[inside], lists.ids[places[inside]], k)]
            full = len(chosen) == k and threshold is not None and threshold < scores[chosen[-1]]
            if threshold is None or full or (low is not None and threshold < low):
                found[w] = places[chosen], scores[chosen]
                open_windows.discard(w)
        if not open_windows:
            break
    return [found[w] for w in range(len(windows))]


def _longs(values: list) -> pa.Array:
    return pa.array([max(-_LIMIT - 1, min(_LIMIT, int(v))) for v in values], pa.int64())


def _cell(anchors: pa.Table, candidates: pa.Table):
    """Ids, labels and matrices of both sides of a cell."""
    width = max(_width(anchors["vector"]), _width(candidates["vector"]))
    a, c = _exact(_matrix(anchors["vector"], width), _matrix(candidates["vector"], width))
    ids, labels = (candidates[n].to_numpy() for n in ("id", "label"))
    return a, anchors["id"].to_numpy(), anchors["label"].to_numpy(), c, ids, labels


def _positives(anchors: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    out: list[list] = [[], [], []]
    if anchors.num_rows and candidates.num_rows:
        a, a_ids, a_labels, c, ids, labels = _cell(anchors, candidates)
        for label in np.intersect1d(a_labels, labels):
            mine = np.nonzero(labels == label)[0]
            lists = Lists(c[mine], ids[mine])
            for i in np.nonzero(a_labels == label)[0]:
                (places, scores), = best_of(lists, a[i], k, lists.ids != a_ids[i], [None])
                out[0] += [a_ids[i]] * len(places)
                out[1] += lists.ids[places].tolist()
                out[2] += scores.tolist()
    return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), _longs(out[2])], names=["anchor_id", "id", "score"])


def _negatives(anchors: pa.Table, candidates: pa.Table, k: int, low: int, high: int) -> pa.Table:
    out: list[list] = [[], [], [], []]
    if anchors.num_rows and candidates.num_rows:
        a, a_ids, a_labels, c, ids, labels = _cell(anchors, candidates)
        lists = Lists(c, ids)
        asked = anchors["asked"].to_pylist()
        for i, positives in enumerate(asked):
            windows = [(-(-low * p // 100), high * p // 100) for p in positives]
            for p, (places, scores) in zip(positives, best_of(lists, a[i], k, labels != a_labels[i], windows)):
                out[0] += [a_ids[i]] * len(places)
                out[1] += [p] * len(places)
                out[2] += ids[places].tolist()
                out[3] += scores.tolist()
    made = [*(pa.array(x, pa.int64()) for x in out[:3]), _longs(out[3])]
    return pa.table(made, names=["anchor_id", "positive_score", "id", "score"])


def mine(
    rows: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    block: int = CANDIDATES,
    group: int = ANCHORS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``: for each row for which ``anchors`` (a condition on ``id``) holds and
    each of its first ``positives`` rows of the same label, the first ``negatives`` rows of
    another label with ``low * positive_score <= 100 * score <= high * positive_score``."""
    spark = rows.sparkSession
    ship_package(spark)
    given = written(prepared(rows, key, vector, label), "vectors")
    asking = given.where(anchors)
    n, n_asking = given.agg(F.count(F.lit(1)), F.count(F.when(anchors, 1))).first()
    blocks = max(math.ceil(n / block), min(2 * spark.sparkContext.defaultParallelism, math.ceil(n / 64)), 1)
    groups = max(math.ceil(n_asking / group), 1)

    def part(count: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    candidates = given.select("*", part(blocks).alias("b"), every(groups).alias("g")).groupBy("b", "g")

    def cells(asked: DataFrame):
        return asked.select("*", part(groups).alias("g"), every(blocks).alias("b")).groupBy("b", "g").cogroup(candidates)

    def leading(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        return found.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)

    near = cells(asking).applyInArrow(
        lambda a, c: _positives(a, c, positives), "anchor_id long, id long, score long"
    )
    near = written(leading(near, ["anchor_id"], positives, "place"), "positives")
    scores = near.where("score >= 0").groupBy("anchor_id").agg(F.collect_set("score").alias("asked"))
    asked = written(asking.join(scores, asking["id"] == scores["anchor_id"]).drop("anchor_id"), "asked")
    far = cells(asked).applyInArrow(
        lambda a, c: _negatives(a, c, negatives, low, high), "anchor_id long, positive_score long, id long, score long"
    )
    far = leading(far, ["anchor_id", "positive_score"], negatives, "rank")
    pairs = near.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
