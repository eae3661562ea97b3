"""Blocked products of ratings and item links.

A user's score of a target is a weighted mean over the items the user rated. All scores are
one product of the ratings (users x sources) with the links (sources x targets), cut in three
ways, and a cell is one block of users, targets and sources. Blocks of users and targets are
ranges of their ids where these fill the ranges evenly, so that what belongs together and is
numbered together meets in few cells; other ids are hashed.

Neither side reaches a cell row by row. The ratings of a source within a block of users are
one strip (users and values, about ``USER_BLOCK`` long at most), its links within a block of
targets another (``TARGET_BLOCK``). Joining strips by source is the routing: a source's
links go to those blocks of users that rated it and to no other. A cell reads its joined
strips as a stream and adds them up in two arrays of fixed size, so its memory depends on
the block sizes alone, however many items there are, and sources need no blocks: a cell is
complete by itself. With a ``SOURCE_BLOCK`` below the number of items Spark adds the partial
sums of several cells, which moves every user's every target once for each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyforge.session import ship_package

#: Users, targets and sources of a cell.
USER_BLOCK, TARGET_BLOCK, SOURCE_BLOCK = 16_384, 1024, 1 << 62
#: Terms that are added up at a time (what they need stays in a core's cache), and rows of a
#: batch that leaves a cell.
TERMS_AT_ONCE, ROWS_OUT = 1 << 15, 1 << 16
_CELL = ["ub", "tb", "sb"]
#: Rows of a block of whole users, and rows of one user that no block takes.
ROWS, HEAVY = 1 << 20, 1 << 22


@dataclass(frozen=True)
class Grid:
    """How many blocks each dimension has, and the ids that the ranges of users and targets span."""

    users: int
    targets: int
    sources: int
    user_span: tuple[int, int] | None = None
    item_span: tuple[int, int] | None = None

    @staticmethod
    def of(users: int, items: int, parallel: int) -> Grid:
        """Blocks no larger than stated, and cells enough to keep all cores at work."""
        n_users = math.ceil(users / USER_BLOCK) or 1
        n_targets = max(math.ceil(items / TARGET_BLOCK), math.ceil(parallel / n_users), 1)
        return Grid(n_users, n_targets, math.ceil(items / SOURCE_BLOCK) or 1)


def rounded(score, digits: int):
    """To ``digits`` places. The nudge makes exact halves go up whatever the order of summation was."""
    return np.floor((score + 10.0 ** -(digits + 3)) * 10.0**digits + 0.5) / 10.0**digits


def numbered(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def ranged(column: str, blocks: int, span: tuple[int, int] | None) -> Column:
    """The number of the range of ids, all ranges being equally wide; without a span a hash."""
    if span is None:
        return numbered(column, blocks)
    low, high = span
    return F.floor((F.col(column) - low) / ((high - low) // blocks + 1)).cast("int")


def even_span(ids: DataFrame, column: str, n: int, blocks: int) -> tuple[int, int] | None:
    """First and last of the ``n`` different ids if no range has twice as many as it should, else None."""
    if blocks == 1 or not n:
        return None
    found = ids.agg(F.min(column), F.max(column)).first()
    span = int(found[0]), int(found[1])
    if span[1] - span[0] >= 1 << 52:
        return None
    fill = ids.groupBy(ranged(column, blocks, span).alias("b")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return span if fill <= 2 * math.ceil(n / blocks) else None


def by_user(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with the ``block`` of their user, blocks of about ``ROWS`` rows with all rows of
    a user side by side, and the rows of users with more than ``HEAVY``, if there are any."""
    counts = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    n, users, most = counts.agg(F.sum("n"), F.count(F.lit(1)), F.max("n")).first()
    heavy = None
    if most is not None and most > HEAVY:
        many = F.broadcast(counts.where(F.col("n") > HEAVY).select("user_id"))  # one in HEAVY rows at most
        rows, heavy = rows.join(many, "user_id", "left_anti"), rows.join(many, "user_id", "left_semi")
    blocks = max(math.ceil((n or 0) / ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, users), 1)
    whole = isinstance(rows.schema["user_id"].dataType, T.IntegralType)
    span = even_span(counts.select("user_id"), "user_id", users, blocks) if whole else None
    return rows.withColumn("block", ranged("user_id", blocks, span)), heavy


def with_vectors(
    placed: DataFrame, vectors: DataFrame, rule: Callable[[pa.Table, np.ndarray, np.ndarray, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``rule(rows, place of each row's item, matrix of vectors, vector rows)`` of each block of ``placed``
    that has vectors, without the rows whose item has none. A row of ``vectors(block, item_id, v)`` was sent once to a block
    that needs it; rows of a ``placed`` that is persisted in parts by block stay where they are."""
    ship_package(placed.sparkSession)
    empty = T._parse_datatype_string(schema)

    def run(rows: pa.Table, given: pa.Table) -> pa.Table:
        place = pc.index_in(rows.column("item_id"), value_set=given.column("item"))
        rows, place = rows.filter(place.is_valid()), place.drop_null().to_numpy()
        if not rows.num_rows:
            return to_arrow_schema(empty).empty_table()
        v = given.column("v").combine_chunks()
        return rule(rows, place, v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1), given)

    sent = vectors.select(F.col("block").alias("to"), F.col("item_id").alias("item"), "v")
    return placed.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(run, schema)


def rating_strips(ratings: DataFrame, blocks: int, span: tuple[int, int] | None = None) -> DataFrame:
    """``(source, ub, ub_ids, ub_values)``: the ratings of one source by one block of users."""
    cut = ratings.withColumn("ub", ranged("user_id", blocks, span))
    packed = cut.groupBy(F.col("item_id").alias("source"), "ub").agg(
        F.collect_list(F.struct(F.col("user_id").alias("id"), F.col("rating").alias("value"))).alias("strip")
    )
    return packed.select("source", "ub", F.col("strip.id").alias("ub_ids"), F.col("strip.value").alias("ub_values"))


def _packed(group: pa.Table) -> pa.Table:
    """Both directions of the links between two blocks, as strips by source."""
    a, b, sim = (group.column(c).to_numpy() for c in ("item_a", "item_b", "similarity"))
    low, high = (group.column(c).to_numpy() for c in ("block_a", "block_b"))
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    block, sim = np.concatenate([high, low]), np.concatenate([sim, sim])
    order = np.lexsort((block, source))
    source, target, block, sim = source[order], target[order], block[order], sim[order]
    new = (np.diff(source) != 0) | (np.diff(block) != 0)
    edges = np.concatenate([[0], np.nonzero(new)[0] + 1, [len(source)]]).astype(np.int32)
    columns = [
        pa.array(source[edges[:-1]]), pa.array(block[edges[:-1]]),
        pa.ListArray.from_arrays(pa.array(edges), pa.array(target)), pa.ListArray.from_arrays(pa.array(edges), pa.array(sim)),
    ]
    return pa.table(columns, names=["source", "tb", "tb_ids", "tb_values"])


def link_strips(sims: DataFrame, blocks: int, span: tuple[int, int] | None = None) -> DataFrame:
    """``(source, tb, tb_ids, tb_values)``: the links of one source into one block of targets.

    A link travels once: all links between two blocks, at most ``TARGET_BLOCK`` squared, meet
    in one group, which sends out the strips of both directions."""
    cut = sims.select(
        "item_a", "item_b", "similarity", ranged("item_a", blocks, span).alias("block_a"), ranged("item_b", blocks, span).alias("block_b")
    )
    pair = cut.groupBy(F.least("block_a", "block_b").alias("low"), F.greatest("block_a", "block_b").alias("high"))
    return pair.applyInArrow(_packed, "source long, tb int, tb_ids array<long>, tb_values array<double>")


def cells(ratings: DataFrame, sims: DataFrame, grid: Grid) -> DataFrame:
    """Every pair of strips of one source, with the cell it belongs to. Each item also has a
    strip that links it with itself and weighs NaN, which marks what a user rated."""
    rated = rating_strips(ratings, grid.users, grid.user_span)
    own = ratings.select(F.col("item_id").alias("source")).distinct().select(
        "source", ranged("source", grid.targets, grid.item_span).alias("tb"), F.array("source").alias("tb_ids"),
        F.array(F.lit(float("nan"))).alias("tb_values"),
    )
    links = link_strips(sims, grid.targets, grid.item_span).unionByName(own)
    return rated.join(links, "source").withColumn("sb", numbered("source", grid.sources))


def _edges(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Where stretches of equal values begin, and the number of rows."""
    new = np.any([np.diff(batch.column(c).to_numpy()) != 0 for c in columns], axis=0)
    return np.concatenate([[0], np.nonzero(new)[0] + 1, [batch.num_rows]])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and all values of a list column."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy()


class Sums:
    """Numerators and denominators of one block of users against one block of targets."""

    def __init__(self):
        self.users, self.targets = np.empty(0, np.int64), np.empty(0, np.int64)
        self.num = self.den = np.zeros((0, 0))

    def _grow(self, users: np.ndarray, targets: np.ndarray) -> None:
        """Makes room for new users and targets; both are bounded by their block."""
        rows, cols = np.union1d(self.users, users), np.union1d(self.targets, targets)
        if len(rows) == len(self.users) and len(cols) == len(self.targets):
            return
        at = np.ix_(np.searchsorted(rows, self.users), np.searchsorted(cols, self.targets))
        for name in ("num", "den"):
            wider = np.zeros((len(rows), len(cols)))
            wider[at] = getattr(self, name)
            setattr(self, name, wider)
        self.users, self.targets = rows, cols

    def add(self, batch: pa.RecordBatch) -> None:
        """Adds the outer products of the strips of a batch."""
        n_users, users = _lists(batch.column("ub_ids"))
        n_targets, targets = _lists(batch.column("tb_ids"))
        ratings, links = batch.column("ub_values").flatten().to_numpy(), batch.column("tb_values").flatten().to_numpy()
        self._grow(users, targets)
        u, t = np.searchsorted(self.users, users), np.searchsorted(self.targets, targets)
        # a term for every user of a strip with every target of the strip beside it
        width, strip = len(self.targets), np.repeat(np.arange(len(n_users)), n_users)
        count, first = n_targets[strip], (np.cumsum(n_targets) - n_targets)[strip]
        ends = np.cumsum(count)
        low = 0
        while low < len(u):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + TERMS_AT_ONCE, "right")))
            mine = count[low:high]
            shift = first[low:high] - (ends[low:high] - mine - done)
            at = np.arange(ends[high - 1] - done) + np.repeat(shift, mine)
            cell, weight = np.repeat(u[low:high] * width, mine) + t[at], links[at]
            terms = weight * np.repeat(ratings[low:high], mine)
            np.add.at(self.num.reshape(-1), cell, terms)
            np.add.at(self.den.reshape(-1), cell, weight)
            low = high

    def _best(self, keep: np.ndarray, score: np.ndarray, best: int) -> np.ndarray:
        """The first of each user by score and target: whatever is below the last place goes,
        equal scores there go by target."""
        score = np.where(keep, score, -np.inf)
        if best >= score.shape[1]:
            return keep
        last = -np.partition(-score, best - 1, axis=1)[:, best - 1]
        above, tied = keep & (score > last[:, None]), keep & (score == last[:, None])
        return above | tied & (np.cumsum(tied, axis=1) <= (best - above.sum(axis=1))[:, None])

    def scores(self, best: int | None, digits: int | None) -> Iterator[pa.RecordBatch]:
        """The quotients of sums that are whole."""
        keep = self.den > 0
        score = np.divide(self.num, self.den, where=keep, out=np.zeros_like(self.num))
        if digits is not None:
            score = rounded(score, digits)
        if best is not None and keep.any():
            keep = self._best(keep, score, best)
        return self._out(keep, {"score": score})

    def parts(self) -> Iterator[pa.RecordBatch]:
        """The sums of one source block, with the marks of rated targets."""
        return self._out(self.den != 0, {"num": self.num, "den": self.den})

    def _out(self, keep: np.ndarray, made: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        users, targets = np.nonzero(keep)
        for low in range(0, len(users), ROWS_OUT):
            u, t = users[low : low + ROWS_OUT], targets[low : low + ROWS_OUT]
            columns = {"user_id": self.users[u], "item_id": self.targets[t]} | {n: v[u, t] for n, v in made.items()}
            yield pa.RecordBatch.from_pydict({n: pa.array(v) for n, v in columns.items()})


def _same(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Stretches of a batch that belong to one cell."""
    edges = _edges(batch, _CELL).tolist()
    for low, high in zip(edges, edges[1:]):
        yield tuple(batch.column(c)[low].as_py() for c in _CELL), batch.slice(low, high - low)


def products(ratings: DataFrame, sims: DataFrame, best: int | None = None, digits: int | None = None) -> DataFrame:
    """``(user_id, item_id, score)`` of every user and target that share a source, targets that
    the user rated left out; with ``best`` only what can be among a user's first so many.

    ``ratings(user_id, item_id, rating)`` and ``sims(item_a, item_b, similarity)``, one row for
    each pair of two items, similarities above zero.
    """
    spark = ratings.sparkSession
    ship_package(spark)
    users, items = ratings.agg(F.count_distinct("user_id"), F.count_distinct("item_id")).first()
    grid = Grid.of(users, items, spark.sparkContext.defaultParallelism)
    spans = [
        even_span(ratings.select(c).where(F.col(c).isNotNull()).distinct(), c, n, b)
        for c, n, b in (("user_id", users, grid.users), ("item_id", items, grid.targets))
    ]
    grid = replace(grid, user_span=spans[0], item_span=spans[1])
    whole = grid.sources == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sums = None, Sums()
        for batch in batches:
            if not batch.num_rows:
                continue
            for now, part in _same(batch):
                if now != cell:
                    yield from sums.scores(best, digits) if whole else sums.parts()
                    cell, sums = now, Sums()
                sums.add(part)
        yield from sums.scores(best, digits) if whole else sums.parts()

    sent = cells(ratings, sims, grid).repartition(*_CELL).sortWithinPartitions(*_CELL)
    sent = sent.select(*_CELL, "ub_ids", "ub_values", "tb_ids", "tb_values")
    if whole:
        return sent.mapInArrow(run, "user_id long, item_id long, score double")
    out = sent.mapInArrow(run, "user_id long, item_id long, num double, den double")
    out = out.groupBy("user_id", "item_id").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
    score = F.col("num") / F.col("den")
    if digits is not None:
        score = F.round(score + 10.0 ** -(digits + 3), digits)
    return out.where(~F.isnan("den")).select("user_id", "item_id", score.alias("score"))
