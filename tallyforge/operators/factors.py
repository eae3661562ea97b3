"""Matrix factorisation: fitting, scoring, recommending."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.blocks import by_user, even_span, ranged, with_vectors
from tallyforge.operators.decompose import fold_products, map_rows, whitener
from tallyforge.operators.joins import lookup_join
from tallyforge.operators.ordering import global_index
from tallyforge.operators.similar import best_products
from tallyforge.session import discard, ensure_checkpoint, fresh_path, release, releasing, ship_package, tidy, written

# Rank, rounds and regularisation used by default.
RANK, ROUNDS, REGULARISATION = 50, 10, 0.01
#: Ids a block must have for ranges to be worth it: the factors of fewer are soon sent.
RANGED = 1000
#: Ratings of a block of a fit, which a task holds several times over while it sorts them.
RATINGS = 4_000_000
#: Users of a block whose ratings meet factors.
USERS = 16_384


@dataclass(frozen=True)
class Codes:
    """Numbers of the ids of one side. Spark's blocks are remainders; where ids fill their range
    evenly, code ``blocks * o + b`` stands for the id at place ``o`` of range ``b``, so that a block
    is a range. Without a span, and for few ids, codes are the ids."""

    blocks: int
    span: tuple[int, int] | None

    @staticmethod
    def of(ids: DataFrame, column: str, blocks: int) -> Codes:
        plain = Codes(blocks, None)
        if not isinstance(ids.schema[column].dataType, T.IntegralType):
            return plain
        known = ids.select(column).where(F.col(column).isNotNull()).distinct()
        n = known.count()
        span = even_span(known, column, n, blocks) if n >= RANGED * blocks else None
        fits = span is not None and -(2**31) <= span[0] and span[1] < 2**31 and span[1] - span[0] + blocks < 2**31 - blocks
        return Codes(blocks, span) if fits else plain

    @property
    def width(self) -> int:
        return (self.span[1] - self.span[0]) // self.blocks + 1

    def code(self, ids: Column) -> Column:
        """Null for an id out of range, which no model knows."""
        if self.span is None:
            return ids
        at = ids.cast("long") - self.span[0]
        range_of = F.floor(at / self.width)
        return F.when(ids.between(*self.span), (at - range_of * self.width) * self.blocks + range_of).cast("int")

    def id(self, codes: Column) -> Column:
        if self.span is None:
            return codes
        place = F.floor(codes / self.blocks)
        return ((codes - place * self.blocks) * self.width + place + self.span[0]).cast("int")


@dataclass(frozen=True)
class Model:
    """A fitted factorisation and the numbers it was fitted on."""

    als: ALSModel
    users: Codes
    items: Codes

    @property
    def rank(self) -> int:
        return self.als.rank

    def coded(self, rows: DataFrame, *sides: str) -> DataFrame:
        """Rows whose ids may be known, with ``user_code`` and ``item_code``."""
        for side in sides:
            codes = self.users if side == "user" else self.items
            rows = rows.withColumn(f"{side}_code", codes.code(F.col(f"{side}_id")))
            if codes.span is not None:
                rows = rows.where(F.col(f"{side}_code").isNotNull())
        return rows


def fit(
    ratings: DataFrame,
    rank: int = RANK,
    rounds: int = ROUNDS,
    reg: float = REGULARISATION,
    implicit_alpha: float | None = None,
    seed: int = 42,
    blocks: int | None = None,
) -> Model:
    """Alternating least squares; ``implicit_alpha`` turns ratings into confidences.

    ``blocks`` of users and of items are the tasks of a round; by default as many as the
    cluster has cores, ten at least, and so many that a block has some ``RATINGS``.

    Ids must fit an int (Spark checks it); ``NamedFactors`` takes any others. ``ratings`` is read
    several times. Spark checkpoints the items every round and then forgets what it sent for it;
    the model is saved and read back, so nothing of the fit stays with the executors.
    """
    spark = ratings.sparkSession
    ensure_checkpoint(spark)
    with tidy(spark):
        blocks = blocks or max(10, spark.sparkContext.defaultParallelism, math.ceil(ratings.count() / RATINGS))
        users, items = Codes.of(ratings, "user_id", blocks), Codes.of(ratings, "item_id", blocks)
    als = ALS(
        numUserBlocks=blocks, numItemBlocks=blocks,
        rank=rank, maxIter=rounds, regParam=reg, seed=seed,
        userCol="user_code", itemCol="item_code", ratingCol="rating",
        implicitPrefs=implicit_alpha is not None, alpha=implicit_alpha or 1.0,
        coldStartStrategy="drop", checkpointInterval=1,
    )
    coded = ratings.select(users.code(F.col("user_id")).alias("user_code"), items.code(F.col("item_id")).alias("item_code"), "rating")
    path = fresh_path(spark, "factors")
    with releasing(spark):
        als.fit(coded).save(path)
    return Model(ALSModel.load(path), users, items)


def user_factors(model: Model) -> DataFrame:
    return model.als.userFactors.select(model.users.id(F.col("id")).alias("id"), F.col("features").cast("array<double>").alias("features"))


def item_factors(model: Model) -> DataFrame:
    return model.als.itemFactors.select(model.items.id(F.col("id")).alias("id"), F.col("features").cast("array<double>").alias("features"))


def predict(model: Model, pairs: DataFrame) -> DataFrame:
    """Score of each given (user, item) in single precision; pairs unknown to the model are left out.
    Pairs meet factors in blocks of users, so none is joined with a vector."""
    kinds = [pairs.schema[c].dataType.simpleString() for c in ("user_id", "item_id")]

    def each(block: Block, at: np.ndarray, items: np.ndarray, v: np.ndarray, _: np.ndarray) -> Iterator[pa.RecordBatch]:
        product = np.einsum("ij,ij->i", block.factors[at], v).astype(np.float32).astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block.ids[at], items, product)], ["user_id", "item_id", "prediction"])

    given = pairs.select("user_id", "item_id", F.lit(0.0).alias("value"))
    out = in_blocks(given, "value", model, 0, each, lambda block: iter(()), "user_id long, item_id long, prediction double")
    return out.select(*(F.col(c).cast(k).alias(c) for c, k in zip(("user_id", "item_id"), kinds)), "prediction")


def _best(model: Model, users: DataFrame, k: int) -> DataFrame:
    """The ``k`` best items of the given rows of user factors, by score and then by id."""
    found = best_products(users, model.als.itemFactors.select(model.items.id(F.col("id")).alias("id"), "features"), k)
    return found.select(F.col("id").cast("int").alias("user_id"), "rank", F.col("other").cast("int").alias("item_id"), "score")


def recommend_to_all(model: Model, k: int) -> DataFrame:
    """The ``k`` best items of every user: blocked products with a bounded heap per user."""
    return _best(model, model.als.userFactors.select(model.users.id(F.col("id")).alias("id"), "features"), k)


def recommend_to(model: Model, users: DataFrame, k: int, titles: DataFrame | None = None) -> DataFrame:
    """The ``k`` best items of the given users, with titles when a title table is given; an
    item without a title has a null one."""
    asked = model.coded(users.select("user_id").distinct(), "user").select(F.col("user_code").alias("id"))
    known = model.als.userFactors.join(asked, "id", "left_semi")
    ranked = _best(model, known.select(model.users.id(F.col("id")).alias("id"), "features"), k)
    return lookup_join(ranked, titles, "item_id", "left") if titles is not None else ranked


class Block:
    """The factors of a block of users, by ascending id, and one row of ``width`` sums for each."""

    def __init__(self, width: int):
        self.width, self.given = width, []

    def add_users(self, ids: np.ndarray, factors: np.ndarray) -> None:
        self.given.append((ids, factors))

    def close(self) -> bool:
        """All users are here; False if there are none."""
        if self.given:
            ids, factors = (np.concatenate(x) for x in zip(*self.given))
            order = np.argsort(ids)
            self.ids, self.factors, self.sums, self.given = ids[order], factors[order], np.zeros((len(ids), self.width)), []
        return hasattr(self, "ids")

    def add(self, at: np.ndarray, terms: np.ndarray) -> None:
        order = np.argsort(at, kind="stable")
        heads = np.flatnonzero(np.diff(at[order], prepend=-1))
        self.sums[at[order][heads]] += np.add.reduceat(terms[order], heads, axis=0)


#: What to do with the ratings of a block: its places of their users, item ids, item factors and values ...
Rows = Callable[[Block, np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]
#: ... and at its end.
End = Callable[[Block], Iterator[pa.RecordBatch]]


def in_blocks(rows: DataFrame, value: str, model: Model, width: int, each: Rows, end: End, schema: str) -> DataFrame:
    """``each`` over ``rows(user_id, item_id, value)`` in blocks of users, with the factors of both sides.

    A factor is sent once to each block that needs it and not once a row. A block holds about ``USERS``
    users and reads items one after the other, each before its rows, so its memory depends on neither
    the items nor the rows. Rows whose user or item has no factors are left out.
    """
    ship_package(rows.sparkSession)
    users, items = user_factors(model).withColumn("id", F.col("id").cast("long")), item_factors(model)
    n = users.count()
    blocks = max(math.ceil(n / USERS), min(rows.sparkSession.sparkContext.defaultParallelism, n), 1)
    span = even_span(users, "id", n, blocks)
    vector = F.col("features").cast("array<float>").alias("vector")

    def made(block: Column, item: Column | None, user: Column | None, amount: Column | None, factors: Column | None) -> list[Column]:
        given = ((item, "long", "item"), (user, "long", "user"), (amount, "double", "value"), (factors, "array<float>", "vector"))
        return [block.alias("block"), *((F.lit(None) if c is None else c).cast(kind).alias(name) for c, kind, name in given)]

    # hashes of ids depend on their type
    known = rows.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).withColumn("user_id", F.col("user_id").cast("long"))
    placed = known.withColumn("block", ranged("user_id", blocks, span))
    needed = placed.select("block", F.col("item_id").alias("id")).distinct().join(items, "id")
    sent = (
        users.select(*made(ranged("id", blocks, span), None, F.col("id"), None, vector))
        .unionByName(needed.select(*made(F.col("block"), F.col("id"), None, None, vector)))
        .unionByName(placed.select(*made(F.col("block"), F.col("item_id"), F.col("user_id"), F.col(value), None)))
    )
    k = model.rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block, names, vectors = None, None, np.empty(0, np.int64), np.empty((0, k))
        for batch in batches:
            where = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                if where[low] != number:
                    if block is not None and block.close():
                        yield from end(block)
                    number, block, names, vectors = where[low], Block(width), names[:0], vectors[:0]
                part = batch.slice(low, high - low)
                has, is_user = (part.column(c).is_valid().to_numpy(zero_copy_only=False) for c in ("vector", "user"))
                factors = part.column("vector").flatten().to_numpy().reshape(-1, k).astype(float)
                of_items, of_users = (part.column(c).fill_null(0).to_numpy() for c in ("item", "user"))
                if (has & is_user).any():
                    block.add_users(of_users[has & is_user], factors[is_user[has]])
                # the item of the last batch may have more rows in this one
                names = np.append(names[-1:], of_items[has & ~is_user])
                vectors = np.concatenate([vectors[-1:], factors[~is_user[has]]])
                if has.all() or not len(names) or not block.close():
                    continue
                mine, who = of_items[~has], of_users[~has]
                item = np.maximum(np.searchsorted(names, mine, "right") - 1, 0)
                at = np.minimum(np.searchsorted(block.ids, who), len(block.ids) - 1)
                real = (names[item] == mine) & (block.ids[at] == who)
                if real.any():
                    values = part.column("value").filter(pa.array(~has)).to_numpy(zero_copy_only=False)
                    yield from each(block, at[real], mine[real], vectors[item[real]], values[real])
        if block is not None and block.close():
            yield from end(block)

    order = [F.col("block"), F.col("item").asc_nulls_first(), F.col("user").asc_nulls_first()]
    return sent.repartition(blocks, "block").sortWithinPartitions(*order).mapInArrow(run, schema)


def stated_and_predicted(ratings: DataFrame, model: Model) -> DataFrame:
    """``(actual, predicted)`` of each rating whose user and item the model knows. Ratings meet factors
    in blocks of users, so none is joined with a vector, nor with its prediction."""

    def each(block: Block, at: np.ndarray, _: np.ndarray, v: np.ndarray, ratings: np.ndarray) -> Iterator[pa.RecordBatch]:
        product = np.einsum("ij,ij->i", block.factors[at], v)
        missing = np.isnan(ratings)  # a null rating comes as this
        yield pa.RecordBatch.from_arrays([pa.array(ratings, mask=missing), pa.array(product)], ["actual", "predicted"])

    return in_blocks(ratings, "rating", model, 0, each, lambda block: iter(()), "actual double, predicted double")


def agreement(scored: DataFrame, score: str, model: Model, tolerance: float = 1e-4) -> DataFrame:
    """``(user_id, item_id, same)``: whether a given score is the product of the two factors, but for
    the tolerance relative to it."""

    def each(block: Block, at: np.ndarray, items: np.ndarray, v: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        product = np.einsum("ij,ij->i", block.factors[at], v)
        same = np.abs(product - values) <= tolerance * (1 + np.abs(product))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block.ids[at], items, same)], ["user_id", "item_id", "same"])

    return in_blocks(scored, score, model, 0, each, lambda block: iter(()), "user_id long, item_id long, same boolean")


def optimality(
    ratings: DataFrame, model: Model, reg: float = REGULARISATION, implicit_alpha: float | None = None
) -> DataFrame:
    """``(user_id, n, residual)``: how far each user is from the optimum given the items.

    The last half-step of a fit solves the users' ridge equations, so the gradient of every
    user's own loss is zero but for the rounding of factors to single precision. ``residual`` is
    its largest entry, relative to the sizes of the terms that cancel. As the user's factors are
    known, a rating adds a multiple of the item's factors and no outer product. ``n`` counts
    the ratings that the penalty is weighted by.
    """
    k = model.rank
    items = item_factors(model).select(F.col("features").alias("v"))

    def each(block: Block, at: np.ndarray, _: np.ndarray, v: np.ndarray, ratings: np.ndarray) -> Iterator[pa.RecordBatch]:
        if implicit_alpha is None:
            weight, target, counted = np.ones(len(at)), ratings, np.ones(len(at))
        else:
            weight, counted = np.abs(ratings) * implicit_alpha, (ratings > 0).astype(float)
            target = np.where(ratings > 0, 1 + weight, 0.0)
        seen = weight * np.einsum("ij,ij->i", block.factors[at], v)
        size = (np.abs(seen) + np.abs(target)) * np.sqrt((v * v).sum(axis=1))
        block.add(at, np.column_stack([(seen - target)[:, None] * v, size, counted, np.ones(len(at))]))
        return iter(())

    def end(block: Block) -> Iterator[pa.RecordBatch]:
        rated = block.sums[:, k + 2] > 0
        sums, own = block.sums[rated], block.factors[rated]
        edges = pa.array(np.arange(0, own.size + 1, k, dtype=np.int32))
        g, u = (pa.ListArray.from_arrays(edges, pa.array(np.ascontiguousarray(x).reshape(-1))) for x in (sums[:, :k], own))
        columns = [pa.array(block.ids[rated]), u, pa.array(sums[:, k + 1].astype(np.int64)), pa.array(sums[:, k]), g]
        yield pa.RecordBatch.from_arrays(columns, ["user_id", "u", "n", "size", "g"])

    summed = in_blocks(ratings, "rating", model, k + 3, each, end, "user_id long, u array<double>, n long, size double, g array<double>")
    if implicit_alpha is not None:  # every item pulls towards zero
        gram = fold_products(items, "v", "v")
        summed = map_rows(summed, ["u"], "all", lambda u: u @ gram)
        summed = summed.withColumns({
            "g": F.zip_with("g", "all", lambda a, b: a + b),
            "size": F.col("size") + F.sqrt(F.aggregate("all", F.lit(0.0), lambda a, x: a + x * x)),
        })
    share = F.col("n") * F.lit(reg)
    gradient = F.zip_with("g", "u", lambda a, b: F.abs(a + share * b))
    size = F.col("size") + share * F.sqrt(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x))
    residual = F.when(size > 0, F.array_max(gradient) / size).otherwise(0.0)
    return summed.select("user_id", "n", residual.alias("residual"))


def id_dictionary(df: DataFrame, column: str) -> DataFrame:
    """``(column, code)``: dense numbers from 0 for the ids of any type, in their order. Null is
    no id. Written once, so that every use sees the same codes."""
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = written(global_index(ids, [column], "code"), f"codes-{column}")
    most = codes.agg(F.max("code")).first()[0]
    if most is not None and most > 2**31 - 1:
        raise ValueError(f"{column}: {most + 1} ids are more than a factorisation can number")
    return codes.withColumn("code", F.col("code").cast("int"))


class NamedFactors:
    """A factorisation of ratings whose ids are strings, long integers or anything that can be
    sorted. Ids are numbered around the fit and come back in all results; ratings with a null id
    take no part, and pairs with an unknown id have no prediction."""

    def __init__(self, ratings: DataFrame, **options):
        self.users, self.items = id_dictionary(ratings, "user_id"), id_dictionary(ratings, "item_id")
        self.options = options
        self.rows = written(self._coded(ratings.select("user_id", "item_id", "rating")), "coded-ratings")
        self.model = fit(self.rows, **options)

    def _coded(self, rows: DataFrame) -> DataFrame:
        for column, codes in (("user_id", self.users), ("item_id", self.items)):
            rows = lookup_join(rows, codes, column).drop(column).withColumnRenamed("code", column)
        return rows

    def _named(self, rows: DataFrame, *columns: str) -> DataFrame:
        names = rows.columns
        for column in columns:
            codes = self.users if column == "user_id" else self.items
            back = codes.select(F.col("code").alias(column), F.col(column).alias("__id"))
            rows = lookup_join(rows, back, column).drop(column).withColumnRenamed("__id", column)
        return rows.select(*names)

    def user_factors(self) -> DataFrame:
        return self._named(user_factors(self.model).withColumnRenamed("id", "user_id"), "user_id")

    def item_factors(self) -> DataFrame:
        return self._named(item_factors(self.model).withColumnRenamed("id", "item_id"), "item_id")

    def predict(self, pairs: DataFrame) -> DataFrame:
        return self._named(predict(self.model, self._coded(pairs.select("user_id", "item_id"))), "user_id", "item_id")

    def recommend_to_all(self, k: int) -> DataFrame:
        """As the function of that name; equal scores go by the ids' order, which codes keep."""
        return self._named(recommend_to_all(self.model, k), "user_id", "item_id")

    def optimality(self) -> DataFrame:
        given = {n: self.options[n] for n in ("reg", "implicit_alpha") if n in self.options}
        return self._named(optimality(self.rows, self.model, **given), "user_id")


def latent_items(
    ratings: DataFrame, dims: int = 4, spare: int = 12, rounds: int = 30, tolerance: float = 1e-8, seed: int = 42
) -> DataFrame:
    """Items as rows of the right singular vectors of the user x item matrix.

    Block Krylov iteration on tables. A round multiplies a block of vectors by the
    matrix and its transpose and writes one table in place of the one before; all blocks
    together form the basis the answer is taken from. It ends when the leading squared singular values stand
    still, and raises if they don't within ``rounds``. The ratings stay in memory or on
    local disk in blocks of whole users. A block gets the vectors of its items once and
    gives one sum for each, so neither a rating nor a user's sum moves. The few users
    with more than ``blocks.HEAVY`` ratings are joined and summed instead, and the driver
    sees matrices as wide as the basis, whatever the number of users and items. The sign
    of each dimension is fixed, so the result is reproducible; ratings without a user, an
    item or a value take no part. ``ratings`` is read twice. ``(item_id, features)``.
    """
    r = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("rating")).dropna()
    placed, heavy = by_user(r)
    spark = ratings.sparkSession
    placed = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").persist()
    try:
        return _latent(placed, heavy, dims, dims + spare, rounds, tolerance, seed)
    finally:
        placed.unpersist()


def _both_ways(rows: pa.Table, place: np.ndarray, v: np.ndarray, given: pa.Table) -> pa.Table:
    """The block's rows of the matrix times the vectors, and their transpose times that."""
    rating = rows.column("rating").to_numpy()
    coded = rows.column("user_id").combine_chunks().dictionary_encode()
    user, n = coded.indices.to_numpy(), len(coded.dictionary)
    out = np.empty_like(v)
    for k in range(v.shape[1]):  # column by column: no rating is widened to a whole vector
        image = np.bincount(user, rating * v[place, k], n)
        out[:, k] = np.bincount(place, rating * image[user], len(v))
    edges = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32))
    w = pa.ListArray.from_arrays(edges, pa.array(out.reshape(-1)))
    return pa.table([given.column("item"), w], names=["item_id", "w"])


def _latent(placed: DataFrame, heavy: DataFrame | None, dims: int, m: int, rounds: int, tolerance: float, seed: int) -> DataFrame:
    kind = placed.schema["item_id"].dataType.simpleString()

    def added(rows: DataFrame, key: str, *vector: Column) -> DataFrame:
        return rows.groupBy(key).agg(F.array(*[F.sum(v) for v in vector]).alias("v"))

    def image_of(table: DataFrame) -> DataFrame:
        """The matrix and its transpose times ``v``."""
        sent = table.select(F.explode("blocks").alias("block"), "item_id", "v")
        parts = with_vectors(placed, sent, _both_ways, f"item_id {kind}, w array<double>")
        if heavy is not None:
            terms = [F.col("rating") * F.col("v")[i] for i in range(m)]
            users = F.broadcast(added(heavy.join(table.select("item_id", "v"), "item_id"), "user_id", *terms))
            parts = parts.unionByName(added(heavy.join(users, "user_id"), "item_id", *terms).withColumnRenamed("v", "w"))
        return added(parts, "item_id", *[F.col("w")[i] for i in range(m)]).withColumnRenamed("v", "w")

    pairs = placed.select("item_id", "block").distinct()
    if heavy is not None:
        pairs = pairs.unionByName(heavy.select("item_id", F.lit(None).cast("int").alias("block")).distinct())
    items = pairs.groupBy("item_id").agg(F.collect_list("block").alias("blocks"))
    start = F.array(*[F.xxhash64("item_id", F.lit(seed + i)).cast("double") / float(1 << 63) for i in range(m)])
    first = written(items.select("item_id", "blocks", start.alias("w")), "svd-start")
    base, table = first, first.select("item_id", "blocks", F.array().cast("array<double>").alias("b"), "w")
    # The matrix seen from the basis; every round adds the columns of one block.
    seen, leading = np.zeros((0, 0)), np.zeros(dims)
    for i in range(rounds + 1):
        sums = fold_products(table.select(F.concat("b", "w").alias("l"), F.col("w").alias("r")), "l", "r")
        c, gram = sums[:-m], sums[-m:]
        if i:
            grown = np.zeros((len(c), len(c)))
            grown[: len(seen), : len(seen)] = seen
            grown[:, -m:] = c
            grown[-m:, :] = c.T
            seen, before = grown, leading
            leading = np.linalg.eigvalsh((seen + seen.T) / 2)[::-1][:dims]
            if np.abs(leading - before).max() <= tolerance * leading[0]:
                break
            if i == rounds:
                raise RuntimeError(f"the singular values still move after {rounds} rounds: allow more, or a larger tolerance")
        # New directions: what the images add to the basis, made orthonormal.
        fresh = whitener(gram - c.T @ c)
        table = map_rows(table, ["b", "w"], "v", lambda b, w, c=c, t=fresh: (w - b @ c) @ t)
        table = written(
            table.select("item_id", "blocks", F.concat("b", "v").alias("b")).join(image_of(table), "item_id"), "svd-basis"
        )
        discard(base)  # the new table holds all its columns
        base = table
    inner = whitener(fold_products(table, "b", "b"))
    power = inner.T @ seen @ inner
    rotation = inner @ np.linalg.eigh((power + power.T) / 2)[1][:, ::-1][:, :dims]
    vectors = written(map_rows(table.select("item_id", "b"), ["b"], "v", lambda b: b @ rotation), "svd-v")
    discard(base)
    extremes = vectors.agg(*[F.max_by(F.col("v")[i], F.abs(F.col("v")[i])) for i in range(dims)]).first()
    signed = [F.col("v")[i] * (-1.0 if extremes[i] < 0 else 1.0) for i in range(dims)]
    return vectors.select("item_id", F.array(*signed).alias("features"))
