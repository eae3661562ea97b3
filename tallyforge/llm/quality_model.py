"""Quality score: random-indexing word vectors pooled per document, and a two-layer network
whose probabilities are calibrated by a temperature.

Every word falls into one of ``BUCKETS`` by hash and owns a sparse ternary index vector. A
bucket's vector is the sum of the index vectors of its neighbours over all documents. Each
task sums its own documents and hands on at most ``BUCKETS`` rows, so what is shuffled and
what the driver gets (4096 rows of 32 numbers) don't depend on the length of the texts.
Documents are pooled by mean and deviation of their words' vectors, by how alike and how
often equal neighbours are, and by length. The network is fitted in numpy to a bounded
sample of the labelled rows given to it (``TRAIN_ROWS``, chosen by a hash of ``doc_id``); a
fifth of it sets the temperature.

Null and empty texts have pooled vectors of zeros and get a score like any other; labels
other than 0 and 1 are not used; without labelled rows of both classes every score is the
share of ones, or one half. Repeated rows score alike; several labels of one document each
count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import ROWS, Remembered, map_batches
from tallyforge.session import ship_package

BUCKETS = 4096
WIDTH = 32
NONZERO = 4
REACH = 2
TRAIN_ROWS = 8000
HIDDEN = 24
EPOCHS = 60
#: Tokens that are summed or pooled at a time.
PIECE = 1 << 19

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_FEATURES = 2 * WIDTH + 4


def _bucket(token: str) -> int:
    if token[0].isalpha():
        shape = "A " if len(token) > 1 and token.isupper() else "a "
        name = shape + token.lower()
    else:
        name = "0" if token[0].isdigit() else token[:3]
    return crc32(name.encode()) % BUCKETS


_buckets = Remembered(_bucket, 100_000)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector."""
    rng = np.random.default_rng(7)
    return rng.integers(0, WIDTH, (BUCKETS, NONZERO)), rng.choice([-1, 1], (BUCKETS, NONZERO))


def bucket_ids(text: str | None) -> np.ndarray:
    return np.fromiter((_buckets[m[0]] for m in _TOKEN.finditer(text)) if text and len(text) > PIECE else map(_buckets.__getitem__, _TOKEN.findall(text or "")), np.int64)


def _context(ids: np.ndarray, doc: np.ndarray, total: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the index vectors of each token's neighbours to its bucket."""
    for step in range(1, REACH + 1):
        same = doc[step:] == doc[:-step]
        left, right = ids[:-step][same], ids[step:][same]
        for a, b in ((left, right), (right, left)):
            for k in range(NONZERO):
                total += np.bincount(a * WIDTH + places[b, k], signs[b, k], len(total))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all buckets, over all documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total, held, size = np.zeros(BUCKETS * WIDTH), [], 0

        def flush() -> None:
            ids = np.concatenate(held)
            doc = np.repeat(np.arange(len(held)), [len(h) for h in held])
            for low in range(0, len(ids), PIECE):
                part = slice(low, low + PIECE + REACH)
                _context(ids[part], doc[part], total, places, signs)
            held.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                for text in batch.column(0).slice(start, ROWS).to_pylist():
                    held.append(bucket_ids(text))
                    size += len(held[-1])
                    if size >= PIECE:
                        flush()
                        size = 0
        if held:
            flush()
        sums = total.reshape(BUCKETS, WIDTH).astype(np.int64)
        used = np.nonzero(sums.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(sums[used, k]) for k in range(WIDTH))], names)

    names = ["bucket", *(f"v{k}" for k in range(WIDTH))]
    ship_package(docs.sparkSession)
    partial = docs.select("text").mapInArrow(each, ", ".join(f"{n} bigint" for n in names))
    summed = partial.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names[1:])).collect()
    vectors = np.zeros((BUCKETS, WIDTH))
    for row in summed:
        vectors[row["bucket"]] = row[1:]
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    out = np.zeros((len(texts), _FEATURES))
    for i, text in enumerate(texts):
        ids = bucket_ids(text)
        if not len(ids):
            continue
        first = second = 0.0
        alike = equal = 0.0
        for low in range(0, len(ids), PIECE):
            part = vectors[ids[low : low + PIECE]]
            first, second = first + part.sum(0, dtype=float), second + (part * part).sum(0, dtype=float)
            alike += float(np.einsum("ij,ij->", part[1:], part[:-1]))
            equal += int((ids[low + 1 : low + PIECE] == ids[low : low + PIECE - 1][: max(0, len(ids) - low - 1)]).sum())
        mean = first / len(ids)
        deviation = np.sqrt(np.maximum(second / len(ids) - mean * mean, 0))
        pairs = max(1, len(ids) - 1)
        distinct = len(np.unique(ids)) / len(ids)
        out[i] = np.concatenate([mean, deviation, [alike / pairs, equal / pairs, distinct, np.log1p(len(ids))]])
    return out


class Network:
    """Two layers over standardised features, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.constant = None
        if len(np.unique(y)) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        held = np.arange(len(y)) % 5 == 0
        if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
            held[:] = False
        self.centre, self.spread = x.mean(0), x.std(0) + 1e-6
        self._fit((x[~held] - self.centre) / self.spread, y[~held].astype(float))
        z = self.logits(x[held] if held.any() else x)
        t = y[held] if held.any() else y
        grid = np.geomspace(0.25, 8, 101)
        loss = [np.logaddexp(0, np.where(t == 1, -z, z) / k).mean() for k in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        rng = np.random.default_rng(3)
        shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), ()]
        w = [rng.normal(0, s[0] ** -0.5 if len(s) == 2 else 0.2, s) if s and i != 1 else np.zeros(s) for i, s in enumerate(shapes)]
        m, v, t = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for low in range(0, len(y), 64):
                rows = order[low : low + 64]
                a, b = x[rows], y[rows]
                h = np.tanh(a @ w[0] + w[1])
                error = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30))) - b) / len(rows)
                back = error[:, None] * w[2] * (1 - h * h)
                grads = [a.T @ back + 1e-3 * w[0], back.sum(0), h.T @ error + 1e-3 * w[2], error.sum()]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - 0.005 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.weights = w

    def logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh((x - self.centre) / self.spread @ w[0] + w[1]) @ w[2] + w[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(docs: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of all ``docs`` and a network from ``labelled`` (``doc_id``, ``label``)."""
    vectors = word_vectors(docs)
    sample = labelled.where("label IN (0, 1)").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most ``rows`` rows of two numbers

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pooled(batch.column(2).to_pylist(), vectors)
        packed = pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["doc_id", "label", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    given = chosen.select("doc_id", F.col("label").cast("int").alias("label"), "text")
    made = map_batches(given, work, f"doc_id {kind}, label int, x binary")
    found = made.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(2 * rows).collect()
    x = np.array([np.frombuffer(r["x"], np.float32) for r in found], float).reshape(-1, _FEATURES)
    return vectors, Network(x, np.array([r["label"] for r in found], np.int64))


def score(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """``doc_id`` and ``score`` of each row's ``text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = network.scores(pooled(batch.column(1).to_pylist(), vectors))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")
