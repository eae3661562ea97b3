"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel compares two strings by all their common subsequences of three characters, each
weighted by ``DECAY`` to the power of the stretch it covers in both, normalised to one. So
a term that is cut up by dots or has characters put in stays close to itself.

Strings are the words of labelled sentences: runs of characters between blanks, and runs
of single characters ("i d i o t") as one. Over all labelled documents Spark counts in how
many toxic and other documents each word stands. Words that stand in toxic ones far above
chance are the positive strings; the negative ones are frequent words, words chosen by hash
and, in a second round, words that a first machine mistakes (at most ``POSITIVES`` and
``NEGATIVES``). Nyström landmarks are picked among them greedily, each the
one worst explained by those before; the machine is trained in their feature space.

The decision is linear in the kernel values, and each kernel value is linear in the weighted
subsequences of the string. So the trained machine folds into one table of weights per
subsequence, and a word costs its subsequences, not a comparison with every landmark.

A document's score is logistic in its two highest decisions, the numbers of high ones and its
length; that part is fitted to at most ``TRAIN_ROWS`` labelled documents chosen by a hash of
``doc_id``. Null and empty texts score like texts without words. Labels other than 0 and 1
are not used. Without positive strings every score is the share of toxic labels.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_batches
from tallyforge.operators.joins import lookup_join
from tallyforge.session import written

DECAY = 0.6
ORDER = 3
POSITIVES = 400
NEGATIVES = 3000
LANDMARKS = 192
LEAST_DOCS = 3
#: Least log-likelihood ratio of a positive string.
LEAST_RATIO = 15.0
#: Greatest one of a negative string.
PLAIN_RATIO = 4.0
TRAIN_ROWS = 8000
#: Characters of the windows that longer strings are seen through, and the step.
WINDOW = 24
STEP = 12
ALPHABET = 64
REMEMBERED = 200_000
#: Decisions above which a document's strings are counted.
LIMITS = (0.25, 0.5, 0.75)
FEATURES = 3 + len(LIMITS)

_EDGES = ".,;:!?\"'()[]{}<>*#$%&|…«»“”"
_SPELT = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")


def units(text: str | None) -> set[str]:
    """The different strings of a text, in lower case, without marks at their ends; one with
    marks inside also counts without them."""
    low = (text or "").lower()
    found = {w.strip(_EDGES) for w in set(low.split())}
    if _SPELT.search(low):
        found |= {m[0].replace(" ", "").strip(_EDGES) for m in _SPELT.finditer(low)}
    found |= {"".join(filter(str.isalnum, w)) for w in found if not w.isalnum()}
    found.discard("")
    return found


def windows(unit: str) -> list[str]:
    if len(unit) <= WINDOW:
        return [unit]
    return [unit[i : i + WINDOW] for i in range(0, len(unit) - WINDOW + STEP, STEP)]


def codes(strings: list[str]) -> np.ndarray:
    """Symbols of strings of one length: letters, digits, and classes of all others."""
    points = np.array([[ord(c) for c in s] for s in strings], np.int64).reshape(len(strings), -1)
    letter = (points >= 97) & (points <= 122)
    digit = (points >= 48) & (points <= 57)
    mark = points < 128
    return np.where(letter, points - 97, np.where(digit, points - 48 + 26, np.where(mark, 36, 37 + points % 27)))


@lru_cache(maxsize=WINDOW + 1)
def _places(length: int) -> tuple[np.ndarray, np.ndarray]:
    """All triples of places in a string and their decay."""
    triples = np.array(list(combinations(range(length), ORDER)), np.int64).reshape(-1, ORDER)
    return triples, DECAY ** (triples[:, -1] - triples[:, 0] + 1.0)


def subsequences(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each string's subsequences (strings x triples) and their weights."""
    triples, weight = _places(c.shape[1])
    return (c[:, triples[:, 0]] * ALPHABET + c[:, triples[:, 1]]) * ALPHABET + c[:, triples[:, 2]], weight


def self_kernel(c: np.ndarray) -> np.ndarray:
    """Kernel of each string with itself, by the recursion over prefixes; the recursion's
    inner sum over the second string is one product with a triangle of decays."""
    count, length = c.shape
    match = (c[:, :, None] == c[:, None, :]) * (DECAY * DECAY)
    gap = np.arange(length)[None, :] - np.arange(length)[:, None]
    triangle = np.where(gap >= 0, DECAY ** np.maximum(gap, 0.0), 0.0)
    prime, total = np.ones((length + 1, count, length + 1)), np.zeros(count)
    for order in range(ORDER):
        after = np.zeros_like(prime)
        for i in range(1, length + 1):
            step = match[:, i - 1] * prime[i - 1, :, :-1]
            if order == ORDER - 1:
                total += step.sum(1)
            else:
                after[i, :, 1:] = DECAY * after[i - 1, :, 1:] + step @ triangle
        prime = after
    return total


def features(strings: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse normalised kernel features of a few strings: subsequence numbers, weights."""
    out = []
    for s in strings:
        if len(s) < ORDER:
            out.append((np.zeros(0, np.int64), np.zeros(0)))
            continue
        numbers, weight = subsequences(codes([s]))
        found, at = np.unique(numbers[0], return_inverse=True)
        values = np.bincount(at, weight, len(found))
        out.append((found, values / np.linalg.norm(values)))
    return out


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised kernel between two small lists of strings."""
    left, right = features(a), features(b)
    out, table = np.zeros((len(a), len(b))), np.zeros(ALPHABET**ORDER)
    for j, (numbers, values) in enumerate(right):
        table[numbers] = values
        out[:, j] = [table[n] @ v for n, v in left]
        table[numbers] = 0
    return out


class Machine:
    """The trained machine as weights per subsequence."""

    def __init__(self, positive: list[tuple[str, float]], negative: list[tuple[str, float]]):
        strings = [s for s, _ in positive + negative]
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        share = np.concatenate([_shares([n for _, n in part]) for part in (positive, negative)])
        marks = _landmarks([s for s, _ in positive], LANDMARKS * 3 // 4) + _landmarks([s for s, _ in negative], LANDMARKS // 4)
        gram = kernel(marks, marks)
        values, vectors = np.linalg.eigh(gram)
        root = vectors / np.sqrt(np.maximum(values, 1e-6)) * (values > 1e-6)
        phi = np.concatenate([kernel(strings, marks) @ root, np.ones((len(strings), 1))], axis=1)
        self.weights, self.bias = self._folded(marks, root, _squared_hinge(phi, y, share))
        self.known: dict[str, float] = {}

    @staticmethod
    def _folded(marks: list[str], root: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
        table = np.zeros(ALPHABET**ORDER)
        for (numbers, values), beta in zip(features(marks), root @ w[:-1], strict=True):
            table[numbers] += beta * values
        return table, float(w[-1])

    def _decide(self, strings: list[str]) -> dict[str, float]:
        by_length: dict[int, list[str]] = {}
        for s in strings:
            by_length.setdefault(len(s), []).append(s)
        out = {}
        for length, group in by_length.items():
            if length < ORDER:
                out.update((s, self.bias) for s in group)
                continue
            step = max(1, 400_000 // len(_places(length)[1]))
            for low in range(0, len(group), step):
                part = group[low : low + step]
                c = codes(part)
                numbers, weight = subsequences(c)
                norms = np.sqrt(self_kernel(c))
                out.update(zip(part, ((self.weights[numbers] @ weight) / norms + self.bias).tolist(), strict=True))
        return out

    def decisions(self, strings: set[str]) -> None:
        """Make sure that ``known`` has all of these."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = [s for s in strings if s not in self.known]
        parts = {s: windows(s) for s in fresh}
        made = self._decide(list({w for ws in parts.values() for w in ws}))
        self.known.update((s, max(made[w] for w in ws)) for s, ws in parts.items())

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        """Highest and second decision, log numbers of those above three limits and of all."""
        sets = [units(t) for t in texts]
        self.decisions(set().union(*sets))
        out = np.zeros((len(texts), FEATURES))
        for row, found in zip(out, sets, strict=True):
            values = np.array([self.known[s] for s in found])
            above = np.sort(values[values > -0.5])[::-1]
            counts = [(above > limit).sum() for limit in LIMITS]
            row[:2] = np.clip([*above[:2], -1, -1][:2], -1, 1)
            row[2:] = np.log1p([*counts, len(values)])
        return out


def _shares(counts: list[float]) -> np.ndarray:
    """Weights that add up to one; a frequent string weighs as its root."""
    root = np.sqrt(np.array(counts, float))
    return root / max(root.sum(), 1e-9)


def _landmarks(strings: list[str], count: int) -> list[str]:
    """Greedy choice by the largest residual among all strings (pivoted Cholesky of the
    kernel)."""
    pool = [s for s in strings if len(s) >= ORDER]
    if not pool:
        return []
    known, table = features(pool), np.zeros(ALPHABET**ORDER)
    rest, basis, taken = np.ones(len(pool)), np.zeros((len(pool), 0)), []
    for _ in range(min(count, len(pool))):
        at = int(np.argmax(rest))
        if rest[at] < 1e-3:
            break
        taken.append(pool[at])
        numbers, values = known[at]
        table[numbers] = values
        column = (np.array([table[n] @ v for n, v in known]) - basis @ basis[at]) / np.sqrt(rest[at])
        table[numbers] = 0
        basis = np.column_stack([basis, column])
        rest = np.maximum(rest - column * column, 0)
        rest[at] = 0
    return taken


def _squared_hinge(phi: np.ndarray, y: np.ndarray, share: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Newton steps for the mean squared hinge loss with weights ``share``."""
    w, ridge = np.zeros(phi.shape[1]), penalty * np.eye(phi.shape[1])
    for _ in range(50):
        active = y * (phi @ w) < 1
        x, s = phi[active], share[active][:, None]
        new = np.linalg.solve((x * s).T @ x + ridge, (x * s).T @ y[active])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def labelled_strings(docs: DataFrame, labelled: DataFrame) -> tuple[list[tuple[str, float]], list[tuple[str, float]], float]:
    """Positive and negative strings with the number of their documents, and the share of
    toxic documents. The counts cover all labelled documents."""
    known = labelled.where("label IN (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    share = known.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
    if not 0 < share < 1:
        return [], [], share
    marked = lookup_join(docs.select("doc_id", "text"), known, "doc_id").select("label", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(label, u) for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for u in units(text)]
        toxic, everything = {}, {}
        for label, unit in found:
            toxic[unit] = toxic.get(unit, 0) + label
            everything[unit] = everything.get(unit, 0) + 1
        names = list(everything)
        columns = pa.array(names, pa.string()), pa.array([toxic[u] for u in names], pa.int64()), pa.array(list(everything.values()), pa.int64())
        return pa.RecordBatch.from_arrays(list(columns), ["unit", "bad", "n"])

    counts = map_batches(marked, work, "unit string, bad bigint, n bigint").groupBy("unit").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    counts = counts.where((F.col("n") >= LEAST_DOCS) & (F.length("unit") >= ORDER))
    part = F.col("bad") / F.col("n")

    def term(x, p):
        return F.when(x > 0, x * F.log(x / (F.col("n") * p))).otherwise(0.0)

    ratio = 2 * (term(F.col("bad"), share) + term(F.col("n") - F.col("bad"), 1 - share))
    # counted once, then read for each of the choices below
    rated = written(counts.withColumn("ratio", F.when(part > share, ratio).otherwise(-ratio)), "strings")
    strong = rated.where((F.col("ratio") >= LEAST_RATIO) & (part >= 0.5)).orderBy(F.desc("ratio"), "unit").limit(POSITIVES)
    positive = [(r["unit"], float(r["n"])) for r in strong.collect()]
    plain = rated.where(F.col("ratio") < PLAIN_RATIO)
    frequent = plain.orderBy(F.desc("n"), "unit").limit(NEGATIVES // 3).collect()
    hashed = plain.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES // 3).collect()
    negative = {r["unit"]: float(r["n"]) for r in [*frequent, *hashed]}
    if positive and negative:
        negative |= _mistaken(plain, Machine(positive, sorted(negative.items())))
    return positive, sorted(negative.items()), share


def _mistaken(plain: DataFrame, machine: Machine) -> dict[str, float]:
    """The most frequent other strings that a first machine takes for positive or nearly so."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.column(0).to_pylist()
        machine.decisions(set(names))
        kept = pa.array([machine.known[u] > -0.3 for u in names], pa.bool_())
        return batch.filter(kept)

    machine.known.clear()
    found = map_batches(plain.select("unit", "n"), work, "unit string, n bigint")
    return {r["unit"]: float(r["n"]) for r in found.orderBy(F.desc("n"), "unit").limit(NEGATIVES // 3).collect()}


class Scorer:
    """Machine and the logistic part on top; ``constant`` where nothing could be learnt."""

    def __init__(self, machine: Machine | None, constant: float):
        self.machine, self.constant, self.weights = machine, constant, None

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        if len(np.unique(y)) < 2:
            return
        self.centre, self.spread = x.mean(0), x.std(0) + 1e-6
        z = np.concatenate([(x - self.centre) / self.spread, np.ones((len(x), 1))], axis=1)
        w = np.zeros(z.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ ((p - y) / len(y)) + 1e-4 * w
            w = w - np.linalg.solve((z * (p * (1 - p) / len(y))[:, None]).T @ z + 1e-4 * np.eye(len(w)), slope)
        self.weights = w

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.machine is None or self.weights is None:
            return np.full(len(texts), self.constant)
        z = (self.machine.pooled(texts) - self.centre) / self.spread @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS) -> Scorer:
    """Train from ``labelled`` (``doc_id``, ``label``)."""
    positive, negative, share = labelled_strings(docs, labelled)
    if not positive or not negative:
        return Scorer(None, share)
    scorer = Scorer(Machine(positive, negative), share)
    machine = scorer.machine
    sample = labelled.where("label IN (0, 1)").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most ``rows`` rows of two numbers

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = machine.pooled(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, k]) for k in range(FEATURES))], names)

    names = ["label", *(f"x{k}" for k in range(FEATURES))]
    schema = "label int, " + ", ".join(f"{n} double" for n in names[1:])
    made = map_batches(chosen.select(F.col("label").cast("int").alias("label"), "text"), work, schema)
    found = np.array([tuple(r) for r in made.orderBy(names).limit(2 * rows).collect()], float).reshape(-1, 1 + FEATURES)
    scorer.fit(found[:, 1:], found[:, 0])
    machine.known.clear()
    return scorer


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id`` and ``score`` of each row's ``text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = scorer.scores(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")
