"""SimHash near-duplicates over four-word shingles, found by Golay-code fuzzy hashing.

Fingerprints link when they differ in at most four bits. The 64 bits are cut into six
blocks. Of four errors at least two blocks are free, whichever two; the other four form
two pairs, and one pair holds at most two errors. So for each choice of two exact blocks
(15) and each of the two remaining pairs (2) a key is made of the exact bits and of a
Golay index of the pair: the pair's 20 to 22 bits are read as a word of the perfect
(23, 12) code, and the word and all words one bit away are decoded to the index of their
codeword. Two pairs that differ in at most two bits have a word between them that is at
most one bit from both, so they share an index. Each key therefore has 20 or 22 exact bits
and one of 4096 indices, five indices on average, and no link within four bits is missed.

Equal fingerprints are one node, so copies are never expanded. Of the rows of a key only
one star is linked first; keys whose rows are then already connected are done. For the
others every row outside the largest part is compared with all rows of the key.

Null, empty and blank texts have fingerprint zero and link like any other. A text with
fewer words than a shingle is one shingle. Repeated rows get the same component. A row
without ``doc_id`` takes part as text, but ids of components come from other rows; a
component without any id has a null id.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import WORD, components, map_batches
from tallyforge.session import written

SHINGLE = 4
SEED = 42
BITS = 4
#: Widths of the six blocks, from the highest bit down.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Generator polynomial of the binary Golay code (a fixed value).
GENERATOR = 0b110001110101

_WORD = re.compile(WORD.encode())
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash

    words = _WORD.findall((text or "").encode().translate(_LOWER))
    if not words:
        return 0
    joined, size = b" ".join(words), min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for low in range(0, len(starts), 1 << 15):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[low : low + (1 << 15)], stops[low:], strict=False)]
        counts += np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``fp`` (the fingerprint as a signed long) of each row's ``text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], [key, "fp"])

    return map_batches(docs.select(key, "text"), work, f"`{key}` {docs.schema[key].dataType.simpleString()}, fp bigint")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


@lru_cache(maxsize=1)
def _errors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The error of each remainder, and remainders of the low 12 and of the high 11 bits."""
    flips = [0, *(sum(1 << i for i in c) for k in (1, 2, 3) for c in combinations(range(23), k))]
    patterns = np.array(flips, np.int64)
    error = np.zeros(2048, np.int64)
    error[_remainder(patterns)] = patterns
    return error, _remainder(np.arange(1 << 12)), _remainder(np.arange(1 << 11) << 12)


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    error, low, high = _errors()
    return (words ^ error[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of unsigned fingerprints, one after the other, and their number for each."""
    parts, shift = [], 64
    for width in BLOCKS:
        shift -= width
        parts.append(((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64))
    columns, combo = [], 0
    pairs = {}
    for x, y in combinations(range(6), 2):
        word, width = parts[x] << BLOCKS[y] | parts[y], BLOCKS[x] + BLOCKS[y]
        near = np.concatenate([[0], 1 << np.arange(width)])
        index = np.sort(codeword_index(word[:, None] ^ near[None, :]), axis=1)
        fresh = np.ones(index.shape, bool)
        fresh[:, 1:] = index[:, 1:] != index[:, :-1]
        pairs[x, y] = word, index, fresh
    masks = []
    for exact in combinations(range(6), 2):
        rest = [i for i in range(6) if i not in exact]
        for fuzzy in ((rest[0], rest[1]), (rest[2], rest[3])):
            _, index, fresh = pairs[fuzzy]
            columns.append((combo << 34 | pairs[exact][0] << 12)[:, None] | index)
            masks.append(fresh)
            combo += 1
    mask = np.concatenate(masks, axis=1)
    return np.concatenate(columns, axis=1)[mask], mask.sum(axis=1)


def keyed(nodes: DataFrame) -> DataFrame:
    """``(key, fp)`` rows of distinct fingerprints."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        keys, counts = fuzzy_keys(fps.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(fps, counts))], ["key", "fp"])

    return map_batches(nodes.select("fp"), work, "key bigint, fp bigint")


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= BITS


def linked(nodes: DataFrame) -> DataFrame:
    """``(node, component)`` of the distinct fingerprints ``fp`` that have a link."""
    rows = keyed(nodes).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    rows = written(rows.withColumn("first", F.min("fp").over(Window.partitionBy("key"))).where("n > 1").drop("n"), "keyed")
    stars = rows.where("fp <> first").where(_near("fp", "first")).select("fp", "first").distinct()
    parts = written(components(stars, "fp", "first"), "stars")
    marked = rows.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "key", "fp", F.coalesce("component", "fp").alias("part")
    )
    by_key = marked.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    open_keys = (
        by_key.groupBy("key")
        .agg(F.count(F.lit(1)).alias("parts"), F.max_by("part", F.struct("n", "part")).alias("largest"))
        .where("parts > 1")
        .select("key", "largest")
    )
    left = written(marked.join(open_keys, "key"), "open")
    outside = left.where("part <> largest").select("key", F.col("fp").alias("fp2"), F.col("part").alias("part2"))
    close = left.join(outside, "key").where("part <> part2").where(_near("fp", "fp2"))
    more = close.select(F.col("part").alias("a"), F.col("part2").alias("b")).distinct()
    merged = components(more, "a", "b").withColumnsRenamed({"node": "part", "component": "whole"})
    alone = more.select(F.col("a").alias("node")).union(more.select("b"))
    known = parts.union(alone.select("node", F.col("node").alias("component"))).distinct()
    return (
        known.withColumnRenamed("component", "part")
        .join(merged, "part", "left")
        .groupBy("node")
        .agg(F.min(F.coalesce("whole", "part")).alias("component"))
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits), ``component_id`` (the least key
    that is reachable by links)."""
    prints = written(fingerprints(docs, key), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min(key).alias("least")), "nodes")
    of = nodes.join(linked(nodes).withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    found = of.join(least, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(found, "fp").select(key, digits, "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of each group of near-duplicates one row, that of the least ``key`` and hash of its
    text; rows without a ``key`` stay. Different texts that share a ``key`` are told apart."""
    hashed = F.xxhash64("text")
    who = F.struct(F.col(key).alias(key), hashed.alias("_text_hash")).alias("_who")
    groups = near_duplicates(docs.where(F.col(key).isNotNull()).select(who, "text"), "_who")
    keep = groups.where(F.col("component_id") == F.col("_who")).select("_who.*").distinct()
    both = [key, "_text_hash"]
    named = docs.withColumn("_text_hash", hashed).join(keep, both, "left_semi").dropDuplicates(both)
    return named.select(docs.columns).unionByName(docs.where(F.col(key).isNull()))
