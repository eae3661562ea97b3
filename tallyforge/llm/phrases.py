"""Phrase collocation mining with a HAT-trie of word ids.

A text, with A-Z in lower case, is cut into pieces at ``. , ; : ! ?`` and line ends, and a
piece into words at blanks and tabs. A task gives words ids as they come and counts phrases
in a trie: the first word leads to a container, a hash table from the packed ids of the
words that follow to a count. A container that outgrows its bound bursts into one container
per next word, so the trie stays shallow and deep only where phrases are many. When a task
holds more entries than its budget, whole subtrees, largest first, are spilled as sorted
runs, in which a phrase stands once. Runs are dealt by prefix and merged there. The prefix is
the first word; behind a word that is more than one in ``HOT`` of all words it goes on, so
such a word or a frequent pair does not bring all its phrases to one task.

Three rounds, as a phrase is never more frequent than its parts: words; pairs of frequent
words; phrases of three and four words all of whose pairs are frequent. What is frequent
goes to tasks as a bitmap of fixed size, which may let more through and never less; counts
are exact and everything below ``least`` falls away after the merge. So counts are those of
all occurrences, overlaps included.

Then per language: a candidate is a phrase of two to four words with ``a >= least``. Of its
cuts into two parts with frequencies l and r the one with the least ``floor(2000000 * a / (l
+ r))`` counts, of equal ones the first. A candidate inside a longer one that has 80 % of its
frequency is dropped. Decimals of 38 digits keep products exact.

Null text counts as empty, null language as ``und``. Repeated rows count each time. Ties in
score go to the greater frequency, then to the phrase that comes first byte by byte. A
language without candidates, and an empty table, give no rows. Other columns of the input
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.joins import lookup_join
from tallyforge.operators.ordering import top_per_key
from tallyforge.session import ship_package, written

LEAST, TOP, COVERED, SCALE = 30, 2000, 80, 2_000_000
LONGEST = 4
#: Bits of a hash that address the bitmap of frequent parts: 16 million places.
PLACES = 24
#: Bits of a word id in a packed suffix; three of them fit a 64-bit integer.
ID_BITS = 21
#: Entries of a container before it bursts, of a task's trie before it spills, and words of
#: a task before it starts anew.
BURST, BUDGET, WORDS = 8_192, 600_000, 400_000
#: A word of which there is more than one in so many has its phrases dealt by further words.
HOT = 2_000
#: Words that are counted by sorting before they go to the trie.
CHUNK = 1 << 18

_BREAK = 0xFF  # no byte of UTF-8
_MASK = (1 << ID_BITS) - 1
_TABLE = bytes(
    _BREAK if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_ROUND = "place int, lang string, phrase string, count long"


class Trie:
    """Counts of phrases of up to four ids. The root leads by the first id to a container
    (suffix to count) or, once burst, to a node (next id to container)."""

    def __init__(self, burst: int = BURST):
        self.burst, self.root, self.sizes, self.entries = burst, {}, {}, 0

    def extend(self, firsts: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds distinct phrases, sorted by first id and suffix."""
        edges = [0, *(np.nonzero(np.diff(firsts))[0] + 1).tolist(), len(firsts)]
        flat, numbers, root, sizes = keys.tolist(), counts.tolist(), self.root, self.sizes
        new = 0
        for first, low, high in zip(firsts[edges[:-1]].tolist(), edges, edges[1:]):
            under = root.get(first)
            if under is None and high - low <= self.burst:
                root[first] = (dict(zip(flat[low:high], numbers[low:high])), None)
                sizes[first] = high - low
                new += high - low
            elif under is not None and flat[low] in under[0] and high - low == 1:
                under[0][flat[low]] += numbers[low]
            else:
                self.add(first, keys[low:high], counts[low:high])
        self.entries += new

    def _into(self, container: dict, keys: list[int], counts: list[int]) -> int:
        """Adds counts to a container; how many entries are new."""
        before = len(container)
        if not container:
            container.update(zip(keys, counts))
        else:
            get = container.get
            container.update([(k, get(k, 0) + c) for k, c in zip(keys, counts)])
        return len(container) - before

    def add(self, first: int, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds distinct, sorted suffixes behind one first id."""
        under = self.root.get(first)
        if under is None:
            under = self.root[first] = ({}, None)
            self.sizes[first] = 0
        container, node = under
        if node is None:
            new = self._into(container, keys.tolist(), counts.tolist())
            if len(container) > self.burst:
                self.root[first] = ({}, self._burst(container))
        else:
            new, nexts = 0, keys >> 2 * ID_BITS
            edges = np.nonzero(np.diff(nexts))[0] + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
                below = node.setdefault(int(nexts[low]), {})
                new += self._into(below, keys[low:high].tolist(), counts[low:high].tolist())
        self.sizes[first] += new
        self.entries += new

    @staticmethod
    def _burst(container: dict) -> dict:
        node: dict[int, dict] = {}
        for key, count in container.items():
            node.setdefault(key >> 2 * ID_BITS, {})[key] = count
        return node

    def largest(self, share: float) -> list[int]:
        """First ids of the largest subtrees that hold this share of all entries."""
        out, held = [], 0
        for first in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if held >= share * self.entries:
                break
            out.append(first)
            held += self.sizes[first]
        return out

    def take(self, firsts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First ids, suffixes and counts of whole subtrees, which leave the trie."""
        of, keys, counts = [], [], []
        for first in firsts:
            container, node = self.root.pop(first)
            for part in [container] if node is None else node.values():
                of += [first] * len(part)
                keys += part.keys()
                counts += part.values()
            self.entries -= self.sizes.pop(first)
        return np.array(of, np.int64), np.array(keys, np.int64), np.array(counts, np.int64)


class _Ids(dict):
    """Ids of words in the order in which they come; 0 is the edge of a piece."""

    def __init__(self):
        super().__init__({bytes([_BREAK]): 0})

    def __missing__(self, word: bytes) -> int:
        new = self[word] = len(self)
        return new


def _mixed(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PLACES)


def _places(words: list[np.ndarray], lang: str) -> np.ndarray:
    """Places in the bitmap of phrases given as columns of word hashes."""
    import xxhash

    total = np.full(len(words[0]), xxhash.xxh64_intdigest(lang.encode(), 5), np.uint64)
    for column in words:
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + column
    return _mixed(total ^ (total >> np.uint64(29)))


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, 3)


class Counter:
    """Counts the phrases of one language within one task."""

    def __init__(
        self, lang: str, sizes: tuple[int, ...], known: np.ndarray | None, hot: frozenset[bytes], burst: int, budget: int, words: int
    ):
        self.lang, self.sizes, self.known, self.hot = lang, sizes, known, hot
        self.burst, self.budget, self.words = burst, budget, words
        self._anew()

    def _anew(self) -> None:
        self.ids, self.trie = _Ids(), Trie(self.burst)
        self.hashes, self.is_hot, self.waiting, self.held = np.zeros(0, np.uint64), np.zeros(0, bool), [], 0

    def _allowed(self, ids: np.ndarray, n: int) -> np.ndarray:
        """For every place whether the ``n`` words that start there have no edge among them and
        only frequent parts."""
        words = ids != 0
        if self.known is not None and n == 2:
            one = self._frequent([np.arange(len(self.ids))])
            words = words & one[ids]
        ok = words.copy()
        for k in range(1, n):
            ok[:-k] &= words[k:]
            ok[-k:] = False
        if self.known is not None and n > 2:
            low, high = ids[:-1], ids[1:]
            pairs = np.zeros(len(ids), bool)
            pairs[:-1] = self._frequent([low, high])
            for k in range(n - 1):
                ok[: len(ids) - k] &= pairs[k:]
        return ok

    def _hashed(self) -> None:
        """Hashes of words that came since the last time."""
        if len(self.hashes) < len(self.ids):
            new = list(self.ids)[len(self.hashes):]
            self.hashes = np.concatenate([self.hashes, np.array([_hash(w) for w in new], np.uint64)])
            self.is_hot = np.concatenate([self.is_hot, np.array([w in self.hot for w in new], bool)])

    def _prefix(self, ids: list[np.ndarray]) -> np.ndarray:
        """Where phrases are merged, by the hash of their prefix."""
        self._hashed()
        place, step = self.hashes[ids[0]], np.uint64(0x9E3779B97F4A7C15)
        for column in ids[1:3]:
            place = np.where(self.is_hot[ids[0]], place * step + self.hashes[column], place)
        return ((place ^ place >> np.uint64(31)) * step >> np.uint64(33)).astype(np.int32)

    def _frequent(self, ids: list[np.ndarray]) -> np.ndarray:
        self._hashed()
        at = _places([self.hashes[i] for i in ids], self.lang)
        return (self.known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def read(self, text: str) -> Iterator[pa.RecordBatch]:
        """Takes a text in; runs that had to be spilled."""
        edge = bytes([_BREAK])
        tokens = text.encode().translate(_TABLE).replace(edge, b" " + edge + b" ").split()
        for low in range(0, len(tokens), CHUNK):
            # each part goes on for as many words as a phrase may have behind its first one
            part = tokens[low : low + CHUNK + LONGEST - 1]
            own = min(len(part), CHUNK)
            ids = np.fromiter(map(self.ids.__getitem__, part), np.int64, len(part))
            self.waiting.append((ids, own))
            self.held += len(ids)
            if self.held >= CHUNK:
                yield from self._count()

    def _count(self) -> Iterator[pa.RecordBatch]:
        """Sorts what waits, adds it to the trie, spills what is too much."""
        # behind each part an edge, and no phrase starts in what was only looked ahead at
        ids = np.concatenate([x for part, _ in self.waiting for x in (part, np.zeros(1, np.int64))])
        start = np.concatenate([np.arange(len(part) + 1) < own for part, own in self.waiting])
        self.waiting, self.held = [], 0
        for n in self.sizes:
            at = np.nonzero(self._allowed(ids, n) & start)[0]
            if not len(at):
                continue
            first, suffix = ids[at], np.zeros(len(at), np.int64)
            for k in range(1, n):
                suffix = suffix << ID_BITS | ids[at + k]
            behind = ID_BITS * (LONGEST - n)  # shorter phrases end in zeros
            if n < LONGEST:
                # all ids in one number, which sorts without an order of places
                whole = np.sort(first << ID_BITS * (n - 1) | suffix)
                starts = np.nonzero(np.append(True, whole[1:] != whole[:-1]))[0]
                whole = whole[starts]
                first, suffix = whole >> ID_BITS * (n - 1), whole & (1 << ID_BITS * (n - 1)) - 1
            else:
                order = np.lexsort((suffix, first))
                first, suffix = first[order], suffix[order]
                starts = np.nonzero(np.append(True, (first[1:] != first[:-1]) | (suffix[1:] != suffix[:-1])))[0]
                first, suffix = first[starts], suffix[starts]
            self.trie.extend(first, suffix << behind, np.diff(np.append(starts, len(at))))
            if self.trie.entries > self.budget:
                yield from self._spilled(self.trie.largest(0.5))
        if len(self.ids) > self.words:
            yield from self.finish()

    def finish(self) -> Iterator[pa.RecordBatch]:
        """All that is left, and a new start."""
        if self.waiting:
            waiting = self._count()
            yield from waiting
        if self.trie.entries:
            yield from self._spilled(list(self.trie.root))
        self._anew()

    def _spilled(self, firsts: list[int]) -> Iterator[pa.RecordBatch]:
        """Whole subtrees as one run, sorted by phrase."""
        first, suffix, counts = self.trie.take(firsts)
        words = pa.array(list(self.ids), pa.binary())
        columns = [first, *(suffix >> ID_BITS * (LONGEST - 1 - k) & _MASK for k in range(1, LONGEST))]
        sizes = np.sum([c > 0 for c in columns], axis=0)
        for n in self.sizes:
            mine = np.nonzero(sizes == n)[0]
            parts = [words.take(pa.array(columns[k][mine])) for k in range(n)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ")) if n > 1 else parts[0]
            order = pc.sort_indices(phrase)
            made = {
                "place": pa.array(self._prefix([columns[k][mine] for k in range(n)])).take(order),
                "lang": pa.array([self.lang]).take(pa.array(np.zeros(len(mine), np.int64))),
                "phrase": phrase.take(order).cast(pa.string()),
                "count": pa.array(counts[mine]).take(order),
            }
            run = pa.RecordBatch.from_pydict(made)
            for low in range(0, run.num_rows, 50_000):
                yield run.slice(low, 50_000)


def _runs(
    docs: DataFrame, sizes: tuple[int, ...], known: bytes | None, hot: dict[str, frozenset[bytes]], burst: int, budget: int, words: int
) -> DataFrame:
    """Sorted runs of counts: ``(place, lang, phrase, count)``, a phrase at most once in each."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = None if known is None else spark.sparkContext.broadcast(known)  # of fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.frombuffer(shared.value, np.uint8)
        counters: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in counters:
                    counters[lang] = Counter(lang, sizes, bits, hot.get(lang, frozenset()), burst, budget, words)
                yield from counters[lang].read(text)
            while sum(c.trie.entries for c in counters.values()) > 2 * budget or len(counters) > 64:
                # many languages: those with most entries leave the task
                lang = max(counters, key=lambda k: counters[k].trie.entries)
                yield from counters.pop(lang).finish()
        for counter in counters.values():
            yield from counter.finish()

    return docs.mapInArrow(work, _ROUND)


def _merged(runs: DataFrame) -> DataFrame:
    """Runs dealt by prefix and summed: ``(lang, phrase, count)``."""
    return runs.repartition("place").groupBy("place", "lang", "phrase").agg(F.sum("count").alias("count")).drop("place")


def _bitmap(frequent: DataFrame) -> bytes:
    """A bit for the place of every frequent phrase; as large for any input."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hashes = [[_hash(w) for w in p.encode().split(b" ")] for p in phrases]
            for lang in sorted(set(langs)):
                mine = [h for h, l in zip(hashes, langs) if l == lang]
                for n in sorted({len(h) for h in mine}):
                    rows = np.array([h for h in mine if len(h) == n], np.uint64)
                    at = _places(list(rows.T), lang).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], ["word", "bit"])

    words = frequent.select("lang", "phrase").mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toArrow()  # 2 ** (PLACES - 6) rows at most
    bits = np.zeros(1 << PLACES - 6, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits.tobytes()


def frequencies(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
    burst: int = BURST, budget: int = BUDGET, words: int = WORDS,
) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, count)`` of all phrases of one to four words that occur ``least``
    times, and ``(lang, n)``, the number of all words of a language."""
    given = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text")
    ).where("text <> ''")
    single = written(_merged(_runs(given, (1,), None, {}, burst, budget, words)), "words")
    totals = single.groupBy("lang").agg(F.sum("count").alias("n"))
    single = single.where(F.col("count") >= least)
    whole = totals.agg(F.sum("n")).first()[0] or 0
    hot: dict[str, frozenset[bytes]] = {}
    for row in single.where(F.col("count") > whole / HOT).collect():  # fewer than HOT, whatever the corpus
        hot[row["lang"]] = hot.get(row["lang"], frozenset()) | {row["phrase"].encode()}

    def longer(sizes: tuple[int, ...], parts: DataFrame, label: str) -> DataFrame:
        runs = _runs(given, sizes, _bitmap(parts), hot, burst, budget, words)
        return written(_merged(runs).where(F.col("count") >= least), label)

    pairs = longer((2,), single, "pairs")
    more = longer((3, 4), pairs, "phrases")
    size = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1
    return written(single.unionByName(pairs).unionByName(more).withColumn("size", size), "frequencies"), totals


def _joined(words: str | Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, **limits: int) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``,
    ``n``, ``score``."""
    known, totals = frequencies(docs, text, lang, least, **limits)
    wide = "decimal(38,0)"
    candidates = known.where("size > 1").select("lang", "phrase", "size", F.col("count").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        _joined("words", F.lit(1), F.col("k")).alias("head"), _joined("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("count").alias("r"))
    both = lookup_join(lookup_join(cuts, heads, ["lang", "head"]), tails, ["lang", "tail"])
    part = F.call_function("div", F.col("a").cast(wide) * SCALE, F.col("l").cast(wide) + F.col("r").cast(wide))
    best = both.withColumn("score", part.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a")
    )
    inner = candidates.where("size > 2").select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = inner.select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    inner = inner.select("lang", "a", _joined("words", F.col("at"), F.col("m")).alias("phrase"))
    cover = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(cover, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * COVERED, F.lit(True))
    )
    rows = written(left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "candidates")
    ranked = top_per_key(rows, ["lang"], [F.desc("score"), F.desc("a"), "phrase"], top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
