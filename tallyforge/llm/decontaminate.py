"""Benchmark decontamination by template windows.

A text becomes a sequence of template tokens: words in lower case, and typed placeholders
for numbers, for units (a unit word or sign behind a number) and for names (a capitalised
word inside a sentence or a listed given name; a run of them is one). Where a capitalised
word opens a window it may also be the first word of a pasted text, so such windows of
documents are tried both ways. Windows of eight
tokens, at least half of them words, are hashed; an item of four to seven tokens is one
window of its own length.

An item without such a window (arithmetic, many names, Title Case), and one with a script
that is written without spaces, is also matched exactly: its real values in lower case,
with operators, and each letter of such a script for itself, as its words have no edges.
It is found where the whole sequence stands; it is cut into windows of eight for the join
alone, all of which must match at one offset. Items of fewer than four exact tokens say too
little and are never matched.

Windows of documents are first held against a bitmap of the benchmark's hashes, whose size
is fixed, and the survivors are joined with the benchmark's windows by hash and template.
Matches of one item at one offset are an occurrence. It counts if its slots are consistent:
every value of a slot in the item stands for one and the same value in the document. So a
question asked again with other numbers or names is caught, and a window that only has the
same shape is not.

An item leaks into a document when at least 30 % of its windows, or ten, match; but one
window of an item that has more is a phrase, and so are windows that other items have too:
two windows must match, one of them the item's own (if it has two, and any of its own).
Null and empty texts have no windows, empty tables no leaks; repeated rows are reported
alike, each with its ``doc_id``.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import Remembered, map_batches
from tallyforge.operators.joins import lookup_join
from tallyforge.session import written

WIDTH = 8
SHORTEST = 4
SHARE_PERCENT = 30
ENOUGH = 10
#: Bits of a hash that address the bitmap: at most 4 million places, whatever the benchmark.
PLACES = 22
#: Characters of a text that are cut into tokens at a time.
PIECE = 1 << 20

#: Unit words, unit signs and given names (fixed values).
UNITS = "mm cm dm m km inch inches ft feet yard yards mile miles mg g kg lb lbs oz ton tons ml cl l litre litres liter liters gallon gallons second seconds sec min minute minutes hour hours day days week weeks month months year years mph kmh hz khz mhz ghz watt watts volt volts joule joules percent dollar dollars cent cents euro euros pound pounds"
SIGNS = "% $ € £ °"
NAMES = "alice bob carol david emma frank grace henry isabel jack james jane john julia karen kevin laura linda lisa maria mark martin mary michael natalia nina olivia paul peter robert sam sarah sophie susan thomas tom weng william"

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,:]\d+)*|[.!?\n%$€£°]")
_WORD, _NUMBER, _NAME, _UNIT, _STOP = range(5)
_CAPITAL, _UNIT_WORD, _LISTED = 8, 16, 32
_FLAGS = 63
_BASE = np.uint64(0x9E3779B97F4A7C15)


#: Operators of exact sequences, and letters of scripts without spaces: Thai to Tibetan,
#: Burmese, Khmer, kana, and Chinese characters.
_EXACT = re.compile(r"[^\W\d_]+|\d+(?:[.,:]\d+)*|[-+*/=<>^%$€£°×÷−]")
_UNSPACED = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
)


def _code(token: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(token.encode(), 11)


_codes = Remembered(_code, 100_000)


def _kind(token: str) -> int:
    """Kind of a token and, above its ``_FLAGS``, the code of a word."""
    import xxhash

    low = token.lower()
    if token[0].isdigit():
        kind = _NUMBER
    elif token in _SIGNS:
        kind = _UNIT | _UNIT_WORD
    elif not token[0].isalpha():
        kind = _STOP
    else:
        kind = _WORD | _CAPITAL * (token[0].isupper() and token[1:].islower())
        kind |= _UNIT_WORD * (low in _UNIT_WORDS) | _LISTED * (low in _NAME_WORDS)
    return kind | (xxhash.xxh64_intdigest(low.encode(), 7) & ~_FLAGS if kind & 7 == _WORD else 0)


_UNIT_WORDS, _NAME_WORDS, _SIGNS = frozenset(UNITS.split()), frozenset(NAMES.split()), frozenset(SIGNS.split())
_kinds = Remembered(_kind, 300_000)


def tokens(text: str | None, pattern: re.Pattern[str] = _TOKEN) -> list[str]:
    """Tokens of a text, cut in pieces that end at white space."""
    text = text or ""
    if len(text) <= PIECE:
        return pattern.findall(text)
    found, start = [], 0
    while start < len(text):
        stop = min(len(text), start + PIECE)
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        found += pattern.findall(text, start, stop)
        start = stop
    return found


def exact_tokens(text: str | None) -> list[str]:
    """Real values in lower case; letters of scripts without spaces one by one."""
    found = []
    for token in tokens(text, _EXACT):
        if token.isascii() or not _UNSPACED.search(token):
            found.append(token.lower())
            continue
        at = 0
        for m in _UNSPACED.finditer(token):
            found += [token[at : m.start()].lower()] * (m.start() > at) + [m[0]]
            at = m.end()
        found += [token[at:].lower()] * (at < len(token))
    return found


def exact_windows(found: list[str], width: int) -> np.ndarray:
    """Hash of every window of exact tokens."""
    n = len(found) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_codes.__getitem__, found), np.uint64, len(found))
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * _BASE + codes[k : k + n]
    return total


class Templates:
    """Template tokens of several texts, one after the other."""

    def __init__(self, texts: list[str | None]):
        self.strings: list[str] = []
        sizes = []
        for text in texts:
            before = len(self.strings)
            self.strings += tokens(text)
            sizes.append(len(self.strings) - before)
        n = len(self.strings)
        packed = np.fromiter(map(_kinds.__getitem__, self.strings), np.uint64, n)
        flags, codes = (packed & np.uint64(_FLAGS)).astype(np.int64), packed & ~np.uint64(_FLAGS)
        row = np.repeat(np.arange(len(texts)), sizes)
        kind = flags & 7
        behind = np.concatenate([[_STOP], kind[:-1]]) if n else kind
        if n:
            behind[1:][row[1:] != row[:-1]] = _STOP
        number = behind == _NUMBER
        kind = np.where((flags & _UNIT_WORD > 0) & number, _UNIT, np.where((kind == _UNIT), _STOP, kind))
        named = (kind == _WORD) & ((flags & _LISTED > 0) | ((flags & _CAPITAL > 0) & (behind != _STOP)))
        kind = np.where(named, _NAME, kind)
        first = ~((kind == _NAME) & (np.concatenate([[_STOP], kind[:-1]]) == _NAME) & (behind != _STOP)) if n else named
        self.at = np.nonzero((kind != _STOP) & first)[0]  # places in ``strings``
        self.kind, self.row, self.all_kinds = kind[self.at], row[self.at], kind
        self.code = np.where(self.kind == _WORD, codes[self.at], self.kind.astype(np.uint64) + np.uint64(1))
        self.word_code = codes[self.at]
        self.rolled: tuple[int, np.ndarray, np.ndarray] | None = None
        self.capital = (self.kind == _NAME) & (flags[self.at] & _CAPITAL > 0)
        self.start = np.searchsorted(self.row, np.arange(len(texts)))

    def windows(self, width: int, opened: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First place and hash of every window that stays in its text; ``opened`` gives
        those that a capitalised word opens, with that word for a plain one."""
        n = len(self.code) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if self.rolled is None or self.rolled[0] != width:  # both kinds share the sums
            total, words = np.zeros(n, np.uint64), np.zeros(n, np.int8)
            for k in range(width):
                total = total * _BASE + self.code[k : k + n]
                words += self.kind[k : k + n] == _WORD
            self.rolled = width, total, words
        _, total, words = self.rolled
        if opened:
            power = np.uint64(1)
            for _ in range(width - 1):
                power = np.uint64(int(power) * int(_BASE) & 0xFFFFFFFFFFFFFFFF)
            total, words = total + (self.word_code[:n] - self.code[:n]) * power, words + np.int8(1)
        whole = (self.row[:n] == self.row[width - 1 :]) & (2 * words >= width)
        place = np.nonzero(whole & self.capital[:n] if opened else whole)[0]
        return place, total[place]

    def text(self, place: int) -> str:
        """What stands for one template token; a run of names is one value."""
        at = stop = int(self.at[place])
        if self.kind[place] == _NAME:
            end = int(self.at[place + 1]) if place + 1 < len(self.at) else len(self.strings)
            while stop + 1 < end and self.all_kinds[stop + 1] == _NAME:
                stop += 1
        return " ".join(self.strings[at : stop + 1]).lower()

    def template(self, place: int, width: int, opened: bool = False) -> tuple[str, list[str]]:
        """The window as text with placeholders, and the values of its slots."""
        shown, slots = [], []
        for p in range(place, place + width):
            kind = _WORD if opened and p == place else int(self.kind[p])
            value = self.strings[int(self.at[p])].lower() if opened and p == place else self.text(p)
            shown.append(value if kind == _WORD else ("", "<number>", "<name>", "<unit>")[kind])
            if kind != _WORD:
                slots.append(value)
        return " ".join(shown), slots


#: A negative width is that of a window of exact tokens, which has no slots.
_ROWS = "place bigint, width int, hash bigint, template string, slots array<string>"


def _rows(kept: list[list], keys: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    place, width, hashes, shown, slots = kept
    made = [
        pa.array(place, pa.int64()),
        pa.array(width, pa.int32()),
        pa.array(np.array(hashes, np.uint64).view(np.int64)),
        pa.array(shown, pa.string()),
        pa.array(slots, pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays([*keys, *made], [*names, "place", "width", "hash", "template", "slots"])


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of each item: ``item_id``, place, width, hash, template, slots, ``windows``
    (their number in the item, one for an item with exact windows only) and ``exact``
    (the number of its exact windows)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        found = Templates(texts)
        sizes = np.bincount(found.row, minlength=batch.num_rows)
        kept, rows = [[], [], [], [], []], []
        for width in range(SHORTEST, WIDTH + 1):
            for place, hashed in zip(*found.windows(width), strict=True):
                row = int(found.row[place])
                if width == WIDTH or sizes[row] == width:
                    rows.append(row)
                    for column, value in zip(kept, (int(place - found.start[row]), width, hashed, *found.template(int(place), width)), strict=True):
                        column.append(value)
        total = np.bincount(np.array(rows, np.int64), minlength=batch.num_rows)
        exact = np.zeros(batch.num_rows, np.int64)
        for row, text in enumerate(texts):
            if total[row] and not _UNSPACED.search(text):
                continue
            whole = exact_tokens(text)
            if len(whole) >= SHORTEST:
                width = min(WIDTH, len(whole))
                hashes = exact_windows(whole, width)
                exact[row] = len(hashes)
                for place, hashed in enumerate(hashes):
                    rows.append(row)
                    for column, value in zip(kept, (place, -width, hashed, " ".join(whole[place : place + width]), []), strict=True):
                        column.append(value)
        made = _rows(kept, [batch.column(0).take(pa.array(rows, pa.int64()))], ["item_id"])
        of = np.array(rows, np.int64)
        made = made.append_column("windows", pa.array(np.maximum(total, 1)[of], pa.int64()))
        return made.append_column("exact", pa.array(exact[of], pa.int64()))

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return map_batches(benchmark.select("item_id", "text"), work, f"item_id {kind}, {_ROWS}, windows bigint, exact bigint")


def document_windows(docs: DataFrame, bits: bytes, widths: list[int]) -> DataFrame:
    """Windows of documents that the bitmap lets through, with ``doc_id`` and ``copy``,
    a hash of the whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        marked = np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool)
        texts = batch.column(2).to_pylist()
        rows, kept = [], [[], [], [], [], []]
        low = 0
        while low < len(texts):  # as many texts as make up one piece
            high, size = low, 0
            while high < len(texts) and (size == 0 or size + len(texts[high] or "") <= PIECE):
                size += len(texts[high] or "")
                high += 1
            found = Templates(texts[low:high])
            for width, opened in product([w for w in widths if w > 0], (False, True)):
                places, hashes = found.windows(width, opened)
                passed = marked[(hashes >> np.uint64(64 - PLACES)).astype(np.int64)]
                for place, hashed in zip(places[passed].tolist(), hashes[passed], strict=True):
                    row = int(found.row[place])
                    rows.append(low + row)
                    for column, value in zip(kept, (place - int(found.start[row]), width, hashed, *found.template(place, width, opened)), strict=True):
                        column.append(value)
            for row in range(low, high if widths and widths[0] < 0 else low):
                whole = exact_tokens(texts[row])
                for width in (-w for w in widths if w < 0):
                    hashes = exact_windows(whole, width)
                    for place in np.nonzero(marked[(hashes >> np.uint64(64 - PLACES)).astype(np.int64)])[0].tolist():
                        rows.append(row)
                        for column, value in zip(kept, (place, -width, hashes[place], " ".join(whole[place : place + width]), []), strict=True):
                            column.append(value)
            low = high
        index = pa.array(rows, pa.int64())
        return _rows(kept, [batch.column(0).take(index), batch.column(1).take(index)], ["doc_id", "copy"])

    given = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(given, work, f"doc_id {kind}, copy bigint, {_ROWS}")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and leaked item: ``doc_id``, ``copy``, ``item_id``,
    ``n_windows`` of the item, ``n_matched`` of them, ``verbatim`` (all of them stand at one
    offset with equal slots)."""
    items = written(benchmark_windows(benchmark), "benchmark-windows")
    place = F.shiftrightunsigned("hash", 64 - PLACES).cast("int")
    bitmap = np.zeros(1 << PLACES, bool)
    bitmap[[r[0] for r in items.select(place).distinct().toLocalIterator()]] = True
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    theirs = items.select(
        "item_id", F.col("place").alias("item_place"), "width", "hash", "template", F.col("slots").alias("item_slots"), "windows",
        F.when(F.col("width") < 0, F.col("exact")).otherwise(0).alias("exact"),
    )
    # windows that stand in one item only, and how many of them each item has
    own = items.where("width > 0").groupBy("width", "template").agg(F.min("item_id").alias("item_id"), F.max("item_id").alias("other"))
    own = own.where("item_id = other").select("width", "template", "item_id", F.lit(1).alias("own"))
    theirs = theirs.join(own, ["width", "template", "item_id"], "left")
    n_own = theirs.groupBy("item_id").agg(F.sum(F.coalesce("own", F.lit(0))).alias("n_own"))
    theirs = written(theirs.join(n_own, "item_id"), "own-windows")
    pairs = lookup_join(document_windows(docs, np.packbits(bitmap).tobytes(), widths), theirs, ["hash", "width", "template"])
    # copies of one row are told apart by nothing, so a match counts once for all of them
    pairs = pairs.withColumn("offset", F.col("place") - F.col("item_place"))
    slots = F.transform(F.arrays_zip("item_slots", "slots"), lambda s: F.struct(s["item_slots"].alias("a"), s["slots"].alias("b")))
    whole = pairs.groupBy("doc_id", "copy", "item_id", "windows", "exact", "n_own", "offset").agg(
        F.collect_set("item_place").alias("places"),
        F.array_distinct(F.flatten(F.collect_list(slots))).alias("slots"),
        F.max(F.coalesce("own", F.lit(0))).alias("own"),
    )
    all_places = F.when(F.col("exact") == 0, F.col("windows")).otherwise(F.col("exact"))
    same = (F.size("places") == all_places) & F.forall("slots", lambda s: s["a"] == s["b"])
    consistent = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["a"])))
    # an exact occurrence is the whole item, so all of its windows match
    complete = (F.col("exact") == 0) | (F.size("places") == F.col("exact"))
    places = F.when(F.col("exact") == 0, F.col("places"))
    by_item = (
        whole.where(consistent & complete)
        .groupBy("doc_id", "copy", "item_id", "windows", "n_own")
        .agg(
            F.greatest(
                F.size(F.array_distinct(F.flatten(F.collect_list(places)))).cast("long"),
                F.max(F.when(F.col("exact") > 0, F.col("windows"))),
            ).alias("n_matched"),
            F.max(same).alias("verbatim"),
            F.max(F.greatest("own", F.when(F.col("exact") > 0, 1).otherwise(0))).alias("own"),
        )
    )
    enough = (100 * F.col("n_matched") >= SHARE_PERCENT * F.col("windows")) | (F.col("n_matched") >= ENOUGH)
    several = F.col("n_matched") >= F.least(F.lit(2), "windows")
    special = (F.col("own") > 0) | (F.col("n_own") == 0)
    return by_item.where(enough & several & special).select("doc_id", "copy", "item_id", F.col("windows").alias("n_windows"), "n_matched", "verbatim")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no leaked item. Texts decide, so rows without
    ``doc_id`` and rows that share one are judged each by its own text."""
    found = written(leaks(docs, benchmark).select("copy").distinct(), "leaks").withColumnRenamed("copy", "_copy")
    names = docs.columns
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_copy"))
    return lookup_join(packed, found, "_copy", "left_anti").select(*(F.col("_row")[c].alias(c) for c in names))
