"""Byte-level BPE: encode to ids and decode back.

A text is cut by the vocabulary's own word rule; each word is merged over a doubly linked
list of symbols with a priority queue of merge ranks, where an entry whose symbols have
changed meanwhile is skipped. Ids travel as little-endian unsigned 32-bit integers in one
binary value. Decoding concatenates the vocabulary strings and reads their bytes.

Null text counts as empty: no ids, an empty text back. A single word of any length costs
its length times the logarithm.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyforge.llm.common import Remembered, map_batches

#: Stretches of text that a worker remembers in each of two generations.
REMEMBERED = 120_000
#: Bits of a place or an id within a packed number.
PLACE = 32
LOW = (1 << PLACE) - 1
#: White space of Unicode, as the vocabulary's word rule means it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The word rule of the vocabulary (a fixed value).
WORDS = regex.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: A space before a character that isn't white space always begins a word, so a text may be
#: cut there; LOOSE finds texts that have other spaces too.
TIGHT = re.compile(f" (?=[^{SPACE}])")
LOOSE = re.compile(f" (?![^{SPACE}])")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        joined = [(vocab[x], vocab[y], vocab[x + y]) for x, y in pairs]
        self.rank = {left << PLACE | right: rank << PLACE for rank, (left, right, _) in enumerate(joined)}
        self.result = [new for _, _, new in joined]
        alphabet = byte_alphabet()
        self.of_byte = [vocab[c] for c in alphabet]
        self.of_bytes = [self.rank.get(x << PLACE | y, -1) for x in self.of_byte for y in self.of_byte]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known = Remembered(self.word, remembered)
        self.first = Remembered(self.stretch, remembered // 32)
        self.later = Remembered(self.piece, remembered)
        self.pack = [struct.Struct(f"<{n}I").pack for n in range(64)]

    def merged(self, word: bytes) -> list[int]:
        """Ids of one word. A queue entry is a rank and the place of its left symbol; it is
        stale if the symbols that stand there now don't merge with that rank."""
        of_bytes, rank_of, result = self.of_bytes, self.rank.get, self.result
        symbols = [self.of_byte[b] for b in word]
        # the rank of the symbol at each place with the one after it, above the place's bits
        live = [of_bytes[b << 8 | c] for b, c in zip(word, word[1:])]
        queue = [rank | at for at, rank in enumerate(live) if rank >= 0]
        if not queue:
            return symbols
        live.append(-1)
        end = len(symbols)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        heapify(queue)
        while queue:
            entry = heappop(queue)
            at = entry & LOW
            if live[at] != entry - at:
                continue
            then = after[at]
            new = symbols[at] = result[entry >> PLACE]
            symbols[then] = live[then] = -1
            follow = after[at] = after[then]
            if follow < end:
                before[follow] = at
                rank = live[at] = rank_of(new << PLACE | symbols[follow], -1)
                if rank >= 0:
                    heappush(queue, rank | at)
            else:
                live[at] = -1
            lead = before[at]
            if lead >= 0:
                rank = live[lead] = rank_of(symbols[lead] << PLACE | new, -1)
                if rank >= 0:
                    heappush(queue, rank | lead)
        return [s for s in symbols if s >= 0]

    def word(self, text: str) -> bytes:
        ids = self.merged(text.encode())
        return self.pack[len(ids)](*ids) if len(ids) < len(self.pack) else struct.pack(f"<{len(ids)}I", *ids)

    def stretch(self, text: str) -> bytes:
        """Ids of a part of a text that begins and ends where words do."""
        words = WORDS.findall(text)
        return self.known[words[0]] if len(words) == 1 else b"".join(map(self.known.__getitem__, words))

    def piece(self, text: str) -> bytes:
        """Ids of a space and the stretch after it. Letters or digits of ASCII alone are one word with it."""
        if text.isascii() and (text.isalpha() or text.isdigit()):
            return self.known[" " + text]
        return self.stretch(" " + text)

    def encode(self, text: str) -> bytes:
        """All ids of a text, four bytes each."""
        out = []
        for part in self.split_special.split(text) if any(map(text.__contains__, self.special)) else [text]:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                first, *later = part.split(" ") if not LOOSE.search(part) else TIGHT.split(part)
                out.append(self.first[first])
                out += map(self.later.__getitem__, later)
        return b"".join(out)


class Decoder:
    """The strings of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        value = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = spec["model"]["vocab"]
        self.strings = {i: bytes(value[c] for c in s) for s, i in vocab.items() if all(c in value for c in s)}
        self.strings |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", ())}

    def decode(self, ids: bytes) -> str:
        """The text of the concatenated vocabulary strings."""
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One per Python worker; what it remembers serves later tasks."""
    return Encoder(path, remembered)


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, path: str, keys: list[str], remembered: int = REMEMBERED) -> DataFrame:
    """``keys``, ``ids`` (binary) and ``n_tokens`` of each row's ``text``. ``remembered`` words and
    pieces in a generation trade a worker's memory for time; the ids are the same."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        use = encoder(path, remembered)
        ids = [use.encode(t or "") for t in batch.column(len(keys)).to_pylist()]
        made = {"ids": pa.array(ids, pa.binary()), "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64())}
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *made.values()], [*keys, *made])

    given = docs.select(*keys, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return map_batches(given, work, f"{schema}, ids binary, n_tokens bigint")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encoded`` with the column ``decoded``."""
    names = encoded.columns
    at = names.index("ids")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        use = decoder(path)
        texts = pa.array([use.decode(i or b"") for i in batch.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, texts], [*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return map_batches(encoded, work, f"{schema}, decoded string")
