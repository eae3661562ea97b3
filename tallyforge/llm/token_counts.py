"""Token counts of a sentence-piece model, also for texts too long to encode at once.

Short texts are encoded whole. A huge one is encoded in overlapping chunks; both
encodings of an overlap are laid side by side by byte offset and spliced at a boundary
that both have and that is proven stable. When an overlap holds none it is widened, up to
the rest of the text, so a count is exact at any length.

Why a boundary is stable: the vocabulary has no piece in which the space mark follows
another character (checked when a model is loaded), so no merge ever spans the place
between a character and the single space after it; and a chunk that starts right after
such a space gets the same mark from the model's own leading space. Both sides therefore
encode as they do in the whole text. Should a model have such a piece, or rewrite its
input, texts are encoded whole.

Null text counts as empty: 0 bytes, 0 tokens.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyforge.llm.common import map_batches

#: Characters of a chunk and of the first overlap tried.
CHUNK = 1 << 15
OVERLAP = 1 << 8
#: Texts of more characters than this are encoded by chunks.
HUGE = 1 << 16
MARK = "▁"
_START = regex.compile(r"(?<=[^ ] )[^ ]")


class Counter:
    """Counts with one model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = any(regex.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        probe = " a  b ﬁÅ\tc "
        self.splits = not crossing and self.model.decode(self.model.encode(probe)) == probe
        self.bytes_of = np.array(
            [1 if self.model.is_byte(i) else len(p.replace(MARK, " ").encode()) for i, p in enumerate(pieces)], np.int64
        )

    def ends(self, chunk: str) -> np.ndarray:
        """Byte offset in ``chunk`` after each of its tokens."""
        ids = np.asarray(self.model.encode(chunk, num_threads=1), np.int64)
        return np.cumsum(self.bytes_of[ids]) - 1  # the model's own leading space

    def spliced(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a long text, chunk by chunk."""
        text = text.replace(MARK, " ")  # the model takes both for the same mark
        total, start = 0, 0
        while True:
            if len(text) - start <= chunk + overlap:
                return total + len(self.ends(text[start:]))
            wide, splice = overlap, None
            while splice is None and start + chunk + wide < len(text):
                splice = self.splice(text, start, start + chunk, start + chunk + wide)
                wide *= 2
            if splice is None:
                return total + len(self.ends(text[start:]))
            tokens, start = splice
            total += tokens

    def splice(self, text: str, start: int, left: int, right: int) -> tuple[int, int] | None:
        """Tokens from ``start`` to a common boundary in ``[left, right)``, and where the
        text goes on. None if the two encodings of the overlap agree on no stable place."""
        after = _START.search(text, left, right)
        if not after:
            return None
        first = after.start()  # the later chunk begins here, behind a single space
        ours = self.ends(text[start:right])
        theirs = self.ends(text[first:right])
        base = len(text[start:first].encode())
        shared = {int(e) for e in theirs} | {-1}
        for place in [after, *_START.finditer(text, first + 1, right)]:
            at = len(text[start : place.start()].encode()) - 1  # the boundary before the space
            found = int(np.searchsorted(ours, at))
            if found < len(ours) and ours[found] == at and at - base in shared:
                return found + 1, place.start()
        return None

    def count(self, texts: list[str]) -> list[int]:
        huge = [len(t) > HUGE and self.splits for t in texts]
        short = iter(self.model.encode([t for t, h in zip(texts, huge, strict=True) if not h], num_threads=1))
        return [self.spliced(t) if h else len(next(short)) for t, h in zip(texts, huge, strict=True)]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", limit: int = 4096) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row's ``text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        counts = counter(path).count(texts)
        made = [
            batch.column(0),
            pa.array([len(t.encode()) for t in texts], pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array([n > limit for n in counts], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(made, [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs.select(key, "text"), work, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
