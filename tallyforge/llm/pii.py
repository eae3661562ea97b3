"""Personal data by weak supervision.

Fixed base rules find e-mail, ip, card and phone spans; they always stay. Wider rules
propose further candidates (``number``, ``local_phone``, ``id_number``, ``hidden_email``,
``secret``, ``name``). Five labelers (format, context before, context against, gazetteer,
edges) vote for, against or not at all on every candidate and base span. Votes and a few
coarse features are counted over the whole corpus; their combinations are bounded by the
product of their values, 58,320, so the counts fit the driver at any corpus size. On them
expectation-maximisation estimates how reliable each labeler is and how common each kind
is, and the posteriors train the final classifier, a logistic regression on the features
alone. A candidate becomes a span when the classifier gives it one half or more. Candidates
are taken whole: a value that is too long for its kind is spoken against by the format
labeler, never cut. Of a run of digit groups longer than any card number, as of cards in a
row, the parts that pass Luhn are proposed.

Null text counts as empty. Overlapping spans of different kinds are all reported; in a
redacted text they are one gap named after the first. Repeated rows are treated alike.
"""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "number", "local_phone", "id_number", "hidden_email", "secret", "name")
VOTERS = ("format", "context", "against", "gazetteer", "edges")
ROUNDS = 50
STEPS = 400
#: Characters of context that labelers read on either side.
CONTEXT = 40

#: Context words, mail providers and given names (fixed values).
SPEAKS_FOR = "call phone tel mobile fax contact mail email reach write card visa mastercard credit account ip address host server token password passwd secret key ssn passport name mr mrs ms dr prof"
SPEAKS_AGAINST = "version isbn issn doi page chapter section figure table equation order item build revision rfc"
PROVIDERS = "gmail yahoo hotmail outlook icloud proton gmx aol mail example"
GIVEN = "alice bob carol david emma frank grace henry james john julia karen kevin laura linda lisa maria mark martin mary michael peter robert sarah susan thomas"

_FOR, _AGAINST = frozenset(SPEAKS_FOR.split()), frozenset(SPEAKS_AGAINST.split())
_PROVIDERS, _GIVEN = frozenset(PROVIDERS.split()), frozenset(GIVEN.split())

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Groups that cards are printed in.
_CARD_SHAPE = re.compile(r"[0-9]+|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,4})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}")
_DIGIT_RUN = re.compile("[0-9]+")
_DIGITS = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_ID_NUMBER = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_HIDDEN_AT = re.compile(r"[\[(]at[\])] ?")
_HIDDEN_DOT = re.compile(r" ?(?:\.|[\[(]dot[\])]) ?")
_HIDDEN_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:{_HIDDEN_DOT.pattern}[A-Za-z0-9-]+)+")
_ASSIGNED = re.compile(r"[=:]\s{0,3}[\"']?")
_VALUE = re.compile(r"[^\s\"',;]{6,}")
_SECRET_NAME = re.compile(r"(?:token|password|passwd|pwd|secret|(?:api|access|private)[_-]?key)\s{0,3}$", re.IGNORECASE)
_ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")
_BEARER = re.compile(r"\b[Bb]earer\s{1,3}([A-Za-z0-9._~+/=-]{16,})")
_ISSUED = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk_live_|sk-)[A-Za-z0-9_-]{16,}")
_KEY_BEGIN = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
_KEY_BODY = re.compile(r"(?:\s*[A-Za-z0-9+/=]{16,}+)*+")
_KEY_END = re.compile(r"-----END [A-Z ]{0,30}PRIVATE KEY-----")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_CAPITALISED = r"[A-Z][\w'-]+(?: [A-Z][\w'-]+)*"
_NAMED = re.compile(rf"\b[Mm]y name is ({_CAPITALISED})")
_GIVEN_RUN = re.compile(rf"\b(?:{'|'.join(sorted(w.capitalize() for w in _GIVEN))}) {_CAPITALISED}")
_TITLED = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.? ([A-Z][\w'-]+(?: [A-Z][\w'-]+)*)")
_WORDS = re.compile(r"[a-z]+")
_GIVEN_CAPITAL = tuple(w.capitalize() for w in _GIVEN)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the base rule. The local part is the run of its characters
    before an ``@``, so each ``@`` is looked at once, whatever stands between."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        done = domain.end() if domain else at + 1
        at = text.find("@", done)
    return found


def hidden_emails(text: str) -> list[tuple[int, int]]:
    """Addresses with a spelt-out at sign, of any length; each sign is looked at once."""
    found, done = [], 0
    for sign in _HIDDEN_AT.finditer(text):
        start = stop = sign.start() - (sign.start() > done and text[sign.start() - 1] == " ")
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _HIDDEN_DOMAIN.match(text, sign.end()) if start < stop else None
        if domain:
            found.append((start, domain.end()))
        done = max(done, domain.end() if domain else sign.end())
    return found


def assigned_secrets(text: str) -> list[tuple[int, int]]:
    """Whole values behind the name of a secret. What begins inside a found value is part
    of it, so each run of characters is read once."""
    found, done = [], 0
    for m in _ASSIGNED.finditer(text):
        if m.end() >= done and _SECRET_NAME.search(text, max(0, m.start() - 20), m.start()):
            value = _VALUE.match(text, m.end())
            if value:
                found.append(value.span())
                done = value.end()
    return found


def private_keys(text: str) -> list[tuple[int, int]]:
    """Whole key blocks; one without an end goes as far as its long runs do."""
    found, done, ends = [], 0, [m.span() for m in _KEY_END.finditer(text)]
    starts = [m for m in _KEY_BEGIN.finditer(text)]
    for m, after in zip(starts, [*(n.start() for n in starts[1:]), len(text)], strict=True):
        while done < len(ends) and ends[done][0] < m.end():
            done += 1
        if done < len(ends) and ends[done][0] < after:
            found.append((m.start(), ends[done][1]))
        else:
            body = _KEY_BODY.match(text, m.end(), after)
            found.append((m.start(), body.end()))
    return found


def numbers_within(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Parts of a longer run of digit groups that are 13 to 19 digits from the edge of a group
    to the edge of another and pass Luhn: the longest of each first group. A part has 19
    groups at most, so the time is linear."""
    groups = [m.span() for m in _DIGIT_RUN.finditer(text, start, end)]
    found = []
    for i in range(len(groups)):
        digits, best = "", None
        for a, b in groups[i : i + 19]:
            if len(digits) + b - a > 19:
                break
            digits += text[a:b]
            if len(digits) >= 13 and luhn(digits):
                best = b
        if best is not None:
            found.append((groups[i][0], best))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base rules, in order."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` that the wider rules propose outside base spans."""
    found = []
    if _DIGIT.search(text):
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 13:
                continue
            size = sum(c.isdigit() for c in m[0])
            if 13 <= size <= 19:
                found.append((m.start(), 4, m.end()))
            elif size > 19:
                found += [(a, 4, b) for a, b in numbers_within(text, m.start(), m.end())]
        found += [(m.start(), 4, m.end()) for m in _DIGITS.finditer(text)]
        found += [(m.start(), 5, m.end()) for m in _LOCAL_PHONE.finditer(text)]
        if "-" in text:
            found += [(m.start(), 6, m.end()) for m in _ID_NUMBER.finditer(text)]
        found += [(m.start(), 6, m.end()) for m in _IBAN.finditer(text)]
    if "[at]" in text or "(at)" in text:
        found += [(a, 7, b) for a, b in hidden_emails(text)]
    if "=" in text or ":" in text:
        found += [(a, 8, b) for a, b in assigned_secrets(text)]
    if "earer" in text:
        found += [(m.start(1), 8, m.end(1)) for m in _BEARER.finditer(text)]
    if "_" in text or "-" in text:
        found += [(m.start(), 8, m.end()) for m in _ISSUED.finditer(text)]
    if "-----BEGIN" in text:
        found += [(a, 8, b) for a, b in private_keys(text)]
    if "AKIA" in text:
        found += [(m.start(), 8, m.end()) for m in _ACCESS_KEY.finditer(text)]
    if "Mr" in text or "Ms" in text or "Dr" in text or "Prof" in text:
        found += [(m.start(1), 9, m.end(1)) for m in _TITLED.finditer(text)]
    if "y name is" in text:
        found += [(m.start(1), 9, m.end(1)) for m in _NAMED.finditer(text)]
    if any(w in text for w in _GIVEN_CAPITAL):
        found += [(m.start(), 9, m.end()) for m in _GIVEN_RUN.finditer(text)]
    out, edges = [], sorted((a, b) for a, _, b in base)
    for span in sorted(set(found)):
        low = _first_after(edges, span[0])
        across = False
        while low < len(edges) and edges[low][0] < span[2] and not across:
            across = edges[low][1] > span[0]
            low += 1
        if not across:
            out.append(span)
    return out


def _first_after(edges: list[tuple[int, int]], low: int) -> int:
    """Index of the first base span that can reach ``low``: spans of one kind never overlap,
    so at most four lie across a place."""
    from bisect import bisect_left

    return max(0, bisect_left(edges, (low, low)) - 4)


def described(text: str, span: tuple[int, int, int]) -> tuple[int, ...]:
    """Kind, the votes (0 none, 1 for, 2 against) and the features of one span."""
    start, kind, end = span
    value = text[start:end]
    near = set(_WORDS.findall(text[max(0, start - CONTEXT) : start].lower()))
    digits = [c for c in value if c.isdigit()]
    context = 1 if near & _FOR else 0
    against = 2 if near & _AGAINST else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = 2 if left.isalnum() or right.isalnum() else 0  # clean edges speak for nothing
    return (
        kind,
        _format_vote(kind, value, digits),
        context,
        against,
        _gazetteer_vote(kind, value, digits),
        edges,
        min(3, len(value) // 10),
        0 if not digits else 1 if 2 * len(digits) < len(value) else 2,
        int(any(c.isupper() for c in value)),
    )


def _format_vote(kind: int, value: str, digits: list[str]) -> int:
    if kind == 4:
        return 2 if not luhn("".join(digits)) else 1 if _CARD_SHAPE.fullmatch(value) else 0
    if kind == 5:
        return 2 if digits[0] in "01" else 1
    if kind == 6 and value[0].isalpha():
        turned = (value[4:] + value[:4]).replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 else 2
    if kind == 6:
        return 2 if "".join(digits[:3]) in ("000", "666") or digits[3:5] == ["0", "0"] else 1
    if kind == 7:
        local, domain = _HIDDEN_AT.split(value, maxsplit=1)
        labels = _HIDDEN_DOT.split(domain)
        return 2 if len(local.rstrip()) > 64 or len(labels) > 9 or max(map(len, labels)) > 63 else 1
    if kind == 9:
        return 2 if max(map(len, value.split())) > 41 else 0 if value.count(" ") > 3 else 1
    if kind == 8 and value.startswith("-----BEGIN"):
        return 1
    if kind == 8:
        return 1 if digits and any(c.isalpha() for c in value) else 2
    if kind == 2:
        return 2 if len(set(digits)) < 3 else 1
    return 1


def _gazetteer_vote(kind: int, value: str, digits: list[str]) -> int:
    low = value.lower()
    if kind in (0, 7):
        return 1 if any(w.rstrip("0123456789") in _PROVIDERS for w in re.split(r"[^a-z0-9]+", low)) else 0
    if kind in (2, 4):
        return 1 if digits[0] in "456" or "".join(digits[:2]) in ("34", "37") else 0
    if kind == 1:
        return 2 if low.startswith(("0.", "255.")) else 0
    if kind == 9:
        return 1 if low.split()[0] in _GIVEN else 0
    return 0


#: Values of each field of ``described``; their product bounds what the driver gets.
SIZES = (len(KINDS), 3, 3, 3, 3, 3, 4, 3, 2)


def _features(rows: np.ndarray) -> np.ndarray:
    """One-hot features of described spans without their votes, and the bias."""
    used = [0, 2, 3, 5, 6, 7, 8]
    parts = [np.eye(len(KINDS) if i == 0 else 4)[rows[:, i]] for i in used]
    # how the format looks within a kind is a property of the text, not a vote
    parts.append(np.eye(len(KINDS) * 3)[rows[:, 0] * 3 + rows[:, 1]])
    return np.concatenate([*parts, np.ones((len(rows), 1))], axis=1)


def reliabilities(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each labeler is right when it votes, and the posterior of every row, by
    expectation-maximisation. A labeler is held to be better than chance."""
    votes = rows[:, 1 : 1 + len(VOTERS)]
    right, prior = np.full(len(VOTERS), 0.8), np.full(len(KINDS), 0.5)
    for _ in range(ROUNDS):
        with np.errstate(divide="ignore"):
            odds = np.log(right) - np.log1p(-right)
        start = prior[rows[:, 0]]
        z = np.log(start) - np.log1p(-start) + ((votes == 1) * odds - (votes == 2) * odds).sum(1)
        true = 1 / (1 + np.exp(-z))
        agree = (votes == 1) * true[:, None] + (votes == 2) * (1 - true[:, None])
        right = np.clip(((agree * counts[:, None]).sum(0) + 8) / (((votes > 0) * counts[:, None]).sum(0) + 10), 0.55, 0.99)
        mass = np.bincount(rows[:, 0], counts * true, len(KINDS)) + 1
        prior = np.clip(mass / (np.bincount(rows[:, 0], counts, len(KINDS)) + 2), 0.05, 0.95)
    return right, true


class Model:
    """Weights of the span classifier, fitted to counted descriptions."""

    def __init__(self, rows: np.ndarray, counts: np.ndarray):
        self.weights = None
        if not len(rows):
            return
        self.right, soft = reliabilities(rows, counts)
        x, share = _features(rows), counts / counts.sum()
        weights = np.zeros(x.shape[1])
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-x @ weights))
            weights -= 2.0 * (x.T @ (share * (p - soft)) + 1e-4 * weights)
        self.weights = weights

    def accepts(self, text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        if self.weights is None or not spans:
            return []
        z = _features(np.array([described(text, s) for s in spans])) @ self.weights
        return [s for s, yes in zip(spans, z >= 0, strict=True) if yes]


def fit(docs: DataFrame) -> Model:
    """Count the descriptions of all spans of all texts and train on the counts."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes = []
        for text in batch.column(0).to_pylist():
            base = base_spans(text or "")
            codes += [int(np.ravel_multi_index(described(text, s), SIZES)) for s in base + candidates(text or "", base)]
        values, counts = np.unique(np.array(codes, np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["code", "n"])

    counted = map_batches(docs.select("text"), work, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    rows = sorted((r["code"], r["n"]) for r in counted.collect())
    codes = np.array([c for c, _ in rows], np.int64)
    described_rows = np.stack(np.unravel_index(codes, SIZES), axis=1) if rows else np.zeros((0, len(SIZES)), np.int64)
    return Model(described_rows, np.array([n for _, n in rows], float))


def spans_of(text: str | None, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of a text."""
    base = base_spans(text or "")
    return base, sorted(base + model.accepts(text or "", candidates(text or "", base)))


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key``, the number of base spans by kind, ``base`` and ``spans`` as
    ``kind:start:end`` joined by commas."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [spans_of(t, model) for t in batch.column(1).to_pylist()]
        counts = [pa.array([sum(k == kind for _, k, _ in b) for b, _ in both], pa.int64()) for kind in range(len(BASE))]
        texts = [pa.array([shown(s[i]) for s in both], pa.string()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, *texts], [key, *names, "base", "spans"])

    names = [f"n_{kind}" for kind in BASE]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {', '.join(f'{n} bigint' for n in names)}, base string, spans string"
    return map_batches(docs.select(key, "text"), work, schema)


def redacted_text(text: str | None, model: Model) -> str | None:
    """The text with a gap such as ``<email>`` in place of every span."""
    if text is None:
        return None
    out, done = [], 0
    for start, kind, end in spans_of(text, model)[1]:
        if start >= done:
            out += text[done:start], f"<{KINDS[kind]}>"
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with redacted ``text`` and, where it is a column, its new length in ``n_chars``."""
    names = docs.columns
    at = names.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        before = columns[at].to_pylist()
        texts = [redacted_text(t, model) for t in before]
        columns[at] = pa.array(texts, pa.string())
        if "n_chars" in names:
            counts = names.index("n_chars")
            lengths = [n if t == u else len(u) for n, t, u in zip(columns[counts].to_pylist(), before, texts, strict=True)]
            columns[counts] = pa.array(lengths, columns[counts].type)
        return pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, work, schema)
