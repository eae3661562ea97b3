"""URL filter: host and path rules, and for the rest logistic regression on hashed character
n-grams of host and path, trained from a small labelled table.

The table is made by one rule from words that name unwanted sites and words that name others,
each alone and beside words that stand with both. A gram counts by its rarity in the table.
Training runs in the driver: the labelled table is small by contract and its size is checked.
The threshold is set on hosts that the weights never saw. Weights are one array of
``2 ** BITS`` numbers, sent with the task. A null url or one without ``://`` has an empty host
and path; the classifier allows it, having no gram. Repeated urls get equal verdicts, an empty
table has no rows, and further columns are not looked at.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_batches

BITS = 16
GRAMS = (3, 4, 5)
STEPS = 300
RATE = 2.0
PENALTY = 1e-4
#: Parts that the labelled table is held out in, by host, and the share of wanted rows that
#: may be blocked there.
FOLDS = 8
FALSE_ALARMS = 0.02
MOST_LABELS = 10_000

#: Rules: verdict and host with path prefix (fixed values of the contract).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

#: Words that name unwanted sites, and words that name others, some of which share letters
#: with the former (fixed values).
UNWANTED = """
casino poker slots roulette jackpot blackjack gambling gamble bets betting bingo wager
pills pharmacy viagra cialis steroids tramadol xanax
porn xxx adult sex sexy cams escort nude erotic hookup fetish
warez torrent keygen crack cracked nulled pirate serials
malware exe phishing trojan spyware botnet carding hacked
spam seo backlinks clickbait ads adserver popunder popups
payday replica counterfeit lottery sweepstakes winner casinos getrich moneyfast
""".split()
WANTED = """
library museum university school hospital weather recipes gardening history science journal research news sports nature
music theatre cinema maps travel railway bank insurance loans student students farmers farm farming market markets council
city government parliament law court health clinic medicine books poetry language dictionary wiki docs forum blog
engineering software code data archive photo photography painting architecture physics chemistry biology astronomy geology
mathematics statistics economics business jobs careers network linked links linking track tracking tracks server servers
tickets hotel food kitchen coffee wine winery garden flower birds animals ocean river mountain forest island village town
bridge station airport cycling running football tennis chess alphabets pillar pillow spanish essex sussex exeter crackers
roads heads uploads winter window wind winning cameras campus scripts slow lottie expert exercise exchange index texas
sexton seoul season porter portal pokemon sport support report export training translate hacker hackathon malta popular
population pharmacology adulthood adoption address advice administration radio shadows betty better alpha beta clicker
drug-safety consumer energy climate children family community church charity foundation institute academy college center
""".split()
#: Words that stand beside both kinds, and paths of both (fixed values).
BESIDE = """
best online free my the world site go top plus cheap buy shop live play new hub zone club express now today pro big super
easy fast local daily home one first global web net info guide play24 deals store club5 max star sun
""".split()
PATHS = "/ /en/12 /de/7 /index.html /page/44 /fr/3.html /a/b /es/9?x /list /view/123".split()
#: Sites made of each word.
SITES = 5


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host_: Column, path_: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    named, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(RULES, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host_ == domain) | host_.endswith("." + domain)) & path_.startswith(slash + rest)
        named, verdict = F.when(fits, F.lit(text)).otherwise(named), F.when(fits, F.lit(said)).otherwise(verdict)
    return named, verdict


def grams(name: str, where: str) -> np.ndarray:
    """Slots of the hashed character n-grams of one host and path, which are told apart."""
    found = set()
    for field, text in (("h", f"^{name}$"), ("p", re.sub(r"\d+", "0", where))):
        for n in GRAMS:
            found.update(field + text[i : i + n] for i in range(len(text) - n + 1))
    return np.fromiter((crc32(g.encode()) & ((1 << BITS) - 1) for g in sorted(found)), np.int64, len(found))


def _descended(slots: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Weights, the last one the bias, by gradient descent on the mean log loss; both labels
    weigh the same in all, and a gram counts by its rarity among the labelled urls."""
    flat, rows = np.concatenate(slots), np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    rarity = np.log((1 + len(y)) / (1 + np.bincount(flat, minlength=1 << BITS)))
    values = rarity[flat] * np.array([max(1, len(s)) ** -0.5 for s in slots])[rows]
    shares = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weights, bias = np.zeros(1 << BITS), 0.0
    for _ in range(STEPS):
        z = np.bincount(rows, values * weights[flat], len(slots)) + bias
        error = (1 / (1 + np.exp(-z)) - y) * shares
        weights -= RATE * (np.bincount(flat, error[rows] * values, 1 << BITS) + PENALTY * weights)
        bias -= RATE * error.sum()
    return np.append(weights * rarity, bias)


def _decision(slots: np.ndarray, weights: np.ndarray) -> float:
    return weights[slots].sum() * max(1, len(slots)) ** -0.5 + weights[-1]


def held_out(labelled: list[tuple[str, str, int]], folds: int = FOLDS) -> tuple[np.ndarray, np.ndarray]:
    """Decisions and labels of all rows, each by weights that never saw its host."""
    slots, y = [grams(h, p) for h, p, _ in labelled], np.array([label for _, _, label in labelled], float)
    fold = np.array([crc32(h.encode()) % folds for h, _, _ in labelled])
    decisions = np.zeros(len(y))
    for k in np.unique(fold):
        rest = np.nonzero(fold != k)[0]
        weights = _descended([slots[i] for i in rest], y[rest]) if len(rest) else np.zeros((1 << BITS) + 1)
        decisions[fold == k] = [_decision(slots[i], weights) for i in np.nonzero(fold == k)[0]]
    return decisions, y


def threshold(decisions: np.ndarray, y: np.ndarray) -> float:
    """The least decision from which on at most ``FALSE_ALARMS`` of the wanted rows are blocked."""
    wanted = np.sort(decisions[y == 0])[::-1]
    allowed = int(FALSE_ALARMS * len(wanted))
    return float(np.nextafter(wanted[allowed], np.inf)) if len(wanted) > allowed else 0.0


def train(labelled: list[tuple[str, str, int]]) -> np.ndarray:
    """Weights, the last one the bias. The bias is moved so that a score of one half is the
    threshold set on held-out hosts."""
    if len(labelled) > MOST_LABELS:
        raise ValueError(f"the labelled table is meant to be small: at most {MOST_LABELS} rows")
    y = np.array([label for _, _, label in labelled], float)
    weights = _descended([grams(h, p) for h, p, _ in labelled], y)
    weights[-1] -= max(0.0, threshold(*held_out(labelled)))
    return weights


def default_labels() -> list[tuple[str, str, int]]:
    """The labelled table: each word alone and beside others, by one rule for both labels."""
    rows = []
    for label, words in ((1, UNWANTED), (0, WANTED)):
        for i, word in enumerate(words):
            for j in range(SITES):
                other = BESIDE[(7 * i + 11 * j) % len(BESIDE)]
                name = (word, f"{other}-{word}", f"{word}{other}", f"{word}-{other}", f"{other}{word}")[j % 5]
                rows.append((name, PATHS[(i + 3 * j) % len(PATHS)].partition("?")[0], label))
    return rows


def scored(parts: DataFrame, weights: np.ndarray) -> DataFrame:
    """``parts`` (with ``host`` and ``path``) and ``score``, how likely a url is unwanted.
    A host is read as a whole and as a host under a suffix of two labels; the higher counts."""
    names = parts.columns
    at_host, at_path = names.index("host"), names.index("path")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = []
        for h, p in zip(batch.column(at_host).to_pylist(), batch.column(at_path).to_pylist(), strict=True):
            read = [grams(name, p) for name in readings(h)] if h else []
            z = max((_decision(s, weights) for s in read), default=-9.0)
            scores.append(float(1 / (1 + np.exp(-z))))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return map_batches(parts, work, f"{schema}, score double")


def whole_name(name: str) -> str:
    """A host without its last label and without a leading ``www``, where others are left."""
    labels = name.split(".")
    labels = labels[:-1] or labels
    return ".".join(labels[1:] if labels[0] == "www" and len(labels) > 1 else labels)


def readings(name: str) -> list[str]:
    """The whole name and, as the last two labels may be a suffix under which hosts of
    others stand, what is before them without www, m and blog. The whole name always counts."""
    own = ".".join(x for x in name.split(".")[:-2] if x not in ("www", "m", "blog"))
    return list(dict.fromkeys(x for x in (whole_name(name), own) if x))


def judged(pages: DataFrame, labelled: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of each url."""
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    named, said = rule(F.col("host"), F.col("path"))
    return scored(parts, train(labelled or default_labels())).select(
        "page_id",
        "host",
        "path",
        named.alias("rule"),
        F.coalesce(said, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
