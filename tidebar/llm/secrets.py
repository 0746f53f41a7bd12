"""Secret scans: fixed patterns, and character Markov models for the rest.

Edge cases: a null text is empty; a text without spans has the digest of the
empty string; an empty table gives no rows; repeated rows each give a row;
further columns of the input are ignored; a very long text takes time linear in
its length. The models learn from whole texts of a bounded sample of rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from hashlib import sha256
from itertools import accumulate
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, map_texts, table

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
# A run is matched whole, so the least lengths can stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: What the models judge: unbroken runs of the characters of keys.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

#: Rows of the labelled sample that the models learn from, whole texts each.
SAMPLE_DOCS = 4000
#: Mean log-likelihood ratio in nats for each character from which a run is a secret, where no held-out strings say another one.
THRESHOLD = 0.5
#: One string in HELD_OUT is kept from the models, to set the threshold by.
HELD_OUT = 4
#: Shares of the held-out strings: ordinary ones that may be above the threshold, random ones that may be below.
PLAIN_ABOVE, RANDOM_BELOW = 0.001, 0.05

_CLASS = np.full(128, 64, np.int64)
for _i, _c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
    _CLASS[ord(_c)] = _i
_CLASS[ord("\n")] = 65
_N = 66  # the 64 above, any other one, and the start


def _codes(run: str) -> np.ndarray:
    b = np.frombuffer(run.encode("ascii", "replace"), np.uint8)
    return np.concatenate([[65], _CLASS[b & 127]])


def steps(runs: list[str]) -> np.ndarray:
    """How often each class follows each other one in the runs, the start included; flat."""
    if not runs:
        return np.zeros(_N * _N, np.int64)
    c = _CLASS[np.frombuffer("".join("\n" + r for r in runs).encode("ascii", "replace"), np.uint8) & 127]
    pairs = c[:-1] * _N + c[1:]
    return np.bincount(pairs[c[1:] != 65], minlength=_N * _N)


class MarkovPair:
    """First-order character models of random strings and of ordinary identifiers, from the counts of their steps."""

    def __init__(self, random_steps: np.ndarray, plain_steps: np.ndarray, threshold: float = THRESHOLD):
        self.ratio = self._table(random_steps) - self._table(plain_steps)
        self.threshold = threshold

    @staticmethod
    def _table(counts: np.ndarray) -> np.ndarray:
        counts = counts.reshape(_N, _N) + 0.5
        return np.log(counts / counts.sum(1, keepdims=True))

    def score(self, run: str) -> float:
        """Mean log-likelihood ratio for each character."""
        c = _codes(run)
        return float(self.ratio[c[:-1], c[1:]].mean())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class _Touched:
    """Whether a stretch of the text meets one of the sorted spans."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s for s, _, _ in spans]
        self.ends = list(accumulate((e for _, _, e in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def one_word(run: str) -> bool:
    return not any(c.isdigit() for c in run) and (run.islower() or run.istitle() or run.isupper())


def find(text: str, models: MarkovPair | None) -> tuple[list, list]:
    """(base spans, all spans); the models add runs that no base span touches."""
    base = base_spans(text)
    more = []
    if models is not None:
        touched = _Touched(base)
        for m in CANDIDATE.finditer(text):
            if not one_word(m[0]) and not touched(m.start(), m.end()) and models.score(m[0]) > models.threshold:
                more.append((m.start(), 3, m.end()))
    return base, sorted(base + more)


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_WORD = re.compile(r"[A-Za-z0-9_+/=-]{4,}")


def labelled(text: str) -> tuple[list[str], list[str]]:
    """(random strings, ordinary identifiers) of a text: what the fixed patterns find, and the words around it.

    A random string is the value that a pattern found, without its name. Identifiers also come joined, as camelCase, snake_case, paths,
    dated and numbered names.
    """
    spans = base_spans(text)
    touched = _Touched(spans)
    plain = [m[0] for m in _WORD.finditer(text) if not touched(m.start(), m.end())]
    joined = []
    for a, b, c in zip(plain[::3], plain[1::3], plain[2::3]):
        x, y, z = len(a), len(b), len(c)
        joined += [f"{a}_{b}_{c}".lower(), a.lower() + b.title() + c.title(), f"{a}/{b}-{c}", f"{a.upper()}_{b.upper()}", f"{a}{b}{z}"]
        joined += [f"{2000 + x % 40}-{y % 12 + 1:02d}-{z % 28 + 1:02d}-{a}-{b}".lower(), f"/{a}/{b}/{c}{x % 10}/{b}-{y % 10}".lower(), f"{a.lower()}{b.title()}By{c.title()}{y % 10}"]
    return [ASSIGN.fullmatch(text, s, e)[2] if k == 0 else text[s:e] for s, k, e in spans], plain + joined


def held_out(run: str) -> bool:
    return crc32(run.encode()) % HELD_OUT == 0


#: Scores in steps of 0.05, between -5 and 5.
_STEP, _REACH = 0.05, 100


def fit_threshold(random_bins: np.ndarray, plain_bins: np.ndarray) -> float:
    """Between the least score that few ordinary strings pass and the score that most random ones reach; the former where they overlap."""
    if not plain_bins.sum() or not random_bins.sum():
        return THRESHOLD
    above = plain_bins[::-1].cumsum()[::-1] / plain_bins.sum()
    low = int(np.argmax(np.append(above, 0) <= PLAIN_ABOVE))
    high = int(np.argmax(random_bins.cumsum() / random_bins.sum() > RANDOM_BELOW))
    return ((low + max(low, high)) / 2 - _REACH) * _STEP


def train(docs: DataFrame, id_col: str, text_col: str, n_docs: int = SAMPLE_DOCS) -> MarkovPair:
    """Learns both models from the whole texts of at most ``n_docs`` rows, and the threshold from strings that they didn't see.

    Labels come from the fixed patterns. Seeded strings over the usual
    key alphabets join the random ones, so that kinds of keys that the sample
    lacks are known too. Steps between characters are counted in the tasks, and so are the scores of held-out strings that a scan would
    judge; only sums reach the driver.
    """
    rng = np.random.default_rng(11)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = (lower + lower.upper() + digits, lower + lower.upper() + digits + "+/", lower.upper() + digits, lower + digits)
    made = ["".join(rng.choice(list(a), n)) for a in alphabets for n in (20, 30, 40, 60) for _ in range(100)]
    seeded = steps([r for r in made if not held_out(r)])
    sample = bounded_sample(docs.select(id_col, text_col), id_col, n_docs, 5)

    def totals(kernel, size):
        out = np.zeros((2, size), np.int64)
        for r in map_texts(sample, [text_col], kernel, "kind int, at int, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect():
            out[r.kind, r.at] += r.n
        return out

    def sparse(counts):
        kind, at = np.nonzero(counts)
        return [kind.tolist(), at.tolist(), counts[kind, at].tolist()]

    def count(texts):
        counts = np.zeros((2, _N * _N), np.int64)
        for t in texts:
            for kind, runs in enumerate(labelled(t or "")):
                counts[kind] += steps([r for r in runs if not held_out(r)])
        return sparse(counts)

    models = MarkovPair(*(totals(count, _N * _N) + np.stack([seeded, np.zeros_like(seeded)])))

    def score_bin(run):
        return min(max(int(np.floor(models.score(run) / _STEP)) + _REACH, 0), 2 * _REACH - 1)

    def judge(texts):
        bins = np.zeros((2, 2 * _REACH), np.int64)
        for t in texts:
            for kind, runs in enumerate(labelled(t or "")):
                for r in runs:
                    if len(r) >= 20 and held_out(r) and CANDIDATE.fullmatch(r) and not one_word(r):
                        bins[kind, score_bin(r)] += 1
        return sparse(bins)

    bins = totals(judge, 2 * _REACH)
    bins[0] += np.bincount([score_bin(r) for r in made if held_out(r)], minlength=2 * _REACH)
    models.threshold = fit_threshold(*bins)
    return models


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", models: MarkovPair | None = None) -> DataFrame:
    """Counts, digest and all spans of each row's whole text."""
    models = models or train(docs, id_col, text_col)

    def kernel(ids, texts):
        out = []
        for t in texts:
            base, every = find(t or "", models)
            n = [sum(k == j for _, k, _ in base) for j in range(3)]
            out.append((*n, sha256(_join(base).encode()).hexdigest(), _join(every), len(every) - len(base)))
        return [ids, *map(list, zip(*out))]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(
        docs, [id_col, text_col], kernel,
        f"{id_col} {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long",
    )


def op8_secret_scans(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
