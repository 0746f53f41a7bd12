"""Quality classifier: a linear-chain conditional random field over lines.

Edge cases: null and empty texts have no lines and get the score of the
model's prior; an empty table gives no rows; repeated rows each give a row; further columns of
the input are ignored; with no labelled rows all scores are 0.5; a very long text is one
chain, whose time and memory are linear in its lines.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, map_texts, table

#: Rows of the labelled sample, whole texts each.
SAMPLE_DOCS = 4000
#: Texts run in step while their lines, filled up to the longest, are at most so many; a longer one runs alone.
CELLS = 1 << 18
#: Longer texts are learned from in stretches of at most this many lines. Scores come from the whole chain.
STRETCH = 128

_SENTENCE = re.compile(r"[.!?…。][\"')\]»”’]*$")
N_OWN = 21


def _classes() -> bytes:
    """Byte to class: U upper, L other letter, N digit, S space, P punctuation, O odd sign, C rest of a letter."""
    out = bytearray(b"O" * 256)
    for i in range(256):
        c = chr(i)
        if 0x80 <= i < 0xC0:
            out[i] = ord("C")
        elif i >= 0xC0 or (i < 0x80 and c.isalpha()):
            out[i] = ord("U") if i < 0x80 and c.isupper() else ord("L")
        elif c.isdigit():
            out[i] = ord("N")
        elif c.isspace():
            out[i] = ord("S")
        elif c in ".,;:!?'\"()-":
            out[i] = ord("P")
    return bytes(out)


_CLASS = _classes()


def _own(line: str, seen: set[str]) -> list[float]:
    """Features of one line. All are bounded shares or logarithms."""
    low = line.lower().split()
    k, n = len(low), len(line)
    if not k:
        return [1.0] + [0.0] * (N_OWN - 1)
    kinds = line.encode("utf-8", "replace").translate(_CLASS)
    upper, digits, odd = kinds.count(b"U"), kinds.count(b"N"), kinds.count(b"O")
    letters = kinds.count(b"L") + upper
    tail = (kinds.count(b"PS") + kinds.count(b"OS") + (kinds[-1:] in (b"P", b"O"))) / k
    distinct = len(set(low)) / k
    pairs = len(set(zip(low, low[1:]))) / (k - 1) if k > 1 else 1.0
    short = sum(map((3).__ge__, map(len, low))) / k
    known = line in seen
    seen.add(line)
    return [
        0.0, np.log1p(k) / 5, np.log1p(n) / 8, min(2.0, n / k / 10), letters / n, upper / n, float(upper > 0.6 * max(letters, 1)),
        digits / n, min(1.0, 4 * odd / n), float(odd > 0.05 * n), min(1.0, 4 * line.count("!") / n), min(1.0, 4 * line.count("|") / n),
        distinct, pairs, min(1.0, tail), float(tail > 0.5), min(1.0, kinds.count(b"SOS") / k),
        float(known), float(bool(_SENTENCE.search(line[-8:].rstrip()))), short, float(short > 0.15),
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features with those of both neighbours, line lengths) of the lines with text."""
    lines = [x for x in (text or "").split("\n") if x.strip()]
    if not lines:
        return np.zeros((0, 3 * N_OWN + 3)), np.zeros(0)
    seen: set[str] = set()
    own = np.array([_own(x, seen) for x in lines])
    none = np.zeros((1, N_OWN))
    before, after = np.vstack([none, own[:-1]]), np.vstack([own[1:], none])
    first, last = np.zeros((len(lines), 1)), np.zeros((len(lines), 1))
    first[0], last[-1] = 1, 1
    return np.hstack([own, before, after, first, last, np.ones((len(lines), 1))]), np.array([len(x) for x in lines], float)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class LineCrf:
    """States bad (0) and good (1); ``w`` scores good, ``t`` the step between states."""

    def __init__(self, n_features: int):
        self.w, self.t, self.prior = np.zeros(n_features), np.zeros((2, 2)), 0.5
        self.mean, self.scale = np.zeros(n_features), np.ones(n_features)

    def marginals(self, xs: list[np.ndarray]) -> list[np.ndarray]:
        """P(good) of each line of each text: forward-backward, all texts in step."""
        return [g for g, _ in self._pass(xs)]

    def _pass(self, xs: list[np.ndarray]):
        """(marginals, summed pair marginals) of each text; texts of a length alike run together."""
        out: list = [None] * len(xs)
        order = sorted((i for i in range(len(xs)) if len(xs[i])), key=lambda i: -len(xs[i]))
        for i in range(len(xs)):
            if not len(xs[i]):
                out[i] = (np.zeros(0), np.zeros((2, 2)))
        at = 0
        while at < len(order):
            group = order[at : at + max(1, CELLS // len(xs[order[at]]))]
            at += len(group)
            n = [len(xs[i]) for i in group]
            top, m = n[0], len(group)
            emit = np.zeros((top, m, 2))
            live = np.zeros((top, m), bool)
            for j, i in enumerate(group):
                emit[: n[j], j, 1] = ((xs[i] - self.mean) / self.scale) @ self.w
                live[: n[j], j] = True
            a = np.zeros((top, m, 2))
            a[0] = emit[0]
            for k in range(1, top):
                a[k] = np.where(live[k][:, None], _logsum(a[k - 1][:, :, None] + self.t, 1) + emit[k], a[k - 1])
            b = np.zeros((top, m, 2))
            for k in range(top - 2, -1, -1):
                b[k] = np.where(live[k + 1][:, None], _logsum(self.t + (emit[k + 1] + b[k + 1])[:, None, :], 2), 0.0)
            z = _logsum(a[-1], 1)
            good = np.exp(a[:, :, 1] + b[:, :, 1] - z)
            pair = np.zeros((m, 2, 2))
            for k in range(1, top):
                p = np.exp(a[k - 1][:, :, None] + self.t + (emit[k] + b[k])[:, None, :] - z[:, None, None])
                pair += p * live[k][:, None, None]
            for j, i in enumerate(group):
                out[i] = (good[: n[j], j], pair[j])
        return out

    def fit(self, xs: list[np.ndarray], labels: np.ndarray, rounds: int = 100, rate: float = 0.1, ridge: float = 1e-4) -> LineCrf:
        """Gradient ascent (Adam) on the log-likelihood; each line carries its document's label.

        Each text weighs the same however long it is, and both classes weigh the same together.
        All lines of a long text are learned from, in stretches.
        """
        keep = [i for i in range(len(xs)) if len(xs[i])]
        xs, y = [xs[i] for i in keep], labels[keep]
        if not xs:
            return self
        every = np.vstack(xs)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-6
        self.mean[-1], self.scale[-1] = 0.0, 1.0
        self.prior = float((y.sum() + 1) / (len(y) + 2))
        lengths = np.array([len(x) for x in xs])
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) / lengths
        parts = [x[k : k + STRETCH] for x in xs for k in range(0, len(x), STRETCH)]
        owner = np.repeat(np.arange(len(xs)), -(-lengths // STRETCH))
        z = (every - self.mean) / self.scale
        line_share, line_label = np.repeat(share, lengths), np.repeat(y, lengths)
        inner = np.array([len(x) - 1 for x in parts]) * share[owner]
        true = np.diag([inner[y[owner] == 0].sum(), inner[y[owner] == 1].sum()])
        m = [np.zeros_like(self.w), np.zeros_like(self.t)]
        v = [np.zeros_like(self.w), np.zeros_like(self.t)]
        for step in range(1, rounds + 1):
            good, pairs = zip(*self._pass(parts))
            gw = z.T @ (line_share * (line_label - np.concatenate(good))) - ridge * self.w
            gt = true - np.tensordot(share[owner], np.array(pairs), 1) - ridge * self.t
            for p, g, m_, v_ in zip((self.w, self.t), (gw, gt), m, v):
                m_ *= 0.9
                m_ += 0.1 * g
                v_ *= 0.999
                v_ += 0.001 * g * g
                p += rate * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.999**step)) + 1e-8)
            np.clip(self.t, -2.0, 2.0, out=self.t)  # labels of whole documents would make steps certain
        return self

    def scores(self, texts: list[str | None]) -> list[float]:
        """Length-weighted mean of the lines' marginals."""
        pairs = [features(t) for t in texts]
        out = []
        for good, (_, n) in zip(self.marginals([x for x, _ in pairs]), pairs):
            out.append(float((good * n).sum() / n.sum()) if len(n) else self.prior)
        return [min(1.0, max(0.0, s)) for s in out]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = SAMPLE_DOCS) -> LineCrf:
    """Fits the field on at most ``n_docs`` labelled rows that are not held out."""
    known = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("__l"), F.col("quality").alias("__q")).where(
        F.crc32(F.col("__l").cast("string")) % 3 != 1
    )
    chosen = bounded_sample(known, "__l", n_docs, 3)
    # At most n_docs rows: the bound of the broadcast.
    rows = (
        docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__l"))
        .select("__l", "__q", F.col(text_col).alias("t"))
        .collect()
    )
    rows.sort(key=lambda r: (r["__l"], r["t"] or ""))
    model = LineCrf(3 * N_OWN + 3)
    return model.fit([features(r.t)[0] for r in rows], np.array([int(r["__q"]) for r in rows], int))


def classify(docs: DataFrame, model: LineCrf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, held_out, score and predicted of each row's whole text."""

    def kernel(ids, texts):
        s = model.scores(texts)
        held = [crc32(str(i).encode()) % 3 == 1 if i is not None else None for i in ids]
        return [ids, held, s, [int(x >= 0.5) for x in s]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], kernel, f"{id_col} {kind}, held_out boolean, score double, predicted int")


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, train(docs, table(spark, sf_dir, "labels")))
