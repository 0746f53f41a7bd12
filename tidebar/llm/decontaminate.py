"""Benchmark decontamination: latent semantic retrieval, then subsequence and answer checks.

Edge cases: null or empty texts and items match nothing; an empty benchmark or table gives no
rows; items or rows that repeat each give rows of their own id; further columns of
the input are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, own_id, table

#: Words in a block; a passage is two adjacent blocks, and each block is in two passages.
BLOCK = 20
#: Longer items are cut into parts of at most this many words, each searched for.
ITEM_WORDS = 48
#: Dimensions of the latent space, and further ones while it is found.
RANK, OVERSAMPLE = 64, 16
#: The space is fitted on so many words at a time.
STEP_WORDS = 5_000
#: Least cosine of a candidate, least shares of an item's weight in the common
#: subsequence: alone, and with the answer found.
CANDIDATE, VERBATIM, PARAPHRASE = 0.6, 0.75, 0.5
ANSWER_WORDS, ANSWER_SHARE = 6, 0.8
#: Share of a part's weight that may lie in words that are no keys of it.
REST = 0.2
#: Items are searched in slices whose words take at most so many bytes: the bound of what is sent to tasks.
SLICE_BYTES = 4_000_000

_FOLD = bytes(
    (ord(chr(i).lower()) if chr(i).isalnum() else 32) if i < 128 else i for i in range(256)
)
assert all(_FOLD[ord(c)] == 32 for c in string.punctuation)


def words(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII punctuation separates."""
    return (text or "").lower().encode("utf-8", "replace").translate(_FOLD).split()


class Index:
    """Item parts, the benchmark's vocabulary, idf, and the latent space."""

    def __init__(self, items: list[tuple], df: dict[bytes, int] | None = None, n_docs: int = 0):
        self.parts: list[tuple] = []  # (item id, word numbers)
        self.number: dict[bytes, int] = {}
        for item, text in items:
            w = words(text)
            k = max(1, -(-len(w) // ITEM_WORDS))
            for part in np.array_split(np.array([self.number.setdefault(x, len(self.number)) for x in w], np.int64), k):
                if len(part):
                    self.parts.append((item, part))
        counts = np.array([(df or {}).get(w, 0) for w in self.number], float)
        self.idf = np.log((n_docs + 1) / (counts + 1)) + 0.1 if len(counts) else np.zeros(0)
        self.space = np.zeros((len(self.number), 0), np.float32)
        self.seen = np.zeros(len(self.number), bool)  # scratch
        self._key()

    def _key(self) -> None:
        """The heaviest words of each part, all but ``REST`` of its weight, as a list of parts for each word.

        ``check`` takes no part of which a text has less than ``PARAPHRASE`` of the weight, so of a part's keys
        a text must have ``need``, which is the difference at least.
        """
        rows: list[tuple] = []
        self.need = np.zeros(len(self.parts))
        for p, (_, part) in enumerate(self.parts):
            w, n = np.unique(part, return_counts=True)
            weight = n * self.idf[w]
            order = np.argsort(-self.idf[w], kind="stable")
            left = weight.sum() - np.cumsum(weight[order])
            k = int(np.argmax(left <= REST * weight.sum())) + 1
            self.need[p] = PARAPHRASE * weight.sum() - left[k - 1] - 1e-9
            rows.append((w[order[:k]], np.full(k, p), weight[order[:k]]))
        word, part, weight = (np.concatenate(x) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
        by = np.argsort(word, kind="stable")
        self.key_part, self.key_weight = part[by], weight[by]
        self.key_at = np.searchsorted(word[by], np.arange(len(self.number) + 1))

    def keyed(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(part, block) of the keys of parts of which the text has enough; no part that ``check`` takes is missed."""
        known = np.sort(ids[ids >= 0])
        known = known[np.flatnonzero(np.diff(known, prepend=-1))]
        size = self.key_at[known + 1] - self.key_at[known]
        ends = np.cumsum(size)
        rows = np.repeat(self.key_at[known] - (ends - size), size) + np.arange(ends[-1]) if len(known) else np.zeros(0, np.int64)
        have = np.bincount(self.key_part[rows], self.key_weight[rows], len(self.parts))
        ok = (have >= self.need) & (have > 0)
        rows, words_ = rows[ok[self.key_part[rows]]], np.repeat(known, size)[ok[self.key_part[rows]]]
        return sorted({(p, b) for p, w in zip(self.key_part[rows].tolist(), words_.tolist()) for b in (np.flatnonzero(ids == w) // BLOCK).tolist()})

    def ids(self, text: str | None) -> np.ndarray:
        """Numbers of a text's words; -1 for words that no item has."""
        w = words(text)
        return np.fromiter(map(self.number.get, w, [-1] * len(w)), np.int64, len(w))

    def blocks(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Sum of the words' vectors over each block."""
        n = -(-len(ids) // BLOCK)
        out = np.zeros((n, vectors.shape[1]), np.float32)
        at = np.flatnonzero(ids >= 0)
        if len(at):
            b = at // BLOCK
            first = np.flatnonzero(np.diff(b, prepend=-1))
            out[b[first]] = np.add.reduceat(vectors.take(ids[at], 0), first, axis=0)
        return out

    def sketch(self, texts: Iterable[str | None], omega: np.ndarray) -> np.ndarray:
        """Sum over passages a of a (a . omega), a being their unit TF-IDF vectors."""
        out, weighted = np.zeros_like(omega), self.idf[:, None] * omega
        held, n, room = [], 0, np.empty((2 * STEP_WORDS, omega.shape[1]))
        for t in texts:
            held.append(self.ids(t))
            n += len(held[-1])
            if n >= STEP_WORDS:
                room = self._add_passages(held, weighted, out, room)
                held, n = [], 0
        if held:
            self._add_passages(held, weighted, out, room)
        out *= self.idf[:, None]
        return out

    def _add_passages(self, texts: list[np.ndarray], weighted: np.ndarray, out: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Adds to ``out``, for each word, the passages' ``a . omega`` by the square of their length, as often as they hold the word.

        ``room`` is where rows are gathered; it comes back, larger where a text needs it.
        """
        sizes = np.array([len(x) for x in texts])
        blocks = -(-sizes // BLOCK)
        first = np.cumsum(np.r_[1, blocks + 1])  # an empty block before and after each text
        begins = np.zeros(first[-1] + 1, bool)  # blocks at which a passage begins
        begins[np.repeat(first[:-1] - np.cumsum(np.r_[0, blocks[:-1]]), blocks) + np.arange(blocks.sum())] = True
        at = np.repeat(first[:-1], sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(np.r_[0, sizes[:-1]]), sizes)) // BLOCK
        ids = np.concatenate(texts)
        ids, at = ids[ids >= 0], at[ids >= 0]
        if not len(ids):
            return room
        if len(ids) > len(room):
            room = np.empty((len(ids), room.shape[1]))
        cut = np.flatnonzero(np.diff(at, prepend=-1))
        sums = np.zeros((len(begins) + 1, weighted.shape[1]))
        sums[at[cut]] = np.add.reduceat(weighted.take(ids, 0, room[: len(ids)], "clip"), cut, axis=0)
        passages = sums[:-1] + sums[1:]
        one, n = np.unique(np.concatenate([at, at - 1]) * len(self.idf) + np.tile(ids, 2), return_counts=True)
        square = np.bincount(one // len(self.idf), (n * self.idf[one % len(self.idf)]) ** 2, len(begins))
        passages *= np.divide(1.0, square, out=np.zeros(len(begins)), where=begins & (square > 0))[:, None]
        by = np.argsort(ids, kind="stable")
        cut = np.flatnonzero(np.diff(ids[by], prepend=-1))
        passages[1:] += passages[:-1].copy()  # a block is in the passage that begins there and in the one before
        out[ids[by][cut]] += np.add.reduceat(passages.take(at[by], 0, room[: len(ids)], "clip"), cut, axis=0)
        return room

    def _outer(self, w, n, omega) -> np.ndarray:
        a = n * self.idf[w]
        a = a / np.linalg.norm(a)
        return a[:, None] * (a @ omega[w])[None, :]

    def omega(self) -> np.ndarray:
        return np.random.default_rng(23).standard_normal((len(self.number), min(RANK + OVERSAMPLE, max(1, len(self.number)))))

    def fit(self, corpus: np.ndarray) -> None:
        """The leading right singular vectors from the sketch ``C omega`` of corpus and items.

        One pass suffices: C = A^T A is symmetric, so C is near Y (omega^T Y)^-1 Y^T
        for Y = C omega. The items weigh as much as the corpus.
        """
        omega = self.omega()
        items = np.zeros_like(omega)
        for _, part in self.parts:
            w, n = np.unique(part, return_counts=True)
            items[w] += self._outer(w, n, omega)
        size = np.linalg.norm(corpus)
        y = items + corpus * (np.linalg.norm(items) / size if size else 0.0)
        nu = 1e-8 * np.linalg.norm(y)
        y = y + nu * omega
        b = omega.T @ y
        values, turn = np.linalg.eigh((b + b.T) / 2)
        ok = values > 1e-12 * values[-1]
        u, _, _ = np.linalg.svd(y @ (turn[:, ok] / np.sqrt(values[ok])), full_matrices=False)
        self.space = (u[:, :RANK] * self.idf[:, None]).astype(np.float32)
        self.targets = self._unit(np.array([self.space[p].sum(0) for _, p in self.parts], np.float32))

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(part, first word, end) of passages whose cosine with a part is high or that hold keys of it; adjacent ones are one.

        The space can't tell thousands of items apart, and a short item is little of a passage: these are found by their keys.
        A part of whose keys the whole text has too little is one that ``check`` takes in no passage, so passages are held against the others only.
        """
        near: set[tuple[int, int]] = set(self.keyed(ids))
        if not near:
            return []
        parts = np.array(sorted({p for p, _ in near}))
        b = self.blocks(ids, self.space)
        passages = b.copy()
        passages[:-1] += b[1:]
        for lo in range(0, len(passages), 4096):
            at, part = np.nonzero(self._unit(passages[lo : lo + 4096]) @ self.targets[parts].T >= CANDIDATE)
            near.update(zip(parts[part].tolist(), (at + lo).tolist()))
        found: dict[int, list[list[int]]] = {}
        for p, i in sorted(near):
            runs = found.setdefault(p, [])
            if runs and i * BLOCK <= runs[-1][1]:
                runs[-1][1] = (i + 2) * BLOCK
            else:
                runs.append([i * BLOCK, (i + 2) * BLOCK])
        return [(p, s, e) for p, runs in found.items() for s, e in runs]

    def check(self, part: np.ndarray, ids: np.ndarray, start: int, end: int) -> tuple[float, float]:
        """(weight of the longest common subsequence / the part's weight, share of the answer's words found).

        The answer is the part's last words.
        """
        margin = len(part)
        here = ids[max(0, start - margin) : end + margin]
        here = here[here >= 0]
        w, seen = self.idf[part], self.seen
        seen[here] = True
        there = seen[part]
        seen[here] = False
        if w @ there < PARAPHRASE * w.sum():  # no subsequence weighs more than its words
            return 0.0, 0.0
        seen[part] = True
        here = here[seen[here]]  # other words match nothing
        seen[part] = False
        row = np.zeros(len(part) + 1)
        for x in here:  # row[j]: best weight of a common subsequence with the first j words
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(part == x, row[:-1] + w, 0.0)))
        return float(row[-1] / w.sum()), float(there[-ANSWER_WORDS:].mean())

    def matches(self, text: str | None) -> list[tuple]:
        """(item id, subsequence share, answer share) of the items that a text holds; the best of an item's parts."""
        ids = self.ids(text)
        best: dict = {}
        for p, s, e in self.candidates(ids) if len(ids) else []:
            item, part = self.parts[p]
            share, answer = self.check(part, ids, s, e)
            if share >= VERBATIM or (share >= PARAPHRASE and answer >= ANSWER_SHARE):
                best[item] = max(best.get(item, (0.0, 0.0)), (share, answer))
        return [(i, *x) for i, x in best.items()]


def _slices(bench: DataFrame, id_col: str, text_col: str):
    """The items in groups of at most ``SLICE_BYTES``; one group for usual benchmarks."""
    total = bench.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(1, -(-total // SLICE_BYTES))
    for i in range(n):
        part = bench if n == 1 else bench.where(F.pmod(F.xxhash64(id_col), F.lit(n)) == i)
        rows = part.where(F.col(text_col).isNotNull()).select(id_col, text_col).collect()
        yield sorted((r[0], r[1]) for r in rows if r[0] is not None)




def build(docs: DataFrame, items: list[tuple], id_col: str, text_col: str) -> Index | None:
    """Document frequencies over all rows, and the space from all of their passages."""
    index = Index(items)
    if not index.parts:
        return None
    vocabulary = frozenset(index.number)

    def frequencies(texts):
        found: dict[bytes, int] = {}
        for t in texts:
            for w in vocabulary.intersection(words(t)):
                found[w] = found.get(w, 0) + 1
        found[b""] = len(texts)
        return [list(found), list(found.values())]

    df = {
        bytes(r.word): r.n
        for r in map_texts(docs, [text_col], frequencies, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    }
    index = Index(items, df, df.get(b"", 0))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One table of sums for each task, however many passages it has."""
        y = index.sketch((t for b in batches for t in b.column(0).to_pylist()), index.omega())
        used = np.flatnonzero(np.abs(y).sum(1))
        for at in range(0, len(used), 10_000):
            some = used[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([y[i].tobytes() for i in some], pa.binary())], names=["word", "y"])

    corpus = np.zeros_like(index.omega())
    parts = docs.select(text_col).mapInArrow(sketched, "word long, y binary")

    def summed(key, rows):
        total = sum(np.frombuffer(y, float) for y in rows.column("y").to_pylist())
        return pa.table({"word": [key[0].as_py()], "y": pa.array([total.tobytes()], pa.binary())})

    # A row for each word of the benchmark comes back, never one for each passage.
    for r in parts.groupBy("word").applyInArrow(summed, "word long, y binary").collect():
        corpus[r.word] = np.frombuffer(bytes(r.y), float)
    index.fit(corpus)
    return index


def find(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(<id_col>, <item_col>, lcs_share, answer_share)`` of each document that holds an item."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), bench.schema[item_col].dataType.simpleString()
    schema = f"{id_col} {kind}, {item_col} {item_kind}, lcs_share double, answer_share double"
    out = spark.createDataFrame([], schema)
    for items in _slices(bench, item_col, item_text):
        index = build(docs, items, id_col, text_col)
        if index is None:
            continue
        sent = spark.sparkContext.broadcast(index)  # at most SLICE_BYTES of words, RANK numbers for each

        def kernel(ids, texts, sent=sent):
            rows = [(i, *m) for i, t in zip(ids, texts) for m in sent.value.matches(t)]
            return [list(c) for c in zip(*rows)] or [[], [], [], []]

        out = out.unionByName(map_texts(docs, [id_col, text_col], kernel, schema))
    return out


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark."""
    keyed = docs.withColumn("__own", own_id("doc_id", "text"))
    return keyed.join(find(keyed, bench, "__own").select("__own").distinct(), "__own", "left_anti").select(*docs.columns)


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
