"""Ranked lexical search: each item's best documents, by dense products of tiles.

Items come in slices of bounded text, each made into tiles: up to 64 items by up to 512 of the
terms that occur in them. Tasks turn documents into tiles of impacts over the same terms and multiply
both in float64. Impacts and weights are integers, and a tile's weights are held so low that no
partial sum reaches 2^53, so products are exact; tiles are added up in 64-bit integers. Each task keeps its k best for
each item by (score, id), so it sends on a bounded number of rows, and one window
ranks those.

Two looks at all documents for each slice: how many hold each term of the slice (with N and L), then scores. Statistics cover whole texts of all rows.

Edge cases: a null text has no terms; documents without terms don't count in N and are never ranked; an item without terms, or
whose terms occur nowhere, has no rows. Equal scores are ordered by id, null ids last. Repeated
documents are ranked each, repeated items are answered each. An empty table gives no rows; further
columns are ignored. A text's terms are counted in memory proportional to its length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

K = 10
#: Text of a slice of items in bytes, which bounds what is broadcast at once.
SLICE_BYTES = 1 << 18
ITEM_TILE, TERM_TILE, DOC_TILE = 64, 512, 256
#: Numbers that a tile of documents may hold, in impacts and in scores.
TILE_CELLS = 1 << 22
TOP_IMPACT = 1_000_000  # an impact is at most 10^9 tf div 10^3 tf
EXACT = (1 << 53) - 1

# Term bytes to themselves, A-Z to a-z, all others to a space. Beyond ASCII all bytes are term bytes.
_TERM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased, of a UTF-8 text."""
    return (text or b"").translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class ItemTiles:
    """A slice's items as tiles of weights: (items' positions, terms' positions, items x terms in float64)."""

    def __init__(self, vocabulary: dict[bytes, int], items: list[Counter], weights: dict[bytes, int]):
        self.vocabulary = vocabulary  # terms by their column
        self.n_items = len(items)
        self.tiles: list[tuple[slice, np.ndarray, np.ndarray]] = []
        for at in range(0, len(items), ITEM_TILE):
            some = items[at : at + ITEM_TILE]
            own = sorted({vocabulary[t] for c in some for t in c if weights[t] > 0})
            column = {v: i for i, v in enumerate(own)}
            for lo in range(0, len(own), TERM_TILE):
                cols = own[lo : lo + TERM_TILE]
                w = np.zeros((len(some), len(cols)), np.int64)
                for i, c in enumerate(some):
                    for t, n in c.items():
                        j = column.get(vocabulary[t], -1) - lo
                        if 0 <= j < len(cols):
                            w[i, j] = n * weights[t]
                self._add(slice(at, at + len(some)), np.array(cols), w)

    def _add(self, items: slice, cols: np.ndarray, w: np.ndarray) -> None:
        """Weights so high that a sum could pass 2^53 go on several tiles of the same terms."""
        cap = EXACT // (TOP_IMPACT * len(cols))
        while w.any():
            part = np.minimum(w, cap)
            self.tiles.append((items, cols, np.ascontiguousarray(part.T, float)))
            w = w - part

    def scores(self, impacts: np.ndarray) -> np.ndarray:
        """Documents x items, exact."""
        out = np.zeros((len(impacts), self.n_items), np.int64)
        for items, cols, w in self.tiles:
            out[:, items] += (impacts[:, cols] @ w).astype(np.int64)
        return out


class Best:
    """The k best (score, id) of each item among what a task has seen."""

    def __init__(self, n_items: int, k: int):
        self.k, self.held = k, [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, np.int64)  # the least score that can still enter

    def add(self, scores: np.ndarray, ids: list) -> None:
        for at in np.flatnonzero((scores >= self.floor).any(0)):
            own = scores[:, at]
            rows = np.flatnonzero(own >= self.floor[at])
            mine = self.held[at] + [(-int(own[r]), ids[r] is None, ids[r] if ids[r] is not None else 0) for r in rows]
            mine.sort()
            self.held[at] = mine[: self.k]
            if len(mine) >= self.k:
                self.floor[at] = -self.held[at][-1][0]


def impacts(counts: list[tuple[int, Counter]], vocabulary: dict[bytes, int], n_docs: int, n_terms: int) -> np.ndarray:
    """Documents x terms in float64: (10^9 tf) div (10^3 tf + 8 m)."""
    out = np.zeros((len(counts), len(vocabulary)))
    for row, (n, held) in enumerate(counts):
        m8 = 8 * (25 + 75 * n * n_docs // n_terms)
        for t, tf in held.items():
            out[row, vocabulary[t]] = 1_000_000_000 * tf // (1000 * tf + m8)
    return out


def _bytes(column: pa.Array) -> list[bytes | None]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def _known(text: bytes | None, vocabulary) -> tuple[int, Counter]:
    """(number of terms, counts of those in the vocabulary)."""
    found = terms(text)
    return len(found), Counter(t for t in found if t in vocabulary)


def statistics(docs: DataFrame, text_col: str, vocabulary: dict[bytes, int]) -> tuple[int, int, dict[bytes, int]]:
    """(documents with terms, all their terms, documents that hold each term of the vocabulary)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df, n_docs, n_terms = sent.value, Counter(), 0, 0
        for b in batches:
            for text in _bytes(b.column(0)):
                found = terms(text)
                n_docs, n_terms = n_docs + bool(found), n_terms + len(found)
                df.update(known.keys() & set(found))
        at = [known[t] for t in df]
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at], pa.int64()), pa.array([n_docs, n_terms, *df.values()], pa.int64())], names=["at", "n"])

    got = {r.at: r.n for r in docs.select(text_col).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    return got.get(-1, 0), got.get(-2, 0), {t: got.get(i, 0) for t, i in vocabulary.items()}


def _slice(docs: DataFrame, items: list, id_col: str, text_col: str, item_col: str, item_type: str, k: int) -> DataFrame | None:
    """Each task's best of one slice of items: (item, its place, id, score)."""
    held = [Counter(terms(t)) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for c in held for t in c))}
    if not vocabulary:
        return None
    n_docs, n_terms, df = statistics(docs, text_col, vocabulary)
    if not n_docs:
        return None
    tiles = ItemTiles(vocabulary, held, {t: weight(n_docs, n) for t, n in df.items()})
    sent = docs.sparkSession.sparkContext.broadcast((tiles, [i for i, _ in items]))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, names = sent.value
        best, schema = Best(tiles.n_items, k), None
        step = min(DOC_TILE, max(1, TILE_CELLS // (len(tiles.vocabulary) + tiles.n_items)))
        for b in batches:
            schema = b.schema
            ids, texts = b.column(0).to_pylist(), _bytes(b.column(1))
            for at in range(0, len(ids), step):
                counts = [_known(t, tiles.vocabulary) for t in texts[at : at + step]]
                best.add(tiles.scores(impacts(counts, tiles.vocabulary, n_docs, n_terms)), ids[at : at + step])
        rows = [(names[i], i, None if none else d, -s) for i, held in enumerate(best.held) for s, none, d in held]
        if rows:
            item, place, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(place, pa.int32()), pa.array(doc, schema.field(0).type), pa.array(score, pa.int64())], names=[item_col, "__place", id_col, "score"]
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"{item_col} {item_type}, __place int, {id_col} {kind}, score long")


def rank(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    k: int = K, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(item, rank, id, score) of the k best documents with a score above 0 for each item."""
    spark: SparkSession = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(item_text), F.lit(0))
    numbered = items.select(F.col(item_col).alias("i"), F.encode(item_text, "UTF-8").alias("t"), size.alias("size"))
    parts, held, total, number = [], [], 0, 0

    def close():
        nonlocal held, total, number
        part = _slice(docs, held, id_col, text_col, item_col, item_type, k) if held else None
        if part is not None:
            parts.append(part.withColumn("__slice", F.lit(number)))
        held, total, number = [], 0, number + 1

    for r in numbered.toLocalIterator():  # one partition of items at a time, one slice kept
        if held and total + r["size"] > slice_bytes:
            close()
        held.append((r.i, bytes(r.t) if r.t is not None else None))
        total += r["size"]
    close()
    if not parts:
        kind = docs.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"{item_col} {item_type}, rank int, {id_col} {kind}, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    w = Window.partitionBy("__slice", "__place").orderBy(F.desc("score"), F.asc_nulls_last(id_col))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(item_col, "rank", id_col, "score")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents), n AS (SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
words AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM n) GROUP BY ALL),
items AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM words GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, total),
scored AS (SELECT i.item_id, x.doc_id, CAST(sum(i.times * w.w * ((1000000000 * x.tf) // (1000 * x.tf + 8 * (25 + (75 * x.n * docs) // total.terms)))) AS BIGINT) AS score
  FROM items i JOIN words x USING (term) JOIN w USING (term), total GROUP BY i.item_id, x.doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""
