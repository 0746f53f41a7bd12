"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

Edge cases: null and empty texts have fingerprint zero and are linked like any
other; rows that repeat a doc_id each give a row of the result; a null doc_id
never names a component, so a component of only such rows has a null id; an
empty table gives an empty result; columns besides id and text are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, cut, discard, map_texts
from .components import connected_components, linked_components

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Shingles that are counted at once; longer texts add up pieces of this size.
_PIECE = 8192


def _shingle_hashes(text: str | None, shingle: int, seed: int = 42):
    """Yields arrays of the shingles' XXH64, repeats included."""
    words = (text or "").encode().translate(_FOLD).split()
    if not words:
        return
    if len(words) < shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
        return
    for at in range(0, len(words) - shingle + 1, _PIECE):
        part = words[at : at + _PIECE + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        yield np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64)


def simhash64(text: str | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed long."""
    n, ones = 0, np.zeros(64, np.int64)
    for h in _shingle_hashes(text, shingle):
        n += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """One row ``(<id_col>, fp)`` for each document."""

    def kernel(ids, texts):
        return [ids, [simhash64(t, shingle) for t in texts]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], kernel, f"{id_col} {kind}, fp long")


def _blocks(bits: int, n: int) -> list[int]:
    """Masks of n adjacent blocks over the low ``bits`` bits."""
    ends = [round(bits * i / n) for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(ends, ends[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def tables(bits: int, max_distance: int, n_blocks: int) -> list[int]:
    """Masks such that two fingerprints within ``max_distance`` agree under one.

    Of ``n_blocks`` blocks at most ``max_distance`` differ, so some
    ``n_blocks - max_distance`` of them agree: one mask for each such choice.
    """
    b = _blocks(bits, n_blocks)
    return [_signed(sum(x)) for x in combinations(b, n_blocks - max_distance)]


def blocks_for(n: int, max_distance: int) -> int:
    """The number of blocks at which keys are about as many as fingerprints."""
    for extra in (2, 3, 4):
        if 64 * extra / (max_distance + extra) >= np.log2(max(n, 2)) - 1:
            return max_distance + extra
    return max_distance + 5


def _links(nodes: DataFrame, masks: list[int], max_distance: int, hot: int) -> DataFrame:
    """Pairs ``(u, v)`` of distinct fingerprints that differ in few bits.

    Fingerprints meet under each mask (an equi join on mask number and masked
    bits). A pair is made under the first mask on which it agrees only, so
    each link comes once. Where more than ``hot`` fingerprints meet, no pairs are
    made: two fingerprints are within 2r bits exactly if some value is within
    r bits of both, so each of these hangs on the least fingerprint around
    every value within r of it. That gives the same components with work that is linear
    in the bucket.
    """
    keyed = nodes.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("t", "key"),
    )
    many = cut(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("t", "key"))
    crowded = not many.isEmpty()
    cold = keyed.join(many, ["t", "key"], "left_anti") if crowded else keyed
    x: Column = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = F.lit(None).cast("int")
    for i in reversed(range(len(masks))):
        first = F.when(x.bitwiseAND(F.lit(masks[i]).cast("long")) == 0, i).otherwise(first)
    pairs = (
        cold.alias("a")
        .join(
            cold.alias("b"),
            (F.col("a.t") == F.col("b.t"))
            & (F.col("a.key") == F.col("b.key"))
            & (F.col("a.fp") < F.col("b.fp"))
            & (F.bit_count(x) <= max_distance)
            & (first == F.col("a.t")),
        )
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    )
    if not crowded:
        return pairs
    if max_distance % 2:
        raise ValueError("the exact way for crowded buckets needs an even distance")
    flips = [0]
    for r in range(1, max_distance // 2 + 1):
        flips += [_signed(sum(1 << i for i in c)) for c in combinations(range(64), r)]
    around = (
        keyed.join(many, ["t", "key"], "left_semi")
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in flips])).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    )
    centre = around.groupBy("mid").agg(F.min("fp").alias("v"))
    stars = around.join(centre, "mid").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()
    return pairs.unionByName(stars)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_distance: int = 4,
    n_blocks: int | None = None,
    hot: int = 2048,
) -> DataFrame:
    """``(<id_col>, fp, component_id)`` for each row of ``docs``.

    Documents whose fingerprints differ in at most ``max_distance`` bits are linked;
    ``component_id`` is the least id reachable over links. Copies meet in the
    aggregation by fingerprint; only distinct fingerprints are paired.
    """
    found = cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = found.select("fp").distinct()
    if n_blocks is None:
        n_blocks = blocks_for(found.count(), max_distance)
    labels = connected_components(_links(nodes, tables(64, max_distance, n_blocks), max_distance, hot))
    named = (
        found.groupBy("fp")
        .agg(F.min(id_col).alias("least"))
        .join(labels, F.col("fp") == F.col("node"), "left")
        .select("fp", "least", F.coalesce("component", "fp").alias("component"))
    )
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(named.join(ids, "component").select("fp", "component_id"), "fp").select(
        id_col, "fp", "component_id"
    )


#: Documents alike by five-word shingles; hash buckets of the table that orders shingles, and one part in so many of the rows that it is counted on.
SHINGLE, SIMILARITY, TABLE, SHARE = 5, 0.8, 1 << 18, 16


def words_hash(text: str | None) -> int:
    """A hash of the text's words."""
    return xxhash.xxh64_intdigest(b" ".join((text or "").encode().translate(_FOLD).split()), 7) - 2**63


def shingle_set(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """The distinct hashes of a text's word shingles, as signed longs."""
    parts = list(_shingle_hashes(text, shingle))
    return np.unique(np.concatenate(parts)).view(np.int64).tolist() if parts else []


def shingle_ranks(docs: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """A rank for each of ``TABLE`` hash buckets of shingles: the more frequent in a sample of the rows, the higher."""

    def kernel(texts):
        n = np.bincount(np.array([h for t in texts for h in shingle_set(t)], np.int64) % TABLE, minlength=TABLE)
        at = np.flatnonzero(n)
        return [at.tolist(), n[at].tolist()]

    sample = docs.where(F.pmod(F.xxhash64(F.lit(31), id_col), F.lit(SHARE)) == 0)
    out = np.zeros(TABLE, np.uint8)
    for r in map_texts(sample, [text_col], kernel, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1").collect():
        out[r.slot] = min(255, int(8 * np.log2(r.n)))
    return out


def least_shingles(shingles: list[int], ranks: np.ndarray) -> list[int]:
    """The rarest of a text's shingles: at a similarity of 0.8 two texts share one of them at least.

    Of n shingles the other text has ceil(0.8 n) or more, so the least common one in any order
    of all shingles is among the first n - ceil(0.8 n) + 1.
    """
    s = np.array(shingles, np.int64)
    n = len(s)
    return s[np.lexsort((s, ranks[s % TABLE]))][: n - (4 * n + 4) // 5 + 1].tolist()


def parity_sketch(shingles: list[int]) -> list[int]:
    """Parities of the shingles by hash, at least as many bits as shingles and a power of two, as longs.

    A shingle that one of two texts lacks changes one bit at most, so texts whose sketches differ in more bits
    than the similarity allows shingles to differ are not alike. The halves of a sketch add up to one of half the bits.
    """
    n = max(64, 1 << max(0, len(shingles) - 1).bit_length())
    odd = np.bincount(np.array(shingles, np.int64) & (n - 1), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def _sketches_allow() -> Column:
    """Whether sketches ``pu`` and ``pv`` of ``nu`` and ``nv`` shingles leave a similarity of 0.8 possible.

    Then (nu + nv) / 9 shingles at most are in one of the texts only.
    """

    def folded(p: str, other: str) -> Column:
        n = F.size(other)
        halves = F.zip_with(F.slice(p, F.lit(1), n), F.slice(p, n + 1, n), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(p) > n, halves).otherwise(F.col(p))

    bits = F.zip_with(folded("pu", "pv"), folded("pv", "pu"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda a, x: a + x) * 9 <= F.col("nu") + F.col("nv")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, component_id)``: documents whose five-word shingles have a Jaccard similarity of 0.8.

    Documents meet on their rarest shingles, so many that no such pair is missed; pairs that meet are cut by
    their sizes and parity sketches, neither of which drops a pair that is alike, and verified by
    the similarity itself. The order of the shingles comes from a sample and changes only how many meet by
    chance. Texts of equal words are one node; texts without words are copies of each other.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(shingle_ranks(docs, id_col, text_col))  # TABLE bytes

    def kernel(ids, texts):
        sets = [shingle_set(t) for t in texts]
        keys = [least_shingles(s, ranks.value) for s in sets]
        return [ids, list(map(words_hash, texts)), list(map(len, sets)), keys, list(map(parity_sketch, sets))]

    kind = docs.schema[id_col].dataType.simpleString()
    every = cut(map_texts(docs, [id_col, text_col], kernel, f"{id_col} {kind}, sig long, n int, keys array<long>, sketch array<long>"))
    first = [F.first(c).alias(c) for c in ("n", "keys", "sketch")]
    nodes = cut(every.groupBy("sig").agg(F.min(id_col).alias("least"), *first))
    found = cut(every.select(id_col, "sig"))
    discard(every)
    buckets = nodes.select(F.col("sig").alias("id"), F.explode("keys").alias("bucket"))

    def verify(pairs: DataFrame) -> DataFrame:
        u, v = (nodes.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"p{x}")) for x in "uv")
        alike_size = F.least("nu", "nv") * 5 >= F.greatest("nu", "nv") * 4
        near = cut(pairs.join(u, "u").join(v, "v").where(alike_size).where(_sketches_allow()).select("u", "v"))
        wanted = near.select(F.explode(F.array("u", "v")).alias("sig")).distinct().join(nodes.select("sig", "least"), "sig")
        texts = docs.select(F.col(id_col).alias("least"), F.col(text_col).alias("text")).join(wanted, "least").select("sig", "text")
        # Rows that repeat an id may have other words: only the text that the node stands for counts.
        sets = cut(map_texts(texts, ["sig", "text"], lambda s, t: [s, list(map(words_hash, t)), list(map(shingle_set, t))], "sig long, own long, s array<long>"))
        one = sets.where("sig = own").dropDuplicates(["sig"])
        both = near.join(one.select(F.col("sig").alias("u"), F.col("s").alias("su")), "u").join(
            one.select(F.col("sig").alias("v"), F.col("s").alias("sv")), "v"
        )
        common = F.size(F.array_intersect("su", "sv"))
        links = cut(both.where(common * 5 >= 4 * (F.size("su") + F.size("sv") - common)).select("u", "v"))
        discard(near, sets)
        return links

    labels = linked_components(buckets, verify)
    named = nodes.select("sig", "least").join(labels, F.col("sig") == F.col("node"), "left").select("sig", "least", F.coalesce("component", "sig").alias("component"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(named.join(ids, "component").select("sig", "component_id"), "sig").select(id_col, "component_id")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
