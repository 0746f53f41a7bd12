"""Language identification by cross-parsing entropy over suffix automata.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; with
nothing to learn from, every text is ``und``; an empty table gives no rows;
repeated rows each give a row; further columns of the input are ignored; of languages that
need equally many phrases the first by name wins; a very long text is parsed whole.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, table

#: Labelled texts are cut into passages of this many characters, and so many passages of
#: each language, chosen by hash from all passages of all its texts, are learned from.
PASSAGE_CHARS = 400
SAMPLE_PASSAGES = 60
#: Texts are parsed in pieces of this many characters, all pieces in step.
PIECE = 512
#: Columns of the dense table of steps; further characters have their steps in a sorted one.
ALPHABET = 96

_LETTER = re.compile(r"[^\W\d_]")
_SQUEEZE = re.compile(r"[\W\d_]+")


def normal(text: str) -> str:
    """Lower case; what is not a letter becomes one space."""
    return _SQUEEZE.sub(" ", text.lower())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Steps of the least automaton that accepts each substring of ``text``; state 0 starts."""
    step: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class CrossParser:
    """All languages' automata in one table.

    ``go[state * A + code]`` is the next state, or the complement of the state
    after a new phrase has begun where the current phrase can't grow. The ``ALPHABET`` - 2
    commonest characters of all samples have a column there; each other character of the samples has a code
    from ``ALPHABET`` on, and its steps are in ``rare``, sorted by state and code.
    """

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in samples]
        # By Ziv and Merhav a phrase that is parsed against n characters costs log(n): short samples break phrases sooner.
        self.cost = np.log([len(t) + 2 for _, t in samples])
        common = Counter("".join(t for _, t in samples)).most_common(ALPHABET - 2)
        code = {c: i + 2 for i, (c, _) in enumerate(common)}  # 0 fills pieces up, 1 is any other character
        others = sorted({c for _, t in samples for c in t} - code.keys())
        rare = {c: i + ALPHABET for i, c in enumerate(others)}
        self.lut = np.ones(0x110000, np.int32)
        for c, i in (code | rare).items():
            self.lut[ord(c)] = i
        self.n_rare = max(1, len(rare))
        parts, roots, base = [], [], 0
        edges: list[tuple[int, int]] = []  # state * n_rare + rare code, next state
        for _, text in samples:
            steps = suffix_automaton(text)
            go = np.full((len(steps), ALPHABET), -1, np.int32)
            for s, out in enumerate(steps):
                for c, to in out.items():
                    if c in code:
                        go[s, code[c]] = to
                    else:
                        edges.append(((s + base) * self.n_rare + rare[c] - ALPHABET, to + base))
            fresh = np.where(go[0] >= 0, go[0], 0) + base
            go = np.where(go >= 0, go + base, ~fresh[None, :]).astype(np.int32)
            go[:, 0] = np.arange(len(steps)) + base
            parts.append(go)
            roots.append(base)
            base += len(steps)
        self.go = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int32)
        edges.sort()
        self.rare_at = np.array([k for k, _ in edges], np.int64)
        self.rare_to = np.array([to for _, to in edges], np.int32)

    def _find(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next state by a rare character, -1 where there is none."""
        if not len(self.rare_at):
            return np.full(state.shape, -1, np.int32)
        key = state.astype(np.int64) * self.n_rare + (code - ALPHABET)
        at = np.minimum(np.searchsorted(self.rare_at, key), len(self.rare_at) - 1)
        return np.where(self.rare_at[at] == key, self.rare_to[at], -1).astype(np.int32)

    def _step(self, state: np.ndarray, row: np.ndarray) -> np.ndarray:
        far = np.flatnonzero(row >= ALPHABET)
        if not len(far):
            return self.go[state * ALPHABET + row]
        to = self.go[state * ALPHABET + np.where(row < ALPHABET, row, 1)]
        codes = np.broadcast_to(row[far], (len(self.roots), len(far)))
        next_ = self._find(state[:, far], codes)
        roots = np.broadcast_to(self.roots[:, None], codes.shape)
        first = self._find(roots, codes)  # a new phrase begins with the character, if the language has it
        to[:, far] = np.where(next_ >= 0, next_, ~np.where(first >= 0, first, roots))
        return to

    def phrases(self, texts: list[str]) -> np.ndarray:
        """(texts x languages): longest-match phrases that each language needs for each text."""
        codes = [self.lut[np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)] for t in texts]
        pieces = [max(1, -(-len(c) // PIECE)) for c in codes]
        grid = np.zeros((sum(pieces), PIECE), np.int32)
        at = 0
        for c, k in zip(codes, pieces):
            grid[at : at + k].ravel()[: len(c)] = c
            at += k
        steps = np.ascontiguousarray(grid.T)
        state = np.repeat(self.roots[:, None], grid.shape[0], 1)
        count = np.ones(state.shape, np.int32)
        for row in steps:
            to = self._step(state, row)
            new = to >> 31  # -1 where a phrase begins
            count -= new
            state = to ^ new
        owner = np.repeat(np.arange(len(texts)), pieces)
        total = np.zeros((len(texts), len(self.langs)))
        for j in range(len(self.langs)):
            total[:, j] = np.bincount(owner, count[j], len(texts))
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language with fewest normalised phrases, and how far it is ahead of the next one (0 to 1)."""
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        ok = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        for lo, hi in _ranges([len(texts[i]) for i in ok], 2_000_000):
            group = ok[lo:hi]
            n = self.phrases([normal(texts[i]) for i in group]) * self.cost if self.langs else np.zeros((len(group), 0))
            for i, row in zip(group, n):
                if len(row):
                    best = int(row.argmin())
                    rest = np.delete(row, best)
                    langs[i] = self.langs[best]
                    scores[i] = float(1 / (1 + np.exp(-8 * (1 - row[best] / rest.min())))) if len(rest) else 1.0
        return langs, scores


def _ranges(sizes: list[int], most: int):
    """Ranges of items of at most ``most`` characters together, or of one longer item."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


@lru_cache(maxsize=2)
def _parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    """Built once in each worker from the small sample, not shipped as a table."""
    return CrossParser(samples)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[tuple[str, str], ...]:
    """(language, text) of a bounded sample of passages of the labelled rows that are not held out.

    Whole texts are cut into passages, each with a seeded hash. The number of a language's passages gives a
    limit of the hash under which about four times ``SAMPLE_PASSAGES`` fall; only these are ranked, so
    neither a task nor the driver holds more of a language.
    """
    held_out = F.crc32(F.col(id_col).cast("string")) % 4 == 2
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out).select(
        F.col(lang_col).alias("__g"), F.col(id_col).alias("__i"), F.col(text_col).alias("__t"),
        F.ceil(F.length(text_col) / PASSAGE_CHARS).cast("int").alias("__n"),
    ).where("__n > 0")
    share = (4 * SAMPLE_PASSAGES / F.sum("__n")).alias("__share")
    hashed = F.transform(F.sequence(F.lit(0), F.col("__n") - 1), lambda k: F.struct(k.alias("k"), F.xxhash64(F.lit(17), "__i", k).alias("h")))
    under = F.filter("__x", lambda x: F.pmod(x["h"], F.lit(1 << 30)) < F.col("__share") * (1 << 30))
    passages = (
        known.join(F.broadcast(known.groupBy("__g").agg(share)), "__g")  # a row for each language, less than its automaton takes
        .withColumn("__x", hashed)
        .select("__g", "__i", F.explode(F.transform(under, lambda x: F.struct(
            F.pmod(x["h"], F.lit(1 << 30)).alias("r"), x["h"].alias("h"), F.substring("__t", x["k"] * PASSAGE_CHARS + 1, F.lit(PASSAGE_CHARS)).alias("t")
        ))).alias("__x"))
        .select("__g", "__i", "__x.*")
    )
    rank = F.row_number().over(Window.partitionBy("__g").orderBy("r", "h", "__i", "t"))
    rows = passages.withColumn("__k", rank).where(F.col("__k") <= SAMPLE_PASSAGES).select("__g", "__k", "t").collect()
    found: dict[str, str] = {}
    for r in sorted(rows, key=lambda r: (r["__g"], r["__k"])):
        text = normal(r["t"])
        if text.strip():
            found[r["__g"]] = found.get(r["__g"], "") + " " + text
    return tuple(sorted(found.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, held_out, lang_pred and score of each row's whole text."""

    def kernel(ids, texts):
        langs, scores = _parser(samples).predict(texts)
        held = [crc32(str(i).encode()) % 4 == 2 if i is not None else None for i in ids]
        return [ids, held, langs, scores]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], kernel, f"{id_col} {kind}, held_out boolean, lang_pred string, score double")


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn(docs))
