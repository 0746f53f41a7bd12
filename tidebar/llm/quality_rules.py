"""Quality rules: plain counts, and compression bands over documents and chunks.

Edge cases: a null text has no words and fails; an empty table gives no rows;
repeated rows each give a row; further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, table

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"

#: (least bytes, least ratio, greatest ratio) of a whole text, the last line that fits its length.
WHOLE_BANDS = ((0, 1.0, 2.4), (1_000, 1.3, 2.8), (4_000, 1.5, 3.2), (16_000, 1.6, 3.6), (64_000, 1.6, 4.0))
CHUNK_BYTES = 4096
#: The same for each chunk; a text goes if more than CHUNK_SHARE of its chunks are outside.
CHUNK_BANDS = ((0, 0.8, 2.8), (1_000, 1.2, 2.8), (4_000, 1.5, 3.0))
CHUNK_SHARE = 0.34


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1_000_000:  # else the third factor fits in 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    grams = pairs[:-1] * len(number) + ids[2:]
    _, at, n = np.unique(grams, return_inverse=True, return_counts=True)
    twice = n[at] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(twice)] |= twice
    return int(inside.sum())


def _fits(n: int, ratio: float, bands) -> bool:
    _, low, high = [b for b in bands if b[0] <= n][-1]
    return low <= ratio <= high


def compression(text: str) -> tuple[float, float, bool]:
    """(ratio of the whole, share of chunks outside their band, verdict)."""
    raw, c = text.encode(), zstandard.ZstdCompressor(level=3)
    if not raw:
        return 0.0, 0.0, False
    ratio = len(raw) / len(c.compress(raw))
    chunks = [raw[i : i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)]
    # A short last chunk joins no band of its own where longer ones exist.
    chunks = chunks[:-1] if len(chunks) > 1 and len(chunks[-1]) < CHUNK_BYTES // 4 else chunks
    out = sum(not _fits(len(x), len(x) / len(c.compress(x)), CHUNK_BANDS) for x in chunks) / len(chunks)
    return ratio, out, _fits(len(raw), ratio, WHOLE_BANDS) and out <= CHUNK_SHARE


def measure(text: str | None) -> tuple:
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    n, again = len(words), repeated_words(words)
    failed = n < 50 or 100 * again > 50 * n
    ratio, outside, fits = compression(text)
    return (
        n, len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
        again, failed, not failed and fits, ratio, outside,
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the counts, base_failed, kept, zstd_ratio and chunks_outside of each row."""

    def kernel(ids, texts):
        return [ids, *map(list, zip(*map(measure, texts)))]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(
        docs, [id_col, text_col], kernel,
        f"{id_col} {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, zstd_ratio double, chunks_outside double",
    )


def keep(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        return pd.Series([measure(t)[6] for t in texts], dtype=bool)

    return docs.where(passes(F.col(text_col)))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
