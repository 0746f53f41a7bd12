"""Whitening, ranked search and personal data against brute-force versions, and on awkward rows."""

import math
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from tidebar.llm import pii, ranking, whitening

# ---- whitening ---------------------------------------------------------------


def spectra():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    equal = q @ np.diag(np.r_[[9.0] * 3, [4.0] * 5, [1.0] * 32]) @ q.T
    free = rng.standard_normal((30, 30))
    return {
        "one": np.array([[3.0]]), "two": np.array([[2.0, 1.0], [1.0, 2.0]]), "diagonal": np.diag(np.arange(12.0)), "equal": (equal + equal.T) / 2,
        "free": free @ free.T, "zero": np.zeros((4, 4)), "rank one": np.outer(np.arange(9.0), np.arange(9.0)), "small": 1e-30 * free @ free.T,
    }


@pytest.mark.parametrize("name", list(spectra()))
def test_eigenpairs(name):
    a = spectra()[name]
    values, vectors = whitening.leading_eigenpairs(a, 8)
    want = np.linalg.eigvalsh(a)[::-1][:8]
    size = max(want[0], 1e-300)
    assert np.abs(values - np.maximum(want, 0)).max() <= 1e-13 * size
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-13 * size
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() <= 1e-13


VECTORS = "vec_id long, embedding array<float>, label int, component string"


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = (rng.standard_normal((300, 10)) @ np.diag(np.linspace(1, 3, 10)) + 5).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0, "x") for i, v in enumerate(x)]
    bad = [(900, None, 0, "x"), (901, [], 0, "x"), (902, [1.0] * 9 + [None], 0, "x"), (903, [math.nan] + [1.0] * 9, 0, "x"), (904, [math.inf] * 10, 0, "x"), (905, [1.0] * 4, 0, "x")]
    got = whitening.whiten(spark.createDataFrame([*rows, rows[0], *bad], VECTORS)).toPandas()
    ints = np.floor(1024 * np.vstack([x, x[:1]]).astype(float)).astype(int) + 100_000
    n = len(ints)
    centred = ints - ints.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    assert len(got) == 8 * n and set(got.vec_id) == set(range(300)) and (got.n == n).all()
    exact = {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, ints.sum(0))) for i, v in enumerate(ints[:300])}
    assert all(exact[i] == d for i, d in zip(got.vec_id, got.deviation))
    projected = centred @ vectors / np.sqrt(values)
    wide = got.drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.abs(wide) - np.abs(projected[:300])).max() < 1e-9
    assert np.allclose(sorted(got.explained.unique())[::-1], values / np.trace(centred.T @ centred / n), rtol=1e-9)
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1


def test_whitening_awkward_tables(spark):
    empty = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "component", "n"]
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (None, [1.0, 2.0], 0, "")], VECTORS)).collect()
    assert len(same) == 4 and all(r.whitened is None and r.deviation == 0 and r.explained == 0 and r.identity_error is None for r in same)
    great = whitening.whiten(spark.createDataFrame([(1, [3e38, 2.0], 0, ""), (2, [-3e38, 1.0], 0, "")], VECTORS)).collect()
    assert {r.deviation for r in great} == {None} and all(math.isfinite(r.whitened) for r in great if r.component == 1)


def test_sums_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(c) for c in rng.standard_normal(6)], 0, "") for i in range(500)], VECTORS)
    one, many = (sorted(map(tuple, whitening.whiten(df.repartition(k)).collect())) for k in (1, 7))
    assert [r[:5] for r in one] == [r[:5] for r in many]  # the identity error alone sums doubles


# ---- ranked search -----------------------------------------------------------

DOCS = "doc_id long, text string, score string, rank string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_ranks(docs, items, k=10):
    split = lambda t: TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = [(i, Counter(w), len(w)) for i, w in ((i, split(t)) for i, t in docs) if w]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in split(text) if t in c)
            if s > 0:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def search_rows():
    rng = random.Random(6)
    word = lambda: rng.choice(["été", "Straße", "x9", "日本", "w"]) + str(rng.randrange(40))
    docs = [(i, rng.choice([" ", "-", "\n", "@{"]).join(word() for _ in range(rng.randrange(1, 60)))) for i in range(150)]
    docs += [(500 + i, docs[3][1]) for i in range(30)] + [(700, None), (701, ""), (702, "?!"), (703, "w1 " * 20_000)]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 30)))) for i in range(40)] + [(90, None), (91, ""), (92, "unseen terms"), (93, "w1 " * 300), (94, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("slice_bytes, tile", [(1 << 18, 512), (200, 512), (1 << 18, 3)])
def test_ranks_against_brute_force(spark, monkeypatch, slice_bytes, tile):
    monkeypatch.setattr(ranking, "TERM_TILE", tile)
    monkeypatch.setattr(ranking, "ITEM_TILE", 16 if tile < 9 else 64)
    docs, items = search_rows()
    got = ranking.rank(
        spark.createDataFrame([(i, t, "a", "b") for i, t in docs], DOCS).repartition(5), spark.createDataFrame(items, "item_id long, text string"), slice_bytes=slice_bytes
    )
    assert sorted(map(tuple, got.collect())) == brute_ranks(docs, items)


def test_weights_beyond_a_tile_bound_are_split():
    vocabulary = {b"a": 0, b"b": 1}
    tiles = ranking.ItemTiles(vocabulary, [Counter({b"a": 10**7, b"b": 3})], {b"a": 20_000, b"b": 5})
    assert len(tiles.tiles) > 1 and all((w.sum(0) * ranking.TOP_IMPACT < 1 << 53).all() for _, _, w in tiles.tiles)
    assert tiles.scores(np.array([[999.0, 7.0]])).tolist() == [[999 * 20_000 * 10**7 + 7 * 15]]


def test_ranks_of_awkward_tables(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "item_id long, text string")
    assert ranking.rank(none, items).count() == 0
    docs = spark.createDataFrame([(None, "a", "", ""), (5, "a", "", ""), (5, "a", "", ""), (6, "c", "", "")], DOCS)
    assert ranking.rank(docs, items.limit(0)).count() == 0
    got = sorted((r.item_id, r["rank"], r.doc_id or -1) for r in ranking.rank(docs, items).collect())
    assert got == sorted([(1, 1, 5), (1, 2, 5), (1, 3, -1)] * 2)
    by_name = ranking.rank(spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "doc_id string, text string"), items.select("item_id").distinct().selectExpr("item_id", "'X' as text"))
    assert [(r["rank"], r.doc_id) for r in by_name.where("item_id = 1").orderBy("rank").collect()] == [(1, "a"), (2, "b")]


# ---- personal data -----------------------------------------------------------

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return (True, all(int(p) <= 255 for p in text.split(".")) if kind == 1 else False, 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[kind]


def brute_spans(text):
    found = sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text or "") if holds(k, m[0]))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in found)


TEXTS = [
    None, "", " \n", "no data", "a@b.c", "a@b.com_x@y.org z", "a@b@c.d.e.", ".@-.-.-", "x" * 5000 + "@" + "y" * 50 + ".z", "a@b" + ".c" * 30_000,
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0003.255", "00000000000000000000000000000255.1.1.1", "9" * 60 + ".1.1.1", "1.1.1", "1..1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111  1111 1111 1111", "x4111111111111111y", "0" * 14, "0" * 13, "0" * 19, "0" * 20, "4111111111111111 4111111111111111",
    "+1 (017) 555-7713", "+1((((5", "+123456789", "+1234567890", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++49 30 1234567", "+49.30.123.45.67 ext", "é😀 +1 (017) 555-7713 😀 a@b.co ü 1.2.3.4",
    "call 10.0.0.1 or me@x.org, +1 (222) 333-4444; 4111 1111 1111 1111!", "1 2 3 " * 4000, "+1 " * 3000, "a.b " * 3000 + "q@r.st", "1.2.3.4\n1.2.3.4\n1.2.3.4",
]
SPAN_DOCS = "doc_id long, text string, kind string, start string, row string"


def test_base_spans_against_brute_force(spark):
    rng = random.Random(8)
    texts = TEXTS + ["".join(rng.choice("0123456789 .-+()@ab\n") for _ in range(rng.randrange(300))) for _ in range(300)]
    rows = [(i, t, "k", "s", "r") for i, t in enumerate(texts)] + [(0, None, "k", "s", "r"), (35, texts[35], "k", "s", "r"), (None, "a@b.c", "k", "s", "r")]
    got = pii.digest(pii.detect(spark.createDataFrame(rows, SPAN_DOCS))).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    for r in got:
        text = texts[r.doc_id] if r.doc_id is not None else "a@b.c"
        want = brute_spans(text)
        assert r.base_sha256 == sha256(want.encode()).hexdigest(), (text or "")[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(re.findall(rf"\b{k}:", want)) for k in pii.KINDS[:4]]
        assert ",".join(s for s in r.spans.split(",") if s.split(":")[0] in pii.KINDS[:4]) == want


def test_model_adds_what_looks_alike(spark):
    rng = random.Random(9)
    number = lambda: f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
    rows = [f"please call +1 {number()} today, order {rng.randrange(10**8, 10**9)}x" for _ in range(200)]
    rows += [f"write to {w}{i}@mail.example.org soon" for i in range(100) for w in ("jo", "anna")]
    planted = ["please call 1 (333) 555-1234 today", "write to kim (at) mail (dot) example.org soon", "plain words only, 12 apples"]
    df = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(rows + planted)], SPAN_DOCS)
    got = {r.doc_id: r for r in pii.digest(pii.detect(df)).collect()}
    added = [got[len(rows) + i].spans for i in range(3)]
    assert added[0].startswith("digits:12:") and added[1].startswith("mail:9:") and added[2] == ""
    assert all(got[i].n_added == 0 for i in range(len(rows)))


def test_threshold_and_trees():
    cells = [((0, 1), 100, 98), ((1, 1), 100, 2), ((0, 0), 50, 45), ((1, 0), 50, 0)]
    trees = pii.boost(cells, [2, 2])
    score = lambda f: sum(pii._value(t, f) for t in trees)
    assert score((0, 1)) > score((0, 0)) > score((1, 1)) > score((1, 0)) - 1e-9
    assert pii.threshold([(2.0, 100, 99), (1.0, 100, 60), (0.0, 100, 1)]) == 2.0
    assert pii.threshold([(2.0, 100, 60), (1.0, 100, 99), (0.0, 10, 0)]) is None
    assert pii.threshold([(2.0, 10, 10)]) is None


def test_no_rows(spark):
    assert pii.digest(pii.detect(spark.createDataFrame([], SPAN_DOCS))).count() == 0
