"""Personal data: fixed patterns, and boosted trees that judge what two wider generators propose.

DataFrame functions only. A row's matches of a pattern come with the stretches between them, from which
positions follow as running sums; candidates are shuffled by row once, texts never are.

The generators propose written-out addresses (``mail``: ``jo (at) example dot org``) and groups of seven or
more digits (``digits``); their spans overlap those of the fixed patterns. A candidate that meets a
fixed span is a positive example, any other one is not. What tells the two apart trivially (the plus of a phone,
the sign @) is no feature, so a candidate that looks like personal data and stands like it scores high though
no fixed pattern takes it. Features have few values each: Spark counts examples by their combination
(at most ``CELLS`` of them for a generator, whatever the input), the driver fits small trees to those counts, and the trees are applied as
CASE expressions. Scores are calibrated by isotonic regression on examples that were held back; a generator's
threshold is the lowest score with a probability of ``PRECISION``. One that never reaches it, or has too few examples, adds nothing.

Edge cases: a null or empty text has no spans and the digest of the empty string; repeated rows each
give a row; equal scores of overlapping candidates go to the earlier, then the longer one; an empty
table gives no rows; further columns are ignored. Patterns never go back
over what they have taken, so very long texts take time in proportion to their length, but for the sort of their own candidates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Base kinds in the order of the digest, then the generators.
KINDS = ("email", "ip", "card", "phone", "mail", "digits")
N_BASE = 4
_L, _D = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_AT, _DOT = r"\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?", r"\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_L})){_L}++@{_D}++(?:\.{_D}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",  # a shorter run fails whole
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "mail": rf"(?<!{_L}){_L}++(?:(?:\x20?@\x20?|{_AT}){_D}++(?:(?:\.|{_DOT}|\x20(?i:dot)\x20){_D}++)++|\x20(?i:at)\x20{_D}++(?:\x20(?i:dot)\x20{_D}++)++)",
    "digits": r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20.()-]{0,2}[0-9]){6,}+",
}
#: A cheap look that a text with a match passes.
_HINTS = {
    "email": "contains(t, '@')",
    "ip": r"t rlike '[0-9]\\.[0-9]'",
    "card": r"t rlike '[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9]'",
    "phone": r"t rlike '\\+[0-9]'",
    "mail": r"contains(t, '@') or t rlike '(?i)[\\[({]\\x20?at\\x20?[\\])}]|\\x20dot\\x20'",
    "digits": r"t rlike '[0-9][\\x20.()-]{0,2}[0-9][\\x20.()-]{0,2}[0-9][\\x20.()-]{0,2}[0-9]'",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_CHECKS = {
    "email": "true",
    "ip": rf"m rlike '^{_PART}\\.{_PART}\\.{_PART}\\.{_PART}$'",
    "card": f"CASE WHEN length({_DIGITS}) <= 19 THEN luhn_check({_DIGITS}) ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
}
#: Characters of context before a candidate.
CONTEXT = 24


def _bin(x: str, *bounds: int) -> str:
    """0 for x up to the first bound, and so on."""
    return "CASE " + " ".join(f"WHEN {x} <= {b} THEN {i}" for i, b in enumerate(bounds)) + f" ELSE {len(bounds)} END"


_CUE = r"""CASE WHEN before rlike '(?i)\\b(tel|phone|fax|call|mobile|cell|dial)' THEN 1 WHEN before rlike '(?i)\\b(card|visa|account|iban|mail|contact|write)' THEN 2
  WHEN before rlike '(?i)(version|order|isbn|page|\\bid\\b|\\bno\\.|\\bnr\\b|[#$€=])' THEN 3 ELSE 0 END"""
_BEFORE = r"CASE WHEN before = '' OR before rlike '[\\s(+]$' THEN 0 WHEN before rlike '[A-Za-z0-9]$' THEN 1 ELSE 2 END"
_AFTER = r"CASE WHEN after = '' OR after rlike '^\\s' THEN 0 WHEN after rlike '^[.,;:!?)]' THEN 1 WHEN after rlike '^[A-Za-z0-9]' THEN 2 ELSE 3 END"
_PLAIN = r"regexp_replace(regexp_replace(lower(m), '\\x20?[\\[({]?\\x20?\\bat\\b\\x20?[\\])}]?\\x20?|\\x20?@\\x20?', '@'), '\\x20?[\\[({]?\\x20?\\bdot\\b\\x20?[\\])}]?\\x20?', '.')"
_FIRST = "regexp_extract(m, '^[0-9]{13,19}', 0)"  # cards may stand side by side
#: Features of each generator: (expression over m, before, after; number of values).
FEATURES = {
    "mail": [
        (_bin(f"length(split_part({_PLAIN}, '@', 1))", 1, 3, 8, 16, 32), 6),
        (_bin(f"length(split_part({_PLAIN}, '@', -1)) - length(replace(split_part({_PLAIN}, '@', -1), '.', ''))", 1, 2, 3), 4),
        (_bin(f"length(split_part({_PLAIN}, '.', -1))", 1, 3, 6, 12), 5),
        (f"CASE WHEN split_part({_PLAIN}, '.', -1) rlike '^[a-z]+$' THEN 1 ELSE 0 END", 2),
        (_bin(f"length(split_part({_PLAIN}, '@', -1))", 4, 8, 16, 32), 5),
        (_CUE, 4), (_BEFORE, 3), (_AFTER, 4),
    ],
    "digits": [
        (_bin(f"length({_DIGITS})", 7, 9, 10, 11, 13, 15, 16, 19), 9),
        (_bin(r"length(regexp_replace(regexp_replace(m, '[0-9]+', 'x'), '[^x]', ''))", 1, 2, 3, 4), 5),
        (_bin(r"length(regexp_extract(m, '[0-9]+', 0))", 1, 2, 3, 4, 6, 12), 7),
        (_bin(r"length(regexp_extract(m, '[0-9]+$', 0))", 1, 2, 3, 4, 6, 12), 7),
        (r"CASE WHEN m rlike '[()]' THEN 1 WHEN m rlike '\\.' THEN 2 WHEN m rlike '-' THEN 3 WHEN m rlike '\\x20' THEN 4 ELSE 0 END", 5),
        (f"CASE WHEN length({_DIGITS}) BETWEEN 12 AND 19 AND luhn_check({_DIGITS}) OR {_FIRST} <> '' AND luhn_check({_FIRST}) THEN 1 ELSE 0 END", 2),
        (_CUE, 4), (_BEFORE, 3), (_AFTER, 4),
    ],
}
#: Bound of the number of counts that reach the driver for a generator: the product of its features' values, by label and fold.
CELLS = {k: 4 * math.prod(n for _, n in fs) for k, fs in FEATURES.items()}
ROUNDS, RATE = 30, 0.3
PRECISION, LEAST_EXAMPLES = 0.95, 20


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, kind, start, end, base, positive, f) of all matches, and a row without kind for each document.

    ``base`` marks spans of the fixed patterns that hold; ``positive`` generators' spans that meet one.
    """
    t = F.coalesce(F.col(text_col), F.lit("")).alias("t")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), t)

    def pieces(k: int, kind: str) -> Column:
        found = F.zip_with(
            F.split("t", PATTERNS[kind], -1),
            F.regexp_extract_all("t", F.lit(PATTERNS[kind]), F.lit(0)),
            lambda gap, m: F.struct(F.length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT)).alias("before"), F.left(gap, F.lit(1)).alias("head"), m.alias("m")),
        )
        return F.struct(F.lit(k).alias("kind"), F.when(F.expr(_HINTS[kind]), found).alias("found"))

    kinds = F.array(*[pieces(k, kind) for k, kind in enumerate(KINDS)])
    every = rows.select("row", "id", kinds.alias("kinds")).select("row", "id", F.explode(F.concat(
        F.array(F.struct(F.lit(None).cast("int").alias("kind"), F.lit(None).cast("array<struct<gap:int,before:string,head:string,m:string>>").alias("found"))),
        F.filter("kinds", lambda x: F.size(x.found) > 1),
    )).alias("k"))
    matches = every.select("row", "id", "k.kind", F.posexplode_outer("k.found").alias("at", "x")).select("row", "id", "kind", "at", "x.*")
    by_kind = Window.partitionBy("row", "kind").orderBy("at")
    placed = matches.repartition("row").withColumns({
        "end": F.sum(F.col("gap") + F.coalesce(F.length("m"), F.lit(0))).over(by_kind.rowsBetween(Window.unboundedPreceding, 0)),
        "after": F.coalesce(F.lead("head").over(by_kind), F.lit("")),
        # adjoining matches stand next to each other's characters
        "before": F.when((F.col("gap") == 0) & (F.col("at") > 0), F.lag("m").over(by_kind)).otherwise(F.col("before")),
    }).where("kind is null or m is not null")
    holds = F.expr("CASE kind " + " ".join(f"WHEN {k} THEN {_CHECKS[kind]}" for k, kind in enumerate(KINDS[:N_BASE])) + " ELSE false END")
    spans = placed.withColumns({"start": F.col("end") - F.length("m"), "base": F.coalesce(holds, F.lit(False))})
    by_start = Window.partitionBy("row").orderBy("start")
    earlier = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    later = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    features = F.expr(
        "CASE kind " + " ".join(
            f"WHEN {N_BASE + g} THEN array({', '.join(f'CAST({x} AS TINYINT)' for x, _ in fs)})" for g, fs in enumerate(FEATURES.values())
        ) + " END"
    )
    return (
        spans.withColumn("positive", F.coalesce(earlier > F.col("start"), F.lit(False)) | F.coalesce(later < F.col("end"), F.lit(False)))
        .where(f"kind is null or base or kind >= {N_BASE}")
        .select("row", "id", "kind", "start", "end", "base", "positive", features.alias("f"))
    )


# ---- boosted trees over counts of examples -----------------------------------


def _best_split(cells: list[tuple], grads: list[tuple[float, float]], rows: list[int], sizes: list[int]):
    """(gain, feature, bound) of the split of ``rows`` that lowers the logistic loss most, or None."""
    g, h = sum(grads[r][0] for r in rows), sum(grads[r][1] for r in rows)
    best = None
    for j, n in enumerate(sizes):
        by = [[0.0, 0.0] for _ in range(n)]
        for r in rows:
            slot = by[cells[r][0][j]]
            slot[0] += grads[r][0]
            slot[1] += grads[r][1]
        gl = hl = 0.0
        for b in range(n - 1):
            gl, hl = gl + by[b][0], hl + by[b][1]
            if hl < 1 or h - hl < 1:
                continue
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            if gain > 1e-6 and (best is None or gain > best[0]):
                best = (gain, j, b)
    return best


def _tree(cells, grads, rows, sizes, depth):
    split = _best_split(cells, grads, rows, sizes) if depth else None
    if split is None:
        g, h = sum(grads[r][0] for r in rows), sum(grads[r][1] for r in rows)
        return -RATE * g / (h + 1)
    _, j, b = split
    low = [r for r in rows if cells[r][0][j] <= b]
    high = [r for r in rows if cells[r][0][j] > b]
    return (j, b, _tree(cells, grads, low, sizes, depth - 1), _tree(cells, grads, high, sizes, depth - 1))


def _value(tree, f) -> float:
    while isinstance(tree, tuple):
        j, b, low, high = tree
        tree = low if f[j] <= b else high
    return tree


def boost(cells: list[tuple[tuple, int, int]], sizes: list[int], rounds: int = ROUNDS, depth: int = 3) -> list:
    """Trees for cells of (features, examples, positives among them), by Newton steps on the logistic loss; the first is a constant."""
    n, p = sum(c[1] for c in cells), sum(c[2] for c in cells)
    first = math.log((p + 1) / (n - p + 1))
    scores, trees = [first] * len(cells), [first]
    for _ in range(rounds):
        prob = [1 / (1 + math.exp(-s)) for s in scores]
        grads = [(c[1] * q - c[2], c[1] * q * (1 - q)) for c, q in zip(cells, prob)]
        tree = _tree(cells, grads, list(range(len(cells))), sizes, depth)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
        scores = [s + _value(tree, c[0]) for s, c in zip(scores, cells)]
    return trees


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree:.12f}D"
    j, b, low, high = tree
    return f"CASE WHEN f[{j}] <= {b} THEN {_sql(low)} ELSE {_sql(high)} END"


def threshold(scored: list[tuple[float, int, int]], precision: float = PRECISION, least: int = LEAST_EXAMPLES) -> float | None:
    """The lowest score whose calibrated probability reaches the precision, or None.

    Probabilities come from held-back (score, examples, positives) by isotonic regression: neighbours by score are
    pooled until the share of positives rises with the score. A pool needs ``least`` positives to count.
    """
    merged: dict[float, list[int]] = {}
    for s, n, p in scored:
        slot = merged.setdefault(s, [0, 0])
        slot[0] += n
        slot[1] += p
    pools: list[list] = []  # lowest score, examples, positives
    for s in sorted(merged):
        pools.append([s, *merged[s]])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            _, n, p = pools.pop()
            pools[-1][1] += n
            pools[-1][2] += p
    good = [s for s, n, p in pools if p >= least and p >= precision * n]
    return min(good, default=None)


def train(found: DataFrame) -> dict[str, tuple[list, float]]:
    """(trees, threshold) of each generator that reaches the precision."""
    fold = (F.pmod(F.xxhash64("id", "start"), F.lit(2)) == 0).alias("held_back")
    counts = found.where(f"kind >= {N_BASE}").groupBy("kind", "f", fold).agg(F.count(F.lit(1)).alias("n"), F.count_if("positive").alias("p")).collect()
    models = {}
    for g, (kind, fs) in enumerate(FEATURES.items()):
        own = [(tuple(r.f), r.n, r.p, r.held_back) for r in counts if r.kind == N_BASE + g]
        cells = sorted((f, n, p) for f, n, p, held in own if not held)
        if sum(c[2] for c in cells) < LEAST_EXAMPLES:
            continue
        trees = boost(cells, [n for _, n in fs])
        score = lambda f: round(sum(_value(t, f) for t in trees), 9)  # noqa: B023, E731
        least = threshold([(score(f), n, p) for f, n, p, held in own if held])
        if least is not None:
            models[kind] = (trees, least)
    return models


def selected(found: DataFrame, models: dict[str, tuple[list, float]]) -> DataFrame:
    """``found`` without candidates that no pattern holds for and no model selects; of overlapping selected ones the likeliest stays.

    Rows without kind stay: there is one for each document.
    """
    score, least = F.lit(None).cast("double"), F.lit(None).cast("double")
    for kind, (trees, bound) in models.items():
        own = F.col("kind") == KINDS.index(kind)
        score = F.when(own, F.round(sum((F.expr(_sql(t)) for t in trees), F.lit(0.0)), 9)).otherwise(score)
        least = F.when(own, F.lit(bound)).otherwise(least)
    out = found.withColumns({"score": score, "least": least}).where("kind is null or base or (not positive and score >= least - 1e-9)")
    added = ~F.col("base") & F.col("kind").isNotNull()
    run = Window.partitionBy("row", "added").orderBy("start", "end", "kind")
    # a stretch begins where no earlier added span reaches
    reach = F.max("end").over(run.rowsBetween(Window.unboundedPreceding, -1))
    out = out.withColumn("added", added).withColumn("first", F.coalesce(reach <= F.col("start"), F.lit(True)))
    out = out.withColumn("stretch", F.sum(F.col("first").cast("int")).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("row", "added", "stretch").orderBy(F.desc("score"), "start", F.desc("end"), "kind")
    return out.withColumn("__k", F.row_number().over(best)).where("not added or __k = 1").select("row", "id", "kind", "start", "end", "base", "score")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, kind, start, end, base, score) of all spans, and one row without kind for each document.

    Positions are code points, ``end`` is exclusive. ``row`` tells rows of an equal id apart. Candidates are written to the shared
    folder once; models and spans come from there.
    """
    found = cut(candidates(docs, id_col, text_col))
    return selected(found, train(found))


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: counts of base spans, their digest, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.struct("start", "kind", "end", "base")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start, s.end)), ",")
    return (
        spans.groupBy("row")
        .agg(
            F.first("id").alias(id_col),
            *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:N_BASE])],
            F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), one))).alias("s"),
        )
        .select(
            id_col, *[f"n_{k}" for k in KINDS[:N_BASE]],
            F.sha2(joined(F.filter("s", lambda x: x.base)), 256).alias("base_sha256"),
            joined(F.col("s")).alias("spans"),
            (F.size("s") - F.size(F.filter("s", lambda x: x.base))).cast("long").alias("n_added"),
        )
    )


def op13_pii(spark, sf_dir: str) -> DataFrame:
    return digest(detect(table(spark, sf_dir, "documents")))
