"""Mixing sources to target weights by capped water-filling, in SQL alone.

Edge cases: a null text has size 0; a null source is a source of its own and
comes last; an empty table gives no rows; repeated rows of a doc_id are
separate rows; sources without words get target 0; further columns of the
input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_words, table

#: Weights in the order of the sources by code point, repeating.
WEIGHTS = (3, 1, 2)

_PLAN = """
WITH s AS (
  SELECT source, source IS NULL AS last, CAST(sum(size) AS BIGINT) AS source_size FROM {sized} GROUP BY source
), w AS (
  SELECT *, CAST(element_at({weights}, CAST(({rank} - 1) % {k} + 1 AS INT)) AS DOUBLE) AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY last, source) AS {rank} FROM s)
), o AS (
  SELECT *, CAST({cap} AS DOUBLE) * source_size / weight AS bar,
    {share} * sum(source_size) OVER () AS total FROM w
), f AS (
  SELECT *, (total - CAST({cap} AS DOUBLE) * coalesce(sum(source_size) OVER (ORDER BY bar, {rank}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY bar, {rank} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o
), l AS (
  SELECT *, coalesce(max(CASE WHEN level <= bar THEN level END) OVER (),
    CAST('Infinity' AS DOUBLE)) AS water FROM f
)
SELECT source, source_size, least(CAST({cap} AS DOUBLE) * source_size, weight * water) AS target FROM l
"""


def plan(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``sized(source, size)``.

    A source gets ``weight * level`` words, at most ``cap`` times its size.
    Sources that reach their cap first are those with the least ``cap * size /
    weight``; behind each of them the level for the others follows in closed
    form, and the first level within the next source's reach (the greatest such one) is where
    reshared excess settles. The windows run over one row for each source.
    """
    return sized.sparkSession.sql(
        _PLAN.format(
            sized="{sized}", weights=f"array({', '.join(map(str, weights))})", k=len(weights), rank="rank_no",
            cap=cap, share=f"CAST({share} AS DOUBLE)",
        ),
        sized=sized,
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target and taken.

    Every document is taken whole ``floor(target / source_size)`` times. The
    rest of the target goes to documents in the order of a seeded MD5 of their
    id: each is taken once more, the last one in part, so that a source's
    taken words sum to its rounded target. The running sum is cut into ranges of the
    hash: one row for each range and source is summed first, so that no task
    holds a whole source.
    """
    own = ("size", "source_size", "target", "taken", "__h", "__b", "__before", "__ahead", "__source", "__b_source", "__b_b")
    docs = docs.drop(*own)  # columns of these names are replaced
    sized = docs.withColumn("size", n_words(F.col("text"))).withColumn(
        "__h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    ).withColumn("__b", F.substring("__h", 1, 3))
    targets = plan(sized.select("source", "size"), weights, share, cap)
    spark = docs.sparkSession
    ranges = spark.sql(
        """
        SELECT source AS __b_source, __b AS __b_b, coalesce(sum(n) OVER (PARTITION BY source ORDER BY __b
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __ahead
        FROM (SELECT source, __b, sum(size) AS n FROM {sized} GROUP BY source, __b)
        """,
        sized=sized,
    ).join(
        targets.withColumnRenamed("source", "__source"), F.col("__b_source").eqNullSafe(F.col("__source"))
    )
    inside = spark.sql(
        """
        SELECT *, sum(size) OVER (PARTITION BY source, __b ORDER BY __h, doc_id, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS __before
        FROM {sized}
        """,
        sized=sized,
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.round(F.col("target")).cast("long") - whole * F.col("source_size")
    more = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest - F.col("__ahead") - F.col("__before")))
    return inside.join(
        ranges, F.col("source").eqNullSafe(F.col("__b_source")) & (F.col("__b") == F.col("__b_b"))
    ).select(
        *docs.columns,
        "size", "source_size", "target", (whole * F.col("size") + more).cast("long").alias("taken"),
    )


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat('7:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source COLLATE C) AS rn FROM s
), w AS (SELECT *, CAST(CASE (rn - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight FROM r
), o AS (SELECT *, CAST(2.0 AS DOUBLE) * source_size / weight AS bar,
    CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS BIGINT) AS total FROM w
), f AS (SELECT *, (total - CAST(2.0 AS DOUBLE) * CAST(coalesce(sum(source_size) OVER (ORDER BY bar, rn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
    / sum(weight) OVER (ORDER BY bar, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o
), l AS (SELECT *, coalesce(max(CASE WHEN level <= bar THEN level END) OVER (), CAST('Infinity' AS DOUBLE)) AS water FROM f
), t AS (SELECT source, source_size, least(CAST(2.0 AS DOUBLE) * source_size, weight * water) AS target FROM l
), c AS (SELECT d.*, t.source_size, t.target,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS before,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + least(size, greatest(0, CAST(round(target) AS BIGINT) - whole * source_size - before)) AS BIGINT) AS taken
FROM c
"""
