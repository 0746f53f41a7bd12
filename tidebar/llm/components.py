"""Connected components with DataFrame operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` -> ``(node, component)``; component is the least node reachable.

    Alternating large-star and small-star rounds: every node hangs its larger
    neighbours, then its smaller ones, on the least node of its neighbourhood,
    until nothing changes (logarithmically many rounds). Each round is two
    partially aggregated minima and two joins on the node; a node with very
    many neighbours is split by AQE's skew join. Each round ends in a
    checkpoint in the shared folder. Self loops, repeated edges and edges with
    a null end are ignored; only nodes with an edge are returned.
    """
    from .common import shared_dir

    shared_dir(edges.sparkSession)
    e = (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint()
    )
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = small.checkpoint()
        now = e.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.bit_xor(F.xxhash64("v", "u")).alias("y"),
        ).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("connected components did not settle")
    found = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def linked_components(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    close: Callable[[str, str], Column] = lambda a, b: F.lit(True),
) -> DataFrame:
    """Components of ``(node, component)`` among ids that share a bucket and are alike.

    ``buckets(id, bucket)`` names candidates, ``close`` is a cheap condition on two id
    columns, ``verify`` keeps the ``(u, v)`` of a frame of pairs that are alike, in a written table.
    No group is paired in full: each id is compared with the least and the
    greatest id of each of its buckets, which joins up nearly all of a large
    group with a few comparisons for each id. A bucket whose ids are then in one
    component holds no further news; in the others, ids of different components are
    compared, each pair of them.
    """
    from .common import cut, discard

    w = Window.partitionBy("bucket")
    ends = buckets.select(
        "bucket", "id", F.min("id").over(w).alias("low"), F.max("id").over(w).alias("high"), F.count(F.lit(1)).over(w).alias("m")
    ).where("m > 1")
    # Chance meetings of two are settled by one look at the pair; larger buckets may need another.
    met = cut(ends.where((F.col("m") > 2) | (close("low", "high") & (F.col("id") == F.col("low")))))
    near = cut(
        met.select("id", F.explode(F.array("low", "high")).alias("end"))
        .where((F.col("id") != F.col("end")) & close("id", "end"))
        .select(F.least("id", "end").alias("u"), F.greatest("id", "end").alias("v"))
        .distinct()
    )
    links = verify(near)
    labels = connected_components(links)
    crowd = met.where("m > 2")
    named = cut(crowd.join(labels, F.col("id") == F.col("node"), "left").select("bucket", "id", F.coalesce("component", "id").alias("class")))
    discard(met)
    mixed = named.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y")
    left = named.join(mixed.select("bucket"), "bucket", "left_semi")
    rest = cut(
        left.alias("a")
        .join(
            left.alias("b"),
            (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.class") < F.col("b.class")) & close("a.id", "b.id"),
        )
        .select(F.least("a.id", "b.id").alias("u"), F.greatest("a.id", "b.id").alias("v"))
        .distinct()
        .join(near, ["u", "v"], "left_anti")  # compared above
    )
    discard(near, named)
    more = verify(rest)
    discard(rest)
    return labels if more.isEmpty() else connected_components(links.unionByName(more))
