"""Natural keys, fact hashes, partition manifests and which columns vary within a partition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical as cj

#: Number of parts of each domain's natural key; the third one is the factor type.
ARITY = {"daily_bar": 2, "security_status": 2, "limit_price": 2, "adjustment_factor": 3, "trade_calendar": 2}


def natural_key(domain: Column, *parts: Column) -> Column:
    """Canonical JSON array of as many of ``parts`` as the domain has; null for other domains and where a part is null."""
    return reduce(lambda rest, d: F.when(domain == d, cj.key_json(*parts[: ARITY[d]])).otherwise(rest), ARITY, F.lit(None).cast("string"))


def key_parts(key: Column) -> Column:
    """The parts of a key that is a JSON array, as texts; null for any other text."""
    return F.when(F.schema_of_variant(F.try_parse_json(key)).startswith("ARRAY"), F.from_json(key, "array<string>"))


def key_verdict(domain: Column, key: Column, *typed: Column) -> Column:
    """The first fault of a key: no JSON, no array, wrong arity, a part that is no text or empty, not in canonical form,
    parts that differ from the row's typed columns; else VALID."""
    v, parts = F.try_parse_json(key), key_parts(key)
    arity = reduce(lambda rest, d: F.when(domain == d, ARITY[d]).otherwise(rest), ARITY, F.lit(None).cast("int"))
    kinds = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.schema_of_variant(x))
    bad = F.exists(kinds, lambda k: k != "STRING") | F.exists(parts, lambda p: p == "")
    again = F.concat(F.lit("["), F.array_join(F.transform(parts, cj.text_json), ","), F.lit("]"))
    differs = reduce(lambda a, it: a | ~F.get(parts, F.lit(it[0])).eqNullSafe(it[1]), enumerate(typed), F.lit(False))
    return (
        F.when(v.isNull(), "NOT_JSON").when(parts.isNull(), "NOT_AN_ARRAY").when(arity.isNull(), "UNKNOWN_DOMAIN").when(F.size(parts) != arity, "ARITY")
        .when(bad, "BAD_PART").when(again != key, "NOT_CANONICAL").when(differs, "PARTS_DISAGREE").otherwise("VALID")
    )


def fact_hashes(facts: DataFrame, statement: list[str], version: str) -> DataFrame:
    """``fact_hash`` over the statement's columns and the version, ``review_hash`` over the statement alone."""
    return facts.withColumns({"fact_hash": cj.row_hash(facts, [*statement, version]), "review_hash": cj.row_hash(facts, statement)})


def column_profile(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """(keys, column_name, is_constant, value): whether a column has one value (null is one) in a partition, and which, as JSON.

    One aggregation over all columns: the least and the greatest JSON text and the number of nulls of each. Doubles that are
    not finite count as values.
    """
    columns = columns or [c for c in df.columns if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    json = df.select(*keys, *[F.when(F.col(f"`{c}`").isNotNull(), cj.value_json(F.col(f"`{c}`"), kinds[c])).alias(c) for c in columns])
    lows = [F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.count(c).alias("known")).alias(c) for c in columns]
    wide = json.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *lows)
    long = wide.select(*keys, "__n", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("s")) for c in columns])).alias("p"))
    constant = (F.col("p.s.known") == 0) | (F.col("p.s.known") == F.col("__n")) & (F.col("p.s.low") == F.col("p.s.high"))
    return long.select(*keys, "p.column_name", constant.alias("is_constant"), F.when(constant, F.coalesce("p.s.low", F.lit("null"))).alias("value"))


def partition_manifest(bars: DataFrame, key: str) -> DataFrame:
    """(key, n, table_hash, event_day, vintage): what a partition holds, by partial aggregates."""
    times = bars.groupBy(key).agg(F.max("trade_date").alias("event_day"), F.max("available_on").alias("vintage"))
    hashes = cj.table_hash(bars, [key], [c for c in bars.columns if c != key])
    return hashes.drop("non_finite").join(times, key)


def compare_manifests(declared: DataFrame, actual: DataFrame, key: str, as_of: Column) -> DataFrame:
    """(key, verdict): the first way in which a partition departs from its manifest, or comes after the cutoff."""
    d, a = declared.alias("d"), actual.alias("a")
    differ = lambda c: ~F.col(f"d.{c}").eqNullSafe(F.col(f"a.{c}"))
    verdict = (
        F.when(F.col(f"a.{key}").isNull(), "MISSING").when(F.col(f"d.{key}").isNull(), "UNDECLARED").when(differ("n"), "COUNT")
        .when(differ("event_day"), "EVENT_TIME").when(differ("vintage"), "VINTAGE").when(differ("table_hash"), "CONTENT")
        .when(F.col("a.event_day") > as_of, "EVENT_AFTER_CUTOFF").when(F.col("a.vintage") > as_of, "VINTAGE_AFTER_CUTOFF").otherwise("EQUAL")
    )
    return d.join(a, F.col(f"d.{key}") == F.col(f"a.{key}"), "full").select(F.coalesce(f"d.{key}", f"a.{key}").alias(key), verdict.alias("verdict"))
