"""Landed payloads: what a provider returned for a request, kept as it came and read back by request id.

A payload is ``map<string, array<map<string,string>>>``: members by key, each with its rows, each row with its own columns. A
member can be null, and it can have no rows; both are facts and survive the round trip. A null or empty payload has no members.

Stored are an ``inventory`` (a row for each member) and ``rows``. The rows of a request with many members of one shape are packed:
their columns are named once, in the inventory, and a row holds texts only. All others keep their names in every row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical as cj

#: From this number of members on a request is packed.
PACK_FROM = 128
REQUEST = ("provider", "dataset", "request_id")
PAYLOAD = "map<string, array<map<string,string>>>"
_INVENTORY = "request_id string, layout string, member string, place int, row_count int, shape array<string>, provider string, dataset string"
_MEMBERS = "provider string, dataset string, request_id string, place int, member string, row_count int, lo array<string>, hi array<string>, rows array<map<string,string>>"
_ROWS = "request_id string, member string, ordinal int, cells array<string>, named map<string,string>, provider string, dataset string, layout string"
#: Names under which a row carries its own identity, in any case; the first that is present decides. Fixed values.
IDENTITY_FIELDS = ("provider_symbol", "security_code", "market_code", "code")


def _shapes(payload: Column) -> Column:
    """The distinct lists of column names of all rows."""
    return F.array_distinct(F.flatten(F.transform(F.map_values(payload), lambda rows: F.transform(F.coalesce(rows, F.array().cast("array<map<string,string>>")), lambda r: F.array_sort(F.map_keys(r))))))


def layout_of(payload: Column, pack_from: int = PACK_FROM) -> Column:
    """PACKED or NAMED: packed are ``pack_from`` members or more that aren't null, whose rows all have the same columns, and at least one."""
    shapes = _shapes(payload)
    live = F.size(F.filter(F.map_values(payload), lambda rows: rows.isNotNull()))
    one = (F.size(shapes) == 0) | ((F.size(shapes) == 1) & (F.size(shapes[0]) > 0))
    return F.when((live >= pack_from) & one, "PACKED").otherwise("NAMED")


def _ends(rows: Column) -> tuple[Column, Column]:
    """The least and the greatest list of column names of a member's rows; equal if all rows have the same. A null row has no names."""
    shapes = F.transform(rows, lambda r: F.coalesce(F.sort_array(F.map_keys(r)), F.array().cast("array<string>")))
    return F.array_min(shapes), F.array_max(shapes)


def land(payloads: DataFrame, path: str, pack_from: int = PACK_FROM) -> None:
    """Writes rows (provider, dataset, request_id, payload); a request id comes once for each provider and dataset.

    Tables are partitioned by provider and dataset, rows also by layout, and dealt and sorted by ranges of request ids, so that a read of one opens
    few files, and a request of any size is cut between tasks. The inventory is written last: rows without it are a payload that did not land.
    """
    land_members(payloads.select(*REQUEST, F.posexplode("payload").alias("place", "member", "rows")), path, pack_from)


def land_members(members: DataFrame, path: str, pack_from: int = PACK_FROM) -> None:
    """As ``land``, of rows (provider, dataset, request_id, place, member, rows), each one member; no request is put together in one row.

    Members are worked out once and held until the end. Whether a request is packed comes from counts of its members and the
    least and greatest shape of each, as in ``layout_of``.
    """
    spark = members.sparkSession
    lo, hi = _ends(F.col("rows"))
    count = F.when(F.col("rows").isNotNull(), F.size("rows"))
    members.select(*REQUEST, F.col("place").cast("int").alias("place"), "member", count.alias("row_count"), lo.alias("lo"), hi.alias("hi"), "rows").write.mode("overwrite").parquet(f"{path}/members")
    held = spark.read.schema(_MEMBERS).parquet(f"{path}/members")
    facts = held.groupBy(*REQUEST).agg(F.count("row_count").alias("live"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    one = F.col("lo").isNull() | ((F.col("lo") == F.col("hi")) & (F.size("lo") > 0))
    packed = (F.col("live") >= pack_from) & one
    shape = F.when(packed, F.coalesce("lo", F.array().cast("array<string>")))
    facts = facts.select(*[F.col(c).alias(f"__{c}") for c in REQUEST], F.when(packed, "PACKED").otherwise("NAMED").alias("layout"), shape.alias("shape"))
    placed = held.join(facts, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in REQUEST]))
    keys = ["provider", "dataset", "request_id", "member"]
    # members are dealt, and rows taken out of them after that
    dealt = placed.where("row_count > 0").select(*REQUEST, "member", "layout", "shape", "rows").repartitionByRange(*keys)
    rows = dealt.select(*REQUEST, "layout", "shape", "member", F.posexplode("rows").alias("ordinal", "r"))
    packed = F.col("layout") == "PACKED"
    cells = F.when(packed, F.transform("shape", lambda name: F.element_at(F.col("r"), name)))
    rows = rows.select("request_id", "member", "ordinal", cells.alias("cells"), F.when(~packed, F.col("r")).alias("named"), "provider", "dataset", "layout")
    by = ["provider", "dataset", "layout"]  # the order that the writer needs comes first, so that it doesn't sort again
    rows.sortWithinPartitions(*by, "request_id", "member", "ordinal").write.mode("overwrite").partitionBy(*by).parquet(f"{path}/rows")
    # a row's shape is null where its columns are its own
    inventory = placed.select("request_id", "layout", "member", "place", "row_count", "shape", "provider", "dataset")
    inventory.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy("provider", "dataset").parquet(f"{path}/inventory")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/members")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _scope(df: DataFrame, provider: str | None, dataset: str | None, request_id: str | None) -> DataFrame:
    for name, value in zip(REQUEST, (provider, dataset, request_id)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def inventory(spark: SparkSession, path: str, provider: str | None = None, dataset: str | None = None, request_id: str | None = None) -> DataFrame:
    """A row for each member: its layout, place in the payload, number of rows (null for a null member) and shape (null unless packed)."""
    return _scope(spark.read.schema(_INVENTORY).parquet(f"{path}/inventory"), provider, dataset, request_id)


def read_rows(spark: SparkSession, path: str, provider: str | None = None, dataset: str | None = None, request_id: str | None = None) -> DataFrame:
    """(provider, dataset, request_id, member, row_count, ordinal, row), of all requests or those asked for; a member without rows has one with nulls."""
    held = inventory(spark, path, provider, dataset, request_id)
    rows = _scope(spark.read.schema(_ROWS).parquet(f"{path}/rows"), provider, dataset, request_id).drop("layout")
    row = F.when(F.col("named").isNotNull(), F.col("named")).when(F.col("cells").isNotNull(), F.map_from_arrays("shape", "cells"))
    return held.join(rows, [*REQUEST, "member"], "left").select(*REQUEST, "member", "row_count", "ordinal", row.alias("row"))


def read_payload(spark: SparkSession, path: str, provider: str, dataset: str, request_id: str) -> DataFrame:
    """One landed payload as it came: a row (provider, dataset, request_id, payload), or none. One request is as large as its response was."""
    rows = read_rows(spark, path, provider, dataset, request_id)
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("ordinal").isNotNull(), F.struct("ordinal", F.map_entries("row").alias("e"))))), lambda x: F.map_from_entries(x.e))
    members = rows.groupBy(*REQUEST, "member").agg(F.when(F.max("row_count").isNotNull(), listed).alias("rows"))
    return members.groupBy(*REQUEST).agg(F.map_from_entries(F.collect_list(F.struct("member", "rows"))).alias("payload"))


def verify(spark: SparkSession, path: str) -> DataFrame:
    """Members whose stored rows aren't as many as their inventory says: (provider, dataset, request_id, member, row_count, held)."""
    held = spark.read.schema(_ROWS).parquet(f"{path}/rows").groupBy(*REQUEST, "member").agg(F.count(F.lit(1)).alias("held"))
    both = inventory(spark, path).select(*REQUEST, "member", "row_count").join(held, [*REQUEST, "member"], "full")
    return both.where(~F.coalesce("row_count", F.lit(0)).eqNullSafe(F.coalesce("held", F.lit(0)))).select(*REQUEST, "member", "row_count", F.coalesce("held", F.lit(0)).alias("held"))


def _field(row: Column, *names: str) -> Column:
    """Texts of the columns of these names in any case, nulls and empty ones included, in the order of ``names``."""

    def called(name: str) -> Column:
        return F.transform(F.filter(F.map_entries(row), lambda e: F.lower(e.key) == name), lambda e: F.trim(e.value))

    return F.flatten(F.array(*[called(n) for n in names]))


def identity_verdict(symbol: Column, row: Column) -> Column:
    """Null if the row's own identity agrees with its key, or it has none; else why it is rejected.

    The key is a code with its exchange. A row's identity is the first field that has a text: equal to the key if it holds
    a point, to its bare code if not. Fields that are there without a text are ambiguous.
    """
    found = F.filter(F.map_entries(row), lambda e: F.lower(e.key).isin(*IDENTITY_FIELDS))  # few entries, then looked at by name
    fields = lambda f: F.flatten(F.array(*[F.transform(F.filter(f, lambda e: F.lower(e.key) == n), lambda e: F.trim(e.value)) for n in IDENTITY_FIELDS]))

    def verdict(held: Column) -> Column:
        def of_own(own: Column) -> Column:
            agrees = F.when(F.contains(own, F.lit(".")), own == symbol).otherwise(own == F.split_part(symbol, F.lit("."), F.lit(1)))
            return F.when(own.isNotNull() & ~agrees, "IDENTITY_CONFLICT").when(own.isNull() & (F.size(held) > 0), "IDENTITY_MISSING_OR_AMBIGUOUS")

        return cj.let(F.get(F.filter(held, lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(0)), of_own)

    return cj.let(found, lambda f: F.when(F.size(f) > 0, cj.let(fields(f), verdict)))


def flatten(rows: DataFrame) -> DataFrame:
    """Member maps as rows: (provider, dataset, request_id, symbol, ordinal, marker, reason, row).

    ``rows`` is as ``read_rows`` returns it. Every row gets its member's key as ``PROVIDER_SYMBOL``. A null member leaves
    a NULL_MEMBER row, one without rows an EMPTY_MEMBER row. A row is REJECTED if its own identity conflicts with the key, or if the key
    is no code with an exchange; a key decides for markers as well.
    """
    key = F.col("member")
    bad_key = ~F.coalesce(F.trim(key).rlike("^[0-9]{6}[.](SH|SZ|BJ)$"), F.lit(False))
    plain = F.map_filter("row", lambda k, v: F.lower(k) != "provider_symbol")
    injected = F.when(F.col("row").isNotNull(), F.map_concat(plain, F.create_map(F.lit("PROVIDER_SYMBOL"), key)))
    reason = F.when(bad_key, "KEY_NOT_QUALIFIED").when(F.col("row").isNotNull(), identity_verdict(F.trim(key), F.col("row")))
    marker = F.when(F.col("reason").isNotNull(), "REJECTED").when(F.col("row_count").isNull(), "NULL_MEMBER").when(F.col("row_count") == 0, "EMPTY_MEMBER").otherwise("ROW")
    judged = rows.select(*REQUEST, "member", "row_count", "ordinal", reason.alias("reason"), "row")
    return judged.select(*REQUEST, key.alias("symbol"), "ordinal", marker.alias("marker"), "reason", injected.alias("row"))


def shape_report(flat: DataFrame) -> DataFrame:
    """(provider, dataset, code, tables, n): members affected by each code and rows (or members, for markers) with it.

    Codes are the reasons and markers of ``flatten``, DATE_MISSING_OR_INVALID for rows whose TRADE_DATE is no day, and VALID.
    """
    day = F.get(F.filter(_field(F.col("row"), "trade_date"), lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(0))
    dated = F.expr("try_to_date(d, 'yyyyMMdd')").isNotNull() | F.expr("try_to_date(d, 'yyyy-MM-dd')").isNotNull()
    code = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("marker") != "ROW", F.col("marker")).when(~dated, "DATE_MISSING_OR_INVALID").otherwise("VALID")
    coded = flat.withColumn("d", day).select(*REQUEST, "symbol", code.alias("code"))
    each = coded.groupBy(*REQUEST, "symbol", "code").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("provider", "dataset", "code").agg(F.count(F.lit(1)).alias("tables"), F.sum("n").alias("n"))
