"""Market tables derived from the star-schema test tables.

Bars come from ``lineitem`` (one security for each supplier, price = extended
price / quantity), minute bars from ``events``, identities and exchanges from
``supplier``. Holes are planted by fixed rules on the day number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH = "1990-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit(EPOCH).cast("date"))


def security_id(key: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(key.cast("string"), 6, "0"))


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily open, high, low, close, volume and amount: one shuffle by security, which windows over a security share.

    Lines of one order and number on a day are a tie: the lowest price opens, the highest closes; a line without them is
    the last. Suppliers stay apart even where their keys are too long for ids of six digits.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    place = F.struct(F.isnull("o"), "o", "p")
    return (
        table(spark, sf_dir, "lineitem")
        .select(security_id(F.col("l_suppkey")).alias("security_id"), "l_suppkey", F.col("l_shipdate").cast("date").alias("trade_date"), price.alias("p"), order.alias("o"), "l_quantity", "l_extendedprice")
        .repartition("security_id")
        .groupBy("security_id", "l_suppkey", "trade_date")
        .agg(
            F.min_by("p", place).alias("open"), F.max("p").alias("high"),
            F.min("p").alias("low"), F.max_by("p", place).alias("close"),
            F.round(F.sum("l_quantity")).cast("long").alias("volume"), F.round(F.sum("l_extendedprice"), 2).alias("amount"),
        )
        .drop("l_suppkey")
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with pre_close and availability, and with holes.

    On every 23rd day pre_close is 0, on every 17th amount is null, and rows of
    every 29th day arrive three days late.
    """
    w = Window.partitionBy("security_id").orderBy("trade_date")
    d = day_number(F.col("trade_date"))
    return raw_bars(spark, sf_dir).select(
        "security_id", "trade_date", "open", "high", "low", "close",
        F.when(d % 23 == 0, 0.0).otherwise(F.lag("close").over(w)).alias("pre_close"), "volume",
        F.when(d % 17 != 0, F.col("amount")).alias("amount"),
        F.date_add("trade_date", F.when(d % 29 == 0, 3).otherwise(0)).alias("available_on"),
    )


RAW_BARS_SQL = """
px AS (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS trade_date, l_orderkey * 10 + l_linenumber AS o,
    l_extendedprice / l_quantity AS p, l_quantity, l_extendedprice FROM lineitem),
raw_bars AS (SELECT 'S' || lpad(CAST(k AS VARCHAR), 6, '0') AS security_id, trade_date,
    arg_min(p, o) AS open, max(p) AS high, min(p) AS low, arg_max(p, o) AS close,
    CAST(round(sum(l_quantity)) AS BIGINT) AS volume, round(sum(l_extendedprice), 2) AS amount
  FROM px GROUP BY k, trade_date)"""

BARS_SQL = RAW_BARS_SQL + """,
bars AS (SELECT security_id, trade_date, open, high, low, close,
    CASE WHEN d % 23 = 0 THEN 0.0 ELSE lag(close) OVER (PARTITION BY security_id ORDER BY trade_date) END AS pre_close,
    volume, CASE WHEN d % 17 <> 0 THEN amount END AS amount,
    CAST(trade_date + CASE WHEN d % 29 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS DATE) AS available_on
  FROM (SELECT *, date_diff('day', DATE '1990-01-01', trade_date) AS d FROM raw_bars))"""


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions: the distinct ship dates."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("trade_date")).distinct()


CALENDAR_SQL = "calendar AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS trade_date FROM lineitem)"


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Securities: code, market code 1/2/3, exchange, list and delist date."""
    k, nation = F.col("s_suppkey"), F.col("s_nationkey")
    market = F.pmod(nation, F.lit(3)) + 1
    return table(spark, sf_dir, "supplier").select(
        security_id(k).alias("security_id"), F.lpad(k.cast("string"), 6, "0").alias("code"), market.cast("int").alias("market_code"),
        F.element_at(F.array(F.lit("SH"), F.lit("SZ"), F.lit("BJ")), market.cast("int")).alias("exchange"),
        F.date_add(F.lit("1992-01-01").cast("date"), F.pmod(k * 7, F.lit(900)).cast("int")).alias("list_date"),
        F.when(k % 11 == 0, F.date_add(F.lit("1996-01-01").cast("date"), F.pmod(k * 5, F.lit(700)).cast("int"))).alias("delist_date"),
        (k % 7 == 0).alias("is_st"),
    )


MASTER_SQL = """
master AS (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS security_id, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS code,
    CAST(s_nationkey % 3 + 1 AS INTEGER) AS market_code, ['SH', 'SZ', 'BJ'][s_nationkey % 3 + 1] AS exchange,
    CAST(DATE '1992-01-01' + CAST((s_suppkey * 7) % 900 AS INTEGER) AS DATE) AS list_date,
    CASE WHEN s_suppkey % 11 = 0 THEN CAST(DATE '1996-01-01' + CAST((s_suppkey * 5) % 700 AS INTEGER) AS DATE) END AS delist_date,
    s_suppkey % 7 = 0 AS is_st FROM supplier)"""


def identity_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open symbol intervals. Every fifth security changes its code on 1995-06-01."""
    m = master(spark, sf_dir)
    symbol = F.concat_ws(".", "code", "exchange")
    change = F.lit("1995-06-01").cast("date")
    moved = F.substring("code", 6, 1).isin("0", "5")
    base = ["security_id", "exchange"]
    plain = m.where(~moved).select(*base, symbol.alias("symbol"), F.col("list_date").alias("valid_from"), F.col("delist_date").alias("valid_to"))
    old = m.where(moved).select(*base, symbol.alias("symbol"), F.col("list_date").alias("valid_from"), change.alias("valid_to"))
    new = m.where(moved).select(
        *base, F.concat(F.lit("9"), F.substring("code", 2, 5), F.lit("."), F.col("exchange")).alias("symbol"), change.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    return plain.unionByName(old).unionByName(new)


IDENTITY_SQL = MASTER_SQL + """,
identity AS (
  SELECT security_id, exchange, code || '.' || exchange AS symbol, list_date AS valid_from, delist_date AS valid_to FROM master
    WHERE substr(code, 6, 1) NOT IN ('0', '5')
  UNION ALL SELECT security_id, exchange, code || '.' || exchange, list_date, DATE '1995-06-01' FROM master WHERE substr(code, 6, 1) IN ('0', '5')
  UNION ALL SELECT security_id, exchange, '9' || substr(code, 2, 5) || '.' || exchange, DATE '1995-06-01', NULL FROM master
    WHERE substr(code, 6, 1) IN ('0', '5'))"""


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars of users' event values: security_key, bar_time, trade_date, close, volume."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("security_key"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("bar_time"),
        F.col("ts").cast("date").alias("trade_date"), F.col("value").alias("close"), F.pmod("event_id", F.lit(1000)).alias("volume"),
    )


MINUTE_SQL = """
minutes AS (SELECT user_id AS security_key, date_trunc('minute', ts) AS bar_time, CAST(ts AS DATE) AS trade_date,
    value AS close, event_id % 1000 AS volume FROM events)"""


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_of(raw_bars(spark, sf_dir))


def status_of(b: DataFrame) -> DataFrame:
    """Vendor status rows: one for each bar, flags as strings, some of them '1.0', limits of 10 % (5 % for ST)."""
    d = day_number(F.col("trade_date"))
    k = F.substring("security_id", 2, 6).cast("int")
    st = k % 7 == 0
    rate = F.when(st, 0.05).otherwise(0.1)
    return b.select(
        "security_id", "trade_date", F.substring("security_id", 2, 6).alias("SECURITY_CODE"), F.date_format("trade_date", "yyyyMMdd").alias("TRADE_DATE_TEXT"),
        F.when(st, F.when(d % 2 == 0, "1.0").otherwise("1")).otherwise("0").alias("IS_ST_SEC"),
        F.when(d % 31 == 0, "1").otherwise("0").alias("IS_SUSP_SEC"), F.when(d % 37 == 0, "1").otherwise("0").alias("IS_XR_SEC"),
        F.col("close").alias("PRECLOSE"), (F.col("close") * (1 + rate)).alias("HIGH_LIMITED"), (F.col("close") * (1 - rate)).alias("LOW_LIMITED"),
        "close",
    )


STATUS_SQL = RAW_BARS_SQL + """,
status AS (SELECT security_id, trade_date, substr(security_id, 2, 6) AS SECURITY_CODE, strftime(trade_date, '%Y%m%d') AS TRADE_DATE_TEXT,
    CASE WHEN st THEN CASE WHEN d % 2 = 0 THEN '1.0' ELSE '1' END ELSE '0' END AS IS_ST_SEC,
    CASE WHEN d % 31 = 0 THEN '1' ELSE '0' END AS IS_SUSP_SEC, CASE WHEN d % 37 = 0 THEN '1' ELSE '0' END AS IS_XR_SEC,
    close AS PRECLOSE, close * (1 + rate) AS HIGH_LIMITED, close * (1 - rate) AS LOW_LIMITED, close
  FROM (SELECT *, CAST(substr(security_id, 2, 6) AS INTEGER) % 7 = 0 AS st, date_diff('day', DATE '1990-01-01', trade_date) AS d,
    CASE WHEN CAST(substr(security_id, 2, 6) AS INTEGER) % 7 = 0 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS rate FROM raw_bars))"""
