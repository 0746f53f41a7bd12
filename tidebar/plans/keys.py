"""Queries on keys, hashes and manifests (AG-19, AG-20, AG-22, PRJ-25, PRJ-26, PRJ-47, TB-15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import canonical as cj
from ..operators import keys as ky
from ..sources import derived as dv
from ..sources.storage import month_of
from . import json_sql as js
from .base import query
from .relations import duck, frame

# Bars with amounts that no decimal cast holds, closes that are no number, and ids with a quote.
_DAY = "date_diff('day', DATE '1990-01-01', trade_date)"
ODD_SQL = f"""SELECT * REPLACE (CASE WHEN {_DAY} % 113 = 0 THEN 1e15 ELSE amount END AS amount, CASE WHEN {_DAY} % 127 = 0 THEN CAST('NaN' AS DOUBLE) WHEN {_DAY} % 131 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE close END AS close,
  CASE WHEN {_DAY} % 7 = 0 THEN security_id || '"\\' ELSE security_id END AS security_id), CAST(year(trade_date) * 100 + month(trade_date) AS INT) AS month FROM :bars"""


def odd_bars(spark, sf_dir):
    d = dv.day_number(F.col("trade_date"))
    return dv.bars(spark, sf_dir).withColumns({
        "amount": F.when(d % 113 == 0, 1e15).otherwise(F.col("amount")),
        "close": F.when(d % 127 == 0, float("nan")).when(d % 131 == 0, float("inf")).otherwise(F.col("close")),
        "security_id": F.when(d % 7 == 0, F.concat("security_id", F.lit('"\\'))).otherwise(F.col("security_id")),
        "month": month_of(F.col("trade_date")),
    })


_BAD = " OR ".join(f"coalesce(isnan({c}) OR isinf({c}), false)" for c in ("open", "high", "low", "close", "pre_close", "amount"))
_HASH = f"CASE WHEN NOT ({_BAD}) THEN sha256({js.BARS_ROW}) END"


@query("AG-19", duck(f"WITH o AS ({ODD_SQL}) SELECT security_id, trade_date, {_HASH} AS row_hash, CASE WHEN {_BAD} THEN 'NON_FINITE' END AS error FROM o"))
def row_hashes(spark, sf_dir):
    """Hash of each row's canonical JSON; a row with a number that is not finite is an error, not a hash."""
    bars = odd_bars(spark, sf_dir)
    hashed = bars.select("security_id", "trade_date", cj.row_hash(bars, [c for c in bars.columns if c != "month"]).alias("row_hash"))
    return hashed.withColumn("error", F.when(F.col("row_hash").isNull(), "NON_FINITE"))


def _table_sql(source: str, key: str, row: str = _HASH) -> str:
    sums = ", ".join(f"sum({x}) AS p{i}" for i, x in enumerate(js.lanes("h", 8, 8)))
    whole = "sha256(concat_ws('|', CAST(n AS VARCHAR), " + ", ".join(f"CAST(coalesce(p{i}, 0) AS VARCHAR)" for i in range(8)) + "))"
    return f"SELECT {key}, CASE WHEN non_finite = 0 THEN {whole} END AS table_hash, n, non_finite FROM (SELECT {key}, count(*) AS n, count(*) - count(h) AS non_finite, {sums} FROM (SELECT {key}, {row} AS h FROM {source}) x GROUP BY {key}) y"


@query("AG-20", duck(f"WITH o AS ({ODD_SQL}) {_table_sql('o', 'month')}"))
def table_hashes(spark, sf_dir):
    """Order-free hash of each month's rows; a month with an error row has none."""
    bars = odd_bars(spark, sf_dir)
    return cj.table_hash(bars, ["month"], [c for c in bars.columns if c != "month"])


_VENDOR = "CASE WHEN month(trade_date) % 4 = 0 THEN CAST(NULL AS VARCHAR) WHEN month(trade_date) % 2 = 0 THEN 'vendor_a' WHEN day(trade_date) < 9 THEN 'vendor_b' ELSE 'vendor_a' END"


def provided_bars(spark, sf_dir):
    """Bars with lineage columns that are constant in some months and vary in others."""
    m = F.month("trade_date")
    provider = F.when(m % 4 == 0, F.lit(None).cast("string")).when(m % 2 == 0, "vendor_a").when(F.dayofmonth("trade_date") < 9, "vendor_b").otherwise("vendor_a")
    return dv.bars(spark, sf_dir).withColumns({
        "provider": provider, "run_id": F.concat(F.lit("run-"), F.date_format("trade_date", "yyyyMM")), "quality": F.when(F.dayofmonth("trade_date") == 1, 0.5).otherwise(1.0),
        "month": month_of(F.col("trade_date")),
    })


PROVIDED_SQL = f"SELECT *, {_VENDOR} AS provider, 'run-' || strftime(trade_date, '%Y%m') AS run_id, CASE WHEN day(trade_date) = 1 THEN 0.5 ELSE 1.0 END::DOUBLE AS quality, CAST(year(trade_date) * 100 + month(trade_date) AS INT) AS month FROM :bars"
_JSON = js.BARS | {"provider": js.text("provider"), "run_id": js.text("run_id"), "quality": js.double("quality")}


@query("AG-22", duck(f"WITH p AS ({PROVIDED_SQL}), v AS (" + " UNION ALL ".join(f"SELECT month, '{c}' AS column_name, {x} AS v FROM p" for c, x in _JSON.items()) + ") SELECT month, column_name, count(DISTINCT v) = 1 AS is_constant, CASE WHEN count(DISTINCT v) = 1 THEN max(v) END AS value FROM v GROUP BY ALL"))
def constants(spark, sf_dir):
    return ky.column_profile(provided_bars(spark, sf_dir), ["month"])


_KEY2 = "'[' || " + js.text("s") + " || ',' || " + js.date("trade_date")
_DOMAIN_ROWS = "SELECT domain, CASE WHEN day(trade_date) = 9 THEN security_id || '\"x' ELSE security_id END AS s, security_id, trade_date FROM :domain_rows"


@query("PRJ-25", duck(f"WITH r AS ({_DOMAIN_ROWS}) SELECT domain, security_id, trade_date, CASE WHEN domain = 'industry' OR s IS NULL THEN NULL WHEN domain = 'adjustment_factor' THEN {_KEY2} || ',\"SINGLE\"]' ELSE {_KEY2} || ']' END AS canonical_key FROM r"))
def natural_keys(spark, sf_dir):
    s = F.when(F.dayofmonth("trade_date") == 9, F.concat("security_id", F.lit('"x'))).otherwise(F.col("security_id"))
    key = ky.natural_key(F.col("domain"), s, F.date_format("trade_date", "yyyy-MM-dd"), F.lit("SINGLE"))
    return frame(spark, sf_dir, "domain_rows").select("domain", "security_id", "trade_date", key.alias("canonical_key"))


_TYPES = "list_transform(range(CAST(json_array_length(k) AS BIGINT)), lambda i: json_type(k, '$[' || i || ']'))"
_PARTS = "list_transform(range(CAST(json_array_length(k) AS BIGINT)), lambda i: json_extract_string(k, '$[' || i || ']'))"
_AGAIN = """'[' || list_aggregate(list_transform(parts, lambda p: '"' || p || '"'), 'string_agg', ',') || ']'"""


@query("PRJ-26", duck(f"""WITH j AS (SELECT *, CASE WHEN json_valid(canonical_key) AND json_type(canonical_key) = 'ARRAY' THEN CAST(canonical_key AS JSON) END AS k FROM :keyed),
p AS (SELECT *, CASE WHEN k IS NOT NULL THEN {_TYPES} END AS types, CASE WHEN k IS NOT NULL THEN {_PARTS} END AS parts, CASE WHEN domain = 'adjustment_factor' THEN 3 ELSE 2 END AS arity FROM j)
SELECT canonical_key, security_id, trade_date, CASE WHEN NOT json_valid(canonical_key) THEN 'NOT_JSON' WHEN k IS NULL THEN 'NOT_AN_ARRAY' WHEN len(parts) <> arity THEN 'ARITY'
  WHEN len(list_filter(types, lambda t: t <> 'VARCHAR')) > 0 OR list_contains(parts, '') THEN 'BAD_PART' WHEN {_AGAIN} <> canonical_key THEN 'NOT_CANONICAL'
  WHEN parts[1] <> security_id OR parts[2] <> strftime(trade_date, '%Y-%m-%d') THEN 'PARTS_DISAGREE' ELSE 'VALID' END AS verdict, CASE WHEN len(parts) = 3 THEN parts[3] END AS factor_type FROM p"""))
def key_verdicts(spark, sf_dir):
    rows = frame(spark, sf_dir, "keyed")
    typed = F.col("security_id"), F.date_format("trade_date", "yyyy-MM-dd")
    parts = ky.key_parts(F.col("canonical_key"))
    return rows.select(
        "canonical_key", "security_id", "trade_date", ky.key_verdict(F.col("domain"), F.col("canonical_key"), *typed).alias("verdict"),
        F.when(F.size(parts) == 3, F.get(parts, F.lit(2))).alias("factor_type"),
    )


_STATEMENT = ["event_id", "event_class", "subtype", "symbol", "date_text"]
_FACT = {c: js.whole(c) if c == "event_id" else js.text(c) for c in _STATEMENT}


@query("PRJ-47", duck(f"WITH f AS (SELECT *, 'v' || (event_id % 3) AS truth_version FROM :market_events) SELECT event_id, sha256({js.row(**_FACT, truth_version=js.text('truth_version'))}) AS fact_hash, sha256({js.row(**_FACT)}) AS review_hash FROM f"))
def fact_hashes(spark, sf_dir):
    facts = frame(spark, sf_dir, "market_events").withColumn("truth_version", F.concat(F.lit("v"), F.expr("event_id % 3")))
    return ky.fact_hashes(facts, _STATEMENT, "truth_version").select("event_id", "fact_hash", "review_hash")


_MONTHED = "SELECT *, CAST(year(trade_date) * 100 + month(trade_date) AS INT) AS month FROM :bars"
_DECLARED = """SELECT * REPLACE (CASE WHEN month(trade_date) = 2 AND day(trade_date) = 5 THEN volume + 1 ELSE volume END AS volume, CASE WHEN month = 199604 THEN available_on + 40 ELSE available_on END AS available_on) FROM b
  WHERE month < 199806 AND NOT (month(trade_date) = 9 AND day(trade_date) > 28)"""


def _manifest_sql(source: str) -> str:
    return f"SELECT h.month, h.n, h.table_hash, t.event_day, t.vintage FROM ({_table_sql(source, 'month')}) h JOIN (SELECT month, max(trade_date) AS event_day, max(available_on) AS vintage FROM {source} GROUP BY month) t ON h.month = t.month"


@query("TB-15", duck(f"""WITH b AS ({_MONTHED}), c AS (SELECT * FROM b WHERE month <> 199311), o AS ({_DECLARED}), d AS ({_manifest_sql('o')}), a AS ({_manifest_sql('c')})
SELECT coalesce(d.month, a.month) AS month, CASE WHEN a.month IS NULL THEN 'MISSING' WHEN d.month IS NULL THEN 'UNDECLARED' WHEN d.n <> a.n THEN 'COUNT' WHEN d.event_day <> a.event_day THEN 'EVENT_TIME' WHEN d.vintage <> a.vintage THEN 'VINTAGE'
  WHEN d.table_hash <> a.table_hash THEN 'CONTENT' WHEN a.event_day > DATE '1998-04-15' THEN 'EVENT_AFTER_CUTOFF' WHEN a.vintage > DATE '1998-04-15' THEN 'VINTAGE_AFTER_CUTOFF' ELSE 'EQUAL' END AS verdict FROM d FULL OUTER JOIN a ON d.month = a.month"""))
def partition_sets(spark, sf_dir):
    bars = dv.bars(spark, sf_dir).withColumn("month", month_of(F.col("trade_date")))
    m, day = F.month("trade_date"), F.dayofmonth("trade_date")
    declared = bars.where((F.col("month") < 199806) & ~((m == 9) & (day > 28))).withColumns({
        "volume": F.when((m == 2) & (day == 5), F.col("volume") + 1).otherwise(F.col("volume")),
        "available_on": F.when(F.col("month") == 199604, F.date_add("available_on", 40)).otherwise(F.col("available_on")),
    })
    actual = bars.where("month <> 199311")
    return ky.compare_manifests(ky.partition_manifest(declared, "month"), ky.partition_manifest(actual, "month"), "month", F.lit("1998-04-15").cast("date"))
