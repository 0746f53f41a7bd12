"""Input relations of the catalog's operators, derived from the test tables.

Base relations have a builder and SQL of their own; the others are one text over them.
Every relation grows with the tables, but for the small dimensions (rules, routing and the like).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.dialect import DUCK, SPARK
from ..sources import derived as dv

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
_tail = lambda text, head: text[len(head) :].lstrip(",\n ")
BASE: dict[str, tuple[Callable, str, tuple]] = {
    "raw_bars": (dv.raw_bars, dv.RAW_BARS_SQL, ()),
    "bars": (dv.bars, _tail(dv.BARS_SQL, dv.RAW_BARS_SQL), ("raw_bars",)),
    "calendar": (dv.calendar, dv.CALENDAR_SQL, ()),
    "master": (dv.master, dv.MASTER_SQL, ()),
    "identity": (dv.identity_intervals, _tail(dv.IDENTITY_SQL, dv.MASTER_SQL), ("master",)),
    "minutes": (dv.minute_bars, dv.MINUTE_SQL, ()),
    "status": (dv.status, _tail(dv.STATUS_SQL, dv.RAW_BARS_SQL), ("raw_bars",)),
}
DERIVED: dict[str, Callable] = {}


def rel(name: str, text) -> None:
    DERIVED[name] = text if callable(text) else lambda d, t=text: t


def values(name: str, columns: str, *rows: str) -> None:
    """A small dimension."""
    cols = columns.split(", ")
    rel(name, " UNION ALL ".join("SELECT " + ", ".join(f"{v} AS {c}" for v, c in zip(r, cols)) for r in rows))


def names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"(?<!\w):([a-z_]+)", text)))


def frame(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """The relation ``name``; those of ``given`` are taken as they are."""
    if given and name in given:
        return given[name]
    if name in BASE:
        return BASE[name][0](spark, sf_dir)
    if name in DERIVED:
        text = DERIVED[name](SPARK)
        return spark.sql(re.sub(r"(?<!\w):([a-z_]+)", r"{\1}", text), **{n: frame(spark, sf_dir, n, given) for n in names(text)})
    return dv.table(spark, sf_dir, name)


def duck(text: str) -> str:
    """``text`` with a WITH clause of all relations that it stands on."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order or name in TABLES:
            return
        for n in BASE[name][2] if name in BASE else names(DERIVED[name](DUCK)):
            need(n)
        order.append(name)

    for n in names(text):
        need(n)
    plain = lambda s: re.sub(r"(?<!\w):([a-z_]+)", r"\1", s)
    parts = [BASE[n][1] if n in BASE else f"{n} AS MATERIALIZED ({plain(DERIVED[n](DUCK))})" for n in order]
    body = plain(text).strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join([*parts, body[5:]])
    return (f"WITH {', '.join(parts)} " if parts else "") + body


K = "CAST(substr(security_id, 2, 6) AS INT)"
D = lambda d, day="trade_date": d.days(day, "DATE '1990-01-01'")
MONTH = "CAST(year(trade_date) * 100 + month(trade_date) AS INT)"

rel("vendor", lambda d: f"""SELECT CAST({K} AS INT) AS row_id, CASE WHEN {K} % 17 = 3 THEN 'A' || code WHEN {K} % 5 = 1 THEN code || '.' || exchange WHEN {K} % 19 = 2 THEN exchange || code ELSE code END AS raw_code,
  CASE WHEN {K} % 13 = 4 THEN 9 ELSE market_code END AS raw_market, CASE WHEN {K} % 3 = 0 THEN '' WHEN {K} % 3 = 1 THEN code END AS a, exchange AS b, 'z' AS c, CASE WHEN {K} % 4 = 0 THEN 0 WHEN {K} % 4 = 1 THEN market_code END AS x, 7 AS y,
  CASE WHEN {K} % 6 = 0 THEN 'n/a' WHEN {K} % 6 = 1 THEN substr({d.ymd('list_date')}, 1, 4) || '-' || substr({d.ymd('list_date')}, 5, 2) || '-' || substr({d.ymd('list_date')}, 7, 2) ELSE {d.ymd('list_date')} END AS raw_date,
  CASE WHEN {K} % 9 = 5 THEN 'x1' ELSE CAST({K} AS STRING) || '.5' END AS raw_price, CASE WHEN {K} % 4 = 2 THEN '?' ELSE CAST({K} * 2 AS STRING) END AS raw_extra, CASE WHEN {K} % 2 = 0 THEN 'b; a;;c ' ELSE 'st;x' || CAST({K} AS STRING) END AS raw_flags FROM :master""")
rel("aliases", f"SELECT {K} AS row_id, CASE WHEN {K} % 3 = 0 THEN code END AS SECURITY_CODE, CASE WHEN {K} % 3 = 1 THEN code END AS sec_code, code, CASE WHEN {K} % 2 = 0 THEN market_code END AS MARKET_CODE, market_code AS market FROM :master")
rel("carriers", f"SELECT {K} AS row_id, CASE WHEN {K} % 3 = 0 THEN code END AS explicit_code, CASE WHEN {K} % 4 < 2 THEN code || '.' || exchange END AS carrier, CASE WHEN {K} % 10 = 0 THEN '999999' ELSE code END AS index_code FROM :master")
rel("days", lambda d: f"SELECT 'SH' AS market, {d.ymd('trade_date')} AS day_text FROM :calendar UNION ALL SELECT 'SZ', CASE WHEN day(trade_date) = 13 AND month(trade_date) = 2 AND year(trade_date) = 1995 THEN '19950230' ELSE {d.ymd('trade_date')} END FROM :calendar UNION ALL SELECT 'BJ', {d.ymd('trade_date')} FROM :calendar WHERE year(trade_date) = 1996")
rel("members", lambda d: f"SELECT substr(security_id, 2, 6) AS member_key, CASE WHEN {D(d)} % 41 = 0 THEN '777777' ELSE substr(security_id, 2, 6) END AS embedded_code, trade_date, CASE WHEN {D(d)} % 43 <> 0 THEN close END AS close FROM :bars")
rel("factors", lambda d: f"SELECT security_id, trade_date AS ex_date, CAST(CASE WHEN {K} % 4 = 0 THEN 1.0 ELSE round(1 + ({D(d)} % 50) / 100.0, 2) END AS DOUBLE) AS factor, CAST(round(1 + ({D(d)} % 30) / 10.0, 2) AS DOUBLE) AS cum_factor, row_number() OVER (PARTITION BY security_id ORDER BY {D(d)} % 7, trade_date) AS factor_no FROM :bars WHERE {D(d)} % 61 = 0")
rel("dividends", "SELECT security_id, ex_date FROM :factors WHERE factor > 1.2")
rel("rights", "SELECT CASE WHEN cum_factor < 1.5 THEN NULL ELSE security_id END AS security_id, ex_date FROM :factors WHERE factor <= 1.2")
rel("action_factors", lambda d: f"SELECT security_id, ex_date, CASE WHEN {D(d, 'ex_date')} % 17 = 0 THEN -1.0 WHEN {D(d, 'ex_date')} % 5 = 0 THEN 1.0 ELSE factor END AS factor FROM :factors WHERE {D(d, 'ex_date')} % 13 <> 0")
rel("action_cases", lambda d: f"SELECT security_id || '/' || {d.text('ex_date')} AS case_id, security_id, {d.plus('ex_date', f'CASE WHEN {D(d, "ex_date")} % 19 = 0 THEN 1 ELSE 0 END')} AS trade_date, CASE WHEN {D(d, 'ex_date')} % 29 = 0 THEN NULL WHEN factor > 1.2 OR {D(d, 'ex_date')} % 7 = 0 THEN 'DIVIDEND' ELSE 'RIGHT_ISSUE' END AS event_type FROM :factors")
rel("market_events", lambda d: f"SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'ST' WHEN 1 THEN 'DELIST' WHEN 2 THEN 'DIVIDEND' ELSE 'OTHER' END AS event_class, CASE event_id % 5 WHEN 0 THEN 'st_add' WHEN 1 THEN 'delist' WHEN 2 THEN 'xd' WHEN 3 THEN 'st_remove' ELSE 'huh' END AS alias, CASE WHEN event_id % 3 = 0 THEN 'ADD' WHEN event_id % 3 = 1 THEN 'REMOVE' END AS subtype, CASE WHEN event_id % 11 <> 0 THEN lpad(CAST(user_id AS STRING), 6, '0') END AS symbol, CASE WHEN event_id % 23 = 0 THEN '20231399' ELSE {d.ymd('ts')} END AS date_text FROM :events")
values("alias_dim", "name, event_type", ("'st_add'", "'ST'"), ("'st_remove'", "'ST'"), ("'delist'", "'DELIST'"), ("'xd'", "'DIVIDEND'"))
values("class_dim", "name, event_type", ("'ST'", "'ST'"), ("'DELIST'", "'DELIST'"), ("'DIVIDEND'", "'DIVIDEND'"))
rel("status_view", lambda d: f"SELECT CASE WHEN {D(d)} % 47 <> 0 THEN SECURITY_CODE || '.SH' END AS symbol, trade_date, 1 AS market_code FROM :status UNION ALL SELECT SECURITY_CODE || '.SH', trade_date, 1 FROM :status WHERE {D(d)} % 53 = 0")
rel("normalized", "SELECT member_key, CASE WHEN embedded_code <> member_key THEN 'MEMBER_KEY_CONFLICT' WHEN close IS NULL THEN 'REQUIRED_UNPARSABLE' END AS reject FROM :members")
rel("run_rows", lambda d: f"SELECT 'run' || CAST({K} % 12 AS STRING) AS run_id, {K} % 12 <> 7 AS in_scope, {K} % 2 = 0 AS allow_partial, CASE WHEN {K} % 12 = 5 THEN 0 ELSE 1 END AS retained, CASE WHEN {K} % 12 < 4 THEN 0 WHEN {D(d)} % 43 = 0 THEN 1 ELSE 0 END AS quarantined FROM :bars")
rel("requests", "SELECT event_id AS request_id, CASE WHEN user_id % 2 = 0 THEN 'vendor_a' ELSE 'vendor_b' END AS provider, CASE WHEN event_id % 3 = 0 THEN 'history' ELSE 'snapshot' END AS surface, event_type AS dataset, 'get_' || event_type AS endpoint FROM :events")
rel("routing", "SELECT 'vendor_a' AS provider, 'history' AS surface, event_type AS dataset, 'get_' || event_type AS endpoint, CASE WHEN event_type < 'd' THEN 'none' ELSE 'load_' || event_type END AS handler FROM (SELECT DISTINCT event_type FROM :events) t")
rel("domain_rows", lambda d: f"SELECT CASE {K} % 5 WHEN 0 THEN 'daily_bar' WHEN 1 THEN 'security_status' WHEN 2 THEN 'limit_price' WHEN 3 THEN 'adjustment_factor' ELSE 'industry' END AS domain, CASE WHEN {K} % 5 <> 2 OR {D(d)} % 19 <> 0 THEN security_id END AS security_id, trade_date, available_on AS received_on, {K} % 5 = 1 AND {D(d)} % 59 = 0 AS damaged FROM :bars")
values("domain_matrix", "domain, eligibility", ("'daily_bar'", "'SUPPORTED'"), ("'security_status'", "'SUPPORTED'"), ("'limit_price'", "'SUPPORTED'"), ("'adjustment_factor'", "'SUPPORTED'"), ("'trade_calendar'", "'SUPPORTED'"), ("'industry'", "'BLOCKED'"))
rel("keyed", lambda d: f"""SELECT CASE {D(d)} % 25 WHEN 0 THEN '["' || security_id || '",""]' WHEN 1 THEN security_id WHEN 2 THEN '["S","' || {d.text('trade_date')} || '"' || tail || ']' WHEN 3 THEN '"17"' WHEN 4 THEN '["' || security_id || '"]'
  WHEN 5 THEN '["' || security_id || '",5' || tail || ']' WHEN 6 THEN '["' || security_id || '", "' || {d.text('trade_date')} || '"' || tail || ']' ELSE '["' || security_id || '","' || {d.text('trade_date')} || '"' || tail || ']' END AS canonical_key, security_id, trade_date, domain
  FROM (SELECT security_id, trade_date, CASE WHEN {K} % 3 = 0 THEN 'adjustment_factor' ELSE 'daily_bar' END AS domain, CASE WHEN {K} % 3 = 0 THEN ',"SINGLE"' ELSE '' END AS tail FROM :bars) q""")
rel("market_days", "SELECT c.trade_date, m.exchange FROM :calendar c CROSS JOIN (SELECT DISTINCT exchange FROM :master) m")
SHIFT = lambda d: d.plus("trade_date", "9500")  # noqa: E731  the years 1992 to 1998 become 2018 to 2024
rel("shifted_days", lambda d: f"SELECT {SHIFT(d)} AS trade_date FROM :calendar UNION ALL SELECT {d.plus('trade_date', '10800')} FROM :calendar")
SPLIT = "CASE WHEN trade_date < DATE '2020-01-01' THEN 'warmup' WHEN trade_date <= DATE '2023-12-31' THEN 'development' WHEN trade_date <= DATE '2025-12-31' THEN 'validation_a' WHEN trade_date <= DATE '2026-06-30' THEN 'holdout' ELSE 'outside_window' END"
rel("panel_input", lambda d: f"""SELECT p.*, {SPLIT} AS split FROM (SELECT b.security_id, {d.plus('b.trade_date', '9500')} AS trade_date, b.open, CASE WHEN {D(d, 'b.trade_date')} % 71 = 0 THEN b.low - 1 ELSE b.high END AS high, b.low, CASE WHEN {D(d, 'b.trade_date')} % 73 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE b.close END AS close, CASE WHEN {D(d, 'b.trade_date')} % 79 = 0 THEN CAST('NaN' AS DOUBLE) ELSE b.pre_close END AS pre_close, b.volume, b.amount, m.exchange, i.symbol,
  CASE WHEN {D(d, 'b.trade_date')} % 97 = 0 THEN 'RESEARCH_EXPERIMENTAL' WHEN {D(d, 'b.trade_date')} % 89 = 0 THEN 'RESEARCH_DISABLED_UNRESOLVED' END AS upstream, {D(d, 'b.trade_date')} % 83 = 0 AS identity_conflict, i.security_id AS resolved_id
  FROM :bars b JOIN :master m ON b.security_id = m.security_id LEFT JOIN :identity i ON b.security_id = i.security_id AND b.trade_date >= i.valid_from AND (i.valid_to IS NULL OR b.trade_date < i.valid_to)) p""")
rel("current_symbols", "SELECT security_id, max(symbol) AS symbol FROM :identity WHERE valid_to IS NULL GROUP BY security_id HAVING count(*) = 1")
_PANEL = "SELECT security_id, trade_date, split, exchange, reason,{more} CASE WHEN reason IS NULL THEN 'RESEARCH_ENABLED' WHEN upstream = 'RESEARCH_EXPERIMENTAL' AND reason = 'upstream_unresolved' THEN 'RESEARCH_EXPERIMENTAL' ELSE 'RESEARCH_DISABLED_UNRESOLVED' END AS eligibility, CASE WHEN reason IS NULL THEN 'VERIFIED' WHEN reason IN ('non_finite_value', 'invalid_ohlc') THEN 'INVALID' ELSE 'UNRESOLVED' END AS quality_state FROM (SELECT *, " + __import__("tidebar.operators.catalog", fromlist=["ELIGIBILITY"]).ELIGIBILITY + " AS reason FROM :panel_input) q"
rel("panel", _PANEL.replace("{more}", ""))
rel("panel_priced", _PANEL.replace("{more}", " close, volume,"))
rel("panel_claims", lambda d: f"SELECT split AS assigned_split, CASE WHEN {D(d)} % 101 = 0 THEN 'holdout' ELSE split END AS split, CASE WHEN {D(d)} % 103 = 0 THEN 'x' ELSE reason END AS reason, eligibility, CASE WHEN {D(d)} % 107 = 0 THEN 'INVALID' ELSE quality_state END AS quality_state FROM :panel")
rel("rated", f"SELECT security_id, trade_date, floor(pre_close * 100) / 100 AS pre_close, CASE WHEN {K} % 10 = 0 THEN 0.0 WHEN {K} % 7 = 0 THEN 0.05 ELSE 0.1 END AS up_rate, CASE WHEN {K} % 10 = 0 THEN 0.0 WHEN {K} % 7 = 0 THEN 0.05 ELSE 0.1 END AS down_rate FROM :bars WHERE pre_close > 0")
values("patterns", "pattern", ("'0000xx'",), ("'00xxx1'",), ("'0xxxxx'",), ("'00001'",), ("'xxxx1x'",), ("'xxxxxx'",))
rel("feed_times", lambda d: f"SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(floor({d.micros('ts')} / 1000) AS BIGINT) || '' WHEN 1 THEN {d.micros('ts')} || '' WHEN 2 THEN {d.ymd('ts')} || lpad(CAST(hour(ts) AS STRING), 2, '0') || lpad(CAST(minute(ts) AS STRING), 2, '0') || lpad(CAST(floor(second(ts)) AS INT) || '', 2, '0') ELSE '93000000' END AS digits FROM :events")
rel("identities", lambda d: f"SELECT security_id, exchange, code, CASE WHEN {K} % 8 <> 0 THEN list_date END AS known_list_date, {d.plus('list_date', '3')} AS first_seen FROM :master")
rel("contexts", "SELECT event_id AS row_id, CASE event_id % 5 WHEN 0 THEN 'api_token' WHEN 1 THEN 'PassWord' WHEN 2 THEN 'host' WHEN 3 THEN 'credential_id' ELSE 'dataset' END AS context_key, event_type AS context_value FROM :events")
rel("symbol_days", "SELECT DISTINCT i.symbol, b.trade_date FROM :bars b JOIN :identity i ON b.security_id = i.security_id")
rel("code_changes", f"SELECT security_id, code || '.' || exchange AS old_symbol, '9' || substr(code, 2, 5) || '.' || exchange AS new_symbol, list_date, DATE '1993-06-01' AS effective FROM :master WHERE {K} % 5 = 0")
rel("supplied", lambda d: f"SELECT b.security_id, b.trade_date, CASE WHEN {D(d, 'b.trade_date')} % 67 = 0 THEN 'X' ELSE m.code || '.' || m.exchange END AS symbol, CASE WHEN {D(d, 'b.trade_date')} % 53 = 0 THEN 'xx' WHEN {D(d, 'b.trade_date')} % 59 = 0 THEN NULL ELSE lower(m.exchange) END AS exchange FROM :bars b JOIN :master m ON b.security_id = m.security_id")
rel("master_facts", f"SELECT security_id, CASE WHEN {K} % 13 = 0 THEN '3' WHEN {K} % 3 = 0 THEN '1' END AS is_listed, delist_date FROM :master WHERE {K} % 9 <> 4")
# Codes of all boards, listed between 2018 and 2024; a few listing days are no session.
_HEAD = f"CASE {K} % 8 WHEN 0 THEN '60' WHEN 1 THEN '000' WHEN 2 THEN '30' WHEN 3 THEN '688' WHEN 4 THEN '83' WHEN 5 THEN '43' WHEN 6 THEN '002' ELSE '99' END"
rel("rule_securities", lambda d: f"SELECT security_id, head || substr(code, length(head) + 1, 6) AS code, CASE WHEN head IN ('60', '688', '99') THEN 'SH' WHEN head IN ('83', '43') THEN 'BJ' ELSE 'SZ' END AS exchange, is_st, CASE WHEN k % 31 <> 9 THEN {d.plus('list_date', '9500 + (k % 6) * 365')} END AS listing_date FROM (SELECT *, {K} AS k, {_HEAD} AS head FROM :master) q")
rel("rule_calendar", lambda d: f"SELECT trade_date FROM (SELECT {d.plus('trade_date', '9500')} AS trade_date FROM :calendar) q WHERE day(trade_date) <> 17 AND weekofyear(trade_date) <> 40")
rel("rule_days", lambda d: f"""SELECT s.security_id, s.exchange, s.code, {d.plus('b.trade_date', '9500')} AS trade_date, s.is_st, s.listing_date, b.close, CASE WHEN {D(d, 'b.trade_date')} % 37 <> 0 THEN b.pre_close END AS pre_close,
  CASE WHEN {D(d, 'b.trade_date')} % 41 <> 0 THEN floor(b.pre_close * (110 + CASE WHEN {D(d, 'b.trade_date')} % 5 = 0 THEN 10 ELSE 0 END) + 0.5) / 100 END AS high_limit, floor(b.pre_close * (90 - CASE WHEN {D(d, 'b.trade_date')} % 5 = 0 THEN 10 ELSE 0 END) + 0.5) / 100 AS low_limit
  FROM :bars b JOIN :rule_securities s ON b.security_id = s.security_id""")
rel("rule_status", "SELECT exchange, code, trade_date, is_st, pre_close, CASE WHEN day(trade_date) % 3 = 0 THEN 0.0 ELSE high_limit END AS high_limit, low_limit FROM :rule_days WHERE day(trade_date) <> 11 UNION ALL SELECT exchange, code, trade_date, is_st, pre_close, high_limit, low_limit FROM :rule_days WHERE day(trade_date) = 13")
rel("rule_cases", lambda d: f"SELECT security_id || '/' || {d.text('trade_date')} AS case_id, exchange, code, trade_date, CASE WHEN day(trade_date) % 2 = 0 THEN 0.1 ELSE 0.2 END AS expected_up, CAST(NULL AS DOUBLE) AS expected_down FROM :rule_days WHERE day(trade_date) % 2 = 1 OR day(trade_date) < 9")
rel("security_rules", f"SELECT CASE WHEN {K} % 17 = 0 THEN 'r000001' ELSE 'r' || code END AS rule_id, list_date AS effective_from, coalesce(delist_date, DATE '1996-01-01') AS effective_to, CASE WHEN {K} % 13 = 0 THEN 1.2 WHEN is_st THEN 0.05 ELSE 0.1 END AS up_rate, CASE WHEN {K} % 19 = 0 THEN 'LATER' ELSE 'NONE' END AS age_rule FROM :master")
rel("golden", lambda d: f"SELECT security_id || '/' || {d.text('trade_date')} AS case_id, CASE WHEN {D(d)} % 3 = 0 THEN substr(security_id, 2, 6) ELSE security_id END AS symbol, CASE WHEN {D(d)} % 11 = 0 THEN DATE '2001-01-01' ELSE trade_date END AS trade_date, {K} % 7 = 0 OR {D(d)} % 5 = 0 AS expected FROM :status WHERE {D(d)} % 13 = 0")
rel("st_events", "SELECT event_id, subtype FROM :market_events WHERE event_class = 'ST' AND subtype IS NOT NULL AND event_id % 16 <> 0")
rel("st_audit", "SELECT event_id, CASE WHEN subtype = 'ADD' THEN 0 ELSE 1 END AS flag_before, CASE WHEN subtype = 'ADD' AND event_id % 7 <> 0 THEN 1 ELSE 0 END AS flag_after FROM :market_events WHERE event_class = 'ST' AND subtype IS NOT NULL AND event_id % 20 <> 0")
rel("minute_dim", "SELECT DISTINCT security_key, security_key % 11 AS sector_id FROM :minutes WHERE security_key % 13 <> 0")
rel("bucketed", "SELECT security_key, security_key % 16 AS bucket, bar_time, trade_date, close, volume FROM :minutes")
rel("old_version", "SELECT o_orderkey AS id, o_orderstatus AS payload FROM :orders WHERE o_orderkey % 10 <> 0")
rel("new_version", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS payload FROM :orders WHERE o_orderkey % 7 <> 0")
rel("replacements", "SELECT o_orderkey AS old_id, o_orderkey + 1 AS new_id FROM :orders WHERE o_orderkey % 14 = 0")
rel("approved", lambda d: f"SELECT security_id, CASE WHEN {K} % 9 = 0 THEN {d.plus('list_date', '1')} ELSE list_date END AS list_date FROM :master WHERE {K} % 3 = 0")
rel("listing", lambda d: f"SELECT DISTINCT '/bars/' || {d.text(MONTH)} || '.parquet' AS uri FROM :bars")
rel("registered", lambda d: f"SELECT DISTINCT '/bars/' || {d.text(MONTH)} || '.parquet' AS uri FROM :bars WHERE month(trade_date) <> 5")
rel("status_dup", lambda d: f"SELECT security_id, trade_date FROM :status UNION ALL SELECT security_id, trade_date FROM :status WHERE {D(d)} % 26 = 0 AND {K} % 2 = 0")
rel("fact_ids", f"SELECT CASE WHEN {K} % 15 = 0 THEN 'S9' || substr(security_id, 3, 5) ELSE security_id END AS security_id FROM :bars")
rel("flagged", lambda d: f"SELECT CASE WHEN {K} % 2 = 0 THEN 'daily_bar' ELSE 'status' END AS table_name, CASE {D(d)} % 6 WHEN 0 THEN 'SOURCE_CONFLICT; LATE' WHEN 1 THEN 'BAD_OHLC' WHEN 2 THEN ' FUTURE_ROW ;DUPLICATE_KEY' ELSE 'OK' END AS quality_flags FROM :bars")
rel("components", lambda d: f"SELECT 'p' || {d.text('o_custkey')} AS publish_id, 'file-' || {d.text('o_orderkey')} AS component FROM :orders")
rel("cases", "SELECT event_id AS case_id, event_type AS case_type, CASE WHEN event_id % 4 = 0 THEN 'REVIEWED' ELSE 'COMPILED' END AS review_status, CASE event_id % 7 WHEN 0 THEN 'FAIL' WHEN 1 THEN 'SKIP' ELSE 'PASS' END AS result FROM :events")
rel("minima", "SELECT DISTINCT event_type AS case_type, 'cap_' || substr(event_type, 1, 1) AS capability, 1900 AS minimum FROM :events UNION ALL SELECT 'absent', 'cap_absent', 5")
rel("verdicts", "SELECT DISTINCT event_type AS capability, CASE WHEN event_type < 'd' THEN 'INSUFFICIENT' ELSE 'PASSED' END AS verdict FROM :events")
rel("request_log", "SELECT CAST(ts AS DATE) AS log_date, event_id % 100 AS row_count, event_id % 9 = 0 AS failed FROM :events")
rel("coverage", lambda d: f"SELECT {MONTH} AS month, CASE WHEN month(trade_date) = 3 AND {K} % 9 = 0 THEN 'UNRESOLVED' WHEN month(trade_date) = 4 AND {K} % 2 = 0 THEN 'PARTIAL' ELSE 'OBSERVED' END AS evidence, {K} % 3 AS state_rank FROM :bars")
_ROUTED = f"SELECT security_id, trade_date, split,{{more}} {MONTH} AS month, CASE WHEN eligibility = 'RESEARCH_ENABLED' AND exchange <> 'BJ' THEN 'enabled' WHEN eligibility = 'RESEARCH_EXPERIMENTAL' THEN 'experimental' ELSE 'disabled' END AS route FROM :panel"
rel("routed", _ROUTED.replace("{more}", ""))
rel("routed_reasons", _ROUTED.replace("{more}", " reason,"))
rel("descriptors", "SELECT DISTINCT month FROM :routed WHERE month % 100 <> 7 UNION ALL SELECT DISTINCT month FROM :routed WHERE month % 100 = 9")
rel("run_findings", lambda d: f"SELECT 'run' || {d.text(K + ' % 12')} AS run_id, CASE {D(d)} % 3 WHEN 0 THEN 'SOURCE_CONFLICT' WHEN 1 THEN 'LATE' ELSE 'DUPLICATE_KEY' END AS finding_class, {K} % 12 = 3 AND {D(d)} % 3 = 0 AS is_blocking FROM :bars WHERE {D(d)} % 5 < {K} % 12")
rel("inventory", f"SELECT code AS member, CASE WHEN {K} % 20 = 0 THEN NULL WHEN {K} % 20 = 1 THEN 0 ELSE 1 END AS rows_n FROM :master")
rel("candidates_once", lambda d: f"""SELECT b.security_id, b.trade_date, p.provider, p.priority, p.run_id, md5(p.run_id) AS manifest_hash, CAST({d.long(K.replace('security_id', 'b.security_id'))} * 100000 + {D(d, 'b.trade_date')} * 2 + p.priority AS BIGINT) AS ordinal, b.available_on,
  CASE WHEN {D(d, 'b.trade_date')} % 79 = 0 THEN 'MISSING' ELSE 'RESOLVED' END AS identity_status, CASE WHEN p.priority = 1 AND {D(d, 'b.trade_date')} % 5 = 0 THEN b.volume + 1 ELSE b.volume END AS payload FROM :bars b
  JOIN (SELECT 'vendor_a' AS provider, 0 AS priority, 'run-1' AS run_id UNION ALL SELECT 'vendor_b', 1, 'run-2' UNION ALL SELECT 'vendor_b', 1, 'run-3') p ON {D(d, 'b.trade_date')} % 3 <> p.priority OR p.run_id = 'run-1'""")
rel("candidates", lambda d: f"SELECT * FROM :candidates_once UNION ALL SELECT security_id, trade_date, provider, priority, run_id, manifest_hash, ordinal + 50000000000, available_on, identity_status, payload FROM :candidates_once WHERE {D(d)} % 83 = 0")
rel("artifact_rows", "SELECT o_orderkey AS artifact_id, CASE o_orderkey % 37 WHEN 0 THEN NULL WHEN 1 THEN 'v1' ELSE 'v2' END AS set_version, 'snap' AS snapshot_id, CASE o_orderkey % 31 WHEN 0 THEN NULL WHEN 1 THEN 'other' ELSE 'snap' END AS bound_snapshot_id FROM :orders")
_P = "l_orderkey * 7 + l_linenumber"
rel("artifact_parts", lambda d: f"""SELECT l_orderkey AS artifact_id, CAST(l_linenumber AS INT) AS component, CASE WHEN l_linenumber % 2 = 0 THEN 'volume' ELSE 'price' END AS family, md5({d.text('l_partkey')}) AS declared_content,
  CASE WHEN ({_P}) % 101 = 0 THEN NULL WHEN ({_P}) % 103 = 0 THEN 'other' ELSE md5({d.text('l_partkey')}) END AS content, 's1' AS declared_schema, CASE WHEN ({_P}) % 107 = 0 THEN 's2' ELSE 's1' END AS schema,
  l_suppkey AS declared_rows, CASE WHEN ({_P}) % 109 = 0 THEN l_suppkey + 1 ELSE l_suppkey END AS row_count, CASE WHEN ({_P}) % 113 = 0 THEN NULL WHEN ({_P}) % 103 = 0 THEN 'other' ELSE md5({d.text('l_partkey')}) END AS proof_content,
  CASE WHEN ({_P}) % 127 = 0 THEN 2 ELSE 0 END AS fallback_rows, CASE WHEN ({_P}) % 131 = 0 THEN 1 ELSE 0 END AS blocking_findings FROM :lineitem""")
rel("publish_requests", lambda d: f"SELECT 'p' || {d.text('o_orderkey')} AS publish_id, o_orderkey AS artifact_id, CAST(o_orderdate AS DATE) AS trade_date, o_orderkey AS version FROM :orders")
rel("bars_dup", lambda d: f"SELECT * FROM :bars UNION ALL SELECT * FROM :bars WHERE {D(d)} % 109 = 0")
rel("publish_log", lambda d: f"SELECT 'p' || {d.text('o_custkey')} AS publish_id, CAST(o_orderdate AS DATE) AS trade_date, o_orderkey AS version, CASE WHEN o_orderkey % 6 = 0 THEN 'FAILED' ELSE 'PUBLISHED' END AS state FROM :orders")
rel("violations", "SELECT case_type AS verdict, lpad(CAST(case_id AS STRING), 8, '0') AS case_text FROM :cases WHERE result = 'FAIL'")
rel("sessions", "SELECT trade_date FROM :calendar")
rel("universe", f"SELECT m.security_id, s.trade_date FROM :master m CROSS JOIN :sessions s WHERE {K.replace('security_id', 'm.security_id')} % 10 <> 9")
rel("status_part", lambda d: f"SELECT u.security_id, u.trade_date, CASE WHEN {D(d, 'u.trade_date')} % 8 = 0 THEN '1' ELSE '0' END AS IS_SUSP_SEC FROM :universe u WHERE {K.replace('security_id', 'u.security_id')} % 6 <> 0 OR {D(d, 'u.trade_date')} % 4 <> 0")
rel("suspensions", lambda d: f"SELECT m.security_id, y.first_day AS suspended_from, {d.plus('y.first_day', '15')} AS resumes_on FROM :master m CROSS JOIN (SELECT min(trade_date) AS first_day FROM :calendar WHERE month(trade_date) = 5 GROUP BY year(trade_date)) y WHERE {K} % 12 = 0")
rel("trades", f"SELECT security_id, trade_date, volume AS num_trades FROM :bars WHERE {K} % 6 = 0")
rel("returned", "SELECT DISTINCT security_id, trade_date FROM :bars")
values("classes", "class", *[(f"'{c}'",) for c in ("suspended", "required", "unresolved", "missing", "extra")])
values("windows", "split, first_day, last_day", ("'development'", "DATE '2020-01-01'", "DATE '2023-12-31'"), ("'validation_a'", "DATE '2024-01-01'", "DATE '2025-12-31'"), ("'holdout'", "DATE '2026-01-01'", "DATE '2026-06-30'"))
rel("month_old", lambda d: f"SELECT {MONTH} AS month, count(*) AS n, sum(volume) AS content FROM :bars WHERE NOT (year(trade_date) = 1998 AND month(trade_date) > 6) GROUP BY {MONTH}")
rel("month_new", lambda d: f"SELECT {MONTH} AS month, count(*) AS n, sum(volume) + max(CASE WHEN month(trade_date) = 2 OR {MONTH} = 199806 THEN 1 ELSE 0 END) AS content FROM :bars GROUP BY {MONTH}")
rel("stored_states", "SELECT trade_date, CASE WHEN day(trade_date) = 17 THEN 'ODD' WHEN day(trade_date) % 2 = 0 THEN 'POSITIVE_CENTER' ELSE 'MIXED_CENTER' END AS state, count(*) AS n, count_if(close > pre_close) AS adv, count_if(close < pre_close) + CASE WHEN day(trade_date) = 5 THEN 100000 ELSE 0 END AS dec FROM :bars GROUP BY trade_date")
rel("month_runs", f"SELECT DISTINCT 'run-' || CAST({MONTH} % 37 AS STRING) AS run_id, {MONTH} AS month FROM :bars")
