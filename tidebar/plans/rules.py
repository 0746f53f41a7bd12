"""Queries on trading rules (JN-07, JN-08, JN-10, JN-15, JN-16, PRJ-37). Their SQL joins days and rules directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as tr
from .base import query
from .relations import duck, frame

_LIST = lambda text: "[" + ", ".join(f"'{x}'" for x in text.split()) + "]"
_BOOL = {None: "CAST(NULL AS BOOLEAN)", True: "true", False: "false"}
RULES_SQL = "rules(rule_id, exchanges, patterns, effective_from, effective_to, st_state, age_rule, up_rate, down_rate) AS (VALUES " + ", ".join(
    f"('{i}', {_LIST(e)}, {_LIST(p)}, DATE '{f}', DATE '{t}', {_BOOL[st]}, '{age}', CAST({up} AS DECIMAL(6, 4)), CAST({down} AS DECIMAL(6, 4)))" for i, _, e, p, f, t, st, age, up, down in tr.RULES
) + ")"
_CANDIDATES = RULES_SQL + """,
cand AS (SELECT d.rid, d.trade_date, d.listing_date, r.* FROM days d JOIN rules r ON list_contains(r.exchanges, d.exchange) AND len(list_filter(r.patterns, lambda p: length(p) = length(d.code) AND regexp_full_match(d.code, replace(p, 'x', '.')))) > 0
  AND d.trade_date BETWEEN r.effective_from AND r.effective_to AND (r.st_state IS NULL OR r.st_state = d.is_st)),
best AS (SELECT * FROM cand c WHERE c.st_state IS NOT NULL OR NOT EXISTS (SELECT 1 FROM cand o WHERE o.rid = c.rid AND o.age_rule = c.age_rule AND o.st_state IS NOT NULL))"""
_PLAIN = _CANDIDATES + ", picked AS (SELECT rid, count(*) FILTER (age_rule = 'NONE') AS n, max(rule_id) FILTER (age_rule = 'NONE') AS rule_id, max(up_rate) FILTER (age_rule = 'NONE') AS up_rate, max(down_rate) FILTER (age_rule = 'NONE') AS down_rate, count(*) AS found FROM best GROUP BY rid)"
_AGED = _CANDIDATES + """,
numbers AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS k FROM (SELECT DISTINCT trade_date FROM rule_calendar)),
flags AS (SELECT d.rid, d.trade_date, d.listing_date, n.k, l.k AS lk, d.listing_date < (SELECT min(trade_date) FROM numbers) AS is_old,
    (SELECT count(*) FROM best b WHERE b.rid = d.rid) AS found, (SELECT count(*) FROM best b WHERE b.rid = d.rid AND b.age_rule <> 'NONE') AS ageing,
    d.listing_date = d.trade_date AND EXISTS (SELECT 1 FROM best b WHERE b.rid = d.rid AND b.age_rule LIKE 'IPO%') AS is_ipo,
    EXISTS (SELECT 1 FROM best b WHERE b.rid = d.rid AND b.age_rule LIKE 'FIRST%') AS has_first FROM days d LEFT JOIN numbers n ON d.trade_date = n.trade_date LEFT JOIN numbers l ON d.listing_date = l.trade_date),
wanted AS (SELECT *, CASE WHEN ageing > 0 AND is_ipo THEN 'IPO' WHEN ageing > 0 AND has_first AND coalesce(k - lk < 5, false) THEN 'FIRST' ELSE 'NONE' END AS age,
    CASE WHEN found = 0 THEN 'NO_RULE' WHEN ageing = 0 OR (listing_date IS NOT NULL AND is_ipo) THEN NULL WHEN listing_date IS NULL THEN 'NO_LISTING_DATE' WHEN k IS NULL THEN 'DAY_NOT_IN_CALENDAR' WHEN lk IS NULL AND NOT is_old THEN 'LISTING_NOT_IN_CALENDAR'
      WHEN trade_date < listing_date THEN 'BEFORE_LISTING' END AS why FROM flags),
picked AS (SELECT w.rid, w.age, coalesce(w.why, CASE WHEN count(b.rid) = 0 THEN 'NO_AGE_RULE' WHEN count(b.rid) > 1 THEN 'AMBIGUOUS' END) AS why, max(b.rule_id) AS rule_id, max(b.up_rate) AS up_rate, max(b.down_rate) AS down_rate
  FROM wanted w LEFT JOIN best b ON b.rid = w.rid AND b.age_rule LIKE w.age || '%' GROUP BY w.rid, w.age, w.why)"""
_DAYS = "days AS (SELECT *, row_number() OVER () AS rid FROM {})"


def sql(days: str, body: str) -> str:
    """``body`` over relations by name, ``days`` being the one that is resolved."""
    return duck("WITH " + _DAYS.format(days) + ", " + body.replace(" FROM rule_calendar)", " FROM :rule_calendar)"))


def _rules(spark):
    return tr.rule_table(spark)


@query("PRJ-37", duck("SELECT m.code, p.pattern FROM :master m JOIN :patterns p ON regexp_full_match(m.code, replace(p.pattern, 'x', '[0-9]'))"))
def code_patterns(spark, sf_dir):
    return tr.match_patterns(frame(spark, sf_dir, "master").select("code"), frame(spark, sf_dir, "patterns")).select("code", "pattern")


@query("JN-07", sql(":rule_days", _AGED + " SELECT d.security_id, d.trade_date, CASE WHEN p.why IS NULL THEN p.rule_id END AS rule_id, p.why AS unresolved, p.why IS NULL AND p.age <> 'NONE' AS first_n FROM days d JOIN picked p ON d.rid = p.rid"))
def rule_of_day(spark, sf_dir):
    out = tr.resolve(frame(spark, sf_dir, "rule_days"), _rules(spark), frame(spark, sf_dir, "rule_calendar"))
    return out.select("security_id", "trade_date", F.col("rule.rule_id").alias("rule_id"), "unresolved", "first_n")


@query("JN-08", sql(":rule_days", _PLAIN + " SELECT d.security_id, d.trade_date, CASE WHEN p.n = 1 THEN p.rule_id END AS regime, CASE WHEN coalesce(p.found, 0) = 0 THEN 'NO_RULE' WHEN p.n = 0 THEN 'NO_AGE_RULE' WHEN p.n > 1 THEN 'AMBIGUOUS' END AS unresolved FROM days d LEFT JOIN picked p ON d.rid = p.rid"))
def limit_regime(spark, sf_dir):
    return tr.resolve(frame(spark, sf_dir, "rule_days"), _rules(spark)).select("security_id", "trade_date", F.col("rule.rule_id").alias("regime"), "unresolved")


def _price(rate: str) -> str:
    return f"CAST(round(CAST(CAST(d.pre_close AS DECIMAL(18, 4)) AS DECIMAL(22, 4)) * CAST({rate} AS DECIMAL(6, 4)), 2) AS DOUBLE)"


@query("JN-10", sql(":rule_days", _PLAIN + f""" SELECT d.security_id, d.trade_date, CASE WHEN p.n = 1 THEN p.rule_id END AS rule_id, CASE WHEN d.high_limit IS NULL OR d.low_limit IS NULL OR d.pre_close IS NULL THEN 'NOT_CHECKED' WHEN coalesce(p.n, 0) <> 1 THEN 'RULE_UNRESOLVED'
  WHEN abs(d.high_limit - {_price('1 + p.up_rate')}) > 0.011 THEN 'UP_MISMATCH' WHEN abs(d.low_limit - {_price('1 - p.down_rate')}) > 0.011 THEN 'DOWN_MISMATCH' WHEN d.close NOT BETWEEN d.low_limit - 1e-9 AND d.high_limit + 1e-9 THEN 'CLOSE_OUTSIDE' ELSE 'PASS' END AS verdict
  FROM days d LEFT JOIN picked p ON d.rid = p.rid"""))
def limit_check(spark, sf_dir):
    return tr.limit_check(frame(spark, sf_dir, "rule_days"), _rules(spark)).select("security_id", "trade_date", "rule_id", "verdict")


_CASES = """(SELECT c.*, s.n, s.is_st, s.pre_close, s.high_limit, s.low_limit, m.listing_date FROM :rule_cases c LEFT JOIN (SELECT exchange, code, trade_date, count(*) AS n, max(is_st) AS is_st, max(pre_close) AS pre_close, max(high_limit) AS high_limit, max(low_limit) AS low_limit
  FROM :rule_status GROUP BY ALL) s ON c.exchange = s.exchange AND c.code = s.code AND c.trade_date = s.trade_date LEFT JOIN (SELECT DISTINCT exchange, code, listing_date FROM :rule_securities) m ON c.exchange = m.exchange AND c.code = m.code)"""
_OFF = "(d.{0} <> 0 AND d.pre_close <> 0 AND abs(d.{0} - {1}) > 0.01 + 1e-9) IS TRUE"


@query("JN-15", sql(_CASES, _AGED + f""" SELECT d.case_id, CASE WHEN p.why IS NULL THEN p.rule_id END AS rule_id, CASE WHEN coalesce(d.n, 0) <> 1 THEN 'STATUS_EXACT_MATCH_FAILURE' WHEN d.listing_date IS NULL THEN 'LISTING_DATE_MISSING' WHEN p.why IS NOT NULL THEN 'RULE_UNRESOLVED'
  WHEN p.up_rate = 0 AND p.down_rate = 0 THEN CASE WHEN coalesce(d.high_limit, 0) <> 0 THEN 'NO_LIMIT_CONTRADICTION' ELSE 'PASS' END WHEN abs(d.expected_up - p.up_rate) > 1e-9 THEN 'LIMIT_RATE_MISMATCH'
  WHEN {_OFF.format('high_limit', _price('1 + p.up_rate'))} OR {_OFF.format('low_limit', _price('1 - p.down_rate'))} THEN 'LIMIT_PRICE_MISMATCH' ELSE 'PASS' END AS reason FROM days d LEFT JOIN picked p ON d.rid = p.rid"""))
def limit_cases(spark, sf_dir):
    listing = frame(spark, sf_dir, "rule_securities").select("exchange", "code", "listing_date").distinct()
    return tr.limit_case(frame(spark, sf_dir, "rule_cases"), frame(spark, sf_dir, "rule_status"), listing, _rules(spark), frame(spark, sf_dir, "rule_calendar"))


_BSE = "(SELECT s.*, DATE '2023-06-01' AS trade_date, EXISTS (SELECT 1 FROM :bars b WHERE b.security_id = s.security_id AND b.close > 70000) AS is_member FROM :rule_securities s WHERE s.exchange = 'BJ' OR s.code LIKE '99%')"


@query("JN-16", sql(_BSE, _PLAIN + " SELECT d.security_id, CASE WHEN NOT d.is_member THEN 'NO_HISTORY' WHEN coalesce(p.n, 0) <> 1 THEN 'NO_REGIME' ELSE 'PASS' END AS verdict FROM days d LEFT JOIN picked p ON d.rid = p.rid"))
def bse_mapping(spark, sf_dir):
    """A code of the exchange must be a member of the history (here of bars beyond a price) and have a regime on the day."""
    member = frame(spark, sf_dir, "bars").where("close > 70000").select("security_id").distinct().withColumn("is_member", F.lit(True))
    days = frame(spark, sf_dir, "rule_securities").where("exchange = 'BJ' or code like '99%'").withColumn("trade_date", F.lit("2023-06-01").cast("date")).join(member, "security_id", "left")
    out = tr.resolve(days, _rules(spark))
    return out.select("security_id", F.when(F.col("is_member").isNull(), "NO_HISTORY").when(F.col("rule").isNull(), "NO_REGIME").otherwise("PASS").alias("verdict"))
