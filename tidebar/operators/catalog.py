"""Operators as SQL over named input relations.

An operator's text names its inputs as ``:name``. ``run(spark, key, **frames)``
applies it to DataFrames with those columns; Catalyst sees one plan, so filters and column
pruning reach the callers' scans. The same text with the other
spelling of a few functions is the SQL that results are checked with.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.dialect import SPARK


@dataclass(frozen=True)
class Operator:
    key: str
    doc: str
    text: Callable

    def inputs(self) -> list[str]:
        return list(dict.fromkeys(re.findall(r"(?<!\w):([a-z_]+)", self.text(SPARK))))


OPERATORS: dict[str, Operator] = {}


def op(key: str, doc: str, text: Callable | str) -> None:
    OPERATORS[key] = Operator(key, doc, text if callable(text) else lambda d, t=text: t)


def run(spark: SparkSession, key: str, **frames: DataFrame) -> DataFrame:
    text = re.sub(r"(?<!\w):([a-z_]+)", r"{\1}", OPERATORS[key].text(SPARK))
    return spark.sql(text, **frames)


# ---- normalizers ------------------------------------------------------------

op("PRJ-01", "Provider symbol: bare digits take the market's suffix, suffixed input is validated, anything else is rejected.", lambda d: f"""
SELECT row_id, raw_code, raw_market, CASE WHEN {d.like('raw_code', '^[0-9]+[.](SH|SZ|BJ)$')} THEN raw_code
  WHEN {d.like('raw_code', '^[0-9]+$')} THEN raw_code || CASE raw_market WHEN 1 THEN '.SH' WHEN 2 THEN '.SZ' WHEN 3 THEN '.BJ' END END AS symbol FROM :vendor""")
_UP = "upper(trim(raw_code))"
op("PRJ-02", "Internal symbol: a suffix off, else the exchange prefix of a text of eight; exactly six digits left.", lambda d: f"""
SELECT row_id, raw_code, CASE WHEN {d.like('bare', '^[0-9][0-9][0-9][0-9][0-9][0-9]$')} THEN bare END AS symbol FROM (
  SELECT row_id, raw_code, CASE WHEN {d.like(_UP, '[.](SZ|SH|BJ)$')} THEN {d.strip(_UP, '[.](SZ|SH|BJ)$')}
    WHEN length({_UP}) = 8 THEN {d.strip(_UP, '^(SZ|SH|BJ)')} ELSE {_UP} END AS bare FROM :vendor) q""")
op("PRJ-03", "First present value: zero and the empty string count as present.", "SELECT row_id, coalesce(a, b, c) AS first_text, coalesce(x, y) AS first_number FROM :vendor")
op("PRJ-04", "Alias columns under one canonical name, the first present one wins.", "SELECT row_id, coalesce(SECURITY_CODE, sec_code, code) AS security_code, coalesce(MARKET_CODE, market) AS market_code FROM :aliases")
op("PRJ-05", "Lenient date: the first eight digits as yyyymmdd, else null.", lambda d: f"SELECT row_id, {d.date('substr(' + d.strip('raw_date', '[^0-9]') + ', 1, 8)')} AS parsed FROM :vendor")
op("PRJ-06", "Bar time as an int yyyymmdd.", lambda d: f"SELECT security_id, trade_date, CAST({d.ymd('trade_date')} AS INT) AS kline_time FROM :bars")
op("PRJ-07", "Numeric cast: an unparsable required value rejects the row, an optional one is null.", lambda d: f"""
SELECT row_id, {d.number('raw_price')} AS price, {d.number('raw_extra')} AS extra, CASE WHEN {d.number('raw_price')} IS NULL THEN 'REQUIRED_UNPARSABLE' END AS reject FROM :vendor""")
op("PRJ-08", "Identity of a master row: explicit code, else suffixed carrier, else index; carriers that are present must agree.", lambda d: f"""
SELECT row_id, coalesce(explicit_code, {d.split('carrier', 1)}, index_code) AS code,
  (explicit_code <> {d.split('carrier', 1)}) IS TRUE OR (explicit_code <> index_code) IS TRUE OR ({d.split('carrier', 1)} <> index_code) IS TRUE AS conflict FROM :carriers""")
op("PRJ-09", "Calendar payload: one bad day rejects all of a market's days.", lambda d: f"""
SELECT market, trade_date FROM (SELECT market, {d.date('day_text')} AS trade_date, sum(CASE WHEN {d.date('day_text')} IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY market) AS bad FROM :days) q WHERE bad = 0""")
op("PRJ-10", "Security-master rows.", lambda d: f"SELECT security_id, code || '.' || exchange AS provider_symbol, code AS security_code, market_code, list_date, delist_date, CASE WHEN delist_date IS NULL THEN 1 ELSE 3 END AS is_listed, CASE WHEN is_st THEN 1 ELSE 0 END AS st_flag FROM :master")
op("PRJ-11", "Daily-bar rows; a member key that differs from the embedded code is rejected.", "SELECT member_key, embedded_code, trade_date, close, CASE WHEN embedded_code IS NOT NULL AND embedded_code <> member_key THEN 'MEMBER_KEY_CONFLICT' WHEN close IS NULL THEN 'REQUIRED_UNPARSABLE' END AS reject FROM :members")
op("PRJ-12", "A status row as three outputs: status mirror, limit price, corporate-action flags.", """
SELECT 'status' AS output, security_id, trade_date, IS_ST_SEC AS a, IS_SUSP_SEC AS b, CAST(NULL AS DOUBLE) AS up, CAST(NULL AS DOUBLE) AS down FROM :status
UNION ALL SELECT 'limit_price', security_id, trade_date, NULL, NULL, HIGH_LIMITED, LOW_LIMITED FROM :status
UNION ALL SELECT 'action_flags', security_id, trade_date, IS_XR_SEC, NULL, NULL, NULL FROM :status WHERE IS_XR_SEC = '1'""")
op("PRJ-13", "Adjustment-factor rows of both types.", "SELECT security_id, ex_date, factor, 'SINGLE' AS factor_type FROM :factors UNION ALL SELECT security_id, ex_date, cum_factor, 'BACKWARD' FROM :factors")
op("PRJ-14", "Industry membership rows.", "SELECT security_id, 'I' || lpad(CAST(market_code AS STRING), 3, '0') AS industry_code, 1 AS industry_level, list_date AS in_date, delist_date AS out_date, delist_date IS NULL AS current_sign FROM :master")
op("PRJ-15", "Index daily rows.", "SELECT 'IDX' AS index_code, trade_date, round(sum(amount), 2) AS amount, sum(volume) AS volume, max(high) AS high, min(low) AS low FROM :bars GROUP BY trade_date")
op("PRJ-16", "Equity-structure rows.", "SELECT security_id, list_date AS report_date, CAST(market_code * 1000000 AS BIGINT) AS total_share, CAST(market_code * 600000 AS BIGINT) AS float_a_share FROM :master")
op("PRJ-17", "Corporate-action streams in one view; the stream names the type, and a missing code or date fails.", """
SELECT security_id, ex_date, action_type, CASE WHEN security_id IS NULL OR ex_date IS NULL THEN 'MISSING_IDENTITY_OR_DATE' END AS failure FROM (
  SELECT security_id, ex_date, 'DIVIDEND' AS action_type FROM :dividends UNION ALL SELECT security_id, ex_date, 'RIGHT_ISSUE' FROM :rights) q""")
op("PRJ-18", "Event type from its alias and class; disagreement and unknown names fail.", """
SELECT e.event_id, a.event_type AS by_alias, c.event_type AS by_class, CASE WHEN a.event_type IS NULL THEN 'UNKNOWN_ALIAS' WHEN c.event_type IS NULL THEN 'UNKNOWN_CLASS' WHEN a.event_type <> c.event_type THEN 'CONFLICT' ELSE a.event_type END AS outcome
FROM :market_events e LEFT JOIN :alias_dim a ON e.alias = a.name LEFT JOIN :class_dim c ON e.event_class = c.name""")
op("PRJ-19", "Canonical status view: rows without identity or date, and keys that come twice, are rejected.", "SELECT symbol, trade_date, market_code, CASE WHEN symbol IS NULL OR trade_date IS NULL THEN 'MISSING_KEY' WHEN count(*) OVER (PARTITION BY symbol, trade_date) > 1 THEN 'DUPLICATE_KEY' END AS reject FROM :status_view")
op("PRJ-20", "Canonical daily-bar view: columns as they are, nothing invented.", "SELECT security_id, trade_date, open, high, low, close, pre_close, volume, amount FROM :bars")
op("PRJ-22", "Run status from scope, permission to be partial, and retained rows.", """
SELECT run_id, sum(retained) AS retained, CASE WHEN NOT bool_and(in_scope) OR sum(retained) = 0 THEN 'BLOCKED' WHEN sum(quarantined) = 0 THEN 'SUCCESS' WHEN bool_and(allow_partial) THEN 'PARTIAL' ELSE 'BLOCKED' END AS run_status
FROM :run_rows GROUP BY run_id""")
op("PRJ-23", "Surface routing by exact match of provider, surface, dataset and endpoint.", """
SELECT r.request_id, CASE WHEN d.handler IS NULL THEN 'BLOCKED' WHEN d.handler = 'none' THEN 'NOT_APPLICABLE' ELSE d.handler END AS route FROM :requests r
LEFT JOIN :routing d ON r.provider = d.provider AND r.surface = d.surface AND r.dataset = d.dataset AND r.endpoint = d.endpoint""")
op("PRJ-24", "Calendar expansion: a row for each market and day.", lambda d: f"SELECT {d.each(*[chr(39) + m + chr(39) for m in ('SH', 'SZ', 'BJ')])} AS market, trade_date FROM :calendar")
op("PRJ-28", "Availability is the receipt, for the supported domains.", "SELECT r.domain, r.security_id, r.trade_date, CASE WHEN m.eligibility = 'SUPPORTED' THEN r.received_on END AS available_on FROM :domain_rows r JOIN :domain_matrix m ON r.domain = m.domain")
op("PRJ-29", "Point in time: rows available later than the cutoff are decisions, not data.", "SELECT security_id, trade_date, CASE WHEN available_on <= DATE '1998-06-01' THEN 'ELIGIBLE' ELSE 'EXCLUDED_FUTURE' END AS decision FROM :bars")
op("PRJ-30", "Session close at 15:00 in Shanghai; eligible from then on, equality included; BJ from its first session only.", lambda d: f"""
SELECT trade_date, exchange, {d.shanghai('trade_date', '15:00:00')} AS closes_at_utc, {d.shanghai('trade_date', '15:00:00')} <= '1998-06-01 07:00:00' AND (exchange <> 'BJ' OR trade_date >= DATE '2021-11-15') AS eligible FROM :market_days""")
op("PRJ-31", "Research split of a date.", "SELECT trade_date, " + (SPLIT := """CASE WHEN trade_date < DATE '2020-01-01' THEN 'warmup' WHEN trade_date <= DATE '2023-12-31' THEN 'development' WHEN trade_date <= DATE '2025-12-31' THEN 'validation_a'
  WHEN trade_date <= DATE '2026-06-30' THEN 'holdout' ELSE 'outside_window' END""") + " AS split FROM :shifted_days")
_INF = "CAST('Infinity' AS DOUBLE)"
#: The first of these values that is no finite number, or below zero, decides.
_FAULTS = ", ".join(
    f"CASE WHEN isnan(CAST({c} AS DOUBLE)) OR abs({c}) = {_INF} THEN 'non_finite_value' WHEN {c} < 0 THEN 'invalid_ohlc' END"
    for c in ("open", "high", "low", "close", "pre_close", "volume", "amount")
)
_FAULT = f"coalesce({_FAULTS})"
ELIGIBILITY = f"""CASE WHEN split IN ('warmup', 'outside_window') THEN 'outside_research_window' WHEN upstream IS NOT NULL AND upstream <> 'RESEARCH_ENABLED' THEN 'upstream_unresolved'
  WHEN identity_conflict THEN 'identity_conflict' WHEN resolved_id IS NULL THEN 'identity_unresolved'
  WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL OR amount IS NULL THEN 'missing_required_value'
  WHEN {_FAULT} IS NOT NULL THEN {_FAULT}
  WHEN high < greatest(open, close) OR low > least(open, close) OR low > high THEN 'invalid_ohlc'
  WHEN exchange = 'BJ' THEN 'bse_identity_boundary_unresolved' END"""
op("PRJ-32", "Eligibility in a fixed order of checks, with reason and quality state.", f"""
SELECT security_id, trade_date, split, reason, CASE WHEN reason IS NULL THEN 'RESEARCH_ENABLED' WHEN upstream = 'RESEARCH_EXPERIMENTAL' AND reason = 'upstream_unresolved' THEN 'RESEARCH_EXPERIMENTAL' ELSE 'RESEARCH_DISABLED_UNRESOLVED' END AS eligibility,
  CASE WHEN reason IS NULL THEN 'VERIFIED' WHEN reason IN ('non_finite_value', 'invalid_ohlc') THEN 'INVALID' ELSE 'UNRESOLVED' END AS quality_state FROM (SELECT *, {ELIGIBILITY} AS reason FROM :panel_input) q""")
op("PRJ-33", "Research panel row: identity in force validates, the current symbol is shown.", f"""
SELECT p.security_id, p.trade_date, p.split, p.exchange, p.symbol AS symbol_at_date, c.symbol AS current_symbol, p.open, p.high, p.low, p.close, p.volume, p.amount, p.reason
FROM (SELECT *, {ELIGIBILITY} AS reason FROM :panel_input) p LEFT JOIN :current_symbols c ON p.security_id = c.security_id""")
op("PRJ-34", "History route: enabled, disabled or experimental; BJ is never enabled.", "SELECT security_id, trade_date, CASE WHEN eligibility = 'RESEARCH_ENABLED' AND exchange <> 'BJ' THEN 'enabled' WHEN eligibility = 'RESEARCH_EXPERIMENTAL' THEN 'experimental' ELSE 'disabled' END AS route, eligibility = 'RESEARCH_ENABLED' AND exchange = 'BJ' AS violation FROM :panel")
op("PRJ-35", "Panel invariants: assigned split, a reason exactly when not enabled, enabled rows verified.", lambda d: "SELECT violation, count(*) AS n FROM (SELECT " + d.each("CASE WHEN split <> assigned_split THEN 'SPLIT' END", "CASE WHEN (reason IS NULL) <> (eligibility = 'RESEARCH_ENABLED') THEN 'REASON' END", "CASE WHEN eligibility = 'RESEARCH_ENABLED' AND quality_state <> 'VERIFIED' THEN 'QUALITY' END") + " AS violation FROM :panel_claims) q WHERE violation IS NOT NULL GROUP BY violation")
op("PRJ-36", "Limit prices: pre_close by 1 +- rate, half up to the tick; zero rates mean no limit.", lambda d: f"""
SELECT security_id, trade_date, CASE WHEN up_rate = 0 THEN NULL ELSE {d.decimal2('CAST(pre_close AS DECIMAL(18, 4)) * CAST(1 + up_rate AS DECIMAL(6, 2))')} END AS limit_up,
  CASE WHEN down_rate = 0 THEN NULL ELSE {d.decimal2('CAST(pre_close AS DECIMAL(18, 4)) * CAST(1 - down_rate AS DECIMAL(6, 2))')} END AS limit_down FROM :rated""")
op("PRJ-38", "Quality flags: split, trimmed, empty ones dropped, sorted, joined.", lambda d: f"SELECT row_id, {d.joined('flag')} AS flags FROM (SELECT row_id, trim(flag) AS flag FROM (SELECT row_id, {d.words('raw_flags')} AS flag FROM :vendor) x) y WHERE flag <> '' GROUP BY row_id")
op("PRJ-39", "Event time from digits: 13 are epoch milliseconds, 16 microseconds, 14 a local date and time.", lambda d: f"""
SELECT event_id, CASE length(digits) WHEN 13 THEN {d.from_ms('CAST(digits AS BIGINT)')} WHEN 16 THEN {d.from_ms('CAST(floor(CAST(digits AS BIGINT) / 1000) AS BIGINT)')}
  WHEN 14 THEN substr(digits, 1, 4) || '-' || substr(digits, 5, 2) || '-' || substr(digits, 7, 2) || ' ' || substr(digits, 9, 2) || ':' || substr(digits, 11, 2) || ':' || substr(digits, 13, 2) END AS event_time FROM :feed_times""")
op("PRJ-40", "Trading session: weekdays 09:15 to 11:30 and 13:00 to 15:05.", lambda d: f"""
SELECT event_id, {d.weekday('ts')} < 5 AND (hour(ts) * 100 + minute(ts) BETWEEN 915 AND 1130 OR hour(ts) * 100 + minute(ts) BETWEEN 1300 AND 1505) AS in_session FROM :events""")
KEY = lambda d: f"exchange || ':STOCK:' || code || ':' || coalesce({d.ymd('known_list_date')}, 'F' || {d.ymd('first_seen')})"
op("PRJ-41", "Identity key EX:TYPE:SYMBOL:YYYYMMDD, by first sight and flagged where the list date is unknown.", lambda d: f"SELECT security_id, {KEY(d)} AS identity_key, known_list_date IS NULL AS is_fallback FROM :identities")
op("PRJ-42", "Stable id: UUIDv5 of the identity key.", lambda d: f"SELECT security_id, {d.uuid5('(' + KEY(d) + ')')} AS stable_id FROM :identities")
op("PRJ-44", "Publishable identities: not the fallback ones.", "SELECT security_id FROM :identities WHERE known_list_date IS NOT NULL")
op("PRJ-45", "Domain matrix: a blocked domain that is asked for is an error.", "SELECT r.domain, count(*) AS n, max(coalesce(m.eligibility, 'UNKNOWN')) AS eligibility, max(CASE WHEN coalesce(m.eligibility, 'UNKNOWN') NOT IN ('SUPPORTED', 'AUXILIARY') THEN 1 ELSE 0 END) AS is_error FROM :domain_rows r LEFT JOIN :domain_matrix m ON r.domain = m.domain GROUP BY r.domain")
op("PRJ-46", "Structural events: a valid date, and the subtype and symbol that their class needs.", lambda d: f"SELECT event_id, CASE WHEN {d.date('date_text')} IS NULL THEN 'BAD_DATE' WHEN event_class = 'ST' AND subtype IS NULL THEN 'MISSING_SUBTYPE' WHEN symbol IS NULL THEN 'MISSING_SYMBOL' ELSE 'VALID' END AS verdict FROM :market_events")

# ---- joins ------------------------------------------------------------------

IN_FORCE = "{t}.trade_date >= i.valid_from AND (i.valid_to IS NULL OR {t}.trade_date < i.valid_to)"
op("JN-01", "Identity in force of a symbol on a date; more than one id gives null. The equi key comes first, the interval second.", f"""
SELECT s.symbol, s.trade_date, CASE WHEN count(DISTINCT i.security_id) = 1 THEN max_by(i.security_id, i.valid_from) END AS security_id
FROM :symbol_days s LEFT JOIN :identity i ON s.symbol = i.symbol AND {IN_FORCE.format(t='s')} GROUP BY s.symbol, s.trade_date""")
op("JN-02", "Bare code: resolved if exactly one suffixed variant exists.", lambda d: f"SELECT {d.split('symbol', 1)} AS code, max(symbol) AS symbol FROM :identity GROUP BY {d.split('symbol', 1)} HAVING count(DISTINCT symbol) = 1")
op("JN-03", "Code-change bridge: the old code until the change, the new one from it; a later list date is an error.", """
SELECT security_id, old_symbol AS symbol, list_date AS valid_from, effective AS valid_to, list_date >= effective AS is_error FROM :code_changes
UNION ALL SELECT security_id, new_symbol, effective, CAST(NULL AS DATE), list_date >= effective FROM :code_changes""")
op("JN-04", "Current symbol of an id: its open interval, if it has one only.", "SELECT security_id, CASE WHEN count(DISTINCT symbol) = 1 THEN max_by(symbol, valid_from) END AS current_symbol FROM :identity WHERE valid_to IS NULL GROUP BY security_id")
op("JN-05", "Research identity by id, and by qualified symbol: exactly one in force.", f"""
SELECT s.security_id, s.trade_date, CASE WHEN count(DISTINCT i.symbol) = 1 THEN max(i.symbol) END AS symbol, CASE WHEN count(DISTINCT j.security_id) = 1 THEN max(j.security_id) END AS id_of_symbol FROM :supplied s
LEFT JOIN :identity i ON s.security_id = i.security_id AND {IN_FORCE.format(t='s')}
LEFT JOIN :identity j ON upper(trim(s.symbol)) = j.symbol AND {IN_FORCE.format(t='s').replace('i.', 'j.')} GROUP BY s.security_id, s.trade_date""")
op("JN-06", "Identity conflict: a supplied symbol or exchange differs from the resolved one; what is not supplied or not resolved is none.", f"""
SELECT s.security_id, s.trade_date, i.symbol IS NOT NULL AND ((s.symbol IS NOT NULL AND trim(s.symbol) <> i.symbol) OR (s.exchange IS NOT NULL AND upper(trim(s.exchange)) <> i.exchange)) AS conflict
FROM :supplied s LEFT JOIN :identity i ON s.security_id = i.security_id AND {IN_FORCE.format(t='s')}""")
FLAG = "CASE WHEN {x} IN ('1', '1.0', 'true', 'True') THEN true WHEN {x} IN ('0', '0.0', 'false', 'False') THEN false END"
op("JN-14", "ST and suspension facts: flags must be 0 or 1, then the facts; without facts a row is observed.", f"""
SELECT s.security_id, s.trade_date, CASE WHEN {FLAG.format(x='s.IS_ST_SEC')} IS NULL OR {FLAG.format(x='s.IS_SUSP_SEC')} IS NULL THEN 'BAD_FLAG' WHEN g.case_id IS NULL THEN 'OBSERVED' WHEN {FLAG.format(x='s.IS_ST_SEC')} = g.expected THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM :status s LEFT JOIN :golden g ON g.symbol = s.security_id AND g.trade_date = s.trade_date""")
op("JN-17", "Delisted check: listing state 3 or a delisting date passes, membership alone is missing evidence, another state is a mismatch, absence is survivorship.", """
SELECT m.security_id, CASE WHEN h.security_id IS NULL THEN 'FAIL_SURVIVORSHIP' WHEN trim(h.is_listed) = '3' OR h.delist_date IS NOT NULL THEN 'PASS' WHEN h.is_listed IS NULL THEN 'MISSING' ELSE 'FAIL_MISMATCH' END AS verdict
FROM :master m LEFT JOIN :master_facts h ON m.security_id = h.security_id WHERE m.is_st OR m.delist_date IS NOT NULL""")
op("JN-19", "Identity quality: ids of facts that the dimension lacks, or holds as fallback only.", "SELECT f.security_id, CASE WHEN i.security_id IS NULL THEN 'MISSING' ELSE 'FALLBACK' END AS finding FROM (SELECT DISTINCT security_id FROM :fact_ids) f LEFT JOIN :identities i ON f.security_id = i.security_id WHERE i.security_id IS NULL OR i.known_list_date IS NULL")
op("JN-20", "ST transitions: one audit row for each event, ADD turns the flag on, REMOVE off.", "SELECT coalesce(e.event_id, a.event_id) AS event_id, CASE WHEN e.event_id IS NULL THEN 'EXTRA_AUDIT' WHEN a.event_id IS NULL THEN 'MISSING_AUDIT' WHEN e.subtype = 'ADD' AND NOT (a.flag_before = 0 AND a.flag_after = 1) THEN 'NOT_PROVEN' WHEN e.subtype = 'REMOVE' AND NOT (a.flag_before = 1 AND a.flag_after = 0) THEN 'NOT_PROVEN' ELSE 'PASS' END AS verdict FROM :st_events e FULL OUTER JOIN :st_audit a ON e.event_id = a.event_id")
op("JN-21", "Identity join and group of minute bars.", "SELECT d.sector_id, count(*) AS n, sum(m.volume) AS volume FROM :minutes m JOIN :minute_dim d ON m.security_key = d.security_key GROUP BY d.sector_id")
op("JN-22", "Lineage back-join: dates of each symbol, and bars before listing or from delisting on.", "SELECT b.security_id, min(b.trade_date) AS first_bar, max(b.trade_date) AS last_bar, count(*) AS n, count(*) FILTER (WHERE b.trade_date < m.list_date) AS before_listing, count(*) FILTER (WHERE b.trade_date >= m.delist_date) AS after_delisting FROM :bars b JOIN :master m ON b.security_id = m.security_id GROUP BY b.security_id")
op("JN-23", "Version carry-forward: each old id maps to itself or a replacement; gaps are found.", "SELECT o.id AS old_id, coalesce(r.new_id, n.id) AS new_id, coalesce(r.new_id, n.id) IS NULL AS is_gap FROM :old_version o LEFT JOIN :replacements r ON o.id = r.old_id LEFT JOIN :new_version n ON o.id = n.id")
op("JN-24", "Authorized overlay: only approved facts stay; unmatched approvals are listed.", "SELECT m.security_id, m.list_date, 'KEPT' AS outcome FROM :master m WHERE EXISTS (SELECT 1 FROM :approved a WHERE a.security_id = m.security_id AND a.list_date = m.list_date) UNION ALL SELECT a.security_id, a.list_date, 'UNMATCHED' FROM :approved a WHERE NOT EXISTS (SELECT 1 FROM :master m WHERE a.security_id = m.security_id AND a.list_date = m.list_date)")
op("JN-25", "Orphans: listed files that no row registers.", "SELECT l.uri FROM :listing l WHERE NOT EXISTS (SELECT 1 FROM :registered r WHERE r.uri = l.uri)")
op("JN-26", "Exact lookup with cardinality: none is missing, several are ambiguous.", "SELECT g.case_id, CASE count(s.security_id) WHEN 0 THEN 'MISSING' WHEN 1 THEN 'FOUND' ELSE 'AMBIGUOUS' END AS outcome FROM :golden g LEFT JOIN :status_dup s ON g.symbol = s.security_id AND g.trade_date = s.trade_date GROUP BY g.case_id")
