"""Queries on golden cases (SRC-05, AG-25, AG-47, JN-13): each event is a case, written as a JSON line and read back."""

from __future__ import annotations

from ..operators import golden as gd
from ..sources import storage as st
from .base import query
from .relations import D, K, duck, frame, rel

#: What a line is made of; a null field is left out of the fact's JSON text as null, as a reader sees it.
_FACT = ("case_type", "event_class", "event_effective_date", "event_id", "event_subtype", "expected_fields", "provider_symbol", "trade_date")
_text = lambda c: f"""coalesce('"' || {c} || '"', 'null')"""
_quoted = """'"' || replace(expected_fields, '"', chr(92) || '"') || '"'"""
rel("golden_facts", lambda d: f"""SELECT event_id AS n, 'c' || {d.text('CASE WHEN event_id % 31 = 5 THEN event_id - 1 ELSE event_id END')} AS case_id, CASE event_id % 4 WHEN 0 THEN 'golden_st_transition' WHEN 1 THEN 'golden_delisted' WHEN 2 THEN 'golden_limit_regime' ELSE 'golden_corporate_action' END AS case_type,
  lpad({d.text('user_id')}, 6, '0') || '.SH' AS provider_symbol, {d.text('CAST(ts AS DATE)')} AS trade_date, 'e' || {d.text('event_id')} AS event_id, CASE event_id % 4 WHEN 0 THEN 'ST_TRANSITION' WHEN 1 THEN 'DELIST' WHEN 2 THEN 'LIMIT' ELSE '' END AS event_class,
  CASE event_id % 20 WHEN 0 THEN 'ST_ADD' WHEN 4 THEN 'ST_REMOVE' WHEN 8 THEN 'STAR_ST_ADD' WHEN 12 THEN 'OTHER' END AS event_subtype, CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '2024-13-01' ELSE {d.text('CAST(ts AS DATE)')} END AS event_effective_date,
  CASE WHEN event_id % 11 = 2 THEN 'v3' ELSE 'v4' END AS truth_version, CASE WHEN event_id % 7 = 0 THEN 'REVIEWED' ELSE 'COMPILED' END AS review_status, CASE WHEN event_id % 7 = 0 OR event_id % 13 = 0 THEN 'me' END AS reviewed_by, CASE WHEN event_id % 7 = 0 AND event_id % 3 <> 0 THEN 'ref' END AS artifact,
  chr(123) || '"IS_ST_SEC":' || CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END || chr(125) AS expected_fields FROM :events""")
_HASHED = "chr(123) || " + " || ',' || ".join(f"""'"{c}":' || {_quoted if c == 'expected_fields' else _text(c)}""" for c in _FACT) + " || chr(125)"
rel("golden_lines", lambda d: f"SELECT *, {d.sha(_HASHED)} AS sealed FROM :golden_facts")
_FIELDS = {
    "case_id": "case_id", "case_type": "case_type", "provider_symbol": "provider_symbol", "trade_date": "CASE WHEN n % 37 = 0 THEN '2001-01-01' ELSE trade_date END", "event_id": "event_id", "event_class": "event_class",
    "event_subtype": "event_subtype", "event_effective_date": "event_effective_date", "truth_version": "truth_version", "review_status": "review_status", "compiled_by": "CASE WHEN n % 41 <> 0 THEN 'them' END", "compiled_at": "'2024-02-01'",
    "reviewed_by": "reviewed_by", "reviewed_at": "reviewed_by", "source_artifact_ref": "artifact", "source_artifact_hash": "artifact", "source_artifact_kind": "artifact", "source_retrieved_at": "artifact", "case_semantic_hash": "sealed",
}
_LINE = "CASE WHEN n % 43 = 0 THEN '{broken' ELSE '{' || " + " || ',' || ".join(f"""'"{k}":' || {_text(v)}""" for k, v in _FIELDS.items()) + """ || ',"expected_fields":' || expected_fields || '}' END AS value"""


def _cases(spark, sf_dir):
    def build(path):
        frame(spark, sf_dir, "golden_lines").selectExpr(_LINE).write.text(path)

    return gd.read_cases(spark, st.stored(spark, f"golden {sf_dir}", build), "v4")


_VERDICTS = """v AS (SELECT *, CASE WHEN n % 43 = 0 THEN 'INVALID_JSON' WHEN n % 41 = 0 THEN 'MISSING_SEAL_FIELD' WHEN truth_version <> 'v4' THEN 'TRUTH_VERSION' WHEN review_status = 'COMPILED' AND reviewed_by IS NOT NULL THEN 'COMPILED_WITH_REVIEW'
  WHEN review_status = 'REVIEWED' AND artifact IS NULL THEN 'REVIEW_INCOMPLETE' WHEN n % 37 = 0 THEN 'SEMANTIC_HASH' WHEN case_id IN (SELECT case_id FROM :golden_lines WHERE n % 43 <> 0 GROUP BY case_id HAVING count(*) > 1) THEN 'DUPLICATE_ID' ELSE 'VALID' END AS verdict FROM :golden_lines),
ok AS (SELECT * FROM v WHERE verdict = 'VALID')"""


@query("SRC-05", duck(f"""WITH {_VERDICTS} SELECT CASE WHEN n % 43 <> 0 THEN case_id END AS case_id, CASE WHEN n % 43 <> 0 THEN case_type END AS case_type, CASE WHEN n % 43 = 0 THEN NULL WHEN n % 37 = 0 THEN '2001-01-01' ELSE trade_date END AS trade_date,
  CASE WHEN n % 43 <> 0 THEN expected_fields LIKE '%true%' END AS is_st, verdict FROM v"""))
def golden_scan(spark, sf_dir):
    return _cases(spark, sf_dir).selectExpr("case_id", "case_type", "trade_date", "try_variant_get(expected_fields, '$.IS_ST_SEC', 'boolean') AS is_st", "verdict")


_DAY = "(event_effective_date IS NOT NULL AND event_effective_date <> '2024-13-01')"
_KINDS = ", ".join(f"'{x}'" for x in (*gd.ADDS, *gd.REMOVES))
_GOOD_ST = f"event_class = 'ST_TRANSITION' AND {_DAY} AND coalesce(event_subtype IN ({_KINDS}), false)"
_EVENTS = "(SELECT DISTINCT provider_symbol, event_effective_date, event_subtype FROM ok WHERE " + _GOOD_ST + " AND {x})"


def _count(statistic: str, subject: str, of: str) -> str:
    return f"SELECT '{statistic}' AS statistic, '{subject}' AS subject, (SELECT count(*) FROM {of}) AS n"


_ROWS = [_count("counts_by_type", t, f"ok WHERE case_type = '{t}'") for t in gd.MINIMA]
_RECOUNT = [
    _count("distinct_events", "ST_TRANSITION", _EVENTS.format(x="true")), _count("distinct_events", "DELIST", f"(SELECT DISTINCT provider_symbol, event_effective_date FROM ok WHERE event_class = 'DELIST' AND {_DAY})"),
    _count("st_add_events", "", _EVENTS.format(x="event_subtype LIKE '%ADD'")), _count("st_remove_events", "", _EVENTS.format(x="event_subtype LIKE '%REMOVE'")),
    _count("distinct_delisted_securities", "", "(SELECT DISTINCT provider_symbol FROM ok WHERE event_class = 'DELIST')"),
]
_BROKEN = {"ST_TRANSITION": f"ok WHERE event_class = 'ST_TRANSITION' AND NOT ({_GOOD_ST})", "DELIST": f"ok WHERE event_class = 'DELIST' AND NOT {_DAY}"}
_INVALID = [_count("invalid_structural_cases", k, v) for k, v in _BROKEN.items()]
_LEAST = " ".join(f"WHEN subject = '{k}' THEN {v}" for k, v in (gd.MINIMA | gd.DISTINCT_MINIMA).items())
_AT_LEAST = f"CASE WHEN statistic = 'invalid_structural_cases' THEN NULL {_LEAST} WHEN statistic LIKE 'st_%' THEN 1 ELSE {gd.DELISTED_SYMBOLS} END"


@query("AG-25", duck(f"""WITH {_VERDICTS}, c AS ({' UNION ALL '.join(_ROWS + _RECOUNT + _INVALID)}), b AS (SELECT *, CAST({_AT_LEAST} AS BIGINT) AS at_least FROM c)
SELECT statistic, subject, n, at_least, CASE WHEN at_least IS NULL THEN CAST(0 AS BIGINT) END AS at_most, CASE WHEN at_least IS NULL THEN n = 0 ELSE n >= at_least END AS is_met FROM b"""))
def golden_gates(spark, sf_dir):
    return gd.gates(gd.statistics(_cases(spark, sf_dir).where("verdict = 'VALID'")))


@query("AG-47", duck(f"""WITH {_VERDICTS}, c AS ({' UNION ALL '.join(_RECOUNT)} UNION ALL {_count('distinct_events', 'LIMIT', "(SELECT DISTINCT event_id FROM ok WHERE event_class = 'LIMIT')")}),
f AS (SELECT 'INVALID_STRUCTURE' AS check_name, (SELECT count(*) FROM {_BROKEN['ST_TRANSITION']}) + (SELECT count(*) FROM {_BROKEN['DELIST']}) AS n UNION ALL SELECT 'NOT_COMPILED', (SELECT count(*) FROM ok WHERE review_status <> 'COMPILED') UNION ALL SELECT 'HAS_REVIEW_FIELDS', (SELECT count(*) FROM ok WHERE reviewed_by IS NOT NULL OR artifact IS NOT NULL))
SELECT 'TRUTH_VERSION' AS check_name, '' AS subject, CAST(4 AS BIGINT) AS n, CAST(4 AS BIGINT) AS expected, true AS passes UNION ALL SELECT 'MANIFEST_SCHEMA', '', 2, 2, true UNION ALL SELECT check_name, '', n, 0, n = 0 FROM f
UNION ALL SELECT 'DECLARED:' || statistic, subject, n, CASE WHEN subject = 'LIMIT' THEN NULL WHEN statistic = 'st_add_events' THEN n + 1 ELSE n END, subject <> 'LIMIT' AND statistic <> 'st_add_events' FROM c"""))
def golden_readiness(spark, sf_dir):
    """Declared is what the valid cases say, but for one statistic that is left out and one that is one higher."""
    cases = _cases(spark, sf_dir).where("verdict = 'VALID'")
    declared = gd.statistics(cases).where("subject <> 'LIMIT'").selectExpr("statistic", "subject", "n + CASE WHEN statistic = 'st_add_events' THEN 1 ELSE 0 END AS n")
    return gd.readiness(cases, declared, 4, 2)


rel("fact_rows", lambda d: f"SELECT CASE WHEN {D(d)} % 7 = 0 THEN substr(security_id, 2, 6) ELSE substr(security_id, 2, 6) || '.SH' END AS symbol, trade_date, IS_ST_SEC, IS_SUSP_SEC FROM :status")
rel("fact_cases", lambda d: f"SELECT security_id || '/' || {d.text('trade_date')} AS case_id, CASE {D(d)} % 3 WHEN 0 THEN substr(security_id, 2, 6) WHEN 1 THEN substr(security_id, 2, 6) || '.SH' ELSE substr(security_id, 2, 6) || '.SZ' END AS provider_symbol, CASE WHEN {D(d)} % 11 = 0 THEN '2001-01-01' ELSE {d.text('trade_date')} END AS trade_date, {K} % 7 = 0 OR {D(d)} % 5 = 0 AS is_st, CASE WHEN {D(d)} % 2 = 0 THEN '0' ELSE '1' END AS susp, {D(d)} % 17 = 0 AS has_more FROM :status WHERE {D(d)} % 13 < 4")


@query("JN-13", duck("""WITH x AS (SELECT c.*, f.symbol, f.IS_ST_SEC, f.IS_SUSP_SEC FROM :fact_cases c LEFT JOIN :fact_rows f ON substr(c.provider_symbol, 1, 6) = substr(f.symbol, 1, 6) AND c.trade_date = CAST(f.trade_date AS VARCHAR)),
m AS (SELECT *, CASE WHEN has_more THEN 'GONE' END AS a, CASE WHEN coalesce(IS_ST_SEC IN ('1', '1.0', 'true', 'True'), false) <> is_st THEN 'IS_ST_SEC' END AS b, CASE WHEN IS_SUSP_SEC IS DISTINCT FROM susp THEN 'IS_SUSP_SEC' END AS e FROM x)
SELECT case_id, CASE WHEN symbol IS NULL THEN 'FAIL_MISSING' WHEN coalesce(a, b, e) IS NULL THEN 'PASS' ELSE 'FAIL_VALUE' END AS verdict, CASE WHEN symbol IS NOT NULL THEN concat_ws(',', a, b, e) END AS mismatches FROM m"""))
def golden_compare(spark, sf_dir):
    fields = """parse_json('{"IS_ST_SEC":' || is_st || ',"IS_SUSP_SEC":"' || susp || '"' || CASE WHEN has_more THEN ',"GONE":"x"' ELSE '' END || '}') AS expected_fields"""
    cases = frame(spark, sf_dir, "fact_cases").selectExpr("case_id", "provider_symbol", "trade_date", fields)
    return gd.compare(cases, frame(spark, sf_dir, "fact_rows"), "symbol", "trade_date")
