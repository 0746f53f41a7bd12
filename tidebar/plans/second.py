"""SQL of another form for operators whose text is one for both engines, so that a check tests the text and not only the engine.

Each is written from what the operator means: set operations, correlated subqueries and other joins in place of windows, groupings and
conditional aggregates.
"""

from __future__ import annotations

from .base import ORACLE
from .relations import duck

_FORCE = "{d} >= i.valid_from AND {d} < coalesce(i.valid_to, DATE '9999-12-31')"
_ID = "(SELECT i.{c} FROM :identity i WHERE i.{k} = {v} AND " + _FORCE + ")"
_N = "(SELECT count(DISTINCT i.{c}) FROM :identity i WHERE i.{k} = {v} AND " + _FORCE + ")"


def _one(c: str, k: str, v: str, d: str) -> str:
    """The value in force if there is exactly one."""
    args = {"c": c, "k": k, "v": v, "d": d}
    return f"CASE WHEN {_N.format(**args)} = 1 THEN (SELECT any_value(i.{c}) FROM :identity i WHERE i.{k} = {v} AND {_FORCE.format(d=d)}) END"


_APPLY = "applicable AS (SELECT u.security_id, u.trade_date FROM :universe u, :master m WHERE u.security_id = m.security_id AND u.trade_date >= m.list_date AND u.trade_date < coalesce(m.delist_date, DATE '9999-12-31'))"
_CLASSES = _APPLY + """, flagged AS (SELECT security_id, trade_date, CASE IS_SUSP_SEC WHEN '1' THEN 'suspended' WHEN '0' THEN 'required' END AS class FROM applicable NATURAL JOIN :status_part),
bare AS (SELECT * FROM applicable EXCEPT SELECT security_id, trade_date FROM flagged),
classed AS (SELECT * FROM flagged UNION ALL SELECT security_id, trade_date, CASE WHEN EXISTS (SELECT 1 FROM :suspensions v WHERE v.security_id = b.security_id AND b.trade_date >= v.suspended_from AND b.trade_date < v.resumes_on) THEN 'suspended' ELSE 'unresolved' END FROM bare b),
required AS (SELECT security_id, trade_date FROM classed WHERE class = 'required'), missing AS (SELECT * FROM required EXCEPT SELECT security_id, trade_date FROM :returned), extra AS (SELECT security_id, trade_date FROM :returned EXCEPT SELECT * FROM required)"""
_BEST = "(SELECT {c} FROM {t} o WHERE o.security_id = x.security_id AND o.trade_date = x.trade_date ORDER BY priority, manifest_hash, ordinal LIMIT 1)"
_COUNTS = " UNION ALL ".join([f"SELECT '{c}' AS class, count(*) AS n FROM classed WHERE class = '{c}'" for c in ("suspended", "required", "unresolved")] + [f"SELECT '{c}', count(*) FROM {c}" for c in ("missing", "extra")])

SECOND = {
    "JN-01": f"SELECT s.symbol, s.trade_date, {_one('security_id', 'symbol', 's.symbol', 's.trade_date')} AS security_id FROM (SELECT DISTINCT symbol, trade_date FROM :symbol_days) s",
    "JN-05": f"SELECT s.security_id, s.trade_date, {_one('symbol', 'security_id', 's.security_id', 's.trade_date')} AS symbol, {_one('security_id', 'symbol', 'upper(s.symbol)', 's.trade_date')} AS id_of_symbol FROM :supplied s",
    "JN-22": "SELECT security_id, arg_min(trade_date, trade_date) AS first_bar, arg_max(trade_date, trade_date) AS last_bar, count(*) AS n, (SELECT count(*) FROM :bars c, :master m WHERE c.security_id = b.security_id AND m.security_id = b.security_id AND c.trade_date < m.list_date) AS before_listing, (SELECT count(*) FROM :bars c, :master m WHERE c.security_id = b.security_id AND m.security_id = b.security_id AND c.trade_date >= m.delist_date) AS after_delisting FROM :bars b GROUP BY security_id",
    "JN-25": "SELECT uri FROM :listing EXCEPT SELECT uri FROM :registered",
    "JN-26": "SELECT case_id, CASE WHEN n = 0 THEN 'MISSING' WHEN n = 1 THEN 'FOUND' ELSE 'AMBIGUOUS' END AS outcome FROM (SELECT g.case_id, (SELECT count(*) FROM :status_dup s WHERE s.security_id = g.symbol AND s.trade_date = g.trade_date) AS n FROM :golden g)",
    "WN-21": f"WITH u AS (SELECT * FROM :candidates WHERE identity_status <> 'MISSING') SELECT security_id, trade_date, provider, ordinal, CASE WHEN ordinal = {_BEST.format(c='ordinal', t='u')} AND run_id = {_BEST.format(c='run_id', t='u')} THEN 'SELECTED' WHEN payload IS NOT DISTINCT FROM {_BEST.format(c='payload', t='u')} THEN 'EQUIVALENT_MERGED' ELSE 'SOURCE_CONFLICT' END AS decision FROM u x",
    "WN-22": "SELECT run_id, security_id, trade_date, (SELECT count(*) FROM :candidates o WHERE o.run_id = c.run_id AND o.security_id = c.security_id AND o.trade_date = c.trade_date AND o.ordinal <= c.ordinal) AS k FROM :candidates c WHERE k > 1",
    "WN-24": "SELECT security_id, trade_date FROM (SELECT security_id, trade_date, count(*) AS n FROM :bars_dup GROUP BY ALL), range(20) t(i) WHERE i < n - 1",
    "WN-25": "SELECT trade_date, (SELECT count(*) FROM :calendar o WHERE o.trade_date <= c.trade_date) AS session_no, (SELECT max(trade_date) FROM :calendar o WHERE o.trade_date < c.trade_date) AS before_day, (SELECT min(trade_date) FROM :calendar o WHERE o.trade_date > c.trade_date) AS after_day FROM :calendar c",
    "TB-07": "SELECT id, 'NEW' AS outcome FROM :new_version WHERE id NOT IN (SELECT id FROM :old_version) UNION ALL SELECT id, CASE WHEN (id, payload) IN (SELECT (id, payload) FROM :old_version) THEN 'NO_OP' ELSE 'ERROR' END FROM :new_version WHERE id IN (SELECT id FROM :old_version)",
    "ST-01": f"WITH {_APPLY} SELECT * FROM applicable",
    "ST-03": f"WITH {_CLASSES} SELECT * FROM classed",
    "ST-06": f"WITH {_CLASSES} SELECT 'missing' AS side, * FROM missing UNION ALL SELECT 'extra', * FROM extra",
    "ST-07": f"WITH {_APPLY} SELECT security_id, (SELECT count(*) FROM :sessions) - coalesce(k, 0) AS n FROM :master LEFT JOIN (SELECT security_id, count(*) AS k FROM (SELECT DISTINCT a.security_id, a.trade_date FROM applicable a JOIN :sessions s ON a.trade_date = s.trade_date) GROUP BY security_id) USING (security_id) WHERE (SELECT count(*) FROM :sessions) > coalesce(k, 0)",
    "ST-08": f"WITH {_CLASSES}, counts AS ({_COUNTS}) SELECT class, n, CASE WHEN (SELECT sum(n) FROM counts WHERE class IN ('missing', 'extra', 'unresolved')) = 0 THEN 'PASS' ELSE 'FAIL_CLOSED' END AS verdict FROM counts",
    "ST-15": "SELECT id FROM :old_version EXCEPT SELECT id FROM :new_version",
    "ST-16": """SELECT 'DROPPED' AS diff, count(*) AS n FROM (SELECT id FROM :old_version EXCEPT SELECT id FROM :new_version) UNION ALL SELECT 'ADDED', count(*) FROM (SELECT id FROM :new_version EXCEPT SELECT id FROM :old_version)
  UNION ALL SELECT 'UNCHANGED', count(*) FROM (SELECT id, payload FROM :old_version INTERSECT SELECT id, payload FROM :new_version) UNION ALL SELECT 'CHANGED', (SELECT count(*) FROM (SELECT id FROM :old_version INTERSECT SELECT id FROM :new_version)) - (SELECT count(*) FROM (SELECT id, payload FROM :old_version INTERSECT SELECT id, payload FROM :new_version))""",
    "SO-04": "SELECT p.trade_date, p.publish_id, p.version FROM :publish_log p WHERE state = 'PUBLISHED' AND version = (SELECT max(version) FROM :publish_log o WHERE o.trade_date = p.trade_date AND o.state = 'PUBLISHED')",
}
ORACLE.update({k: duck(text) for k, text in SECOND.items()})
