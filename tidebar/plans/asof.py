"""Queries on as-of joins (JN-09, JN-11, JN-12, JN-18, SO-02); their SQL uses the other engine's ASOF JOIN."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof as ao
from .base import query
from .relations import duck, frame


def _frames(spark, sf_dir, *names):
    return [frame(spark, sf_dir, n) for n in names]


@query("SO-02", duck("SELECT m.security_id, c.trade_date AS first_session FROM :master m ASOF LEFT JOIN :calendar c ON m.list_date <= c.trade_date"))
def first_sessions(spark, sf_dir):
    master, calendar = _frames(spark, sf_dir, "master", "calendar")
    return ao.first_session(master, "list_date", calendar).select("security_id", "first_session")


@query("JN-09", duck("""WITH n AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS k FROM :calendar), f AS (SELECT m.security_id, n.k AS k0 FROM :master m ASOF JOIN n ON m.list_date <= n.trade_date)
SELECT b.security_id, b.trade_date, n.k BETWEEN f.k0 AND f.k0 + 4 AS in_first_n FROM :bars b JOIN n ON b.trade_date = n.trade_date JOIN f ON b.security_id = f.security_id"""))
def first_five(spark, sf_dir):
    return ao.within_first_sessions(*_frames(spark, sf_dir, "bars", "master", "calendar"))


_NO_CLOSE = "date_diff('day', DATE '1990-01-01', trade_date) % 11 <> 0"


@query("JN-11", duck(f"""WITH b AS (SELECT security_id, trade_date, close FROM :bars WHERE {_NO_CLOSE}), f AS (SELECT *, lag(ex_date) OVER (PARTITION BY security_id ORDER BY factor_no) AS before FROM :factors)
SELECT f.security_id, f.ex_date, CASE WHEN f.factor < 0 THEN 'NEGATIVE_FACTOR' WHEN f.ex_date < f.before THEN 'ORDER_BREAK' WHEN p.close IS NULL OR n.close IS NULL THEN 'MISSING_BAR' WHEN abs(p.close * f.factor / n.close - 1) <= 0.02 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM f ASOF LEFT JOIN b p ON f.security_id = p.security_id AND f.ex_date > p.trade_date ASOF LEFT JOIN b n ON f.security_id = n.security_id AND f.ex_date <= n.trade_date"""))
def adjusted_continuity(spark, sf_dir):
    factors, bars = _frames(spark, sf_dir, "factors", "bars")
    return ao.continuity(factors, bars.withColumn("close", F.when(F.expr("datediff(trade_date, DATE '1990-01-01') % 11 <> 0"), F.col("close"))))


@query("JN-12", duck("""WITH s AS (SELECT trade_date, lag(trade_date) OVER (ORDER BY trade_date) AS p, lead(trade_date) OVER (ORDER BY trade_date) AS n FROM :calendar), e AS (SELECT security_id, ex_date, 'DIVIDEND' AS event_type FROM :dividends UNION ALL SELECT security_id, ex_date, 'RIGHT_ISSUE' FROM :rights),
f AS (SELECT security_id, ex_date, max(factor) AS factor FROM :action_factors GROUP BY ALL),
x AS (SELECT c.*, s.p, s.n, b0.close AS c0, b1.close AS c1, b2.close AS c2, f.factor, coalesce(g.factor, 1) AS old, EXISTS (SELECT 1 FROM :status t WHERE t.security_id = c.security_id AND t.trade_date = c.trade_date AND t.IS_SUSP_SEC = '1') AS still,
  EXISTS (SELECT 1 FROM e WHERE e.security_id = c.security_id) AS has_event, EXISTS (SELECT 1 FROM e WHERE e.security_id = c.security_id AND e.ex_date = c.trade_date) AS has_date, EXISTS (SELECT 1 FROM e WHERE e.security_id = c.security_id AND e.ex_date = c.trade_date AND e.event_type = c.event_type) AS has_type
  FROM :action_cases c LEFT JOIN s ON c.trade_date = s.trade_date LEFT JOIN :bars b0 ON b0.security_id = c.security_id AND b0.trade_date = s.p LEFT JOIN :bars b1 ON b1.security_id = c.security_id AND b1.trade_date = c.trade_date LEFT JOIN :bars b2 ON b2.security_id = c.security_id AND b2.trade_date = s.n
  LEFT JOIN f ON f.security_id = c.security_id AND f.ex_date = c.trade_date ASOF LEFT JOIN f g ON g.security_id = c.security_id AND g.ex_date < c.trade_date)
SELECT case_id, CASE WHEN p IS NULL AND n IS NULL THEN 'CALENDAR_MISSING_EVENT_DAY' WHEN p IS NULL OR n IS NULL THEN 'CALENDAR_WINDOW_EDGE' WHEN c0 IS NULL OR c1 IS NULL OR c2 IS NULL THEN CASE WHEN still THEN 'SUSPENSION_AT_EVENT' ELSE 'KLINE_CONTEXT_MISSING' END
  WHEN event_type IS NULL THEN 'EVENT_TYPE_UNRESOLVED' WHEN NOT has_event THEN 'EVENT_SOURCE_MISSING' WHEN NOT has_date THEN 'EVENT_DATE_MISMATCH' WHEN NOT has_type THEN 'EVENT_TYPE_MISMATCH' WHEN factor IS NULL THEN 'ADJ_EVENT_DATE_MISSING' WHEN factor <= 0 THEN 'ADJ_FACTOR_INVALID'
  WHEN factor = old THEN 'ADJ_NO_TRANSITION' WHEN abs((c1 * factor) / (c0 * old) - 1) > 0.35 THEN 'ADJ_CONTINUITY_BROKEN' WHEN factor <> 1 AND abs((c1 / c0 - 1) - ((c1 * factor) / (c0 * old) - 1)) < 1e-12 THEN 'RAW_DISCONTINUITY_UNEXPLAINED' ELSE 'PASS' END AS reason FROM x"""))
def action_context(spark, sf_dir):
    cases, calendar, bars, dividends, rights, factors, status = _frames(spark, sf_dir, "action_cases", "calendar", "bars", "dividends", "rights", "action_factors", "status")
    events = dividends.withColumn("event_type", F.lit("DIVIDEND")).unionByName(rights.withColumn("event_type", F.lit("RIGHT_ISSUE")))
    return ao.corporate_actions(cases, calendar, bars, events, factors, status.where("IS_SUSP_SEC = '1'"))


@query("JN-18", duck("""WITH e AS (SELECT security_id, min(trade_date) AS first_bar FROM :bars GROUP BY security_id)
SELECT m.security_id, e.first_bar, c.trade_date AS first_session, CASE WHEN e.first_bar IS NULL THEN 'NO_BARS' WHEN e.first_bar <= c.trade_date THEN 'PASS' ELSE 'LATE' END AS verdict
FROM (SELECT security_id, greatest(list_date, DATE '1993-01-01') AS bound FROM :master) m ASOF LEFT JOIN :calendar c ON m.bound <= c.trade_date LEFT JOIN e ON m.security_id = e.security_id"""))
def coverage(spark, sf_dir):
    return ao.history_coverage(*_frames(spark, sf_dir, "master", "bars", "calendar"), F.lit("1993-01-01").cast("date"))
