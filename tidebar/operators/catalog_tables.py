"""The catalog's aggregations, windows, sorts, sets and table-level operators."""

from __future__ import annotations

from .catalog import op

# ---- aggregations -----------------------------------------------------------

op("AG-16", "Unit inference: the share of rows whose amount / volume is near the close; nothing checked never passes.", """
SELECT count(*) AS checked, count_if(abs(amount / volume - close) / close <= 0.15) AS near, CASE WHEN count(*) = 0 OR count_if(abs(amount / volume - close) / close <= 0.15) < 0.9 * count(*) THEN 'UNDETERMINED' ELSE 'SHARES_CNY' END AS unit
FROM :bars WHERE amount IS NOT NULL AND volume > 0 AND close > 0""")
op("AG-17", "Earliest bar of each security.", "SELECT security_id, min(trade_date) AS first_bar FROM :bars GROUP BY security_id")
op("AG-18", "Blocking quality flags by table: rows of each flag that blocks.", lambda d: f"""
SELECT table_name, flag, count(*) AS n FROM (SELECT table_name, trim(flag) AS flag FROM (SELECT table_name, {d.words('quality_flags')} AS flag FROM :flagged) x) y
WHERE flag IN ('MISSING_IDENTITY', 'SOURCE_CONFLICT', 'DUPLICATE_KEY', 'FUTURE_ROW', 'BAD_OHLC') GROUP BY table_name, flag""")
op("AG-21", "Manifest hash of a set of components, by identity.", lambda d: f"SELECT publish_id, {d.sha(d.joined('component'))} AS manifest_hash, count(*) AS n FROM :components GROUP BY publish_id")
op("AG-23", "Structural event statistics: distinct ST events, delists and ids of each class.", "SELECT event_class, count(*) AS n, count(DISTINCT concat_ws('|', symbol, date_text, subtype)) AS distinct_events, count(DISTINCT symbol) AS distinct_symbols FROM :market_events GROUP BY event_class")
op("AG-24", "Manifest statistics: cases by type and review status, with totals of each type.", "SELECT case_type, review_status, count(*) AS n FROM :cases GROUP BY GROUPING SETS ((case_type, review_status), (case_type), ())")
op("AG-26", "Event distribution by subtype, class and year in one pass.", "SELECT subtype, event_class, substr(date_text, 1, 4) AS event_year, count(*) AS n FROM :market_events GROUP BY GROUPING SETS ((subtype), (event_class), (substr(date_text, 1, 4)))")
op("AG-27", "Artifact groups: cases by reference and kind, numbered, with their ids.", lambda d: f"SELECT case_type, review_status, {d.joined(d.text('case_id'))} AS case_ids, row_number() OVER (ORDER BY case_type, review_status) AS group_no FROM (SELECT case_type || '-' || CAST(CAST(floor(case_id / 200) AS BIGINT) AS STRING) AS case_type, review_status, case_id FROM :cases) q GROUP BY case_type, review_status")
op("AG-28", "Capability verdict: absent is missing, a failure fails, each required type needs its minimum.", """
SELECT m.capability, CASE WHEN count(c.case_id) = 0 THEN 'MISSING' WHEN count(*) FILTER (WHERE c.result = 'FAIL') > 0 THEN 'FAILED' WHEN count(*) FILTER (WHERE c.result = 'PASS') < max(m.minimum) THEN 'INSUFFICIENT' ELSE 'PASSED' END AS verdict
FROM :minima m LEFT JOIN :cases c ON m.case_type = c.case_type GROUP BY m.capability""")
op("AG-29", "Overall verdict: incomplete, then no go, then degraded, then core.", "SELECT CASE WHEN bool_or(verdict = 'MISSING') THEN 'INCOMPLETE' WHEN bool_or(verdict = 'FAILED') THEN 'NO_GO' WHEN bool_or(verdict = 'INSUFFICIENT') THEN 'GO_DEGRADED' ELSE 'GO_CORE' END AS overall FROM :verdicts")
op("AG-30", "Daily capacity with totals: requests, failures and their rate, bytes.", "SELECT log_date, count(*) AS requests, sum(row_count) AS row_total, count(*) FILTER (WHERE failed) AS failures, round(count(*) FILTER (WHERE failed) / count(*), 6) AS failure_rate FROM :request_log GROUP BY ROLLUP (log_date)")
op("AG-31", "Field profile: rows, nulls and bad dates of each field.", lambda d: f"""
SELECT field, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS nulls, count(*) FILTER (WHERE value IS NOT NULL AND field = 'raw_date' AND {d.date('value')} IS NULL) AS bad_dates
FROM (SELECT 'raw_date' AS field, raw_date AS value FROM :vendor UNION ALL SELECT 'raw_price', raw_price FROM :vendor UNION ALL SELECT 'raw_extra', raw_extra FROM :vendor) q GROUP BY field""")
op("AG-32", "Evidence rollup: unresolved or mixed classes leave a month unresolved; the state is the worst one.", "SELECT month, CASE WHEN bool_or(evidence = 'UNRESOLVED') OR count(DISTINCT evidence) > 1 THEN 'UNRESOLVED' ELSE max(evidence) END AS evidence, max(state_rank) AS worst FROM :coverage GROUP BY month")
op("AG-33", "Partition inventory: months by route, empty ones kept.", """
SELECT s.month, s.route, count(p.security_id) AS n, min(p.trade_date) AS first_day, max(p.trade_date) AS last_day FROM (SELECT m.month, r.route FROM (SELECT DISTINCT month FROM :routed) m CROSS JOIN (SELECT DISTINCT route FROM :routed) r) s
LEFT JOIN :routed p ON s.month = p.month AND s.route = p.route GROUP BY s.month, s.route""")
op("AG-34", "Exclusion reasons with counts.", "SELECT coalesce(reason, 'NONE') AS reason, count(*) AS n FROM :panel GROUP BY coalesce(reason, 'NONE')")
op("AG-39", "Seal checks of a table: rows, distinct keys, nulls.", "SELECT count(*) AS n, count(DISTINCT concat_ws('|', security_id, CAST(trade_date AS STRING))) AS distinct_keys, count(DISTINCT concat_ws('|', security_id, CAST(trade_date AS STRING))) = count(*) AS is_sealed FROM :bars")
op("AG-40", "Run status from findings: one blocking finding blocks, with the classes.", lambda d: f"SELECT run_id, CASE WHEN bool_or(is_blocking) THEN 'BLOCKED' ELSE 'SUCCESS' END AS run_status, {d.joined_set('finding_class')} AS classes FROM :run_findings GROUP BY run_id")
op("AG-41", "Required domains: missing before damaged before unavailable at the cutoff.", """
SELECT m.domain, CASE WHEN count(r.security_id) = 0 THEN 'MISSING' WHEN count(*) FILTER (WHERE r.damaged) > 0 THEN 'DAMAGED' WHEN count(*) FILTER (WHERE r.received_on <= DATE '1995-06-01') = 0 THEN 'UNAVAILABLE' ELSE 'OK' END AS finding
FROM :domain_matrix m LEFT JOIN :domain_rows r ON m.domain = r.domain WHERE m.eligibility = 'SUPPORTED' GROUP BY m.domain""")
op("AG-42", "Rows without identity by domain; any is blocking.", "SELECT domain, count(*) FILTER (WHERE security_id IS NULL) AS missing, count(*) FILTER (WHERE security_id IS NULL) > 0 AS is_blocking FROM :domain_rows GROUP BY domain")
op("AG-43", "Case statistics: type by result.", "SELECT case_type, count(*) FILTER (WHERE result = 'PASS') AS pass_count, count(*) FILTER (WHERE result = 'FAIL') AS fail_count, count(*) FILTER (WHERE result = 'SKIP') AS skip_count FROM :cases GROUP BY case_type")
op("AG-44", "Month boundary: market cutoff and newest receipt, both within the cutoff.", lambda d: f"SELECT CAST(year(trade_date) * 100 + month(trade_date) AS INT) AS month, {d.shanghai('max(trade_date)', '15:00:00')} AS market_as_of, max(available_on) AS source_vintage, max(trade_date) <= DATE '1998-06-01' AND max(available_on) <= DATE '1998-06-01' AS within_cutoff FROM :bars GROUP BY CAST(year(trade_date) * 100 + month(trade_date) AS INT)")
op("AG-45", "Capability coverage: case types that are covered and missing, passes and failures.", lambda d: f"""
SELECT capability, count(*) FILTER (WHERE n > 0) AS covered, count(*) FILTER (WHERE n = 0) AS missing, sum(passes) AS passes, sum(fails) AS fails FROM (SELECT m.capability, m.case_type, count(c.case_id) AS n, count(*) FILTER (WHERE c.result = 'PASS') AS passes, count(*) FILTER (WHERE c.result = 'FAIL') AS fails
  FROM :minima m LEFT JOIN :cases c ON m.case_type = c.case_type GROUP BY m.capability, m.case_type) q GROUP BY capability""")

# ---- windows ----------------------------------------------------------------

op("WN-21", "Source selection: the first by provider priority, manifest and ordinal wins; equal payloads merge, others conflict.", """
SELECT security_id, trade_date, provider, ordinal, CASE WHEN k = 1 THEN 'SELECTED' WHEN payload IS NOT DISTINCT FROM winner THEN 'EQUIVALENT_MERGED' ELSE 'SOURCE_CONFLICT' END AS decision FROM (
  SELECT *, row_number() OVER (PARTITION BY security_id, trade_date ORDER BY priority, manifest_hash, ordinal) AS k, first_value(payload) OVER (PARTITION BY security_id, trade_date ORDER BY priority, manifest_hash, ordinal) AS winner FROM :candidates WHERE identity_status <> 'MISSING') q""")
op("WN-22", "Duplicate keys inside a run: each further row.", "SELECT run_id, security_id, trade_date, k FROM (SELECT run_id, security_id, trade_date, row_number() OVER (PARTITION BY run_id, security_id, trade_date ORDER BY ordinal) AS k FROM :candidates) q WHERE k > 1")
op("WN-23", "Overlapping intervals of an id; an open one reaches on.", "SELECT security_id, symbol, valid_from, valid_to, before_to IS NULL AND k > 1 OR before_to > valid_from AS is_overlap FROM (SELECT *, lag(valid_to) OVER (PARTITION BY security_id ORDER BY valid_from) AS before_to, row_number() OVER (PARTITION BY security_id ORDER BY valid_from) AS k FROM :identity) q")
op("WN-24", "Strict order: keys that do not follow the one before.", "SELECT security_id, trade_date FROM (SELECT security_id, trade_date, lag(trade_date) OVER (PARTITION BY security_id ORDER BY trade_date) AS before FROM :bars_dup) q WHERE before >= trade_date")
op("WN-25", "Session number with its neighbours.", "SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS session_no, lag(trade_date) OVER (ORDER BY trade_date) AS before_day, lead(trade_date) OVER (ORDER BY trade_date) AS after_day FROM :calendar")
op("WN-26", "Events out of order: arrival order against event time, for each feed.", "SELECT user_id, count(*) FILTER (WHERE ts < before) AS out_of_order, count(*) AS n FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM :events) q GROUP BY user_id")
op("WN-27", "Ex-date order breaks in arrival order.", "SELECT security_id, ex_date, before AS before_date FROM (SELECT security_id, ex_date, lag(ex_date) OVER (PARTITION BY security_id ORDER BY factor_no) AS before FROM :factors) q WHERE ex_date < before")

# ---- sorts and top-k --------------------------------------------------------

op("SO-01", "Canonical order of a table.", "SELECT security_id, trade_date, row_number() OVER (PARTITION BY security_id ORDER BY trade_date) AS place FROM :bars")
op("SO-03", "The last five sessions up to a date.", "SELECT trade_date FROM :calendar WHERE trade_date <= DATE '1997-03-01' ORDER BY trade_date DESC LIMIT 5")
op("SO-04", "Latest published row of each trade date.", "SELECT trade_date, max_by(publish_id, version) AS publish_id, max(version) AS version FROM :publish_log WHERE state = 'PUBLISHED' GROUP BY trade_date")
op("SO-05", "First violations of each check, as text.", lambda d: f"SELECT verdict, {d.joined('case_text')} AS first_cases FROM (SELECT verdict, case_text, row_number() OVER (PARTITION BY verdict ORDER BY case_text) AS k FROM :violations) q WHERE k <= 3 GROUP BY verdict")
op("SO-06", "Month order by date, then id.", "SELECT security_id, trade_date, row_number() OVER (PARTITION BY year(trade_date) * 100 + month(trade_date) ORDER BY trade_date, security_id) AS place FROM :bars")

# ---- sets and completeness --------------------------------------------------

APPLICABLE = "applicable AS (SELECT u.security_id, u.trade_date FROM :universe u LEFT JOIN :master m ON u.security_id = m.security_id WHERE (m.list_date IS NULL OR u.trade_date >= m.list_date) AND (m.delist_date IS NULL OR u.trade_date < m.delist_date))"
CLASSED = APPLICABLE + """, classed AS (SELECT a.security_id, a.trade_date, CASE WHEN s.IS_SUSP_SEC = '1' THEN 'suspended' WHEN s.IS_SUSP_SEC = '0' THEN 'required' WHEN v.security_id IS NOT NULL THEN 'suspended' ELSE 'unresolved' END AS class FROM applicable a
  LEFT JOIN :status_part s ON a.security_id = s.security_id AND a.trade_date = s.trade_date LEFT JOIN :suspensions v ON a.security_id = v.security_id AND a.trade_date >= v.suspended_from AND a.trade_date < v.resumes_on)"""
op("ST-01", "Applicable pairs: from the listing on, before the delisting.", f"WITH {APPLICABLE} SELECT security_id, trade_date FROM applicable")
op("ST-02", "Status partition: suspended, required or unresolved.", f"WITH {APPLICABLE} SELECT a.security_id, a.trade_date, CASE s.IS_SUSP_SEC WHEN '1' THEN 'suspended' WHEN '0' THEN 'required' ELSE 'unresolved' END AS class FROM applicable a LEFT JOIN :status_part s ON a.security_id = s.security_id AND a.trade_date = s.trade_date")
op("ST-03", "An approved suspension resolves its own unresolved pairs only.", f"WITH {CLASSED} SELECT security_id, trade_date, class FROM classed")
op("ST-04", "Positive trades: an unresolved pair with trades is required.", f"WITH {CLASSED} SELECT c.security_id, c.trade_date, CASE WHEN c.class = 'unresolved' AND max(coalesce(t.num_trades, 0)) > 0 THEN 'required' ELSE c.class END AS class FROM classed c LEFT JOIN :trades t ON c.security_id = t.security_id AND c.trade_date = t.trade_date GROUP BY c.security_id, c.trade_date, c.class")
op("ST-05", "Status outside the scope that exactly one code change explains.", f"WITH {APPLICABLE} SELECT s.security_id, s.trade_date, count(x.security_id) = 1 AS is_exempt FROM (SELECT p.security_id, p.trade_date FROM :status_part p WHERE NOT EXISTS (SELECT 1 FROM applicable a WHERE a.security_id = p.security_id AND a.trade_date = p.trade_date)) s LEFT JOIN :code_changes x ON s.security_id = x.security_id AND s.trade_date >= x.effective GROUP BY s.security_id, s.trade_date")
REQUIRED = CLASSED + ", required AS (SELECT security_id, trade_date FROM classed WHERE class = 'required')"
op("ST-06", "Missing and extra pairs.", f"WITH {REQUIRED} SELECT 'missing' AS side, security_id, trade_date FROM (SELECT security_id, trade_date FROM required EXCEPT SELECT security_id, trade_date FROM :returned) a UNION ALL SELECT 'extra', security_id, trade_date FROM (SELECT security_id, trade_date FROM :returned EXCEPT SELECT security_id, trade_date FROM required) b")
op("ST-07", "Pairs that do not apply: symbols by sessions, less the applicable ones.", f"WITH {APPLICABLE} SELECT g.security_id, count(*) AS n FROM (SELECT m.security_id, c.trade_date FROM :master m CROSS JOIN :sessions c) g WHERE NOT EXISTS (SELECT 1 FROM applicable a WHERE a.security_id = g.security_id AND a.trade_date = g.trade_date) GROUP BY g.security_id")
#: Required and returned pairs meet once; each class is a count over that one pass.
_PAIRS = CLASSED + """, pairs AS (SELECT c.class, r.security_id IS NOT NULL AS is_returned FROM classed c FULL OUTER JOIN :returned r ON c.security_id = r.security_id AND c.trade_date = r.trade_date),
totals AS (SELECT count(*) FILTER (WHERE class = 'suspended') AS suspended, count(*) FILTER (WHERE class = 'required') AS required, count(*) FILTER (WHERE class = 'unresolved') AS unresolved,
  count(*) FILTER (WHERE class = 'required' AND NOT is_returned) AS missing, count(*) FILTER (WHERE is_returned AND class IS DISTINCT FROM 'required') AS extra FROM pairs)"""
op("ST-08", "Counts of every class, zeros kept, with the verdict.", f"""WITH {_PAIRS}
SELECT s.class, CASE s.class WHEN 'suspended' THEN t.suspended WHEN 'required' THEN t.required WHEN 'unresolved' THEN t.unresolved WHEN 'missing' THEN t.missing ELSE t.extra END AS n,
  CASE WHEN t.missing + t.extra + t.unresolved = 0 THEN 'PASS' ELSE 'FAIL_CLOSED' END AS verdict FROM :classes s CROSS JOIN totals t""")
op("ST-09", "Returned bars: code equals member, finite numbers, dates in scope and once.", "SELECT member_key, trade_date, CASE WHEN embedded_code <> member_key THEN 'CODE' WHEN close IS NULL OR isnan(close) OR abs(close) = CAST('Infinity' AS DOUBLE) THEN 'NUMBER' WHEN trade_date NOT BETWEEN DATE '1992-01-01' AND DATE '1998-12-31' THEN 'SCOPE' WHEN count(*) OVER (PARTITION BY member_key, trade_date) > 1 THEN 'DUPLICATE' ELSE 'VALID' END AS verdict FROM :members")
op("ST-10", "Status validity: a date that comes twice voids all rows of its member.", "SELECT security_id, count(*) AS n FROM (SELECT security_id, trade_date, max(n) OVER (PARTITION BY security_id) AS worst FROM (SELECT security_id, trade_date, count(*) OVER (PARTITION BY security_id, trade_date) AS n FROM :status_dup) a) b WHERE worst = 1 GROUP BY security_id")
op("ST-11", "Monthly spine of the split windows, with the rows of each month.", lambda d: f"SELECT s.split, s.y, s.m, count(r.security_id) AS n FROM (SELECT split, CAST(year(m) AS INT) AS y, CAST(month(m) AS INT) AS m FROM (SELECT split, {d.months('first_day', 'last_day')} AS m FROM :windows) q) s LEFT JOIN :routed r ON r.month = s.y * 100 + s.m GROUP BY s.split, s.y, s.m")
op("ST-12", "Coverage of each month: enabled rows and a descriptor, or a reason.", "SELECT s.month, CASE WHEN s.enabled = 0 THEN 'NO_ENABLED_ROWS' WHEN count(c.month) = 0 THEN 'NO_DESCRIPTOR' WHEN count(c.month) > 1 THEN 'DUPLICATE_DESCRIPTOR' ELSE 'OBSERVED' END AS coverage FROM (SELECT month, count(*) FILTER (WHERE route = 'enabled') AS enabled FROM :routed GROUP BY month) s LEFT JOIN :descriptors c ON s.month = c.month GROUP BY s.month, s.enabled")
op("ST-13", "Rows outside the chosen months are counted, not written.", "SELECT CASE WHEN c.month IS NULL THEN 'OUTSIDE' ELSE 'INSIDE' END AS scope, count(*) AS n FROM :routed r LEFT JOIN (SELECT DISTINCT month FROM :descriptors) c ON r.month = c.month GROUP BY CASE WHEN c.month IS NULL THEN 'OUTSIDE' ELSE 'INSIDE' END")
op("ST-15", "Input continuity: inputs of the prior run that the discovery lacks.", "SELECT id FROM :old_version o WHERE NOT EXISTS (SELECT 1 FROM :new_version n WHERE o.id = n.id)")
op("ST-16", "Version diff: dropped, added, changed and unchanged rows.", "SELECT CASE WHEN n.id IS NULL THEN 'DROPPED' WHEN o.id IS NULL THEN 'ADDED' WHEN o.payload IS DISTINCT FROM n.payload THEN 'CHANGED' ELSE 'UNCHANGED' END AS diff, count(*) AS n FROM :old_version o FULL OUTER JOIN :new_version n ON o.id = n.id GROUP BY CASE WHEN n.id IS NULL THEN 'DROPPED' WHEN o.id IS NULL THEN 'ADDED' WHEN o.payload IS DISTINCT FROM n.payload THEN 'CHANGED' ELSE 'UNCHANGED' END")
op("ST-17", "Symbols: parsed, rejected, and those that come twice.", lambda d: f"SELECT count(*) AS n, count(*) FILTER (WHERE {d.like('raw_code', '^[0-9]+$')}) AS bare, count(*) - count(DISTINCT raw_code) AS repeated FROM :vendor")
op("ST-18", "Exact comparison of a stored and a recomputed table, both ways.", "SELECT side, count(*) AS n FROM (SELECT 'stored_only' AS side, id FROM (SELECT id, payload FROM :old_version EXCEPT ALL SELECT id, payload FROM :new_version) a UNION ALL SELECT 'recomputed_only', id FROM (SELECT id, payload FROM :new_version EXCEPT ALL SELECT id, payload FROM :old_version) b) q GROUP BY side")
op("ST-19", "Surfaces: the datasets of each, once.", lambda d: f"SELECT surface, {d.joined_set('dataset')} AS datasets FROM :requests GROUP BY surface")
op("ST-20", "Intake: well-formed codes without repeats, days in the month and once.", lambda d: f"SELECT count(*) FILTER (WHERE NOT {d.like('symbol', '^[0-9][0-9][0-9][0-9][0-9][0-9][.](SH|SZ)$')}) AS bad_symbols, count(*) - count(DISTINCT symbol) AS repeated, count(*) AS n FROM :identity")

# ---- tables -----------------------------------------------------------------

op("TB-02", "Snapshot projection: typed rows that are unique, in time and well keyed.", "SELECT security_id, trade_date, round(close, 6) AS close, volume FROM (SELECT *, count(*) OVER (PARTITION BY security_id, trade_date) AS n FROM :bars_dup) q WHERE n = 1 AND available_on <= DATE '1998-06-01' AND close IS NOT NULL")
op("TB-07", "Replay: the same identity is a no-op, another content an error.", "SELECT n.id, CASE WHEN o.id IS NULL THEN 'NEW' WHEN o.payload IS NOT DISTINCT FROM n.payload THEN 'NO_OP' ELSE 'ERROR' END AS outcome FROM :new_version n LEFT JOIN :old_version o ON n.id = o.id")
op("TB-08", "Run identity: a hash of all input hashes and versions. Each security's rows are hashed first, so no list is longer than a security's rows or the securities.", lambda d: f"""
SELECT run_id, {d.sha(d.joined('part'))} AS run_identity FROM (SELECT run_id, coalesce(security_id, '') || ':' || manifest_hash || ':' || {d.sha(d.joined('version'))} AS part
  FROM (SELECT run_id, security_id, manifest_hash, {d.text('ordinal')} || '/' || coalesce({d.text('payload')}, '') AS version FROM :candidates) q GROUP BY run_id, security_id, manifest_hash) p GROUP BY run_id""")
op("TB-09", "Closed months: earlier than the current one may not change; the open month gets a revision.", "SELECT n.month, CASE WHEN o.month IS NULL THEN 'CREATE' WHEN o.content = n.content THEN 'NO_OP' WHEN n.month < 199806 THEN 'ERROR_CLOSED' ELSE 'NEW_REVISION' END AS outcome FROM :month_new n LEFT JOIN :month_old o ON n.month = o.month")
op("TB-11", "Files of any publish, superseded ones too.", "SELECT p.publish_id, p.trade_date, count(c.component) AS files FROM :publish_log p LEFT JOIN :components c ON p.publish_id = c.publish_id GROUP BY p.publish_id, p.trade_date")
op("TB-13", "Universe activation: the same rule hash is a no-op, another is rejected.", "SELECT n.id, CASE WHEN o.id IS NULL THEN 'ACTIVATED' WHEN o.payload = n.payload THEN 'NO_OP' ELSE 'REJECTED' END AS outcome FROM :new_version n LEFT JOIN :old_version o ON n.id = o.id")
op("TB-14", "Definition hash of a set from its ordered members.", lambda d: f"SELECT CAST(floor(case_id / 50) AS BIGINT) AS set_id, {d.sha(d.joined(d.text('case_id')))} AS definition_hash FROM :cases GROUP BY CAST(floor(case_id / 50) AS BIGINT)")
op("TB-17", "Validity of stored feature rows: keys, hashes, finite or null values, in time.", lambda d: "SELECT violation, count(*) AS n FROM (SELECT " + d.each("CASE WHEN n > 1 THEN 'DUPLICATE_KEY' END", "CASE WHEN isnan(pre_close) OR abs(pre_close) = CAST('Infinity' AS DOUBLE) THEN 'NON_FINITE' END", "CASE WHEN available_on > DATE '1998-06-01' THEN 'FUTURE' END", "CASE WHEN length(security_id) <> 7 THEN 'BAD_ID' END") + " AS violation FROM (SELECT *, count(*) OVER (PARTITION BY security_id, trade_date) AS n FROM :bars_dup) q) v WHERE violation IS NOT NULL GROUP BY violation")
op("TB-18", "Validity of stored state rows: known values, strict date order, evidence that agrees.", lambda d: "SELECT violation, count(*) AS n FROM (SELECT " + d.each("CASE WHEN state NOT IN ('POSITIVE_CENTER', 'NEGATIVE_CENTER', 'MIXED_CENTER', 'UNKNOWN') THEN 'UNKNOWN_VALUE' END", "CASE WHEN before >= trade_date THEN 'ORDER' END", "CASE WHEN adv + dec > n THEN 'EVIDENCE' END") + " AS violation FROM (SELECT *, lag(trade_date) OVER (PARTITION BY state ORDER BY trade_date) AS before FROM :stored_states) q) v WHERE violation IS NOT NULL GROUP BY violation")

# ---- scans ------------------------------------------------------------------

op("SRC-04", "A scalar list as one value column.", lambda d: f"SELECT row_id, {d.words('raw_flags')} AS value FROM :vendor")
op("SRC-06", "Validity report of the rule dimension.", lambda d: "SELECT violation, count(*) AS n FROM (SELECT " + d.each("CASE WHEN n > 1 THEN 'DUPLICATE_ID' END", "CASE WHEN effective_from > effective_to THEN 'WINDOW' END", "CASE WHEN up_rate NOT BETWEEN 0 AND 1 THEN 'RATE' END", "CASE WHEN age_rule NOT IN ('NONE', 'FIRST_5', 'IPO_DAY') THEN 'ENUM' END") + " AS violation FROM (SELECT *, count(*) OVER (PARTITION BY rule_id) AS n FROM :security_rules) q) v WHERE violation IS NOT NULL GROUP BY violation")
op("SRC-10", "Logical snapshot: one month for each source run, repeats rejected.", "SELECT run_id, month, CASE WHEN count(*) OVER (PARTITION BY run_id) > 1 THEN 'REPEATED_RUN' WHEN count(*) OVER (PARTITION BY month) > 1 THEN 'REPEATED_MONTH' ELSE 'OK' END AS verdict FROM :month_runs")
op("SRC-22", "Canonical projection: selected rows of the run with the partitions as one stream.", "SELECT security_id, trade_date, 'run' AS origin FROM :candidates WHERE provider = 'vendor_a' AND identity_status <> 'MISSING' UNION ALL SELECT security_id, trade_date, 'partition' FROM :bars WHERE year(trade_date) = 1995")
