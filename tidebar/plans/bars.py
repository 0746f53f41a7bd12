"""Queries on features, market breadth and states (WN, AG-01..15, RS)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import market as mk
from ..sources.derived import BARS_SQL, bars
from . import json_sql as js
from .base import query

R = 6  # decimals of compared values


def shown(name: str) -> str:
    """A compared value in SQL. Means of prices often end in a decimal five, so they are cut in binary."""
    return f"CAST(CAST({name} AS FLOAT) AS DOUBLE)" if name.startswith("ma_close") else f"round({name}, {R})"


_VALID = "({0} IS NOT NULL AND NOT isnan({0}) AND NOT isinf({0}))"


def _ratio(name: str, num: str, den: str) -> str:
    value = f"({num} / nullif({den}, 0) - 1)"
    why = (
        f"CASE WHEN NOT {_VALID.format(den)} OR {den} <= 0 THEN 'UNSAFE_DENOMINATOR' WHEN {num} IS NULL THEN 'INPUT_NULL' "
        f"WHEN NOT {_VALID.format(value)} THEN 'NON_FINITE_RESULT' END"
    )
    return f"CASE WHEN {why} IS NULL THEN {value} END AS {name}, {why} AS {name}_reason"


_W = "PARTITION BY security_id ORDER BY trade_date"
_AMP = (
    f"CASE WHEN NOT {_VALID.format('pre_close')} OR pre_close <= 0 THEN 'UNSAFE_DENOMINATOR' WHEN high IS NULL OR low IS NULL THEN 'INPUT_NULL' END"
)
FEATURES_SQL = BARS_SQL + f""",
f1 AS (SELECT *, row_number() OVER ({_W}) AS i,
    {_ratio('raw_return_1', 'close', 'pre_close')}, {_ratio('gap_open_raw', 'open', 'pre_close')}, {_ratio('intraday_return_raw', 'close', 'open')},
    CASE WHEN {_AMP} IS NULL THEN (high - low) / pre_close END AS amplitude_preclose_raw, {_AMP} AS amplitude_preclose_raw_reason,
    {', '.join(f"CASE WHEN count(*) OVER ({_W} ROWS {n - 1} PRECEDING) = {n} AND count(close) OVER ({_W} ROWS {n - 1} PRECEDING) = {n} THEN avg(close) OVER ({_W} ROWS {n - 1} PRECEDING) END AS ma_close_obs_{n}" for n in ft.WINDOWS)},
    {', '.join(f"CASE WHEN count(*) OVER ({_W} ROWS {n - 1} PRECEDING) < {n} THEN 'INSUFFICIENT_HISTORY' WHEN count(close) OVER ({_W} ROWS {n - 1} PRECEDING) < {n} THEN 'INPUT_NULL' END AS ma_close_obs_{n}_reason" for n in ft.WINDOWS)},
    {', '.join(f"lag(close, {n}) OVER ({_W}) AS lag_{n}" for n in ft.WINDOWS)}
  FROM bars),
f2 AS (SELECT *, {', '.join(f"close / ma_close_obs_{n} - 1 AS close_to_ma_obs_{n}, ma_close_obs_{n}_reason AS close_to_ma_obs_{n}_reason" for n in ft.WINDOWS)},
    {', '.join(f"close / lag_{n} - 1 AS return_lag_obs_{n}, CASE WHEN lag_{n} IS NULL THEN 'INSUFFICIENT_HISTORY' END AS return_lag_obs_{n}_reason" for n in ft.WINDOWS)},
    amount IS NOT NULL AS av, raw_return_1 IS NOT NULL AS rv FROM f1),
f3 AS (SELECT *,
    CASE WHEN av THEN count(*) OVER va END AS ak0, CASE WHEN av THEN min(i) OVER va END AS as0, CASE WHEN av THEN avg(amount) OVER va END AS am,
    CASE WHEN av THEN max(available_on) OVER va END AS at0, CASE WHEN av THEN list(i) OVER va END AS la0,
    CASE WHEN rv THEN count(*) OVER vr END AS rk0, CASE WHEN rv THEN min(i) OVER vr END AS rs0, CASE WHEN rv THEN stddev_pop(raw_return_1) OVER vr END AS rm0,
    CASE WHEN rv THEN max(available_on) OVER vr END AS rt0, CASE WHEN rv THEN list(i) OVER vr END AS lr0
  FROM f2 WINDOW va AS (PARTITION BY security_id, av ORDER BY trade_date ROWS 19 PRECEDING), vr AS (PARTITION BY security_id, rv ORDER BY trade_date ROWS 19 PRECEDING)),
f4 AS (SELECT *, {', '.join(f"last_value({x}0 IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS c_{x}" for x in ('ak', 'as', 'at', 'la', 'rk', 'rs', 'rm', 'rt', 'lr'))},
    count(CASE WHEN rv THEN 1 END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS n_r,
    list(i) OVER ({_W} ROWS 60 PRECEDING) AS near, max(available_on) OVER ({_W} ROWS 60 PRECEDING) AS near_t FROM f3),
features AS (SELECT *,
    CASE WHEN av AND c_ak >= 20 AND am > 0 THEN amount / am END AS amount_to_mean_obs_20,
    CASE WHEN amount IS NULL THEN 'INPUT_NULL' WHEN coalesce(c_ak, 0) < 20 THEN 'INSUFFICIENT_HISTORY' WHEN am <= 0 THEN 'UNSAFE_DENOMINATOR' END AS amount_to_mean_obs_20_reason,
    CASE WHEN c_rk >= 20 THEN c_rm END AS vol_raw_return_obs_20, CASE WHEN coalesce(c_rk, 0) < 20 THEN 'INSUFFICIENT_HISTORY' END AS vol_raw_return_obs_20_reason,
    CAST(CASE WHEN c_ak >= 20 THEN i - c_as + 1 - 20 ELSE 0 END AS BIGINT) AS amount_skipped,
    CAST(CASE WHEN c_rk >= 20 THEN i - c_rs + 1 - 20 ELSE i - n_r END AS BIGINT) AS vol_skipped,
    list_sort(list_distinct(list_concat(near, coalesce(c_la, []), coalesce(c_lr, [])))) AS members,
    greatest(near_t, c_at, c_rt) AS feature_available_on FROM f4),
members AS (SELECT security_id, i, sha256('["' || security_id || '","' || strftime(trade_date, '%Y-%m-%d') || '"]|' || sha256({js.BARS_ROW}) || '|' || strftime(available_on, '%Y-%m-%d')) AS h FROM f1),
numbers AS (SELECT security_id, i, {', '.join(f"{x} AS h{k}" for k, x in enumerate(js.lanes("h")))} FROM members),
digests AS (SELECT f.security_id, f.i, count(*) AS lineage_size, sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {', '.join(f"CAST(sum(n.h{k}) AS VARCHAR)" for k in range(4))})) AS input_lineage_hash
  FROM (SELECT security_id, i, unnest(members) AS m FROM features) f JOIN numbers n ON f.security_id = n.security_id AND f.m = n.i GROUP BY f.security_id, f.i),
lineage AS (SELECT f.*, d.lineage_size, d.input_lineage_hash FROM features f JOIN digests d ON f.security_id = d.security_id AND f.i = d.i)"""

#: What the test tables' feature run stands on.
RUN = ft.Run("snapshot-star-1", "canonical-star-1")

KEY = ["security_id", "trade_date"]


def _features(spark, sf_dir):
    return ft.security_features(bars(spark, sf_dir))


def _one(name, spark, sf_dir):
    """One feature; Catalyst drops the windows that it doesn't need."""
    return _features(spark, sf_dir).select(*KEY, F.expr(shown(name)).alias(name), F.col(name + "_reason").alias("reason"))


for _k, _name in enumerate(ft.VALUES, 1):
    query(f"WN-{_k:02d}", f"WITH {FEATURES_SQL} SELECT security_id, trade_date, {shown(_name)} AS {_name}, {_name}_reason AS reason FROM features")(partial(_one, _name))


@query("WN-16", f"WITH {FEATURES_SQL} SELECT security_id, trade_date, amount_skipped, vol_skipped FROM features WHERE amount_skipped > 0 OR vol_skipped > 0")
def skipped(spark, sf_dir):
    return _features(spark, sf_dir).where("amount_skipped > 0 or vol_skipped > 0").select(*KEY, "amount_skipped", "vol_skipped")


@query("WN-17", f"WITH {FEATURES_SQL} SELECT security_id, trade_date, lineage_size, input_lineage_hash FROM lineage")
def lineage_set(spark, sf_dir):
    return _features(spark, sf_dir).select(*KEY, "lineage_size", "input_lineage_hash")


@query("WN-18", f"WITH {FEATURES_SQL} SELECT security_id, trade_date, feature_available_on FROM features")
def available(spark, sf_dir):
    return _features(spark, sf_dir).select(*KEY, "feature_available_on")


FINDINGS_SQL = FEATURES_SQL + ", findings AS (" + " UNION ALL ".join(
    [f"SELECT security_id, trade_date, '{v}' AS feature_name, {v}_reason AS finding_class, CAST(0 AS BIGINT) AS skipped FROM features WHERE {v}_reason IS NOT NULL" for v in ft.VALUES]
    + [f"SELECT security_id, trade_date, '{v}', 'OPTIONAL_INPUT_MISSING', {n} FROM features WHERE {n} > 0" for v, n in (("amount_to_mean_obs_20", "amount_skipped"), ("vol_raw_return_obs_20", "vol_skipped"))]
) + ")"


@query("WN-19", f"WITH {FINDINGS_SQL} SELECT * FROM findings")
def security_findings(spark, sf_dir):
    return ft.findings(_features(spark, sf_dir))


_WRONG = {"snapshot_id": ("snapshot-star-1", "close > 1950", "snapshot-star-0"), "canonical_run_id": ("canonical-star-1", "low < 950", "canonical-star-0")}


@query("WN-20", f"""WITH {BARS_SQL}, b AS (SELECT security_id, trade_date, available_on, open, close, low, security_id || '/' || CASE WHEN high > 2000 THEN 'x' ELSE strftime(trade_date, '%Y-%m-%d') END AS canonical_key FROM bars),
d AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE open > 1900),
k1 AS (SELECT security_id, trade_date FROM d GROUP BY ALL HAVING count(*) > 1), k2 AS (SELECT canonical_key FROM d GROUP BY ALL HAVING count(*) > 1)
SELECT d.security_id, d.trade_date, 'DUPLICATE_SECURITY_DATE' AS violation FROM d JOIN k1 ON d.security_id = k1.security_id AND d.trade_date = k1.trade_date
UNION ALL SELECT d.security_id, d.trade_date, 'DUPLICATE_CANONICAL_KEY' FROM d JOIN k2 ON d.canonical_key = k2.canonical_key
UNION ALL SELECT security_id, trade_date, 'AVAILABLE_AFTER_AS_OF' FROM d WHERE available_on > DATE '1998-06-01'
UNION ALL SELECT security_id, trade_date, 'FOREIGN_SNAPSHOT' FROM d WHERE close > 1950
UNION ALL SELECT security_id, trade_date, 'FOREIGN_CANONICAL_RUN' FROM d WHERE low < 950""")
def guards(spark, sf_dir):
    b = bars(spark, sf_dir)
    key = F.concat_ws("/", "security_id", F.when(F.col("high") > 2000, "x").otherwise(F.date_format("trade_date", "yyyy-MM-dd")))
    b = b.withColumns({"canonical_key": key, **{c: F.when(F.expr(odd), other).otherwise(own) for c, (own, odd, other) in _WRONG.items()}})
    return ft.guard(b.unionByName(b.where("open > 1900")), F.lit("1998-06-01").cast("date"), RUN)


_IDS = {
    "source_snapshot_id": RUN.snapshot_id, "source_canonical_run_id": RUN.canonical_run_id, "feature_run_id": RUN.feature_run_id,
    "feature_set_id": RUN.feature_set_id, "feature_contract_version": RUN.contract_version, "universe_rule_id": RUN.universe_rule_id,
}
_SECURITY = [*KEY, *list(_IDS)[:5], "feature_available_at", "input_lineage_hash"]
#: Stored columns as they are compared.
WIDE = [*_SECURITY, *[f"{shown(v)} AS {v}" for v in ft.VALUES]]


def ids_sql(*names: str) -> str:
    return ", ".join(f"'{_IDS[n]}' AS {n}" for n in names)


SECURITY_SQL = FEATURES_SQL + f", security_table AS (SELECT *, {ids_sql(*list(_IDS)[:5])}, feature_available_on AS feature_available_at FROM lineage)"


@query("WN-28", f"WITH {SECURITY_SQL} SELECT {', '.join(WIDE)} FROM security_table")
def wide(spark, sf_dir):
    return ft.security_table(_features(spark, sf_dir), RUN).selectExpr(*WIDE)


MARKET_SQL = FEATURES_SQL + """,
market0 AS (SELECT trade_date, count(*) AS observed_security_count, count(raw_return_1) AS valid_raw_return_count,
    count(*) FILTER (raw_return_1 > 0) AS advancer_count, count(*) FILTER (raw_return_1 < 0) AS decliner_count, count(*) FILTER (raw_return_1 = 0) AS unchanged_count,
    avg(raw_return_1) AS mean_raw_return_observed, median(raw_return_1) AS median_raw_return_observed, count(ma_close_obs_20) AS valid_ma20_count,
    count(*) FILTER (close_to_ma_obs_20 > 0) AS above_ma20_count, count(return_lag_obs_20) AS valid_mom20_count, count(*) FILTER (return_lag_obs_20 > 0) AS positive_mom20_count,
    sum(amount) AS total_amount_observed, count(amount) AS valid_amount_count, max(feature_available_on) AS feature_available_on,
    sha256(concat_ws('|', CAST(count(*) AS VARCHAR), """ + ", ".join(f"CAST(sum({x}) AS VARCHAR)" for x in js.lanes("sha256(security_id || '|' || input_lineage_hash)")) + """)) AS input_lineage_hash FROM lineage GROUP BY trade_date),
market AS (SELECT *, advancer_count / nullif(valid_raw_return_count, 0) AS advancer_ratio_observed, above_ma20_count / nullif(valid_ma20_count, 0) AS pct_above_ma20_observed,
    positive_mom20_count / nullif(valid_mom20_count, 0) AS pct_positive_mom20_observed FROM market0)"""


def _market(spark, sf_dir):
    return mk.breadth(_features(spark, sf_dir))


_ROUND = {"total_amount_observed": 2, "mean_raw_return_observed": R, "median_raw_return_observed": R, "advancer_ratio_observed": R, "pct_above_ma20_observed": R, "pct_positive_mom20_observed": R}


def _shown(name: str) -> str:
    return f"round({name}, {_ROUND[name]}) AS {name}" if name in _ROUND else name


def _market_one(name, spark, sf_dir):
    return _market(spark, sf_dir).selectExpr("trade_date", _shown(name))


for _k, _name in enumerate(mk.MARKET, 1):
    query(f"AG-{_k:02d}", f"WITH {MARKET_SQL} SELECT trade_date, {_shown(_name)} FROM market")(partial(_market_one, _name))


@query("AG-14", f"WITH {MARKET_SQL} SELECT trade_date, feature_available_on, input_lineage_hash FROM market")
def market_lineage(spark, sf_dir):
    return _market(spark, sf_dir).select("trade_date", "feature_available_on", "input_lineage_hash")


_RATIO_FINDINGS = [f"SELECT trade_date, '{n}' AS feature_name, 'UNSAFE_DENOMINATOR' AS finding_class, CAST(0 AS BIGINT) AS missing FROM market WHERE {b} = 0" for n, _, b in mk.RATIOS]
_RATIO_FINDINGS += [f"SELECT trade_date, '{n}', 'UNSAFE_DENOMINATOR', 0 FROM market WHERE valid_raw_return_count = 0" for n in ("mean_raw_return_observed", "median_raw_return_observed")]
_RATIO_FINDINGS.append("SELECT trade_date, 'total_amount_observed', 'OPTIONAL_INPUT_MISSING', observed_security_count - valid_amount_count FROM market WHERE observed_security_count > valid_amount_count")


@query("AG-15", f"WITH {MARKET_SQL} " + " UNION ALL ".join(_RATIO_FINDINGS))
def market_findings(spark, sf_dir):
    return mk.market_findings(_market(spark, sf_dir))


MARKET_WIDE = ["trade_date", "source_snapshot_id", "feature_run_id", "feature_set_id", "feature_available_at", "input_lineage_hash", "universe_rule_id", *map(_shown, mk.MARKET)]
MARKET_TABLE_SQL = MARKET_SQL + f", market_table AS (SELECT *, {ids_sql('source_snapshot_id', 'feature_run_id', 'feature_set_id', 'universe_rule_id')}, feature_available_on AS feature_available_at FROM market)"


@query("WN-29", f"WITH {MARKET_TABLE_SQL} SELECT {', '.join(MARKET_WIDE)} FROM market_table")
def market_wide(spark, sf_dir):
    return mk.market_table(_market(spark, sf_dir), RUN).selectExpr(*MARKET_WIDE)


STATES_SQL = MARKET_SQL + """,
st1 AS (SELECT *,
    CASE WHEN mean_raw_return_observed IS NULL OR median_raw_return_observed IS NULL THEN 'UNKNOWN' WHEN mean_raw_return_observed > 0 AND median_raw_return_observed > 0 THEN 'POSITIVE_CENTER'
      WHEN mean_raw_return_observed < 0 AND median_raw_return_observed < 0 THEN 'NEGATIVE_CENTER' ELSE 'MIXED_CENTER' END AS return_center_state,
    CASE WHEN valid_raw_return_count IS NULL OR valid_raw_return_count = 0 THEN 'UNKNOWN' WHEN advancer_count > decliner_count THEN 'ADVANCE_DOMINANT'
      WHEN decliner_count > advancer_count THEN 'DECLINE_DOMINANT' ELSE 'BALANCED' END AS daily_participation_state,
    CASE WHEN pct_above_ma20_observed IS NULL OR pct_positive_mom20_observed IS NULL THEN 'UNKNOWN' WHEN pct_above_ma20_observed > 0.5 AND pct_positive_mom20_observed > 0.5 THEN 'BROAD_POSITIVE'
      WHEN pct_above_ma20_observed < 0.5 AND pct_positive_mom20_observed < 0.5 THEN 'BROAD_NEGATIVE' ELSE 'MIXED' END AS trend_participation_state FROM market),
states AS (SELECT *, CASE WHEN 'UNKNOWN' IN (return_center_state, daily_participation_state, trend_participation_state) THEN 'UNKNOWN'
    WHEN return_center_state = 'POSITIVE_CENTER' AND daily_participation_state = 'ADVANCE_DOMINANT' AND trend_participation_state = 'BROAD_POSITIVE' THEN 'BROAD_ADVANCE'
    WHEN return_center_state = 'NEGATIVE_CENTER' AND daily_participation_state = 'DECLINE_DOMINANT' AND trend_participation_state = 'BROAD_NEGATIVE' THEN 'BROAD_DECLINE'
    WHEN return_center_state = 'POSITIVE_CENTER' THEN 'POSITIVE_MIXED_PARTICIPATION' WHEN return_center_state = 'NEGATIVE_CENTER' THEN 'NEGATIVE_MIXED_PARTICIPATION' ELSE 'MIXED' END AS market_structure_state FROM st1)"""


def _states(spark, sf_dir):
    return mk.states(_market(spark, sf_dir))


def _state_one(name, spark, sf_dir):
    return _states(spark, sf_dir).select("trade_date", name)


for _k, _name in enumerate(("return_center_state", "daily_participation_state", "trend_participation_state", "market_structure_state"), 1):
    query(f"RS-{_k:02d}", f"WITH {STATES_SQL} SELECT trade_date, {_name} FROM states")(partial(_state_one, _name))


@query("RS-05", f"""WITH {STATES_SQL}, s AS (
  SELECT trade_date, 'return_center_state' AS state_name, CASE WHEN mean_raw_return_observed IS NULL OR median_raw_return_observed IS NULL THEN 'STATE_INPUT_NULL' END AS finding_class,
    concat_ws(',', CASE WHEN mean_raw_return_observed IS NULL THEN 'mean_raw_return_observed' END, CASE WHEN median_raw_return_observed IS NULL THEN 'median_raw_return_observed' END) AS inputs FROM states
  UNION ALL SELECT trade_date, 'daily_participation_state', CASE WHEN valid_raw_return_count = 0 THEN 'STATE_INPUT_EMPTY_DENOMINATOR' END, '' FROM states
  UNION ALL SELECT trade_date, 'trend_participation_state', CASE WHEN pct_above_ma20_observed IS NULL OR pct_positive_mom20_observed IS NULL THEN 'STATE_INPUT_NULL' END,
    concat_ws(',', CASE WHEN pct_above_ma20_observed IS NULL THEN 'pct_above_ma20_observed' END, CASE WHEN pct_positive_mom20_observed IS NULL THEN 'pct_positive_mom20_observed' END) FROM states)
SELECT * FROM s WHERE finding_class IS NOT NULL""")
def state_findings(spark, sf_dir):
    return mk.state_findings(_states(spark, sf_dir))


STATE_COLUMNS = ["trade_date", *map(_shown, mk.EVIDENCE), "return_center_state", "daily_participation_state", "trend_participation_state", "market_structure_state"]


@query("RS-06", f"WITH {STATES_SQL} SELECT {', '.join(STATE_COLUMNS)} FROM states")
def state_table(spark, sf_dir):
    return _states(spark, sf_dir).selectExpr(*STATE_COLUMNS)


_EVIDENCE = {n: js.double(f"round({n}, 9)" if n.startswith("mean") else n) if n.split("_")[0] in ("advancer", "mean", "median", "pct") and not n.endswith("count") else js.whole(n) for n in mk.EVIDENCE}
_STATE_ROW = js.row(
    **_EVIDENCE, feature_run_id=f"'\"{RUN.feature_run_id}\"'", trade_date=js.date("trade_date"), source_lineage_hash=js.text("input_lineage_hash"),
    source_available_on=js.date("feature_available_on"), rules="'[" + ",".join(f'"{r}"' for r in mk.RULES) + "]'",
)


@query("RS-07", f"WITH {STATES_SQL} SELECT trade_date, sha256({_STATE_ROW}) AS state_lineage_hash FROM states")
def state_lineage(spark, sf_dir):
    states = _states(spark, sf_dir)
    return states.select("trade_date", mk.state_lineage(states, RUN).alias("state_lineage_hash"))


@query("RS-08", f"""WITH {MARKET_SQL}, bad AS (SELECT * REPLACE (CASE WHEN day(trade_date) = 3 THEN advancer_count + 1 ELSE advancer_count END AS advancer_count) FROM market)
SELECT trade_date, 'COUNTS_DISAGREE' AS violation FROM bad WHERE advancer_count + decliner_count + unchanged_count <> valid_raw_return_count
UNION ALL SELECT trade_date, 'RATIO_DISAGREES' FROM bad WHERE (advancer_count / nullif(valid_raw_return_count, 0)) IS DISTINCT FROM advancer_ratio_observed
UNION ALL SELECT trade_date, 'RATIO_OUT_OF_RANGE' FROM bad WHERE pct_above_ma20_observed NOT BETWEEN 0 AND 1 OR pct_positive_mom20_observed NOT BETWEEN 0 AND 1
UNION ALL SELECT trade_date, 'BAD_HASH' FROM bad WHERE length(input_lineage_hash) <> 64""")
def state_guards(spark, sf_dir):
    wrong = F.when(F.dayofmonth("trade_date") == 3, F.col("advancer_count") + 1).otherwise(F.col("advancer_count"))
    return mk.state_guard(_market(spark, sf_dir).withColumn("advancer_count", wrong))
