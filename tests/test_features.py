"""Features on hand-made bars: values, missingness, order and future rows."""

import datetime as dt
import random
import statistics

import pytest

from tidebar.operators import features as ft
from tidebar.operators import market as mk

DAY = dt.date(2026, 1, 1)
SCHEMA = "security_id string, trade_date date, open double, high double, low double, close double, pre_close double, volume long, amount double, available_on date"


def ramp(n=65, **change):
    rows = []
    for i in range(n):
        close = 100 + 0.5 * i
        row = {
            "security_id": "A", "trade_date": DAY + dt.timedelta(i), "open": close - 0.25, "high": close + 1, "low": close - 1, "close": close,
            "pre_close": close - 0.5, "volume": 10, "amount": 1000.0 + i, "available_on": DAY + dt.timedelta(i),
        }
        for k, f in change.items():
            row[k] = f(i, row[k])
        rows.append(tuple(row.values()))
    return rows


def run(spark, rows):
    return {r.trade_date: r for r in ft.security_features(spark.createDataFrame(rows, SCHEMA)).collect()}


def at(out, i):
    return out[DAY + dt.timedelta(i)]


def test_ramp(spark):
    out = run(spark, ramp())
    r = at(out, 60)
    assert r.raw_return_1 == pytest.approx(130 / 129.5 - 1)
    assert r.amplitude_preclose_raw == pytest.approx(2 / 129.5)
    assert r.ma_close_obs_5 == pytest.approx(129) and r.ma_close_obs_60 == pytest.approx(130 - 0.5 * 29.5)
    assert r.return_lag_obs_60 == pytest.approx(0.3)
    assert r.amount_to_mean_obs_20 == pytest.approx(1060 / (1060 - 9.5))
    returns = [(100 + 0.5 * i) / (99.5 + 0.5 * i) - 1 for i in range(41, 61)]
    assert r.vol_raw_return_obs_20 == pytest.approx(statistics.pstdev(returns))
    assert at(out, 3).ma_close_obs_5 is None and at(out, 3).ma_close_obs_5_reason == "INSUFFICIENT_HISTORY"
    assert at(out, 59).return_lag_obs_60_reason == "INSUFFICIENT_HISTORY"
    assert r.lineage_size == 61


def test_last_valid_reaches_over_a_gap(spark):
    out = run(spark, ramp(183, amount=lambda i, v: None if 21 <= i <= 180 else v))
    r = at(out, 182)
    valid = [1000.0 + i for i in [*range(3, 21), 181, 182]]
    assert r.amount_to_mean_obs_20 == pytest.approx(1182 / (sum(valid) / 20))
    assert r.amount_skipped == 160 and at(out, 100).amount_skipped == 80
    assert at(out, 100).amount_to_mean_obs_20_reason == "INPUT_NULL"


def test_unsafe_denominator_and_skipped_returns(spark):
    out = run(spark, ramp(pre_close=lambda i, v: 0.0 if i >= 20 else v))
    r = at(out, 40)
    assert r.raw_return_1 is None and r.raw_return_1_reason == "UNSAFE_DENOMINATOR"
    assert r.vol_raw_return_obs_20 is not None and r.vol_skipped == 21
    none = run(spark, ramp(30, pre_close=lambda i, v: None))
    assert at(none, 9).vol_skipped == 10 and at(none, 9).vol_raw_return_obs_20_reason == "INSUFFICIENT_HISTORY"


def test_order_and_future_do_not_matter(spark):
    rows = ramp()
    base = run(spark, rows)
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    assert run(spark, shuffled) == base
    changed = rows[:-1] + [rows[-1][:5] + (1.0,) + rows[-1][6:]]
    assert at(run(spark, changed), 60) == at(base, 60)


def test_findings_and_guards(spark):
    df = spark.createDataFrame(ramp(6), SCHEMA)
    names = {(r.feature_name, r.finding_class) for r in ft.findings(ft.security_features(df)).collect()}
    assert ("ma_close_obs_60", "INSUFFICIENT_HISTORY") in names and ("raw_return_1", "INPUT_NULL") not in names
    import pyspark.sql.functions as F

    bad = ft.guard(df.unionByName(df.limit(1)), F.lit("2026-01-04").cast("date"))
    assert {r.violation for r in bad.collect()} == {"DUPLICATE_SECURITY_DATE", "AVAILABLE_AFTER_AS_OF"}


@pytest.mark.parametrize(
    "mean, median, valid, adv, dec, above, positive, expected",
    [
        (0.1, 0.1, 3, 2, 1, 0.6, 0.6, ("POSITIVE_CENTER", "ADVANCE_DOMINANT", "BROAD_POSITIVE", "BROAD_ADVANCE")),
        (-0.1, -0.1, 3, 1, 2, 0.4, 0.4, ("NEGATIVE_CENTER", "DECLINE_DOMINANT", "BROAD_NEGATIVE", "BROAD_DECLINE")),
        (0.1, 0.1, 3, 2, 1, 0.5, 0.6, ("POSITIVE_CENTER", "ADVANCE_DOMINANT", "MIXED", "POSITIVE_MIXED_PARTICIPATION")),
        (-0.1, -0.1, 2, 1, 1, 0.5, 0.6, ("NEGATIVE_CENTER", "BALANCED", "MIXED", "NEGATIVE_MIXED_PARTICIPATION")),
        (0.0, 0.1, 2, 1, 1, 0.5, 0.5, ("MIXED_CENTER", "BALANCED", "MIXED", "MIXED")),
        (None, 0.1, 2, 1, 1, 0.5, 0.5, ("UNKNOWN", "BALANCED", "MIXED", "UNKNOWN")),
        (0.1, 0.1, 0, 0, 0, None, 0.5, ("POSITIVE_CENTER", "UNKNOWN", "UNKNOWN", "UNKNOWN")),
    ],
)
def test_states(spark, mean, median, valid, adv, dec, above, positive, expected):
    row = spark.createDataFrame(
        [(DAY, mean, median, valid, adv, dec, above, positive)],
        "trade_date date, mean_raw_return_observed double, median_raw_return_observed double, valid_raw_return_count long, advancer_count long, decliner_count long, pct_above_ma20_observed double, pct_positive_mom20_observed double",
    )
    r = mk.states(row).first()
    assert (r.return_center_state, r.daily_participation_state, r.trend_participation_state, r.market_structure_state) == expected


def test_exact_mean(spark):
    import math
    import random

    from tidebar.functions.exact import exact_mean

    rng = random.Random(9)
    groups = {
        "mixed": [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(500)],
        "cancels": [1e16, 1.0, -1e16, 3.0], "tiny": [5e-324, 1e-310, -2.5e-320], "great": [1.7e308, 1e300, -1.7e308],
        "powers": [2.0**k for k in range(-60, 60)], "zeros": [0.0, -0.0], "some": [None, 0.1, 0.2, None], "none": [None],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 2.0)]
    rng.shuffle(rows)
    got = {r.k: r.exact_mean for r in exact_mean(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    for k, vs in groups.items():
        known = [v for v in vs if v is not None]
        assert got[k] == (math.fsum(known) / len(known) if known else None), k
    assert math.isnan(got["nan"]) and got["inf"] == math.inf


def brute_members(rows, i):
    """Indices of the inputs of row i: the last 61, and the last 20 with an amount and with a return."""
    amounts = [k for k in range(i + 1) if rows[k][8] is not None][-20:]
    returns = [k for k in range(i + 1) if rows[k][6]][-20:]
    return set(range(max(0, i - 60), i + 1)) | set(amounts) | set(returns)


def test_lineage_follows_its_members_and_no_others(spark):
    holes = dict(amount=lambda i, v: None if 5 <= i < 120 and i % 9 else v, pre_close=lambda i, v: 0.0 if i > 15 and i % 4 else v)
    rows = ramp(170, **holes)
    base = run(spark, rows)
    sets = {i: brute_members(rows, i) for i in range(170)}
    assert all(at(base, i).lineage_size == len(sets[i]) for i in sets)
    for k in (0, 7, 14, 20, 63, 118):
        changed = rows[:k] + [rows[k][:2] + (rows[k][2] + 2**-40,) + rows[k][3:]] + rows[k + 1 :]  # the open of one row, by a few bits
        got = run(spark, changed)
        for i in range(170):
            same = at(got, i).input_lineage_hash == at(base, i).input_lineage_hash
            assert same == (k not in sets[i]), (k, i)


def test_first_bad_input_gives_the_reason(spark):
    nan, inf = float("nan"), float("inf")
    out = run(spark, ramp(30, close=lambda i, v: {7: nan, 9: None, 20: None, 22: inf}.get(i, v)))
    reason = lambda i: at(out, i).ma_close_obs_5_reason
    assert [reason(i) for i in (3, 6, 8, 9, 11, 12, 13, 14)] == ["INSUFFICIENT_HISTORY", None, "NON_FINITE_RESULT", "NON_FINITE_RESULT", "NON_FINITE_RESULT", "INPUT_NULL", "INPUT_NULL", None]
    assert [reason(i) for i in (22, 24, 25, 26, 27)] == ["INPUT_NULL", "INPUT_NULL", "NON_FINITE_RESULT", "NON_FINITE_RESULT", None]
    assert at(out, 9).close_to_ma_obs_5_reason == "NON_FINITE_RESULT" and at(out, 12).return_lag_obs_5_reason == "NON_FINITE_RESULT"
    den = run(spark, ramp(3, pre_close=lambda i, v: (inf, None, -1.0)[i]))
    assert [at(den, i).raw_return_1_reason for i in range(3)] == ["NON_FINITE_RESULT", "UNSAFE_DENOMINATOR", "UNSAFE_DENOMINATOR"]


def test_stored_tables_have_all_columns(spark):
    f = ft.security_features(spark.createDataFrame(ramp(25), SCHEMA))
    r = ft.Run("s1", "c1")
    table = ft.security_table(f, r)
    assert len(table.columns) == 24 and table.first().feature_run_id == r.feature_run_id != ft.Run("s2", "c1").feature_run_id
    market = mk.market_table(mk.breadth(f), r)
    assert len(market.columns) == 20 and market.count() == 25
    foreign = spark.createDataFrame(ramp(2), SCHEMA).selectExpr("*", "concat(security_id, trade_date) AS canonical_key", "'s1' AS snapshot_id", "if(trade_date > '2026-01-01', 'c2', 'c1') AS canonical_run_id")
    import pyspark.sql.functions as F

    twice = foreign.unionByName(foreign.limit(1).withColumn("trade_date", F.lit(DAY + dt.timedelta(9))))
    got = sorted((r.violation, str(r.trade_date)) for r in ft.guard(twice, F.lit("2027-01-01").cast("date"), r).collect())
    assert got == [("DUPLICATE_CANONICAL_KEY", "2026-01-01"), ("DUPLICATE_CANONICAL_KEY", "2026-01-10"), ("FOREIGN_CANONICAL_RUN", "2026-01-02")]


def test_features_take_one_sort(spark):
    """No wide row is sorted again: one shuffle and one order by (security, date), besides that of the bars themselves."""
    from tidebar.operators import features
    from tidebar.sources.derived import bars

    own = bars(spark, "/root/testdata/sf0.001")
    sorts = lambda df: df._jdf.queryExecution().executedPlan().toString().count("- Sort [")
    assert sorts(features.security_features(own)) == sorts(own)
