"""Trading rules on hand-made days."""

import datetime as dt

import pytest

from tidebar.operators import rules as tr

DAYS = "exchange string, code string, trade_date date, is_st boolean, listing_date date"


def d(text):
    return dt.date.fromisoformat(text) if text else None


def calendar(spark, first="2019-12-02", last="2026-12-31"):
    """Weekdays, without the first week of October."""
    day, out = d(first), []
    while day <= d(last):
        if day.weekday() < 5 and not (day.month == 10 and day.day < 8):
            out.append((day,))
        day += dt.timedelta(1)
    return spark.createDataFrame(out, "trade_date date")


def resolved(spark, rows, with_age=True, rules=None):
    df = spark.createDataFrame([(x, c, d(t), st, d(l)) for x, c, t, st, l in rows], DAYS)
    out = tr.resolve(df, rules or tr.rule_table(spark), calendar(spark) if with_age else None).collect()
    got = {(r.exchange, r.code, str(r.trade_date), r.is_st, str(r.listing_date or "")): (r.rule.rule_id if r.rule else r.unresolved, r.first_n) for r in out}
    return [got[x, c, t, st, l or ""] for x, c, t, st, l in rows]


@pytest.mark.parametrize("row, rule", [
    (("SH", "600000", "2020-06-01", False, "1999-11-10"), "MAIN_BOARD_NORMAL"), (("SH", "600000", "2020-06-01", True, "1999-11-10"), "MAIN_BOARD_ST_HISTORICAL_SH"),
    (("SZ", "000001", "2026-07-03", True, "1999-11-10"), "MAIN_BOARD_ST_HISTORICAL_SZ"), (("SZ", "000001", "2026-07-06", True, "1999-11-10"), "MAIN_BOARD_ST_CURRENT"),
    (("SZ", "300001", "2020-08-21", False, "1999-11-10"), "CHINEXT_PRE_REGISTRATION_NORMAL"), (("SZ", "300001", "2020-08-24", True, "1999-11-10"), "CHINEXT_REGISTRATION"),
    (("SH", "688001", "2021-03-01", True, "1999-11-10"), "STAR_MARKET"), (("BJ", "830001", "2021-11-15", False, "1999-11-10"), "BSE_LIMIT"),
    (("BJ", "830001", "2021-11-12", False, "1999-11-10"), "NO_RULE"), (("BJ", "600000", "2021-11-12", False, "1999-11-10"), "NO_RULE"),
    (("SH", "60000", "2021-11-12", False, "1999-11-10"), "NO_RULE"), (("SH", "990000", "2021-11-12", False, "1999-11-10"), "NO_RULE"),
    (("SH", "600001", "2021-06-01", False, "2021-06-01"), "MAIN_BOARD_IPO_DAY"), (("SH", "600001", "2021-06-02", False, "2021-06-01"), "MAIN_BOARD_NORMAL"),
    (("SH", "600001", "2021-06-01", False, None), "NO_LISTING_DATE"), (("SH", "600001", "2021-05-31", False, "2021-06-01"), "BEFORE_LISTING"),
    (("SH", "688001", "2021-06-05", False, "2021-06-01"), "DAY_NOT_IN_CALENDAR"), (("SH", "688001", "2021-06-07", False, "2021-06-05"), "LISTING_NOT_IN_CALENDAR"),
    (("BJ", "870001", "2023-05-04", False, "2023-05-04"), "BSE_IPO_DAY_NO_LIMIT"), (("BJ", "870001", "2023-05-05", False, "2023-05-04"), "BSE_LIMIT"),
])
def test_rule_of_a_day(spark, row, rule):
    assert resolved(spark, [row])[0][0] == rule


def test_first_five_sessions_are_counted_over_weekends_and_holidays(spark):
    rows = [("SH", "688002", t, False, "2023-09-28") for t in ("2023-09-28", "2023-09-29", "2023-10-09", "2023-10-10", "2023-10-11", "2023-10-12")]
    assert resolved(spark, rows) == [("STAR_MARKET_FIRST5", True)] * 5 + [("STAR_MARKET", False)]
    assert resolved(spark, rows, with_age=False) == [("STAR_MARKET", False)] * 6
    st = [("SH", "600002", t, True, "2024-03-01") for t in ("2024-03-07", "2024-03-08")]  # the rule for any state holds beside the one for ST
    assert resolved(spark, st) == [("MAIN_BOARD_FIRST5_NO_LIMIT", True), ("MAIN_BOARD_ST_HISTORICAL_SH", False)]


def test_several_rules_are_unresolved(spark):
    two = tr.rule_table(spark, (tr.RULES[0], ("OTHER", "MAIN", "SH", "6xxxx0", "2020-01-01", "2099-12-31", False, "NONE", "0.2", "0.2")))
    rows = [("SH", "600000", "2021-06-01", False, "1999-11-10"), ("SH", "600001", "2021-06-01", False, "1999-11-10"), ("SH", "610000", "2021-06-01", True, "1999-11-10")]
    assert [r[0] for r in resolved(spark, rows, rules=two)] == ["AMBIGUOUS", "MAIN_BOARD_NORMAL", "NO_RULE"]
    only_age = tr.rule_table(spark, (tr.RULES[5],))
    assert resolved(spark, [("SH", "600000", "2024-06-03", False, "2020-06-01")], rules=only_age) == [("NO_AGE_RULE", False)]
    assert resolved(spark, [("SH", "600000", "2024-06-03", False, "2020-06-01")], with_age=False, rules=only_age) == [("NO_AGE_RULE", False)]


def test_patterns(spark):
    codes = spark.createDataFrame([("600000",), ("000001",), ("00001",), ("",), (None,)], "code string")
    patterns = spark.createDataFrame([("60xxxx",), ("xxxxx1",), ("xxxxx",), ("000001",), ("",)], "pattern string")
    got = {(r.code, r.pattern) for r in tr.match_patterns(codes, patterns).collect()}
    assert got == {("600000", "60xxxx"), ("000001", "xxxxx1"), ("000001", "000001"), ("00001", "xxxxx"), ("", "")}


def test_limits(spark):
    schema = DAYS + ", pre_close double, high_limit double, low_limit double, close double"
    case = lambda code, st, pre, up, down, close: ("SH", code, d("2021-06-01"), st, None, pre, up, down, close)
    rows = [case("600001", False, 10.05, 11.06, 9.05, 10.0), case("600002", True, 10.05, 10.55, 9.55, 10.0), case("600003", False, 10.05, 11.08, 9.05, 10.0), case("600004", False, 10.05, 11.06, 9.02, 10.0),
            case("600005", False, 10.05, 11.06, 9.05, 11.07), case("600006", False, None, 11.06, 9.05, 1.0), case("990000", False, 10.05, 11.06, 9.05, 10.0), case("600007", False, 10.05, 11.06, 9.05, None)]
    got = {r.code: r.verdict for r in tr.limit_check(spark.createDataFrame(rows, schema), tr.rule_table(spark)).collect()}
    assert list(got[r[1]] for r in rows) == ["PASS", "PASS", "UP_MISMATCH", "DOWN_MISMATCH", "CLOSE_OUTSIDE", "NOT_CHECKED", "RULE_UNRESOLVED", "PASS"]


def test_limit_cases(spark):
    status = spark.createDataFrame(
        [("SH", c, d("2024-06-03"), False, 10.0, up, 9.0) for c, up in [("600001", 11.0), ("600002", 11.02), ("600003", 11.0), ("600003", 11.0), ("600005", 11.0), ("600006", 11.0), ("600007", 0.0), ("990000", 11.0), ("600008", 11.0)]],
        "exchange string, code string, trade_date date, is_st boolean, pre_close double, high_limit double, low_limit double",
    )
    listing = spark.createDataFrame([("SH", c, d(t)) for c, t in [("600001", "2010-01-04"), ("600002", "2010-01-04"), ("600003", "2010-01-04"), ("600004", "2010-01-04"), ("600006", "2024-05-31"), ("600007", "2024-05-31"), ("990000", "2010-01-04"), ("600008", "2010-01-04")]], "exchange string, code string, listing_date date")
    cases = spark.createDataFrame([(c, "SH", c, d("2024-06-03"), 0.2 if c == "600008" else 0.1, None) for c in ("600001", "600002", "600003", "600004", "600005", "600006", "600007", "600008", "990000")], "case_id string, exchange string, code string, trade_date date, expected_up double, expected_down double")
    got = {r.case_id: r.reason for r in tr.limit_case(cases, status, listing, tr.rule_table(spark), calendar(spark)).collect()}
    assert got == {
        "600001": "PASS", "600002": "LIMIT_PRICE_MISMATCH", "600003": "STATUS_EXACT_MATCH_FAILURE", "600004": "STATUS_EXACT_MATCH_FAILURE", "600005": "LISTING_DATE_MISSING",
        "600006": "NO_LIMIT_CONTRADICTION", "600007": "PASS", "600008": "LIMIT_RATE_MISMATCH", "990000": "RULE_UNRESOLVED",
    }
