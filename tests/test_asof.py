"""As-of joins against brute force, and the checks on hand-made rows."""

import datetime as dt
import random

import pytest

from tidebar.operators import asof as ao

D0 = dt.date(2026, 1, 5)


def day(n):
    return None if n is None else D0 + dt.timedelta(n)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_as_of_against_brute_force(spark, forward, strict):
    rng = random.Random(2)
    pick = lambda: rng.choice(["a", "a", "a", "b", None])
    left = [(i, pick(), rng.choice([None, *range(30)])) for i in range(120)] + [(0, "a", 3), (0, "a", 3)]
    right = [(pick(), rng.choice([None, *range(0, 30, 2)]), rng.choice([None, 1, 2, 3])) for _ in range(60)]
    l = spark.createDataFrame([(i, k, day(t)) for i, k, t in left], "id int, k string, t date").repartition(3)  # noqa: E741
    r = spark.createDataFrame([(k, day(t), v) for k, t, v in right], "k string, u date, v int")
    got = sorted(map(str, ao.as_of(l, r, ["k"], "t", "u", {"v2": "v", "u2": "u"}, forward, strict).collect()))
    want = []
    for i, k, t in left:
        fits = lambda u: (u > t if strict else u >= t) if forward else (u < t if strict else u <= t)  # noqa: E731, B023
        near = [(u if not forward else -u, v if v is not None else -1) for k2, u, v in right if k is not None and k2 == k and t is not None and u is not None and fits(u)]
        u, v = max(near, default=(None, None))
        want.append((i, k, day(t), None if v in (None, -1) else v, None if u is None else day(abs(u))))
    assert got == sorted(f"Row(id={w[0]}, k={w[1]!r}, t={w[2]!r}, v2={w[3]}, u2={w[4]!r})" for w in want)


def test_no_plan_pairs_ranges(spark):
    left = spark.createDataFrame([("a", day(1))], "k string, t date")
    right = spark.createDataFrame([("a", day(0), 1)], "k string, u date, v int")
    plan = ao.as_of(left, right, ["k"], "t", "u", {"v2": "v"})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    listing = spark.createDataFrame([("S", day(1))], "security_id string, list_date date")
    plan = ao.first_session(listing, "list_date", spark.createDataFrame([(day(2),)], "trade_date date"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_continuity(spark):
    bars = spark.createDataFrame([("S", day(n), c) for n, c in [(0, 10.0), (1, None), (3, 8.0), (4, 8.0), (9, 0.0)]], "security_id string, trade_date date, close double")
    factors = [("S", day(2), 0.8, 1), ("S", day(3), 0.81, 2), ("S", day(4), 0.8, 3), ("S", day(4), -1.0, 4), ("S", day(20), 1.0, 5), ("S", day(0), 1.0, 6), ("S", day(9), 1.0, 7), ("T", day(2), 1.0, 1)]
    got = [(r.ex_date, r.verdict) for r in ao.continuity(spark.createDataFrame(factors, "security_id string, ex_date date, factor double, factor_no int"), bars).where("security_id = 'S'").collect()]
    assert sorted(got) == sorted([(day(2), "PASS"), (day(3), "PASS"), (day(4), "FAIL"), (day(4), "NEGATIVE_FACTOR"), (day(20), "MISSING_BAR"), (day(0), "ORDER_BREAK"), (day(9), "NOT_CHECKED")])


def test_corporate_actions(spark):
    calendar = spark.createDataFrame([(day(n),) for n in range(10)], "trade_date date")
    close = {k: 10.0 for k in range(10)}
    bars = [("S", day(n), close[n]) for n in range(10)] + [("T", day(n), 10.0) for n in (1, 2)] + [("U", day(n), 10.0 if n < 5 else 5.0) for n in range(10)]
    events = [(s, day(n), t) for s, n, t in [("S", 2, "DIVIDEND"), ("S", 4, "RIGHT_ISSUE"), ("S", 5, "DIVIDEND"), ("S", 6, "DIVIDEND"), ("S", 7, "DIVIDEND"), ("U", 5, "DIVIDEND"), ("U", 7, "DIVIDEND"), ("U", 8, "DIVIDEND")]] + [(None, day(3), "DIVIDEND")]
    factors = [("S", day(2), 1.1), ("S", day(6), 1.1), ("S", day(7), 0.0), ("U", day(5), 2.0), ("U", day(7), 6.0), ("S", day(4), 1.0)]
    cases = {
        ("S", 30, "DIVIDEND"): "CALENDAR_MISSING_EVENT_DAY", ("S", 0, "DIVIDEND"): "CALENDAR_WINDOW_EDGE", ("S", 9, "DIVIDEND"): "CALENDAR_WINDOW_EDGE", ("T", 2, "DIVIDEND"): "SUSPENSION_AT_EVENT",
        ("T", 1, "DIVIDEND"): "KLINE_CONTEXT_MISSING", ("S", 2, None): "EVENT_TYPE_UNRESOLVED", ("S", 3, "DIVIDEND"): "EVENT_DATE_MISMATCH", ("S", 4, "DIVIDEND"): "EVENT_TYPE_MISMATCH",
        ("S", 5, "DIVIDEND"): "ADJ_EVENT_DATE_MISSING", ("S", 7, "DIVIDEND"): "ADJ_FACTOR_INVALID", ("S", 4, "RIGHT_ISSUE"): "PASS", ("S", 2, "DIVIDEND"): "PASS", ("U", 5, "DIVIDEND"): "PASS",
        ("U", 7, "DIVIDEND"): "ADJ_CONTINUITY_BROKEN", ("U", 8, "DIVIDEND"): "ADJ_EVENT_DATE_MISSING",
    }
    rows = [(f"{s}{n}{t}", s, day(n), t) for s, n, t in cases]
    got = ao.corporate_actions(
        spark.createDataFrame(rows, "case_id string, security_id string, trade_date date, event_type string"), calendar, spark.createDataFrame(bars, "security_id string, trade_date date, close double"),
        spark.createDataFrame(events, "security_id string, ex_date date, event_type string"), spark.createDataFrame(factors, "security_id string, ex_date date, factor double"),
        spark.createDataFrame([("T", day(2))], "security_id string, trade_date date"),
    ).collect()
    assert {r.case_id: r.reason for r in got} == {f"{s}{n}{t}": r for (s, n, t), r in cases.items()}


def test_first_sessions(spark):
    calendar = spark.createDataFrame([(day(n),) for n in (0, 1, 4, 5, 6, 7, 8)], "trade_date date")
    listing = spark.createDataFrame([("A", day(2)), ("B", day(0)), ("C", day(90)), ("D", None)], "security_id string, list_date date")
    got = {r.security_id: r.first_session for r in ao.first_session(listing, "list_date", calendar).collect()}
    assert got == {"A": day(4), "B": day(0), "C": None, "D": None}
    bars = spark.createDataFrame([("A", day(n)) for n in (1, 4, 8)] + [("B", day(n)) for n in (6, 7)], "security_id string, trade_date date")
    inside = {(r.security_id, r.trade_date): r.in_first_n for r in ao.within_first_sessions(bars, listing, calendar).collect()}
    assert inside == {("A", day(1)): False, ("A", day(4)): True, ("A", day(8)): True, ("B", day(6)): True, ("B", day(7)): False}
