"""Catalog operators on hand-made rows, and a sample of queries against SQL."""

import datetime as dt
import uuid

import duckdb
import pytest

from tidebar import plans
from tidebar.functions.dialect import NAMESPACE
from tidebar.operators import catalog, catalog_tables  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def d(text):
    return dt.date.fromisoformat(text)


def test_identity_in_force(spark):
    identity = spark.createDataFrame(
        [("a", "X", d("2020-01-01"), d("2021-01-01")), ("b", "X", d("2021-01-01"), None), ("c", "X", d("2022-01-01"), None)],
        "security_id string, symbol string, valid_from date, valid_to date",
    )
    days = spark.createDataFrame([("X", d(x)) for x in ("2019-12-31", "2020-12-31", "2021-01-01", "2022-06-01")], "symbol string, trade_date date")
    got = {str(r.trade_date): r.security_id for r in catalog.run(spark, "JN-01", symbol_days=days, identity=identity).collect()}
    assert got == {"2019-12-31": None, "2020-12-31": "a", "2021-01-01": "b", "2022-06-01": None}


def test_limit_prices_round_half_up(spark):
    rows = spark.createDataFrame([("A", d("2020-01-01"), 10.05, 0.1, 0.1), ("B", d("2020-01-01"), 1.0, 0.0, 0.0)], "security_id string, trade_date date, pre_close double, up_rate double, down_rate double")
    got = {r.security_id: (r.limit_up, r.limit_down) for r in catalog.run(spark, "PRJ-36", rated=rows).collect()}
    assert got == {"A": (11.06, 9.05), "B": (None, None)}


def test_stable_id_is_uuid5(spark):
    rows = spark.createDataFrame([("S1", "SH", "000001", d("2010-08-27"), d("2010-08-30")), ("S2", "SZ", "000002", None, d("2011-01-02"))], "security_id string, exchange string, code string, known_list_date date, first_seen date")
    got = {r.security_id: r.stable_id for r in catalog.run(spark, "PRJ-42", identities=rows).collect()}
    ns = uuid.UUID(NAMESPACE)
    assert got == {"S1": str(uuid.uuid5(ns, "SH:STOCK:000001:20100827")), "S2": str(uuid.uuid5(ns, "SZ:STOCK:000002:F20110102"))}


def test_selection_merges_and_conflicts(spark):
    day = d("2020-01-01")
    rows = [("A", day, "a", 0, "m1", 1, "RESOLVED", 5), ("A", day, "b", 1, "m2", 2, "RESOLVED", 5), ("A", day, "b", 1, "m3", 3, "RESOLVED", 6), ("A", day, "b", 1, "m4", 4, "MISSING", 5)]
    df = spark.createDataFrame(rows, "security_id string, trade_date date, provider string, priority int, manifest_hash string, ordinal long, identity_status string, payload long")
    got = {r.ordinal: r.decision for r in catalog.run(spark, "WN-21", candidates=df).collect()}
    assert got == {1: "SELECTED", 2: "EQUIVALENT_MERGED", 3: "SOURCE_CONFLICT"}


def brute_subscriptions(rows):
    out = {}
    for feed, _, kind in sorted(rows, key=lambda r: (r[0], r[1])):
        status, events, late, orphan = out.get(feed, ("NEW", 0, 0, 0))
        if kind == "START":
            status = "STARTED" if status == "NEW" else status
        elif kind == "STOP":
            status = "UNSUBSCRIBED"
        elif status == "NEW":
            orphan += 1
        elif status == "UNSUBSCRIBED":
            late += 1
        else:
            status, events = "ACTIVE", events + 1
        out[feed] = (status, events, late, orphan)
    return out


def test_subscription_stream_keeps_its_state_over_batches_and_restarts(spark):
    import random

    from tidebar.sources import storage as st
    from tidebar.streaming import feed as fd

    rng = random.Random(4)
    rows = [(rng.randrange(30), i, rng.choices(["EVENT", "START", "STOP"], [20, 2, 1])[0]) for i in range(900)]
    at, out, state = (st.scratch(spark, n) for n in ("landed", "out", "state"))
    schema = "feed long, seq long, kind string"
    land = lambda part: spark.createDataFrame(part, schema).repartition(2, "feed").write.mode("append").parquet(at)
    want = brute_subscriptions(rows)
    land(rows[:300])
    land(rows[300:500])
    like = spark.createDataFrame([], schema)
    fd.drain(fd.subscriptions(fd.stream(spark, at, "*.parquet", like, 2)), ["feed"], out, state)
    land(rows[500:])
    got = fd.drain(fd.subscriptions(fd.stream(spark, at, "*.parquet", like, 2)), ["feed"], out, state)  # goes on from the checkpoint
    assert {r.feed: (r.status, r.events, r.late, r.orphan) for r in got.collect()} == want
    batch = fd.subscriptions_batch(spark.createDataFrame(rows, schema)).collect()
    assert {r.feed: (r.status, r.events, r.late, r.orphan) for r in batch} == want


def _norm(v):
    return None if v is None else float(f"{v:.9g}") if isinstance(v, float) else v if isinstance(v, int) else str(v)


@pytest.mark.parametrize("key", ["WN-01", "WN-14", "AG-06", "RS-04", "PRJ-01", "PRJ-32", "JN-07", "AG-26", "ST-08", "TB-01", "SRC-08", "SO-05"])
def test_against_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    r = con.execute(plans.ORACLE[key])
    names = [x[0] for x in r.description]
    df = plans.QUERIES[key](spark, SF)
    assert sorted(names) == sorted(df.columns)
    order = lambda rows: sorted((tuple(_norm(x) for x in row) for row in rows), key=lambda t: tuple((a is None, str(a)) for a in t))
    assert order(tuple(x[c] for c in names) for x in df.collect()) == order(r.fetchall())


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE) and len(plans.QUERIES) >= 225


def test_symbols_lose_one_end_only(spark):
    codes = ["000001", "000001.SZ", "SZ000001", "SZ000001.SZ", "sh600000", "SZ00001", "BJ830000.XX", " 000002.sh "]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "row_id int, raw_code string")
    got = [r.symbol for r in catalog.run(spark, "PRJ-02", vendor=rows).orderBy("row_id").collect()]
    assert got == ["000001", "000001", "000001", None, "600000", None, None, "000002"]


def test_eligibility_order(spark):
    nan, inf = float("nan"), float("inf")
    base = dict(security_id="A", trade_date=d("2021-01-01"), split="development", upstream=None, identity_conflict=False, resolved_id="A", open=1.0, high=2.0, low=1.0, close=1.5, pre_close=1.0, volume=1, amount=1.0, exchange="SZ")
    cases = [({}, None), ({"high": inf}, "non_finite_value"), ({"pre_close": nan}, "non_finite_value"), ({"pre_close": None}, None), ({"open": -1.0, "close": nan}, "invalid_ohlc"), ({"open": nan, "low": -1.0}, "non_finite_value"), ({"low": 1.2}, "invalid_ohlc"), ({"amount": None, "open": nan}, "missing_required_value"), ({"exchange": "BJ"}, "bse_identity_boundary_unresolved")]
    schema = "security_id string, trade_date date, split string, upstream string, identity_conflict boolean, resolved_id string, open double, high double, low double, close double, pre_close double, volume long, amount double, exchange string"
    rows = spark.createDataFrame([tuple((base | c | {"security_id": str(i)}).values()) for i, (c, _) in enumerate(cases)], schema)
    got = {int(r.security_id): r.reason for r in catalog.run(spark, "PRJ-32", panel_input=rows).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_candidates_of_high_security_numbers(spark, tmp_path):
    """Ordinals pass 2^31 from the 21,475th security on."""
    from tidebar.plans.relations import frame

    rows = [(1, 7, 1, dt.datetime(1995, 1, 4), 2.0, 30.0), (2, 60_000, 1, dt.datetime(1995, 1, 4), 2.0, 30.0)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.security_id: r.ordinal for r in frame(spark, str(tmp_path), "candidates").where("run_id = 'run-1'").collect()}
    day = (dt.date(1995, 1, 4) - dt.date(1990, 1, 1)).days
    assert got == {"S000007": 700_000 + 2 * day, "S060000": 6_000_000_000 + 2 * day}
    for key in ("WN-21", "WN-22", "TB-08"):
        plans.QUERIES[key](spark, str(tmp_path)).collect()


def test_lines_of_one_order_and_number_are_a_decided_tie(spark, tmp_path):
    """Whatever the order of the rows, the lowest price opens and the highest closes, in the query and in PRJ-33's SQL."""
    from tidebar.plans.relations import frame

    day = dt.datetime(1995, 1, 4)
    rows = [(5, 1, 3, day, 1.0, 7.0), (5, 1, 3, day, 1.0, 6.0), (9, 1, 3, day, 1.0, 9.0), (9, 1, 3, day, 1.0, 8.0), (7, 1, 1, day, 1.0, 1.0)]
    for name, order in (("a", rows), ("b", rows[::-1])):
        lines = spark.createDataFrame(order, "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double")
        lines.coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        got = frame(spark, f"{tmp_path}/{name}", "raw_bars").collect()
        assert [(r.open, r.close, r.high, r.low) for r in got] == [(6.0, 9.0, 9.0, 1.0)]
    con = duckdb.connect()
    assert con.execute("SELECT arg_min(p, (o, p)), arg_max(p, (o, p)) FROM (VALUES (53, 7), (53, 6), (93, 9), (93, 8)) t(o, p)").fetchone() == (6, 9)
    assert "arg_min(p, (o, p))" in plans.ORACLE["PRJ-33"]


def test_bars_of_long_keys_and_lines_without_an_order(spark, tmp_path):
    """Suppliers whose ids are cut to the same six digits keep bars of their own; a line without an order closes its day, as in PRJ-33's SQL."""
    from tidebar.plans.relations import frame
    from tidebar.sources.derived import RAW_BARS_SQL

    day = dt.datetime(1995, 1, 4)
    rows = [(1, 1_000_001, 1, day, 1.0, 7.0), (2, 1_000_002, 1, day, 1.0, 6.0), (None, 3, 1, day, 1.0, 2.0), (4, 3, 1, day, 1.0, 9.0), (5, 3, 1, day, 1.0, 8.0)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(tuple(r) for r in frame(spark, str(tmp_path), "raw_bars").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    fixed = RAW_BARS_SQL.replace("arg_min(p, o)", "arg_min(p, (o, p))").replace("arg_max(p, o)", "arg_max(p, (o, p))")
    assert got == sorted(con.execute(f"WITH {fixed} SELECT * FROM raw_bars").fetchall())
    assert [(r[0], r[2], r[5]) for r in got] == [("S000003", 9.0, 2.0), ("S100000", 6.0, 6.0), ("S100000", 7.0, 7.0)]


def test_run_identity_holds_every_row(spark):
    """TB-08 changes with each ordinal and payload, also where ordinals are alike modulo 97, and not with the order of rows."""
    schema = "run_id string, security_id string, ordinal long, manifest_hash string, payload long"
    base = [("r", "S000001", 3, "m", 5), ("r", "S000001", 100, "m", 5), ("r", "S000002", 7, "m", None)]

    def identity(rows):
        return [tuple(r) for r in catalog.run(spark, "TB-08", candidates=spark.createDataFrame(rows, schema)).collect()]

    others = [base[:1] + base[2:], [*base, ("r", "S000002", 104, "m", 5)], [base[0], ("r", "S000001", 197, "m", 5), base[2]], [*base[:2], ("r", "S000002", 7, "m", 6)]]
    got = [identity(x)[0][1] for x in (base, *others)]
    assert len(set(got)) == len(got) and identity(base[::-1]) == identity(base)
