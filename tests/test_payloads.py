"""Landed payloads: the round trip, the rule for packing, identities and shapes."""

import pytest
from pyspark.sql import functions as F

from tidebar.sources import payloads as pl
from tidebar.sources import storage as st

SCHEMA = f"provider string, dataset string, request_id string, payload {pl.PAYLOAD}"


def code(i):
    return f"{i:06d}.SZ"


def many(n, **extra):
    out = {code(i): [{"TRADE_DATE": "20200102", "CLOSE": str(i)}] for i in range(n)}
    return out | extra


PAYLOADS = {
    "127": many(127),
    "128": many(128),
    "gaps": many(126, **{code(900): None, code(901): [], code(902): []}),
    "mixed": many(127, **{code(900): [{"TRADE_DATE": "20200102"}]}),
    "null value": many(127, **{code(900): [{"TRADE_DATE": "20200102", "CLOSE": None}]}),
    "no columns": {code(i): [{}] for i in range(130)},
    "all empty": {code(i): [] for i in range(130)},
    "one": {code(1): [{"a": "x"}, {"b": None}, {}], code(2): None},
    "quotes": {'6"0.SH': [{"a'b": "ü\n"}]},
}


@pytest.fixture(scope="module")
def landed(spark):
    at = st.scratch(spark, "payloads")
    rows = [("a", "bars", k, v) for k, v in PAYLOADS.items()] + [("b", "bars", "128", {code(1): []}), ("a", "bars", "none", None), ("a", "bars", "void", {})]
    pl.land(spark.createDataFrame(rows, SCHEMA), at)
    return at


@pytest.mark.parametrize("request_id", PAYLOADS)
def test_round_trip(spark, landed, request_id):
    (got,) = pl.read_payload(spark, landed, "a", "bars", request_id).collect()
    assert got.payload == PAYLOADS[request_id]


def test_what_is_packed(spark, landed):
    got = {r.request_id: r.layout for r in pl.inventory(spark, landed, "a").select("request_id", "layout").distinct().collect()}
    assert {k for k, v in got.items() if v == "PACKED"} == {"128", "gaps", "null value", "all empty"}
    assert pl.read_payload(spark, landed, "b", "bars", "128").first().payload == {code(1): []}
    assert not pl.read_payload(spark, landed, "a", "bars", "none").collect() and not pl.read_payload(spark, landed, "a", "bars", "void").collect()


def test_a_read_prunes_folders_and_row_groups(spark, landed):
    df = pl.read_rows(spark, landed, "a", "bars", "128")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert plan.count("EqualTo(request_id,128)") >= 2 and "(provider" in plan[plan.index("PartitionFilters") :]
    assert df.count() == 128


def test_lost_rows_are_found(spark, landed):
    assert not pl.verify(spark, landed).collect()
    at = st.scratch(spark, "lossy")
    pl.land(spark.createDataFrame([("a", "bars", "one", {code(1): [{"a": "x"}], code(2): [{"a": "y"}]})], SCHEMA), at)
    rows = spark.read.parquet(f"{at}/rows").where(F.col("member") != code(2)).collect()
    kept = spark.createDataFrame([tuple(r[c] for c in ("request_id", "member", "ordinal", "cells", "named", "provider", "dataset", "layout")) for r in rows], pl._ROWS)
    kept.write.mode("overwrite").partitionBy("provider", "dataset", "layout").parquet(f"{at}/rows")
    (lost,) = pl.verify(spark, at).collect()
    assert (lost.member, lost.row_count, lost.held) == (code(2), 1, 0)


CASES = {
    "600000.SH": [
        ({"Security_Code": "600000"}, "ROW", None),
        ({"code": "600000.SH"}, "ROW", None),
        ({"code": "600000.SZ"}, "REJECTED", "IDENTITY_CONFLICT"),
        ({"CODE": "600001"}, "REJECTED", "IDENTITY_CONFLICT"),
        ({"code": " "}, "REJECTED", "IDENTITY_MISSING_OR_AMBIGUOUS"),
        ({"code": None, "x": "1"}, "REJECTED", "IDENTITY_MISSING_OR_AMBIGUOUS"),
        ({"code": None, "security_code": "600000"}, "ROW", None),
        ({"x": "1"}, "ROW", None),
    ]
}


def test_identities(spark):
    payload = {k: [r for r, _, _ in v] for k, v in CASES.items()} | {"000001.SZ": None, "000002.SZ": [], "000003": [{"x": "1"}], "SZ": None}
    at = st.scratch(spark, "identities")
    pl.land(spark.createDataFrame([("a", "bars", "r", payload)], SCHEMA), at)
    flat = pl.flatten(pl.read_rows(spark, at))
    got = flat.collect()
    rows = sorted((r for r in got if r.symbol == "600000.SH"), key=lambda r: r.ordinal)
    assert [(r.marker, r.reason) for r in rows] == [(m, why) for _, m, why in CASES["600000.SH"]]
    assert all(r.row["PROVIDER_SYMBOL"] == "600000.SH" for r in rows)
    rest = {r.symbol: (r.marker, r.reason, r.row and r.row["PROVIDER_SYMBOL"]) for r in got if r.symbol != "600000.SH"}
    assert rest == {"000001.SZ": ("NULL_MEMBER", None, None), "000002.SZ": ("EMPTY_MEMBER", None, None), "000003": ("REJECTED", "KEY_NOT_QUALIFIED", "000003"), "SZ": ("REJECTED", "KEY_NOT_QUALIFIED", None)}
    report = {r.code: (r.tables, r.n) for r in pl.shape_report(flat).collect()}
    assert report == {"IDENTITY_CONFLICT": (1, 2), "IDENTITY_MISSING_OR_AMBIGUOUS": (1, 2), "DATE_MISSING_OR_INVALID": (1, 4), "NULL_MEMBER": (1, 1), "EMPTY_MEMBER": (1, 1), "KEY_NOT_QUALIFIED": (2, 2)}


def test_nothing_landed(spark):
    at = st.scratch(spark, "nothing")
    pl.land(spark.createDataFrame([], SCHEMA), at)
    assert not pl.flatten(pl.read_rows(spark, at)).collect() and not pl.shape_report(pl.flatten(pl.read_rows(spark, at))).collect()


def test_dates_of_rows(spark):
    at = st.scratch(spark, "dates")
    days = ["20200102", "2020-01-02", "20200230", "", None]
    pl.land(spark.createDataFrame([("a", "bars", "r", {code(1): [{"trade_date": x} for x in days]})], SCHEMA), at)
    report = {r.code: r.n for r in pl.shape_report(pl.flatten(pl.read_rows(spark, at))).collect()}
    assert report == {"VALID": 2, "DATE_MISSING_OR_INVALID": 3}


def test_landing_by_member_puts_no_request_together(spark, tmp_path):
    """Members land one by one as a payload does, and the plan of the rows holds no map of a request."""
    small = [("a", "bars", "r", i, code(i), [{"c": str(i), "d": None}] * (i % 3)) for i in range(6)] + [("a", "bars", "r", 6, code(6), None), ("a", "bars", "s", 0, code(0), [{"c": "1"}, None]), ("a", "bars", "t", 0, code(0), [])]
    members = spark.createDataFrame(small, "provider string, dataset string, request_id string, place int, member string, rows array<map<string,string>>")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    pl.land_members(members, one, pack_from=2)
    pl.land(members.groupBy(*pl.REQUEST).agg(F.map_from_entries(F.collect_list(F.struct("member", "rows"))).alias("payload")), two, pack_from=2)
    shown = lambda at: sorted(map(str, pl.read_rows(spark, at).collect()))
    kept = lambda at: sorted((r.request_id, r.member, r.layout, r.row_count) for r in pl.inventory(spark, at).collect() if r.row_count is not None)
    assert shown(one) == shown(two) and kept(one) == kept(two)
    assert {(r.request_id, r.layout) for r in pl.inventory(spark, one).collect()} == {("r", "PACKED"), ("s", "NAMED"), ("t", "NAMED")}
    assert pl.verify(spark, one).count() == 0 and not (tmp_path / "one" / "members").exists()


def test_members_of_bars_take_one_shuffle(spark):
    from tidebar.plans.relations import frame

    bars = frame(spark, "/root/testdata/sf0.001", "landed_bars")
    plan = bars.groupBy("security_id", *pl.REQUEST, "member").agg(F.collect_list("cents"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
