"""Stored layouts: what is read, what is refused, and the round trip of facts, lineage and constants."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidebar.sources import reads as rd
from tidebar.sources import storage as st

PANEL = "security_id string, trade_date date, split string, route string, reason string, close double"


@pytest.fixture(scope="module")
def panel(spark):
    rows, day = [], dt.date(2020, 1, 1)
    while day < dt.date(2021, 1, 1):
        for i in range(4):
            route = "disabled" if i == 3 else "enabled"
            rows.append((f"S{i}", day, "development", route, "x" if i == 3 else None, float(i)))
        day += dt.timedelta(3)
    rows.append(("S0", dt.date(2024, 5, 1), "validation_a", "enabled", None, 1.0))
    at = st.scratch(spark, "panel")
    rd.write_panel(spark.createDataFrame(rows, PANEL), at)
    return at


def plan_of(df):
    """The plan with whole metadata, partition filters and pushed filters."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def scan_of(df):
    return re.findall(r"PartitionFilters: \[(.*)\]", plan_of(df))


def files_read(df):
    """Number of files that each scan opened."""
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [m.get().value() for m in (scans.apply(i).metrics().get("numFiles") for i in range(scans.size())) if m.isDefined()]


def test_read_prunes_partitions_and_files(spark, panel):
    df = rd.load_security_daily(spark, panel, "development", "2020-03-10", "2020-04-20", ["S0", "S1"], ["security_id", "trade_date"])
    filters = scan_of(df)[0]
    assert all(c in filters for c in ("route", "split", "year", "month"))
    all_files = spark.read.parquet(panel).select("_metadata.file_path").distinct().count()
    months = spark.read.parquet(panel).where("route = 'enabled' and year = 2020 and month in (3, 4)").select("_metadata.file_path").distinct().count()
    assert files_read(df) == [months] and months < all_files / 4
    got = {(r.security_id, r.trade_date) for r in df.collect()}
    assert {i for i, _ in got} == {"S0", "S1"} and min(t for _, t in got) >= dt.date(2020, 3, 10) and max(t for _, t in got) <= dt.date(2020, 4, 20)
    assert "In(security_id, [S0,S1])" in plan_of(df).split("PushedFilters")[1]


def test_requests_that_are_refused(spark, panel):
    for bad in [dict(split="warmup"), dict(split="development", start="2019-12-31"), dict(split="development", end="2024-01-01"), dict(split="development", start="2021-01-01", end="2020-01-01"),
                dict(split="development", ids=["S0", "S0"]), dict(split="development", ids=[" "]), dict(split="development", ids="S0"), dict(split="development", columns=["nope"]),
                dict(split="development", columns=["close", "close"])]:
        with pytest.raises(rd.ReadError):
            rd.load_security_daily(spark, panel, **bad)
    assert rd.load_security_daily(spark, panel, "development", ids=[]).count() == 0
    with pytest.raises(rd.ReadError):
        rd.project_daily(spark, panel, "development", columns=[])


def test_ids_as_a_table_disabled_and_projection(spark, panel):
    ids = spark.createDataFrame([("S1",), ("S1",), ("S9",)], "security_id string")
    assert {r.security_id for r in rd.load_security_daily(spark, panel, "development", ids=ids).collect()} == {"S1"}
    assert {r.security_id for r in rd.load_disabled(spark, panel).collect()} == {"S3"} and rd.load_disabled(spark, panel, ["S1"]).count() == 0
    assert rd.project_daily(spark, panel, "validation_a", "2020-01-01", "2030-01-01").count() == 1
    assert rd.project_daily(spark, panel, "holdout", "2020-01-01", "2021-01-01").count() == 0
    assert rd.project_daily(spark, panel, None, "2020-12-01", "2024-12-01", ["S0", "S3"], ["security_id", "trade_date"]).where("trade_date > '2021-01-01'").count() == 1


def test_history_stays_in_its_scope(spark, panel):
    scope = spark.createDataFrame([("development", 2020, m) for m in (2, 3, 5)], "split string, year int, month int")
    got = rd.load_history(spark, panel, scope, "development", "2020-02-10", "2020-03-31").collect()
    assert [(r.trade_date, r.security_id) for r in got] == sorted((r.trade_date, r.security_id) for r in got) and len(got) > 20
    with pytest.raises(rd.ReadError):
        rd.load_history(spark, panel, scope, "development", "2020-03-01", "2020-05-01")
    assert "dynamicpruning" in plan_of(rd.load_history(spark, panel, scope, "development", "2020-02-10", "2020-03-31"))


def test_minutes_and_cross_section(spark):
    t0 = dt.datetime(2024, 1, 30, 9, 0)
    rows = [(k, t0 + dt.timedelta(minutes=m, days=d), (t0 + dt.timedelta(days=d)).date(), float(k), 1) for k in range(40) for m in range(3) for d in range(5)]
    minutes = spark.createDataFrame(rows, "security_key long, bar_time timestamp_ntz, trade_date date, close double, volume long")
    for layout in st.LAYOUTS:
        at = st.scratch(spark, layout)
        st.write_minutes(minutes, at, layout)
        r = rd.cross_section(spark, at, t0).first()
        assert r.n == 40 and r.avg_close == 19.5 and r.files == (1 if layout == "L0" else 16)
        some = rd.minutes_of_keys(spark, at, layout, [3, 19], dt.date(2024, 1, 31), dt.date(2024, 2, 1))
        assert some.count() == 2 * 3 * 2 and "month" in scan_of(some)[0] and ("bucket" in scan_of(some)[0]) == (layout != "L0")


def test_stored_is_built_once(spark):
    built = []

    def build(path):
        built.append(path)
        spark.range(3).write.parquet(path)

    name = st.scratch(spark, "name")
    assert st.stored(spark, name, build) == st.stored(spark, name, build) and len(built) == 1
    assert spark.read.parquet(built[0]).count() == 3


@pytest.mark.parametrize("varying", [True, False])
def test_months_round_trip(spark, varying):
    uuid = "0a1b2c3d-0000-5000-8000-00000000000{}"
    rows = []
    for k in range(3):
        for m in (1, 2, 3):
            for d in (3, 4):
                provider = None if m == 1 else "a" if m == 2 or d == 3 or not varying else "b"
                rows.append((f"S{k}", dt.date(2026, m, d), float(k), uuid.format(k), provider, f"run-{m}", None if varying and m == 2 and d == 3 else 7))
    bars = spark.createDataFrame(rows, "security_id string, trade_date date, close double, security_uuid string, provider string, run_id string, quality int")
    at = st.scratch(spark, "months")
    st.write_months(bars, at, ("provider", "run_id", "quality"))
    back = st.read_months(spark, at)
    assert sorted(map(tuple, back.select(*bars.columns).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert back.first().canonical_key == f'["{back.first().security_uuid}","{back.first().trade_date}"]'
    assert spark.read.parquet(f"{at}/facts").schema["security_uuid"].dataType.simpleString() == "binary"
    constants = {r.month: r for r in spark.read.parquet(f"{at}/constants").collect()}
    assert constants[202601].provider__constant and constants[202601].provider is None and constants[202602].run_id == "run-2"
    assert (constants[202603].provider, constants[202603].provider__constant) == ((None, False) if varying else ("a", True))
    if varying:
        sidecar = spark.read.parquet(f"{at}/lineage")
        assert "run_id" not in sidecar.columns and {r.month for r in sidecar.select("month").distinct().collect()} == {202602, 202603}
    one = st.read_months(spark, at, 202602, 202602)
    assert one.count() == 6 and all("month" in f for f in scan_of(one) if f)
    assert st.read_months(spark, at, 202701).count() == 0


def test_panel_is_written_in_one_pass_over_its_input(spark, tmp_path):
    """Prices come with the panel's rows and not by a join of the panel with its own input: the bars are read once."""
    from tidebar.plans.relations import frame

    rows = frame(spark, "/root/testdata/sf0.001", "panel_priced")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    keys = ["security_id", "trade_date"]
    both = frame(spark, "/root/testdata/sf0.001", "panel").join(frame(spark, "/root/testdata/sf0.001", "panel_input").select(*keys, "close", "volume"), keys)
    assert rows.select(sorted(rows.columns)).exceptAll(both.select(sorted(both.columns))).count() == 0 and rows.count() == both.count()


def test_routes_carry_their_reasons(spark):
    """History takes reasons with the routes, without a second look at the bars."""
    from tidebar.plans.relations import frame

    rows = frame(spark, "/root/testdata/sf0.001", "routed_reasons")
    assert rows._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    keys = ["security_id", "trade_date"]
    both = frame(spark, "/root/testdata/sf0.001", "routed").join(frame(spark, "/root/testdata/sf0.001", "panel").select(*keys, "reason"), keys)
    assert rows.select(sorted(rows.columns)).exceptAll(both.select(sorted(both.columns))).count() == 0 and rows.count() == both.count()


def test_month_files_are_not_one_for_each_task_and_month(spark):
    rows = spark.range(2500).selectExpr("concat('S', id % 7) AS security_id", "date_add(DATE '2024-01-01', CAST(id % 360 AS INT)) AS trade_date", "CAST(id AS DOUBLE) AS close", "date_add(DATE '2024-01-01', CAST(id % 2 AS INT)) AS available_on")
    at = st.scratch(spark, "months")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        st.write_months(rows, at)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    facts = spark.read.parquet(f"{at}/facts")
    files = facts.groupBy(F.col("_metadata.file_path").alias("f")).count().count()
    assert facts.count() == 2500 and files <= 12 + 4  # 12 months, 4 tasks
    assert sorted(st.read_months(spark, at).drop("month").select(rows.columns).collect()) == sorted(rows.collect())
