"""Strict projection, contexts without secrets and quarantine."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.operators import projection as pj
from tidebar.sources import builds as bd
from tidebar.sources import storage as st

GOOD = {n: "x" for n, kind in pj.LINEAGE.items() if kind == "string"} | {
    "canonical_domain": "daily_bar", "canonical_key": '["S1","2020-01-02"]', "security_id": "S1", "trade_date": "2020-01-02", "available_at": "2020-01-02T08:00:00+00:00", "ingested_at": "2020-01-02T16:00:00.5+08:00",
    "source_row_ordinal": 3, "close": 1, "open": 1.5, "high": None, "extra": {"a": 1},
}
AS_OF = "2020-01-03 00:00:00 UTC"


def project(spark, docs, domain="daily_bar"):
    rows = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string").select(F.parse_json("t").alias("doc"))
    return pj.project(rows, domain, "run", "snap", F.lit(AS_OF).cast("timestamp"))


def test_a_good_row(spark):
    (r,) = project(spark, [GOOD]).collect()
    assert r.violation is None and (r.close, r.open, r.high, r.low, r.source_row_ordinal, str(r.trade_date), r.canonical_run_id, r.snapshot_id) == (1.0, 1.5, None, None, 3, "2020-01-02", "run", "snap")
    assert len(r) == 2 + 1 + 7 + 15 + 2 + 1


@pytest.mark.parametrize(
    "change, violation",
    [
        ({"canonical_domain": "limit_price"}, "FOREIGN_DOMAIN"), ({"canonical_key": None}, "KEY:MISSING"), ({"canonical_key": '["S1"]'}, "KEY:ARITY"), ({"canonical_key": '["S1", "2020-01-02"]'}, "KEY:NOT_CANONICAL"),
        ({"canonical_key": '["S2","2020-01-02"]'}, "PARTS_DISAGREE"), ({"canonical_key": '["S1","2020-01-03"]'}, "PARTS_DISAGREE"), ({"security_id": None}, "NULL:security_id"), ({"security_id": 1}, "TYPE:security_id"),
        ({"close": "1"}, "TYPE:close"), ({"close": True}, "TYPE:close"), ({"source_row_ordinal": 1.5}, "TYPE:source_row_ordinal"), ({"source_row_ordinal": "3"}, "TYPE:source_row_ordinal"), ({"source_row_ordinal": True}, "TYPE:source_row_ordinal"),
        ({"trade_date": "2020-02-30"}, "TYPE:trade_date"), ({"trade_date": "20200102"}, "TYPE:trade_date"), ({"available_at": "2020-01-02T08:00:00"}, "TYPE:available_at"), ({"available_at": "2020-01-03T00:00:01Z"}, "FUTURE"),
        ({"available_at": "2020-01-03T08:00:00+08:00"}, None), ({"availability_basis": ""}, None), ({"close": 1e300}, None),
    ],
)
def test_violations(spark, change, violation):
    assert project(spark, [GOOD | change]).first().violation == violation


def test_a_part_of_the_key_is_a_column(spark):
    doc = GOOD | {"canonical_domain": "adjustment_factor", "canonical_key": '["S1","2020-01-02","SINGLE"]', "adj_factor": 2}
    r = project(spark, [doc], "adjustment_factor").first()
    assert r.violation is None and (r.factor_type, r.adj_factor) == ("SINGLE", 2.0)
    missing = {k: v for k, v in doc.items() if k != "ingested_at"}
    assert project(spark, [missing], "adjustment_factor").first().violation == "NULL:ingested_at"
    assert not project(spark, [], "adjustment_factor").collect()


DEEP = {"a": [{"b": {"API_Token": [1, {"x": 2}], "ok": "t"}}], "passWord": "p", "n": 1, "list": ["token"]}


def test_secrets_at_any_depth_go(spark):
    deeper = {"credentialed": 1}
    for _ in range(60):
        deeper = {"k": [deeper]}
    broken = '{"token": "x"'
    texts = [json.dumps(DEEP), json.dumps(deeper), broken, None, "3", '{"a":1e999}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    got = [r[1] for r in df.select("i", pj.scrub_json(F.col("t"))).orderBy("i").collect()]
    assert json.loads(got[0]) == {"a": [{"b": {"API_Token": "[REDACTED]", "ok": "t"}}], "passWord": "[REDACTED]", "n": 1, "list": ["token"]}
    assert '"credentialed":"[REDACTED]"' in got[1] and got[2:] == [None, None, "3", None]
    assert json.loads(df.where("i = 0").select(pj.scrub_json(F.col("t"), None)).first()[0]) == {"a": [{"b": {"ok": "t"}}], "n": 1, "list": ["token"]}


def test_typed_secrets_go(spark):
    kind = T.StructType.fromDDL("a array<struct<my_token: string, ok: map<string, struct<secret: int, n: int>>>>, n int")
    df = spark.createDataFrame([(([("t", {"x": (1, 2), "Password": (3, 4)})], 5),), (None,)], T.StructType([T.StructField("v", kind)]))
    got = [r[0] for r in df.select(pj.scrub(F.col("v"), kind)).collect()]
    assert got[1] is None and got[0].n == 5 and got[0].a[0].my_token is None
    assert {k: tuple(v) for k, v in got[0].a[0].ok.items()} == {"x": (None, 2)}


def test_quarantine_accounts_for_every_row(spark):
    rows = spark.createDataFrame([("r", 1, "k", 1.0), ("r", 2, None, float("nan")), ("r", 2, None, None), ("s", 1, "z", 2.0)], "request_id string, ordinal int, api_token string, x double")
    at = pj.quarantine(spark, st.scratch(spark, "quarantine"), rows, F.when(F.col("ordinal") == 2, "BAD"), ["request_id", "ordinal"], ["api_token", "x"])
    facts = bd.manifest(spark, at).first().facts
    assert facts == {"input_rows": "4", "mapped_rows": "2", "quarantined_rows": "2"}
    bad = bd.read_table(spark, at, "quarantine").collect()
    assert {r.error_class for r in bad} == {"BAD"} and all(json.loads(r.context)["api_token"] == "[REDACTED]" for r in bad) and len({r.quarantine_id for r in bad}) == 1
    assert {(r.request_id, r.ordinal) for r in bd.read_table(spark, at, "mapped").collect()} == {("r", 1), ("s", 1)}


def test_a_document_is_taken_apart_once(spark):
    """One look at the document, not several for each column, and the same texts with and without escapes."""
    texts = ["plain", 'a "quoted" one', "back\\slash", "line\nend", "\u00e9\u4e2d", ""]
    docs = spark.createDataFrame([(i, json.dumps({"canonical_domain": x, "volume": 9007199254740993, "source_row_ordinal": -3})) for i, x in enumerate(texts)], "i int, t string").selectExpr("parse_json(t) AS doc")
    out = pj.project(docs, "daily_bar", "run", "snapshot", F.lit("2024-01-01").cast("timestamp"))
    assert sorted(r.canonical_domain for r in out.collect()) == sorted(texts)
    assert {(r.volume, r.source_row_ordinal) for r in out.select("volume", "source_row_ordinal").collect()} == {(9007199254740992.0, -3)}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("doc#") < 12
