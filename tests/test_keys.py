"""Canonical JSON, hashes, keys, manifests and column profiles on hand-made rows."""

import datetime as dt
import hashlib
import json
import math
import random

from pyspark.sql import functions as F

from tidebar.functions import canonical as cj
from tidebar.operators import keys as ky

SCHEMA = """b boolean, d double, day date, i int, `a"b` string, list array<double>, m map<string,int>, n decimal(10,2), s string, t timestamp, u struct<z:string,y:double>"""


def value(x):
    """What a double is in canonical JSON."""
    if x == 0 or 1 <= abs(x) < 2**52:
        whole = math.floor(x)
        return {"f": int((x - whole) * 2**52), "i": whole}
    m, e = math.frexp(x)
    return {"e": e - 54, "m": int(m * 2**54)}


def dumped(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_json_of_every_type(spark):
    text = 'q"b\\n\n\t\r\b\f\x01\x1f é😀\x7f'
    row = (True, 1.5, dt.date(2026, 1, 2), -3, text, [0.1, -2.75, None], {"b": 2, "a": None}, None, "", dt.datetime(2026, 1, 2, 3, 4, 5, 6), (None, 1e300))
    got = spark.createDataFrame([row], SCHEMA)
    got = json.loads(out := got.select(cj.row_json(got)).first()[0])
    want = {
        "b": True, "d": value(1.5), "day": "2026-01-02", "i": -3, 'a"b': text, "list": [value(0.1), value(-2.75), None], "m": {"a": None, "b": 2}, "n": None, "s": "",
        "t": "2026-01-02T03:04:05.000006+00:00", "u": {"y": value(1e300), "z": None},
    }
    assert got == want and out == dumped(want)


def test_doubles_are_exact(spark):
    rng = random.Random(1)
    xs = [0.0, -0.0, 1.0, -1.0, 0.1, 1 / 3, -1e-300, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 2.0**52, 2.0**52 - 0.5, 2.0**53 + 2, 1e15, 1.50001, 1.50002]
    xs += [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-1070, 1020) for _ in range(500)] + [s * 2.0**k for k in range(-1074, 1024, 7) for s in (1, -1)]
    xs += [math.nextafter(x, 9) for x in xs]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = {r.i: r.j for r in df.select("i", cj.double_json(F.col("x")).alias("j")).collect()}
    assert all(json.loads(got[i]) == value(x) for i, x in enumerate(xs))
    assert len(set(got.values())) == len({x + 0.0 for x in xs})  # one ulp is another text


def test_error_rows_and_forged_texts(spark):
    df = spark.createDataFrame([("a", math.nan), ("b", math.inf), ("c", 1e15), ("d", None)], "s string, x double")
    got = {r.s: r.h for r in df.select("s", cj.row_hash(df).alias("h")).collect()}
    assert got["a"] is None and got["b"] is None and got["c"] and got["d"] == hashlib.sha256(b'{"s":"d","x":null}').hexdigest()
    loose = {r.s: r.j for r in df.select("s", cj.row_json(df, strict=False).alias("j")).collect()}
    assert json.loads(loose["a"])["x"]["m"] == "NaN" and json.loads(loose["b"])["x"]["m"] == "Infinity"
    two = spark.createDataFrame([('a","t":"b', "c"), ("a", "b")], "s string, t string")
    assert two.select(cj.row_hash(two).alias("h")).distinct().count() == 2
    whole = cj.table_hash(df).first()
    assert whole.table_hash is None and whole.non_finite == 2
    fine = df.where("s in ('c', 'd')")
    assert cj.table_hash(fine).first().table_hash == cj.table_hash(fine.orderBy(F.desc("s")).repartition(3)).first().table_hash
    assert cj.table_hash(fine).first().table_hash != cj.table_hash(fine.unionByName(fine)).first().table_hash
    assert cj.table_hash(df.limit(0)).first().n == 0


def test_keys(spark):
    key = spark.createDataFrame([("daily_bar", 'S"1', "2026-01-02"), ("adjustment_factor", "S1", "2026-01-02"), ("industry", "S1", "x"), ("daily_bar", None, "x")], "d string, s string, t string")
    got = [r[0] for r in key.select(ky.natural_key(F.col("d"), F.col("s"), F.col("t"), F.lit("SINGLE"))).collect()]
    assert got == ['["S\\"1","2026-01-02"]', '["S1","2026-01-02","SINGLE"]', None, None]
    cases = {
        '["S1","D"]': "VALID", '["S1", "D"]': "NOT_CANONICAL", '["S1",""]': "BAD_PART", '["S1",5]': "BAD_PART", '["S1",null]': "BAD_PART", '["S1"]': "ARITY", "[]": "ARITY",
        '["S2","D"]': "PARTS_DISAGREE", '{"a":1}': "NOT_AN_ARRAY", "7": "NOT_AN_ARRAY", "S1": "NOT_JSON", "": "NOT_JSON", '["S1","D"': "NOT_JSON", '["\\u0053\\u0031","D"]': "NOT_CANONICAL",
    }
    df = spark.createDataFrame([(k, "S1", "D") for k in cases], "k string, s string, t string")
    got = {r.k: r.v for r in df.select("k", ky.key_verdict(F.lit("daily_bar"), F.col("k"), F.col("s"), F.col("t")).alias("v")).collect()}
    assert got == cases


def test_profile_and_manifests(spark):
    df = spark.createDataFrame([(1, "x", None, 1.0), (1, "x", None, 1.0), (2, "x", None, math.nan), (2, "y", 3, math.nan), (3, None, 3, 2.0), (3, "x", 3, 2.5)], "month int, a string, b int, c double")
    got = {(r.month, r.column_name): (r.is_constant, r.value) for r in ky.column_profile(df, ["month"]).collect()}
    assert got[1, "a"] == (True, '"x"') and got[1, "b"] == (True, "null") and got[1, "c"][0]
    assert got[2, "a"] == (False, None) and got[2, "b"] == (False, None) and got[2, "c"][0]
    assert got[3, "a"] == (False, None) and got[3, "b"] == (True, "3") and not got[3, "c"][0]
    bars = spark.createDataFrame([(m, "S", dt.date(2026, m, 3), 1.0, dt.date(2026, m, 4)) for m in (1, 2, 3, 4, 5)], "month int, security_id string, trade_date date, close double, available_on date")
    odd = bars.where("month <> 5").unionByName(bars.where("month = 1")).withColumns({
        "close": F.when(F.col("month") == 2, 1.0000001).otherwise(F.col("close")), "available_on": F.when(F.col("month") == 3, F.date_add("available_on", 1)).otherwise(F.col("available_on")),
    })
    result = ky.compare_manifests(ky.partition_manifest(odd, "month"), ky.partition_manifest(bars.where("month <> 4"), "month"), "month", F.lit("2030-01-01").cast("date"))
    assert {r.month: r.verdict for r in result.collect()} == {1: "COUNT", 2: "CONTENT", 3: "VINTAGE", 4: "MISSING", 5: "UNDECLARED"}


def test_fact_hashes(spark):
    facts = spark.createDataFrame([("a", "v1"), ("a", "v2"), ("b", "v1")], "s string, version string")
    a, b, c = ky.fact_hashes(facts, ["s"], "version").orderBy("s", "version").collect()
    assert a.fact_hash != b.fact_hash and a.review_hash == b.review_hash != c.review_hash


def test_doubles_beside_powers_of_two_need_no_function(spark):
    """The short way gives mantissa and exponent as the long one does, and as Python has them."""
    xs = [s * y for k in (-899, -60, -55, -3, -1, 52, 53, 60, 899) for y in (2.0**k, math.nextafter(2.0**k, 0), math.nextafter(2.0**k, math.inf)) for s in (1, -1)]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", cj._scaled_near(F.col("x")).alias("a"), cj._scaled(F.col("x")).alias("b")).collect():
        m, e = math.frexp(r.x)
        assert r.a == r.b == f'{{"e":{e - 54},"m":{int(m * 2**54)}}}'


def test_sums_of_lanes_are_those_of_the_digits(spark):
    df = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).unionByName(spark.createDataFrame([("f" * 64,), ("0" * 64,), (None,)], "h string"))
    hashes = [r.h for r in df.collect() if r.h]
    got = df.select(*[w.alias(f"w{i}") for i, w in enumerate(cj.wide_lanes(F.col("h")))]).agg(*cj.lane_sums([F.col(f"w{i}") for i in range(4)])).first()
    assert [int(x) for x in got] == [sum(int(h[8 * i : 8 * i + 8], 16) for h in hashes) for i in range(8)]


def test_texts_with_quotes_and_controls(spark):
    texts = ['["S1","D"]', 'a\\"b', 'x"\x01\ny', "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [None if r.j is None else json.loads(r.j) for r in df.select(cj.text_json(F.col("t")).alias("j")).collect()] == texts
