"""Golden cases: verdicts of lines, structural statistics, gates, readiness and comparison."""

import hashlib
import json

import pytest

from tidebar.operators import golden as gd
from tidebar.sources import storage as st

BASE = {
    "case_type": "golden_st_transition", "provider_symbol": "000001.SZ", "trade_date": "2020-01-02", "event_id": "e", "event_class": "ST_TRANSITION", "event_subtype": "ST_ADD",
    "event_effective_date": "2020-01-02", "truth_version": "v4", "review_status": "COMPILED", "compiled_by": "x", "compiled_at": "2024-01-01", "expected_fields": {"b": True, "a": "1"},
}
REVIEWED = {"review_status": "REVIEWED"} | {c: "y" for c in gd.REVIEW}


def sealed(case_id, **changes):
    doc = BASE | {"case_id": case_id} | changes
    fact = {c: doc.get(c) for c in gd.FACT} | {"expected_fields": json.dumps(doc["expected_fields"], sort_keys=True, separators=(",", ":"))}
    return {"case_semantic_hash": hashlib.sha256(json.dumps(fact, sort_keys=True, separators=(",", ":")).encode()).hexdigest()} | doc


def without(doc, name):
    return {k: v for k, v in doc.items() if k != name}


def cases(spark, docs):
    at = st.scratch(spark, "golden")
    spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string").coalesce(1).write.text(at)
    return gd.read_cases(spark, at, "v4")


LINES = [
    (sealed("a"), "VALID"), (sealed("r", **REVIEWED), "VALID"), ("{broken", "INVALID_JSON"), (without(sealed("b"), "compiled_by"), "MISSING_SEAL_FIELD"), (without(sealed("c"), "case_id"), "MISSING_SEAL_FIELD"),
    (sealed("d", truth_version="v3"), "TRUTH_VERSION"), (sealed("e", reviewed_by="me"), "COMPILED_WITH_REVIEW"), (sealed("f", **(REVIEWED | {"source_artifact_hash": ""})), "REVIEW_INCOMPLETE"),
    (sealed("g") | {"trade_date": "2020-01-03"}, "SEMANTIC_HASH"), (sealed("h") | {"expected_fields": {"a": "1", "b": False}}, "SEMANTIC_HASH"), (sealed("i"), "DUPLICATE_ID"), (sealed("i", event_id="z"), "DUPLICATE_ID"),
]


def test_verdicts_of_lines(spark):
    got = cases(spark, [d for d, _ in LINES]).select("case_id", "verdict").collect()
    assert sorted((r.case_id or "", r.verdict) for r in got) == sorted((d.get("case_id", "") if isinstance(d, dict) else "", v) for d, v in LINES)


EVENTS = [
    sealed("1"), sealed("2"), sealed("3", event_subtype="STAR_ST_REMOVE"), sealed("4", event_subtype="OTHER"), sealed("5", event_effective_date="2020-13-01"), sealed("6", event_effective_date=None),
    sealed("7", case_type="golden_delisted", event_class="DELIST"), sealed("8", case_type="golden_delisted", event_class="DELIST", provider_symbol="000002.SZ", event_effective_date=None),
    sealed("9", case_type="golden_limit_regime", event_class="LIMIT"), sealed("10", case_type="golden_limit_regime", event_class="LIMIT"), sealed("11", case_type="x", event_class="", **REVIEWED),
]


def test_statistics_and_gates(spark):
    stats = gd.statistics(cases(spark, EVENTS))
    got = {(r.statistic, r.subject): r.n for r in stats.collect()}
    assert got == {
        ("case_count", ""): 11, ("counts_by_type", "golden_st_transition"): 6, ("counts_by_type", "golden_delisted"): 2, ("counts_by_type", "golden_limit_regime"): 2, ("counts_by_type", "x"): 1,
        ("review_summary", "COMPILED"): 10, ("review_summary", "REVIEWED"): 1, ("distinct_events", "ST_TRANSITION"): 2, ("distinct_events", "DELIST"): 1, ("distinct_events", "LIMIT"): 1,
        ("st_add_events", ""): 1, ("st_remove_events", ""): 1, ("distinct_delisted_securities", ""): 2, ("invalid_structural_cases", "ST_TRANSITION"): 3, ("invalid_structural_cases", "DELIST"): 1,
    }
    met = {(r.statistic, r.subject): (r.n, r.is_met) for r in gd.gates(stats).collect()}
    assert len(met) == 11 and met["counts_by_type", "golden_corporate_action"] == (0, False)
    assert {k for k, v in met.items() if v[1]} == {("st_add_events", ""), ("st_remove_events", "")}


@pytest.mark.parametrize("n, add, is_met", [(49, 1, False), (50, 50, False), (50, 49, True)])
def test_transitions_need_both_kinds(spark, n, add, is_met):
    docs = [sealed(str(i), event_id=str(i), provider_symbol=f"{i:06d}.SZ", event_subtype="ST_ADD" if i < add else "ST_REMOVE") for i in range(n)]
    gate = gd.gates(gd.statistics(cases(spark, docs))).where("subject IN ('ST_TRANSITION', 'golden_st_transition') OR statistic LIKE 'st_%'").collect()
    assert len(gate) == 5 and all(r.is_met for r in gate) == is_met


def test_readiness(spark):
    df = cases(spark, EVENTS[:3] + EVENTS[8:9])
    declared = gd.statistics(df).where("statistic <> 'case_count'")
    assert all(r.passes for r in gd.readiness(df, declared, 4, 2).collect())
    failed = {(r.check_name, r.subject) for r in gd.readiness(cases(spark, EVENTS), declared, 3, 1).collect() if not r.passes}
    assert failed == {
        ("TRUTH_VERSION", ""), ("MANIFEST_SCHEMA", ""), ("INVALID_STRUCTURE", ""), ("NOT_COMPILED", ""), ("HAS_REVIEW_FIELDS", ""), ("DECLARED:distinct_events", "DELIST"), ("DECLARED:distinct_delisted_securities", ""),
    }


def test_comparison(spark):
    rows = spark.createDataFrame(
        [("000001.SZ", "2020-01-02", "1", "10", None), ("000002", "2020-01-02", "0", "5", "x"), ("000003.SZ", "2020-01-02", None, "1.5", "")], "symbol string, day string, st string, price string, note string"
    )
    tests = [
        ("000001.SZ", {"st": True, "price": 10}, "PASS", ""), ("000001.SZ", {"st": False, "price": "11", "gone": "x"}, "FAIL_VALUE", "gone,price,st"), ("000002.SH", {"st": False, "note": "x"}, "PASS", ""),
        ("000003", {"st": False, "price": 1.5}, "PASS", ""), ("000004.SZ", {"st": True}, "FAIL_MISSING", None), ("000001.SZ", {}, "PASS", ""), ("000001.SZ", {"note": None}, "PASS", ""),
    ]
    got = gd.compare(cases(spark, [sealed(str(i), provider_symbol=s, expected_fields=e) for i, (s, e, _, _) in enumerate(tests)]), rows, "symbol", "day")
    assert {int(r.case_id): (r.verdict, r.mismatches) for r in got.collect()} == {i: (v, m) for i, (_, _, v, m) in enumerate(tests)}
