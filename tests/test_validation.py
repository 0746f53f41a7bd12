"""Artifact checks and publication on hand-made artifacts."""

import datetime as dt

from pyspark.sql import functions as F

from tidebar.functions import canonical as cj
from tidebar.operators import validation as va
from tidebar.sources import storage as st

PART = "artifact_id int, component int, family string, declared_content string, content string, declared_schema string, schema string, declared_rows long, row_count long, proof_content string, fallback_rows long, blocking_findings long"


def part(a, c, **change):
    row = dict(artifact_id=a, component=c, family="price" if c else "volume", declared_content="c", content="c", declared_schema="s", schema="s", declared_rows=5, row_count=5, proof_content="c", fallback_rows=0, blocking_findings=0)
    return tuple((row | change).values())


CASES = {
    1: ({}, {}, {}), 2: (dict(content=None), {}, {"COMPONENT_EXISTENCE": "FAIL", "FEATURE_FAMILY_COVERAGE": "FAIL", "IDENTITY_FALLBACK_ZERO": "NOT_TESTABLE", "BLOCKING_DQ_ZERO": "NOT_TESTABLE"}),
    3: (dict(content="x", proof_content="x"), {}, {"COMPONENT_CONTENT_HASH": "FAIL"}), 4: (dict(schema="t"), {}, {"COMPONENT_SCHEMA_HASH": "FAIL"}), 5: (dict(row_count=4), {}, {"COMPONENT_ROW_COUNT": "FAIL"}),
    6: (dict(family="other"), {}, {"FEATURE_FAMILY_COVERAGE": "FAIL"}), 7: ({}, dict(set_version="v1"), {"FEATURE_SET_VERSION_MATCH": "FAIL"}), 8: ({}, dict(bound_snapshot_id="y"), {"DATA_SNAPSHOT_BINDING": "FAIL"}),
    9: (dict(fallback_rows=1), {}, {"IDENTITY_FALLBACK_ZERO": "FAIL"}), 10: (dict(blocking_findings=2), {}, {"BLOCKING_DQ_ZERO": "FAIL"}), 11: (dict(proof_content="old"), {}, {"IDENTITY_FALLBACK_ZERO": "NOT_TESTABLE", "BLOCKING_DQ_ZERO": "NOT_TESTABLE"}),
    12: ({}, dict(manifest_seal="x"), {"ARTIFACT_MANIFEST_PRESENT_AND_SEALED": "FAIL"}), 13: ({}, dict(set_version=None, bound_snapshot_id=None), {"FEATURE_SET_VERSION_MATCH": "NOT_TESTABLE", "DATA_SNAPSHOT_BINDING": "NOT_TESTABLE"}),
}


def checked(spark):
    parts = spark.createDataFrame([part(a, 0, **c) for a, (c, _, _) in CASES.items()] + [part(a, 1) for a in CASES], PART)
    seals = {r.artifact_id: r.s for r in parts.groupBy("artifact_id").agg(cj.sums_hash(F.count(F.lit(1)), *va.manifest_seal(F.col("component"), F.col("declared_content"))).alias("s")).collect()}
    base = lambda a: dict(artifact_id=a, manifest_seal=seals.get(a), set_version="v2", snapshot_id="n", bound_snapshot_id="n")
    rows = [tuple((base(a) | c).values()) for a, (_, c, _) in CASES.items()] + [tuple(base(99).values())]
    artifacts = spark.createDataFrame(rows, "artifact_id int, manifest_seal string, set_version string, snapshot_id string, bound_snapshot_id string")
    return va.validate(artifacts, parts, ["price", "volume"], "v2")


def test_each_check_has_its_failure(spark):
    got = {(r.artifact_id, r.check_name): r.verdict for r in checked(spark).collect()}
    for a, (_, _, odd) in CASES.items():
        assert {k: got[a, k] for k in va.CHECKS} == {k: odd.get(k, "PASS") for k in va.CHECKS}, a
    without = {k: got[99, k] for k in va.CHECKS}  # an artifact without components
    assert without["ARTIFACT_MANIFEST_PRESENT_AND_SEALED"] == "FAIL" and without["COMPONENT_EXISTENCE"] == without["BLOCKING_DQ_ZERO"] == "NOT_TESTABLE"


def test_only_artifacts_that_pass_all_are_published(spark):
    day = dt.date(2026, 1, 5)
    requests = [("a", 1, day, 1), ("b", 3, day, 9), ("c", 1, day, 4), ("d", 1, day + dt.timedelta(1), 2), ("e", 77, day, 5)]
    got = {r.publish_id: r.state for r in va.publish(spark.createDataFrame(requests, "publish_id string, artifact_id int, trade_date date, version int"), checked(spark)).collect()}
    assert got == {"a": "SUPERSEDED", "b": "REFUSED", "c": "PUBLISHED", "d": "PUBLISHED", "e": "REFUSED"}


def test_compaction_keeps_rows_and_bounds_files(spark):
    a, b = st.scratch(spark, "fragments"), st.scratch(spark, "packed")
    rows = spark.range(20_000).selectExpr("id AS k", "id % 3 AS month", "cast(rand(1) AS string) AS x")
    rows.repartition(40).write.partitionBy("month").parquet(a)
    st.compact(spark, a, b, ["month"], ["k"], file_bytes=60_000)
    back = spark.read.parquet(b)
    files = back.select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    assert sorted(map(tuple, back.select("k", "month").collect())) == sorted((i, i % 3) for i in range(20_000))
    assert 3 <= len(files) < 30 and max(f.file_size for f in files) < 120_000
