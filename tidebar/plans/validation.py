"""Queries on artifact checks and publication (TB-10, TB-12): orders are artifacts, their lines components."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import canonical as cj
from ..operators import validation as va
from . import json_sql as js
from .base import query
from .relations import duck, frame

FAMILIES = ["price", "volume"]
_SEALS = f"SELECT artifact_id, sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {', '.join(f'CAST(sum({x}) AS VARCHAR)' for x in js.lanes(chr(104)))})) AS seal FROM (SELECT artifact_id, sha256(CAST(component AS VARCHAR) || '|' || declared_content) AS h FROM :artifact_parts) q GROUP BY artifact_id"
_WITH = f"""WITH seals AS ({_SEALS}), a AS (SELECT x.*, CASE WHEN artifact_id % 41 = 0 THEN NULL WHEN artifact_id % 43 = 0 THEN 'x' ELSE s.seal END AS manifest_seal, s.seal FROM :artifact_rows x LEFT JOIN seals s USING (artifact_id)),
p AS (SELECT *, content IS NOT NULL AND content IS NOT DISTINCT FROM proof_content AS proven FROM :artifact_parts)"""


def _part(name: str, testable: str, passes: str) -> str:
    return f"SELECT a.artifact_id, '{name}' AS check_name, CASE WHEN NOT {testable} THEN 'NOT_TESTABLE' WHEN {passes} THEN 'PASS' ELSE 'FAIL' END AS verdict FROM a"


_OF = "(SELECT 1 FROM p WHERE p.artifact_id = a.artifact_id{})"
_SOME, _THERE, _STALE = "EXISTS " + _OF.format(""), "EXISTS " + _OF.format(" AND content IS NOT NULL"), "EXISTS " + _OF.format(" AND NOT proven")
_SAME = lambda x, y: "NOT EXISTS " + _OF.format(f" AND content IS NOT NULL AND {x} IS DISTINCT FROM {y}")
CHECKS_SQL = " UNION ALL ".join([
    _part(va.CHECKS[0], "true", "coalesce(manifest_seal = seal, false)"), _part(va.CHECKS[1], _SOME, "NOT EXISTS " + _OF.format(" AND content IS NULL")),
    _part(va.CHECKS[2], _THERE, _SAME("declared_content", "content")), _part(va.CHECKS[3], _THERE, _SAME("declared_schema", '"schema"')), _part(va.CHECKS[4], _THERE, _SAME("declared_rows", "row_count")),
    _part(va.CHECKS[5], _THERE, " AND ".join("EXISTS " + _OF.format(f" AND content IS NOT NULL AND family = '{f}'") for f in FAMILIES)),
    _part(va.CHECKS[6], "(set_version IS NOT NULL)", "set_version = 'v2'"), _part(va.CHECKS[7], "(bound_snapshot_id IS NOT NULL)", "bound_snapshot_id = snapshot_id"),
    _part(va.CHECKS[8], f"({_SOME} AND NOT {_STALE})", "NOT EXISTS " + _OF.format(" AND fallback_rows > 0")), _part(va.CHECKS[9], f"({_SOME} AND NOT {_STALE})", "NOT EXISTS " + _OF.format(" AND blocking_findings > 0")),
])


def _checks(spark, sf_dir):
    parts, rows = frame(spark, sf_dir, "artifact_parts"), frame(spark, sf_dir, "artifact_rows")
    seals = parts.groupBy("artifact_id").agg(cj.sums_hash(F.count(F.lit(1)), *va.manifest_seal(F.col("component"), F.col("declared_content"))).alias("s"))
    k = F.col("artifact_id")
    sealed = rows.join(seals, "artifact_id", "left").withColumn("manifest_seal", F.when(k % 41 == 0, None).when(k % 43 == 0, "x").otherwise(F.col("s"))).drop("s")
    return va.validate(sealed, parts, FAMILIES, "v2")


@query("TB-12", duck(f"{_WITH} {CHECKS_SQL}"))
def artifact_checks(spark, sf_dir):
    return _checks(spark, sf_dir)


@query("TB-10", duck(f"""{_WITH}, c AS ({CHECKS_SQL}), fit AS (SELECT artifact_id FROM c GROUP BY artifact_id HAVING bool_and(verdict = 'PASS'))
SELECT r.publish_id, r.trade_date, r.version, CASE WHEN f.artifact_id IS NULL THEN 'REFUSED' WHEN r.version = (SELECT max(o.version) FROM :publish_requests o JOIN fit USING (artifact_id) WHERE o.trade_date = r.trade_date) THEN 'PUBLISHED' ELSE 'SUPERSEDED' END AS state FROM :publish_requests r LEFT JOIN fit f ON r.artifact_id = f.artifact_id"""))
def publication(spark, sf_dir):
    return va.publish(frame(spark, sf_dir, "publish_requests"), _checks(spark, sf_dir))
