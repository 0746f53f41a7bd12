"""Named checks of artifacts in one scan of their components, and what may be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import canonical as cj

#: Fixed names of the required checks.
CHECKS = (
    "ARTIFACT_MANIFEST_PRESENT_AND_SEALED", "COMPONENT_EXISTENCE", "COMPONENT_CONTENT_HASH", "COMPONENT_SCHEMA_HASH", "COMPONENT_ROW_COUNT", "FEATURE_FAMILY_COVERAGE",
    "FEATURE_SET_VERSION_MATCH", "DATA_SNAPSHOT_BINDING", "IDENTITY_FALLBACK_ZERO", "BLOCKING_DQ_ZERO",
)


def _verdict(testable: Column, passes: Column) -> Column:
    return F.when(~F.coalesce(testable, F.lit(False)), "NOT_TESTABLE").when(F.coalesce(passes, F.lit(False)), "PASS").otherwise("FAIL")


def manifest_seal(component: Column, content: Column) -> list[Column]:
    """Aggregates whose hash seals a set of (component, content), in any order."""
    return [F.sum(c.cast("decimal(20,0)")) for c in cj.lanes(F.sha2(F.concat_ws("|", component.cast("string"), content), 256))]


def validate(artifacts: DataFrame, components: DataFrame, families: list[str], version: str) -> DataFrame:
    """(artifact_id, check_name, verdict): all ten checks for every artifact; nothing to test is not a pass.

    ``artifacts``: artifact_id, manifest_seal, set_version, snapshot_id, bound_snapshot_id. ``components``: artifact_id, component, family, and
    what was declared and found: declared_content, content (null where the component is missing), declared_schema, schema,
    declared_rows, row_count, with a scan's proof: proof_content (what it scanned; stale if that is not what was found), fallback_rows,
    blocking_findings. Components are scanned once, as conditional aggregates by artifact.
    """
    c = F.col
    there = c("content").isNotNull()
    proven = there & c("proof_content").eqNullSafe(c("content"))
    seal = manifest_seal(c("component"), c("declared_content"))
    held = components.groupBy("artifact_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(there).alias("found"), F.count_if(proven).alias("proven"), F.collect_set(F.when(there & c("family").isin(families), c("family"))).alias("families"),
        *[F.count_if(there & c(f"declared_{x}").eqNullSafe(c(y))).alias(f"same_{x}") for x, y in (("content", "content"), ("schema", "schema"), ("rows", "row_count"))],
        F.sum(F.when(proven, c("fallback_rows"))).alias("fallback"), F.sum(F.when(proven, c("blocking_findings"))).alias("blocking"), cj.sums_hash(F.count(F.lit(1)), *seal).alias("seal"),
    )
    out = artifacts.join(held, "artifact_id", "left")
    n, found = F.coalesce("n", F.lit(0)), F.coalesce("found", F.lit(0))
    any_there, all_proven = found > 0, (n > 0) & (c("proven") == n)
    verdicts = (
        _verdict(F.lit(True), c("manifest_seal").isNotNull() & (c("manifest_seal") == c("seal"))), _verdict(n > 0, found == n),
        *[_verdict(any_there, c(f"same_{x}") == found) for x in ("content", "schema", "rows")], _verdict(any_there, F.size("families") == len(families)),
        _verdict(c("set_version").isNotNull(), c("set_version") == version), _verdict(c("bound_snapshot_id").isNotNull(), c("bound_snapshot_id") == c("snapshot_id")),
        _verdict(all_proven, c("fallback") == 0), _verdict(all_proven, c("blocking") == 0),
    )
    checks = F.array(*[F.struct(F.lit(k).alias("check_name"), v.alias("verdict")) for k, v in zip(CHECKS, verdicts)])
    return out.select("artifact_id", F.explode(checks).alias("c")).select("artifact_id", "c.*")


def publish(requests: DataFrame, checks: DataFrame) -> DataFrame:
    """(publish_id, trade_date, version, state): of the requests whose artifact passes every check the latest of a date is PUBLISHED,
    earlier ones are SUPERSEDED; a request whose artifact fails one, or has not all ten, is REFUSED.

    ``requests``: publish_id, artifact_id, trade_date, version.
    """
    passed = checks.where("verdict = 'PASS'").groupBy("artifact_id").agg(F.countDistinct("check_name").alias("k")).where(F.col("k") == len(CHECKS))
    out = requests.join(passed, "artifact_id", "left")
    fit = F.col("k").isNotNull()
    place = F.row_number().over(Window.partitionBy("trade_date", fit).orderBy(F.desc("version"), F.desc("publish_id")))
    state = F.when(~fit, "REFUSED").when(place == 1, "PUBLISHED").otherwise("SUPERSEDED")
    return out.select("publish_id", "trade_date", "version", state.alias("state"))
