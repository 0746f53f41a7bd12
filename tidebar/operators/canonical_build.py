"""The canonical build: candidates of several source runs to one row for each key, with a decision for every candidate,
findings, and a status that follows from the findings alone.

Edge cases: a candidate without availability is never known to be in time, one without a key or an identity status has no identity;
equal places in the order of sources are decided by run id; without candidates the requested domains are still judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.builds import Build, read_table

#: Fixed names.
HEALTHY, MASTER = "HEALTHY", "security_master"
_FINDING = ("domain", "canonical_key", "finding_class", "provider", "run_id", "n", "blocking")


def decide(candidates: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """Candidates of healthy source runs with decision, winner_run and is_duplicate (a further row of its run with that key).

    ``candidates``: domain, canonical_key, run_id, provider, priority, manifest_hash, ordinal, available_on, identity_status, payload (of any type
    that compares). ``runs``: run_id, domain, role, provider, verification, received_on. Of the rows that are in time and have an identity the
    first by priority, manifest hash and ordinal is selected; equal payloads merge into it, others conflict with it. One shuffle by key.
    """
    c = F.col
    healthy = runs.where((c("role") == "source") & (c("verification") == HEALTHY)).select("run_id").distinct()
    late = ~F.coalesce(c("available_on") <= as_of, F.lit(False))
    nameless = (F.coalesce("identity_status", F.lit("MISSING")) == "MISSING") | c("canonical_key").isNull()
    rows = candidates.join(healthy, "run_id", "left_semi").withColumn("__fit", ~late & ~nameless)
    key = Window.partitionBy("domain", "canonical_key", "__fit")
    order = key.orderBy("priority", "manifest_hash", "ordinal", "run_id")
    rows = rows.withColumns({"__place": F.row_number().over(order), "__first": F.first(F.struct("run_id", "payload")).over(order)})
    again = F.row_number().over(Window.partitionBy("domain", "canonical_key", "__fit", "run_id").orderBy("ordinal")) > 1
    decision = (
        F.when(late, "EXCLUDED_FUTURE").when(nameless, "IDENTITY_MISSING").when(c("__place") == 1, "SELECTED")
        .when(c("payload").eqNullSafe(c("__first.payload")), "EQUIVALENT_MERGED").otherwise("SOURCE_CONFLICT")
    )
    return rows.select(*candidates.columns, decision.alias("decision"), F.when(c("__fit"), c("__first.run_id")).alias("winner_run"), (c("__fit") & again).alias("is_duplicate"))


def _shape(df: DataFrame, finding: str | Column, blocking: Column | bool = True) -> DataFrame:
    """Findings with all columns, those that ``df`` lacks as null."""
    kinds = {"n": "long", **{x: "string" for x in ("domain", "canonical_key", "provider", "run_id")}}
    values = {k: F.col(k) if k in df.columns else F.lit(None).cast(t) for k, t in kinds.items()}
    values |= {"finding_class": F.lit(finding) if isinstance(finding, str) else finding, "blocking": F.lit(blocking) if isinstance(blocking, bool) else blocking}
    return df.select(*[values[k].alias(k) for k in _FINDING])


def findings(decisions: DataFrame, runs: DataFrame, domains: DataFrame, as_of: Column) -> DataFrame:
    """All findings of a build: conflicts and duplicates by row, the rest by run and requested domain.

    ``domains``: domain, identity_missing_max, requires_identity; one row for each domain that was asked for. A domain without a source run is
    missing; one with damaged runs only has the findings of these; one with a healthy run and no candidate in time is unavailable. The
    identity master counts if some domain needs it: damage is named first, then a master that came too late, then none at all.
    """
    c = F.col
    held = decisions.groupBy("domain").agg(F.count_if(c("decision") == "IDENTITY_MISSING").alias("n"), F.count_if(c("decision") != "EXCLUDED_FUTURE").alias("in_time"))
    sources = runs.where("role = 'source'").groupBy("domain").agg(F.count(F.lit(1)).alias("found"), F.count_if(c("verification") == HEALTHY).alias("healthy"))
    asked = domains.join(sources, "domain", "left").join(held, "domain", "left").fillna(0, ["found", "healthy", "n", "in_time"])
    lack = F.when(c("found") == 0, "REQUIRED_DOMAIN_MISSING").when((c("healthy") > 0) & (c("in_time") == 0), "REQUIRED_DOMAIN_UNAVAILABLE_AT_ASOF")
    damaged = runs.where(c("verification") != HEALTHY)
    scope = F.when(c("role") == "source", F.concat(F.lit("input:"), c("domain"))).otherwise(MASTER)
    kind = F.when(c("role") == "source", "CLOSURE_VERIFICATION_FAILED").otherwise("IDENTITY_EVIDENCE_INVALID")
    masters = runs.where("role = 'identity_master'").agg(
        F.count(F.lit(1)).alias("found"), F.count_if(c("verification") != HEALTHY).alias("bad"), F.count_if((c("verification") == HEALTHY) & (c("received_on") <= as_of)).alias("usable")
    )
    no_master = F.when(c("found") == 0, "IDENTITY_DATASET_MISSING").when((c("bad") == 0) & (c("usable") == 0), "IDENTITY_DATASET_UNAVAILABLE_AT_ASOF")
    needed = domains.agg(F.coalesce(F.bool_or("requires_identity"), F.lit(False)).alias("needed"))
    master = masters.join(F.broadcast(needed)).where("needed").withColumn("domain", F.lit(MASTER))  # one row each
    parts = [
        _shape(decisions.where("decision = 'SOURCE_CONFLICT'"), "SOURCE_CONFLICT"), _shape(decisions.where("is_duplicate"), "DUPLICATE_CANONICAL_KEY"),
        _shape(asked.where("n > 0"), "IDENTITY_MISSING", c("n") > c("identity_missing_max")), _shape(asked.where(lack.isNotNull()).drop("n"), lack),
        _shape(damaged.withColumn("domain", scope), kind), _shape(master.where(no_master.isNotNull()), no_master),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def status(found: DataFrame) -> DataFrame:
    """(run_status, error): any blocking finding blocks, and the error names how many and which classes."""
    held = found.agg(F.count_if("blocking").alias("n"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("blocking"), F.col("finding_class")))), "; ").alias("classes"))
    error = F.when(F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" blocking finding(s): "), F.col("classes")))
    return held.select(F.when(F.col("n") > 0, "BLOCKED").otherwise("SUCCESS").alias("run_status"), error.alias("error"))


def build(spark: SparkSession, path: str, candidates: DataFrame, runs: DataFrame, domains: DataFrame, as_of: Column) -> str:
    """Writes decisions by class (the folder of SELECTED is the canonical table), findings and status, then the manifest."""
    b = Build(spark, path)
    decisions = b.write("decisions", decide(candidates, runs, as_of), by=("decision",))
    found = b.write("findings", findings(decisions, runs, domains, as_of))
    state = b.write("status", status(found)).first()
    return b.close(run_status=state.run_status)


def selected(spark: SparkSession, path: str) -> DataFrame:
    """The canonical rows of a finished build; only their folder is read."""
    return read_table(spark, path, "decisions").where("decision = 'SELECTED'").drop("decision", "winner_run", "is_duplicate")
