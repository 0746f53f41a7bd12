"""Golden cases: known facts as JSON lines, what is wrong with them, statistics and gates over them, and rows held against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import struct_json
from ..functions.canonical import T as types

_TEXTS = (
    "case_id", "case_type", "provider_symbol", "trade_date", "event_id", "event_class", "event_subtype", "event_effective_date", "truth_version", "review_status", "compiled_by", "compiled_at",
    "reviewed_by", "reviewed_at", "review_note", "source_artifact_ref", "source_artifact_hash", "source_artifact_kind", "source_retrieved_at", "case_semantic_hash",
)
SCHEMA = ", ".join(f"{c} string" for c in _TEXTS) + ", expected_fields variant, _corrupt string"
#: Fields that every case must have, and those of a review. Fixed values.
SEAL = ("case_semantic_hash", "truth_version", "review_status", "compiled_by", "compiled_at", "event_id", "event_class")
REVIEW = ("reviewed_by", "reviewed_at", "source_artifact_ref", "source_artifact_hash", "source_artifact_kind", "source_retrieved_at")
#: What the hash of a case covers.
FACT = ("case_type", "provider_symbol", "trade_date", "event_id", "event_class", "event_subtype", "event_effective_date")
#: Least numbers of rows by type, of distinct events by class, and the subtypes of a transition. Fixed values.
MINIMA = {"golden_st_transition": 50, "golden_delisted": 20, "golden_limit_regime": 30, "golden_corporate_action": 20}
DISTINCT_MINIMA = {"ST_TRANSITION": 50, "DELIST": 20}
DELISTED_SYMBOLS = 20
ADDS, REMOVES = ("ST_ADD", "STAR_ST_ADD"), ("ST_REMOVE", "STAR_ST_REMOVE")


def semantic_hash() -> Column:
    """SHA-256 of the canonical JSON of a case's fact; expected fields as JSON text with their names in order."""
    fields = {c: (F.col(c), types.StringType()) for c in FACT} | {"expected_fields": (F.to_json("expected_fields"), types.StringType())}
    return F.sha2(struct_json(fields), 256)


def _given(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def read_cases(spark: SparkSession, path: str, truth_version: str) -> DataFrame:
    """Typed cases of JSON lines with a ``verdict``, the first that holds.

    INVALID_JSON; MISSING_SEAL_FIELD; TRUTH_VERSION (another than asked for); COMPILED_WITH_REVIEW; REVIEW_INCOMPLETE;
    SEMANTIC_HASH (the fact was changed after it was sealed); DUPLICATE_ID (each of them); VALID. A case without an id is MISSING_SEAL_FIELD.
    """
    raw = spark.read.schema(SCHEMA).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    missing = ~_given("case_id")
    for c in SEAL:
        missing |= F.col(c).isNull()
    complete = F.lit(True)
    for c in REVIEW:
        complete &= _given(c)
    alone = (
        F.when(F.col("_corrupt").isNotNull(), "INVALID_JSON").when(missing, "MISSING_SEAL_FIELD").when(F.col("truth_version") != truth_version, "TRUTH_VERSION")
        .when((F.col("review_status") == "COMPILED") & (_given("reviewed_by") | _given("reviewed_at")), "COMPILED_WITH_REVIEW")
        .when((F.col("review_status") == "REVIEWED") & ~complete, "REVIEW_INCOMPLETE").when(semantic_hash() != F.col("case_semantic_hash"), "SEMANTIC_HASH")
    )
    judged = raw.withColumn("verdict", alone)
    again = judged.where(_given("case_id")).groupBy("case_id").agg((F.count(F.lit(1)) > 1).alias("again"))
    out = judged.join(again, "case_id", "left").withColumn("verdict", F.coalesce("verdict", F.when(F.col("again"), "DUPLICATE_ID"), F.lit("VALID")))
    return out.select(*_TEXTS, "expected_fields", "verdict")


def structural() -> Column:
    """Whether a transition or a delisting has the identity that its class needs; null for other classes."""
    day = F.col("event_effective_date")
    dated = F.coalesce(day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.expr("try_to_date(event_effective_date, 'yyyy-MM-dd')").isNotNull(), F.lit(False))
    kind = F.coalesce(F.col("event_subtype").isin(*ADDS, *REMOVES), F.lit(False))
    return F.when(F.col("event_class") == "ST_TRANSITION", _given("provider_symbol") & dated & kind).when(F.col("event_class") == "DELIST", _given("provider_symbol") & dated)


def statistics(cases: DataFrame) -> DataFrame:
    """(statistic, subject, n) of all cases, in long form.

    Rows by type and by review status; distinct events by class, which for transitions are (symbol, day, subtype), for
    delistings (symbol, day), for others event ids; transitions that add and that remove; delisted symbols; rows without the identity that
    their class needs, by class. One row for each case and statistic, then distinct ones, then counts.
    """
    ok, c = structural(), F.col
    at = lambda statistic, subject, key, when: F.when(when, F.struct(F.lit(statistic).alias("statistic"), F.coalesce(subject, F.lit("")).alias("subject"), key.alias("key")))
    none, own = F.lit(""), F.array(c("case_id"))
    event = F.array("provider_symbol", "event_effective_date", "event_subtype")
    is_st, is_delist = c("event_class") == "ST_TRANSITION", c("event_class") == "DELIST"
    other = ~is_st & ~is_delist & (c("event_class") != "")
    facts = F.array(
        at("case_count", none, own, F.lit(True)), at("counts_by_type", c("case_type"), own, F.lit(True)), at("review_summary", c("review_status"), own, F.lit(True)),
        at("distinct_events", c("event_class"), event, is_st & ok), at("distinct_events", c("event_class"), F.array("provider_symbol", "event_effective_date"), is_delist & ok),
        at("distinct_events", c("event_class"), F.array("event_id"), other & _given("event_id")), at("st_add_events", none, event, is_st & ok & c("event_subtype").isin(*ADDS)),
        at("st_remove_events", none, event, is_st & ok & c("event_subtype").isin(*REMOVES)), at("distinct_delisted_securities", none, F.array("provider_symbol"), is_delist),
        at("invalid_structural_cases", c("event_class"), own, ~ok),
    )
    each = cases.select(F.explode(F.filter(facts, lambda x: x.isNotNull())).alias("x")).select("x.*")
    return each.distinct().groupBy("statistic", "subject").agg(F.count(F.lit(1)).alias("n"))


def _bounds(spark: SparkSession) -> DataFrame:
    rows = [("counts_by_type", k, v, None) for k, v in MINIMA.items()] + [("distinct_events", k, v, None) for k, v in DISTINCT_MINIMA.items()]
    rows += [("st_add_events", "", 1, None), ("st_remove_events", "", 1, None), ("distinct_delisted_securities", "", DELISTED_SYMBOLS, None)]
    rows += [("invalid_structural_cases", k, None, 0) for k in DISTINCT_MINIMA]
    return spark.createDataFrame(rows, "statistic string, subject string, at_least long, at_most long")


def gates(stats: DataFrame) -> DataFrame:
    """(statistic, subject, n, at_least, at_most, is_met): quantity and coverage; what no case counts for is 0."""
    out = F.broadcast(_bounds(stats.sparkSession)).join(stats, ["statistic", "subject"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    met = (F.col("n") >= F.coalesce("at_least", "n")) & (F.col("n") <= F.coalesce("at_most", "n"))
    return out.select("statistic", "subject", "n", "at_least", "at_most", met.alias("is_met"))


#: Declared statistics that must equal the ones worked out from the rows.
DECLARED = ("distinct_events", "st_add_events", "st_remove_events", "distinct_delisted_securities")


def readiness(cases: DataFrame, declared: DataFrame, truth_version: int, manifest_schema: int) -> DataFrame:
    """(check_name, subject, n, expected, passes): whether cases may go to review.

    The version is 4 or later and the manifest's schema 2 or later; no row lacks its structural identity; none has left COMPILED;
    none has a field of a review; and each statistic in ``declared`` (statistic, subject, n) equals the recomputed one, those that one side lacks included.
    """
    spark = cases.sparkSession
    fixed = spark.createDataFrame([("TRUTH_VERSION", "", truth_version, 4, truth_version >= 4), ("MANIFEST_SCHEMA", "", manifest_schema, 2, manifest_schema >= 2)], "check_name string, subject string, n long, expected long, passes boolean")
    reviewed = F.lit(False)
    for c in (*REVIEW, "review_note"):
        reviewed |= _given(c)
    counts = cases.agg(
        F.count_if(~structural()).alias("INVALID_STRUCTURE"), F.count_if(~F.col("review_status").eqNullSafe("COMPILED")).alias("NOT_COMPILED"), F.count_if(reviewed).alias("HAS_REVIEW_FIELDS")
    ).unpivot([], ["INVALID_STRUCTURE", "NOT_COMPILED", "HAS_REVIEW_FIELDS"], "check_name", "n")
    counts = counts.select("check_name", F.lit("").alias("subject"), "n", F.lit(0).cast("long").alias("expected"), (F.col("n") == 0).alias("passes"))
    stats = statistics(cases).where(F.col("statistic").isin(*DECLARED))
    stated = declared.where(F.col("statistic").isin(*DECLARED))
    both = stats.join(stated.select("statistic", "subject", F.col("n").alias("expected")), ["statistic", "subject"], "full")
    agree = both.select(F.concat(F.lit("DECLARED:"), "statistic").alias("check_name"), "subject", "n", "expected", F.col("n").eqNullSafe(F.col("expected")).alias("passes"))
    return fixed.unionByName(counts).unionByName(agree)


def compare(cases: DataFrame, rows: DataFrame, symbol: str, date: str) -> DataFrame:
    """(case_id, verdict, mismatches): each case's expected fields against the row of its symbol and day.

    Without such a row the row of a bare code is taken, or of any symbol with the code where the case has a bare one; with none the verdict is
    FAIL_MISSING. ``trade_date`` of a case is yyyy-MM-dd. An expected boolean is met by 1, 1.0, true or True for true and by anything else,
    null included, for false; other values are compared as text. ``mismatches`` are the names in order. A row that comes twice is compared twice.
    """
    names = [c for c in rows.columns if c not in (symbol, date)]
    held = rows.select(F.col(symbol).alias("__s"), F.col(date).cast("string").alias("__d"), F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))]).alias("__row"))
    bare = held.select(F.split_part("__s", F.lit("."), F.lit(1)).alias("__b"), "__d", "__s", "__row").groupBy("__b", "__d").agg(F.min_by("__row", "__s").alias("__bare"))
    code = F.split_part("provider_symbol", F.lit("."), F.lit(1))
    exact = cases.select("case_id", "provider_symbol", "trade_date", "expected_fields").join(held, (F.col("provider_symbol") == F.col("__s")) & (F.col("trade_date") == F.col("__d")), "left").drop("__d", "__s")
    both = exact.join(bare, (code == F.col("__b")) & (F.col("trade_date") == F.col("__d")) & F.col("__row").isNull(), "left")
    row = F.coalesce("__row", "__bare")
    wanted = F.map_entries(F.col("expected_fields").cast("map<string,variant>"))

    def differs(e: Column) -> Column:
        got, text = F.get(F.transform(F.array(row), lambda r: F.try_element_at(r, e.key)), F.lit(0)), e.value.cast("string")
        is_flag = F.schema_of_variant(e.value) == "BOOLEAN"
        flag = F.coalesce(got.isin("1", "1.0", "true", "True"), F.lit(False))
        return F.when(is_flag, flag != (text == "true")).otherwise(~got.eqNullSafe(text))

    wrong = F.array_sort(F.transform(F.filter(wanted, differs), lambda e: e.key))
    out = both.select("case_id", row.alias("r"), F.coalesce(wrong, F.array().cast("array<string>")).alias("mismatches"))
    verdict = F.when(F.col("r").isNull(), "FAIL_MISSING").when(F.size("mismatches") > 0, "FAIL_VALUE").otherwise("PASS")
    return out.select("case_id", verdict.alias("verdict"), F.when(F.col("r").isNotNull(), F.array_join("mismatches", ",")).alias("mismatches"))
