"""Market breadth for each trade date, and four descriptive states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical as cj
from .features import Run

RATIOS = (
    ("advancer_ratio_observed", "advancer_count", "valid_raw_return_count"),
    ("pct_above_ma20_observed", "above_ma20_count", "valid_ma20_count"),
    ("pct_positive_mom20_observed", "positive_mom20_count", "valid_mom20_count"),
)


def breadth(features: DataFrame) -> DataFrame:
    """Counts, ratios, mean, median and total over all observed securities of a date.

    One partially aggregated shuffle by trade_date. The exact median needs the
    date's returns in one place: one number for each security and date. The lineage is a
    digest of the set of the date's securities with their own lineages, from sums.
    """
    r = F.col("raw_return_1")
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    member = F.sha2(F.concat_ws("|", "security_id", "input_lineage_hash"), 256)
    sums = [F.sum(c.cast("decimal(20,0)")) for c in cj.lanes(F.col("__m"))]
    out = features.withColumn("__m", member).groupBy("trade_date").agg(
        F.count("*").alias("observed_security_count"), F.count(r).alias("valid_raw_return_count"),
        count(r > 0).alias("advancer_count"), count(r < 0).alias("decliner_count"), count(r == 0).alias("unchanged_count"),
        F.avg(r).alias("mean_raw_return_observed"), F.median(r).alias("median_raw_return_observed"),
        F.count("ma_close_obs_20").alias("valid_ma20_count"), count(F.col("close_to_ma_obs_20") > 0).alias("above_ma20_count"),
        F.count("return_lag_obs_20").alias("valid_mom20_count"), count(F.col("return_lag_obs_20") > 0).alias("positive_mom20_count"),
        F.sum("amount").alias("total_amount_observed"), F.count("amount").alias("valid_amount_count"),
        F.max("feature_available_on").alias("feature_available_on"),
        cj.sums_hash(F.count("*"), *sums).alias("input_lineage_hash"),
    )
    return out.withColumns({n: F.try_divide(F.col(a), F.col(b)) for n, a, b in RATIOS})


MARKET = (
    "observed_security_count", "valid_raw_return_count", "advancer_count", "decliner_count", "unchanged_count", "advancer_ratio_observed",
    "mean_raw_return_observed", "median_raw_return_observed", "valid_ma20_count", "pct_above_ma20_observed", "valid_mom20_count",
    "pct_positive_mom20_observed", "total_amount_observed",
)


def market_table(market: DataFrame, run: Run) -> DataFrame:
    """The stored market table: seven columns of identity and the thirteen features, in fixed order."""
    ids = {"source_snapshot_id": run.snapshot_id, "feature_run_id": run.feature_run_id, "feature_set_id": run.feature_set_id}
    return market.select(
        "trade_date", *[F.lit(v).alias(k) for k, v in ids.items()], F.col("feature_available_on").alias("feature_available_at"), "input_lineage_hash",
        F.lit(run.universe_rule_id).alias("universe_rule_id"), *MARKET,
    )


def market_findings(market: DataFrame) -> DataFrame:
    """UNSAFE_DENOMINATOR for each empty denominator, OPTIONAL_INPUT_MISSING for absent amounts."""
    items = [F.struct(F.lit(n).alias("feature_name"), F.when(F.col(b) == 0, "UNSAFE_DENOMINATOR").alias("finding_class"), F.lit(0).cast("long").alias("missing")) for n, _, b in RATIOS]
    items += [F.struct(F.lit(n).alias("feature_name"), F.when(F.col("valid_raw_return_count") == 0, "UNSAFE_DENOMINATOR").alias("finding_class"), F.lit(0).cast("long").alias("missing")) for n in ("mean_raw_return_observed", "median_raw_return_observed")]
    gone = F.col("observed_security_count") - F.col("valid_amount_count")
    items.append(F.struct(F.lit("total_amount_observed").alias("feature_name"), F.when(gone > 0, "OPTIONAL_INPUT_MISSING").alias("finding_class"), gone.alias("missing")))
    return market.select("trade_date", F.explode(F.array(*items)).alias("f")).where("f.finding_class is not null").select("trade_date", "f.*")


def return_center(mean: Column, median: Column) -> Column:
    return (
        F.when(mean.isNull() | median.isNull(), "UNKNOWN").when((mean > 0) & (median > 0), "POSITIVE_CENTER")
        .when((mean < 0) & (median < 0), "NEGATIVE_CENTER").otherwise("MIXED_CENTER")
    )


def participation(valid: Column, adv: Column, dec: Column) -> Column:
    return (
        F.when(valid.isNull() | (valid == 0), "UNKNOWN").when(adv > dec, "ADVANCE_DOMINANT").when(dec > adv, "DECLINE_DOMINANT").otherwise("BALANCED")
    )


def trend(above: Column, positive: Column) -> Column:
    return (
        F.when(above.isNull() | positive.isNull(), "UNKNOWN").when((above > 0.5) & (positive > 0.5), "BROAD_POSITIVE")
        .when((above < 0.5) & (positive < 0.5), "BROAD_NEGATIVE").otherwise("MIXED")
    )


def structure(center: Column, part: Column, trend_: Column) -> Column:
    """UNKNOWN in any dimension dominates; full agreement is broad, the center's sign decides the rest."""
    unknown = (center == "UNKNOWN") | (part == "UNKNOWN") | (trend_ == "UNKNOWN")
    up, down = center == "POSITIVE_CENTER", center == "NEGATIVE_CENTER"
    return (
        F.when(unknown, "UNKNOWN")
        .when(up & (part == "ADVANCE_DOMINANT") & (trend_ == "BROAD_POSITIVE"), "BROAD_ADVANCE")
        .when(down & (part == "DECLINE_DOMINANT") & (trend_ == "BROAD_NEGATIVE"), "BROAD_DECLINE")
        .when(up, "POSITIVE_MIXED_PARTICIPATION").when(down, "NEGATIVE_MIXED_PARTICIPATION").otherwise("MIXED")
    )


EVIDENCE = (
    "observed_security_count", "valid_raw_return_count", "advancer_count", "decliner_count", "unchanged_count", "advancer_ratio_observed",
    "mean_raw_return_observed", "median_raw_return_observed", "valid_ma20_count", "pct_above_ma20_observed", "valid_mom20_count",
    "pct_positive_mom20_observed",
)


def states(market: DataFrame) -> DataFrame:
    """The four states of each date with the evidence they stand on."""
    c = F.col
    out = market.withColumns({
        "return_center_state": return_center(c("mean_raw_return_observed"), c("median_raw_return_observed")),
        "daily_participation_state": participation(c("valid_raw_return_count"), c("advancer_count"), c("decliner_count")),
        "trend_participation_state": trend(c("pct_above_ma20_observed"), c("pct_positive_mom20_observed")),
    })
    return out.withColumn("market_structure_state", structure(c("return_center_state"), c("daily_participation_state"), c("trend_participation_state")))


#: Fixed order of the rules that states come from.
RULES = ("return-center-1", "daily-participation-1", "trend-participation-1", "market-structure-1")


def state_lineage(states_: DataFrame, run: Run, rules: tuple = RULES) -> Column:
    """SHA-256 of the canonical JSON of all that a state row stands on: the feature run, the market row's lineage and availability, twelve
    evidence values and the rules' ids. Means come in steps of 1e-9, as their last bits depend on the order of summing."""
    kinds = {f.name: f.dataType for f in states_.schema.fields}
    evidence = {n: (F.round(n, 9) if n == "mean_raw_return_observed" else F.col(n), kinds[n]) for n in EVIDENCE}
    text = T.StringType()
    return F.sha2(cj.struct_json(evidence | {
        "feature_run_id": (F.lit(run.feature_run_id), text), "trade_date": (F.col("trade_date"), T.DateType()),
        "source_lineage_hash": (F.col("input_lineage_hash"), text), "source_available_on": (F.col("feature_available_on"), T.DateType()),
        "rules": (F.array(*map(F.lit, rules)), T.ArrayType(text)),
    }), 256)


def state_findings(states_: DataFrame) -> DataFrame:
    """Why a state is UNKNOWN: a null input, or an empty denominator."""
    inputs = {
        "return_center_state": ("mean_raw_return_observed", "median_raw_return_observed"),
        "daily_participation_state": ("valid_raw_return_count",),
        "trend_participation_state": ("pct_above_ma20_observed", "pct_positive_mom20_observed"),
    }
    items = []
    for state, names in inputs.items():
        empty = F.col("valid_raw_return_count") == 0 if state == "daily_participation_state" else F.lit(False)
        nulls = F.array_compact(F.array(*[F.when(F.col(n).isNull(), n) for n in names]))
        items.append(F.struct(
            F.lit(state).alias("state_name"),
            F.when(F.size(nulls) > 0, "STATE_INPUT_NULL").when(empty, "STATE_INPUT_EMPTY_DENOMINATOR").alias("finding_class"),
            F.array_join(nulls, ",").alias("inputs"),
        ))
    return states_.select("trade_date", F.explode(F.array(*items)).alias("f")).where("f.finding_class is not null").select("trade_date", "f.*")


def state_guard(market: DataFrame) -> DataFrame:
    """Dates whose evidence contradicts itself, by check."""
    c = F.col
    ratio = F.try_divide(c("advancer_count"), c("valid_raw_return_count"))
    outside = lambda x: c(x).isNotNull() & ((c(x) < 0) | (c(x) > 1))
    checks = F.array(
        F.when(c("advancer_count") + c("decliner_count") + c("unchanged_count") != c("valid_raw_return_count"), "COUNTS_DISAGREE"),
        F.when(~ratio.eqNullSafe(c("advancer_ratio_observed")), "RATIO_DISAGREES"),
        F.when(outside("pct_above_ma20_observed") | outside("pct_positive_mom20_observed"), "RATIO_OUT_OF_RANGE"),
        F.when(F.length("input_lineage_hash") != 64, "BAD_HASH"),
    )
    return market.select("trade_date", F.explode(checks).alias("violation")).where("violation is not null")
