"""Per-security features over observed bars, with typed reasons for every missing value.

All windows count bars of the security in date order. One window specification
(``PARTITION BY security_id ORDER BY trade_date``) serves every frame, so the
whole table takes one shuffle and one sort, the two last-N-valid features included.

Lineage is a digest of the set of input rows: sums of lanes of their hashes. A span's
sum is the difference of two running sums, so no row holds a list of its inputs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import canonical as cj

WINDOWS = (5, 20, 60)
N_VALID = 20


def valid(c: Column) -> Column:
    """Present and finite."""
    return F.coalesce(cj.finite(c), F.lit(False))


def _w(rows: int | None = None):
    w = Window.partitionBy("security_id").orderBy("trade_date")
    return w if rows is None else w.rowsBetween(-rows, 0)


def add(df: DataFrame, name: str, value: Column, why: Column) -> DataFrame:
    return df.withColumns({name: value, name + "_reason": why})


def absent(c: Column) -> Column:
    """Why ``c`` is no input: null or not finite; else null."""
    return F.when(c.isNull(), "INPUT_NULL").when(~cj.finite(c), "NON_FINITE_RESULT")


def divided(value: Column, num: list[Column], den: Column) -> tuple[Column, Column]:
    """``value``, a quotient by ``den``, and its reason: the denominator's counts first, then those of what is divided in order.

    Conditions are spelled out over columns; built from one another they would grow beyond what is compiled.
    """
    good = (den > 0) & (den < cj.INF) & valid(value)
    why = F.when(good, None).when(den.isNull(), "UNSAFE_DENOMINATOR").when(~cj.finite(den), "NON_FINITE_RESULT").when(den <= 0, "UNSAFE_DENOMINATOR")
    for c in num:
        why = why.when(c.isNull(), "INPUT_NULL").when(~cj.finite(c), "NON_FINITE_RESULT")
    return F.when(good, value), why.otherwise("NON_FINITE_RESULT")


def change(num: Column, den: Column) -> tuple[Column, Column]:
    """num / den - 1 and its reason."""
    return divided(F.try_divide(num, den) - 1, [num], den)


def ratios(bars: DataFrame) -> DataFrame:
    """raw_return_1, gap_open_raw, intraday_return_raw and amplitude_preclose_raw."""
    c = F.col
    out = add(bars, "raw_return_1", *change(c("close"), c("pre_close")))
    out = add(out, "gap_open_raw", *change(c("open"), c("pre_close")))
    out = add(out, "intraday_return_raw", *change(c("close"), c("open")))
    span = F.try_divide(c("high") - c("low"), c("pre_close"))
    return add(out, "amplitude_preclose_raw", *divided(span, [c("high"), c("low")], c("pre_close")))


def averages(bars: DataFrame, windows=WINDOWS) -> DataFrame:
    """Moving means of close over exactly n bars, and the close's distance from each.

    A mean is missing for the reason of the first bar in its window that has no close.
    """
    close = F.col("close")
    out = bars.withColumns({"__close": F.when(valid(close), close), "__bad": absent(close)})
    frames = {"__number": F.row_number().over(_w())}
    for n in windows:
        frames |= {f"__first{n}": F.first("__bad", ignorenulls=True).over(_w(n - 1)), f"__mean{n}": F.avg("__close").over(_w(n - 1))}
    out = out.withColumns(frames)
    new = {}
    for n in windows:
        mean, first, short = F.col(f"__mean{n}"), F.col(f"__first{n}"), F.col("__number") < n
        full = ~short & first.isNull() & valid(mean)
        why = F.when(short, "INSUFFICIENT_HISTORY").when(first.isNotNull(), first).when(~valid(mean), "NON_FINITE_RESULT")
        value = F.try_divide(close, mean) - 1
        new |= {
            f"ma_close_obs_{n}": F.when(full, mean), f"ma_close_obs_{n}_reason": why,
            f"close_to_ma_obs_{n}": F.when(full & (mean > 0) & valid(value), value),
            f"close_to_ma_obs_{n}_reason": why.when(mean <= 0, "UNSAFE_DENOMINATOR").when(~valid(value), "NON_FINITE_RESULT"),
        }
    return out.withColumns(new)


def lag_returns(bars: DataFrame, lags=WINDOWS) -> DataFrame:
    """close / close n bars ago - 1."""
    out = bars.withColumns({"__number": F.row_number().over(_w())} | {f"__ago{n}": F.lag("close", n).over(_w()) for n in lags})
    for n in lags:
        value, why = change(F.col("close"), F.col(f"__ago{n}"))
        short = F.col("__number") <= n
        out = add(out, f"return_lag_obs_{n}", F.when(~short, value), F.when(short, "INSUFFICIENT_HISTORY").otherwise(why))
    return out


#: Running sums: over all rows so far, over rows with a valid amount, with a valid return, and with both.
FAMILIES = ("t", "a", "r", "b")
_PARTS = [f"{i}" for i in range(cj.LANES)]


def identified(bars: DataFrame) -> DataFrame:
    """Bars with ``canonical_key`` and ``source_row_identity_hash``; those that are there already stay."""
    own = [c for c in bars.columns if not c.startswith("__")]
    new = {"canonical_key": cj.key_json(F.col("security_id"), F.col("trade_date").cast("date").cast("string")), "source_row_identity_hash": cj.row_hash(bars, own, strict=False)}
    return bars.withColumns({k: v for k, v in new.items() if k not in bars.columns})


def member_lanes(bars: DataFrame) -> DataFrame:
    """Lanes ``__h0`` and so on of what a row is as an input: its key, its identity and when it was available."""
    one = F.sha2(F.concat_ws("|", "canonical_key", "source_row_identity_hash", F.col("available_on").cast("date").cast("string")), 256)
    return bars.withColumn("__h", one).withColumns({f"__h{i}": c for i, c in enumerate(cj.lanes(F.col("__h")))}).drop("__h")


def _ago(name: str, k: int) -> Column:
    """The ``k``-th value before that is there."""
    return F.expr(f"lag({name}, {k}) IGNORE NULLS OVER (PARTITION BY security_id ORDER BY trade_date)")


def _mean(values: Column) -> Column:
    """As ``avg`` has it: summed in order of time, nulls don't count."""
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))), F.size(F.array_compact(values)))


def _deviation(values: Column) -> Column:
    """As ``stddev_pop`` has it: moments are carried along in order of time, nulls don't count."""

    def step(a: Column, x: Column) -> Column:
        n, delta = a["n"] + 1.0, x - a["avg"]
        return F.when(x.isNull(), a).otherwise(F.struct(n.alias("n"), (a["avg"] + delta / n).alias("avg"), (a["m2"] + delta * (delta - delta / n)).alias("m2")))

    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("avg"), F.lit(0.0).alias("m2"))
    return F.aggregate(values, none, step, lambda a: F.when(a["n"] > 0, F.sqrt(a["m2"] / a["n"])))


def last_valid(bars: DataFrame, n: int = N_VALID, span: int = 60) -> DataFrame:
    """amount_to_mean_obs_20, vol_raw_return_obs_20, how many rows each skipped, and the lineage.

    The last n valid rows come by ``lag`` over values that are null where not valid and don't count, in the order by
    date that all other frames have. No row is moved or sorted again: an order by the number of valid rows would sort
    wide rows twice more, which spill once a task's share passes its memory.

    Inputs of a row are the last ``span`` + 1 bars with the last n valid amounts and returns;
    while fewer than n are valid these are all valid ones. Skipped rows are not members. Of the
    valid ones only those before the span count on their own: running sums up to there less those up to
    the first of them, and what amounts and returns have in common once.
    """
    run = _w().rowsBetween(Window.unboundedPreceding, 0)
    out = bars.withColumns({"__av": valid(F.col("amount")), "__rv": F.col("raw_return_1").isNotNull()})
    member = {"t": F.lit(True), "a": F.col("__av"), "r": F.col("__rv"), "b": F.col("__av") & F.col("__rv")}
    sums = {f"__{f}n": F.sum(F.when(m, 1).otherwise(0)).over(run) for f, m in member.items()}
    sums |= {f"__{f}{i}": F.sum(F.when(m, F.col(f"__h{i}")).otherwise(0)).over(run) for f, m in member.items() for i in _PARTS}
    out = out.withColumns(sums)
    parts = ["n", *_PARTS]
    out = out.withColumns({
        "__old": F.lag(F.struct(*[f"__{f}{p}" for f in FAMILIES for p in parts]), span + 1).over(_w()),
        "__near_at": F.max("available_on").over(_w(span)),
    })
    for f, source, of in (("a", "amount", _mean), ("r", "raw_return_1", _deviation)):
        own = F.col(f"__{f}v")
        less = lambda g, p: F.col(f"__{g}{p}") - (F.lit(1) if p == "n" else F.col(f"__h{p}"))
        # sums before the row, of its own family and of both; a row that is not in both takes nothing from the latter
        before = [less(f, p).alias(f"o{p}") for p in parts]
        before += [(F.col(f"__b{p}") - F.when(member["b"], F.lit(1) if p == "n" else F.col(f"__h{p}")).otherwise(0)).alias(f"b{p}") for p in parts]
        out = out.withColumns({
            f"__{f}s": F.when(own, F.struct(F.col("__tn").alias("i"), *before)),
            f"__{f}x": F.when(own, F.struct(F.col(source).alias("x"), F.col("available_on").alias("at"))),
        })
    for f, source, of in (("a", "amount", _mean), ("r", "raw_return_1", _deviation)):
        own = F.col(f"__{f}v")
        back = {f"__{f}x{k}": _ago(f"__{f}x", k) for k in range(1, n + 1)}
        out = out.withColumns(back | {f"__{f}s0": _ago(f"__{f}s", n - 1), f"__{f}s1": _ago(f"__{f}s", n), f"__{f}least": F.first(f"__{f}s", ignorenulls=True).over(run)})
        # a valid row is the last of its n; one that is not has n before it
        last = [F.when(own, F.col(f"__{f}x{k - 1}") if k > 1 else F.col(f"__{f}x")).otherwise(F.col(f"__{f}x{k}")) for k in range(n, 0, -1)]
        out = out.withColumn(f"__{f}list", F.array(*last))
        out = out.withColumns({
            f"__{f}first": F.coalesce(F.when(own, F.col(f"__{f}s0")).otherwise(F.col(f"__{f}s1")), F.col(f"__{f}least")),
            f"__{f}m": of(F.col(f"__{f}list.x")),
            f"__{f}at": F.array_max(F.col(f"__{f}list.at")),
        })
    full_a, full_r, i = F.col("__an") >= n, F.col("__rn") >= n, F.col("__tn")
    mean = F.col("__am")
    amount, deviation = F.col("amount"), F.col("__rm")
    why = F.when(amount.isNull(), "INPUT_NULL").when(~F.col("__av"), "NON_FINITE_RESULT").when(~full_a, "INSUFFICIENT_HISTORY")
    why = why.when(~valid(mean), "NON_FINITE_RESULT").when(mean <= 0, "UNSAFE_DENOMINATOR")
    out = add(out, "amount_to_mean_obs_20", F.when(F.col("__av") & full_a & valid(mean) & (mean > 0), F.try_divide(amount, mean)), why)
    why = F.when(~full_r, "INSUFFICIENT_HISTORY").when(~valid(deviation), "NON_FINITE_RESULT")
    out = add(out, "vol_raw_return_obs_20", F.when(full_r & valid(deviation), deviation), why)
    old = lambda f, p: F.col(f"__old.__{f}{p}")
    none = F.lit(0).cast("long")

    def total(p: str) -> Column:
        near = F.col(f"__t{p}") - F.coalesce(old("t", p), none)
        amounts = F.greatest(old("a", p) - F.col(f"__afirst.o{p}"), none)
        returns = F.greatest(old("r", p) - F.col(f"__rfirst.o{p}"), none)
        both = F.greatest(old("b", p) - F.greatest(F.col(f"__afirst.b{p}"), F.col(f"__rfirst.b{p}")), none)
        common = F.when(F.col("__afirst").isNotNull() & F.col("__rfirst").isNotNull(), both)
        return near + F.coalesce(amounts, none) + F.coalesce(returns, none) - F.coalesce(common, none)

    size = total("n")
    return out.withColumns({
        "amount_skipped": F.when(full_a, i - F.col("__afirst.i") + 1 - n).otherwise(0).cast("long"),
        "vol_skipped": F.when(full_r, i - F.col("__rfirst.i") + 1 - n).otherwise(i - F.col("__rn")).cast("long"),
        "lineage_size": size,
        "input_lineage_hash": cj.sums_hash(size, *[total(p) for p in _PARTS]),
        "feature_available_on": F.greatest("__near_at", "__aat", "__rat"),
    })


VALUES = (
    "raw_return_1", "gap_open_raw", "intraday_return_raw", "amplitude_preclose_raw",
    *[f"ma_close_obs_{n}" for n in WINDOWS], *[f"close_to_ma_obs_{n}" for n in WINDOWS], *[f"return_lag_obs_{n}" for n in WINDOWS],
    "amount_to_mean_obs_20", "vol_raw_return_obs_20",
)


def security_features(bars: DataFrame) -> DataFrame:
    """All fifteen features with reasons, skipped counts, lineage and availability."""
    return last_valid(lag_returns(averages(ratios(member_lanes(identified(bars))))))


@dataclass(frozen=True)
class Run:
    """What a feature run stands on and the version of what it computes."""

    snapshot_id: str
    canonical_run_id: str
    feature_set_id: str = "daily-features-1"
    contract_version: str = "1"
    universe_rule_id: str = "observed-bars"

    @property
    def feature_run_id(self) -> str:
        """The same inputs and versions give the same id."""
        parts = [self.snapshot_id, self.canonical_run_id, self.feature_set_id, self.contract_version, self.universe_rule_id]
        return sha256(json.dumps(parts, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def security_table(features: DataFrame, run: Run) -> DataFrame:
    """The stored security table: nine columns of identity and the fifteen features, in fixed order."""
    ids = {
        "source_snapshot_id": run.snapshot_id, "source_canonical_run_id": run.canonical_run_id, "feature_run_id": run.feature_run_id,
        "feature_set_id": run.feature_set_id, "feature_contract_version": run.contract_version,
    }
    return features.select(
        "security_id", "trade_date", *[F.lit(v).alias(k) for k, v in ids.items()], F.col("feature_available_on").alias("feature_available_at"), "input_lineage_hash", *VALUES
    )


def findings(features: DataFrame) -> DataFrame:
    """Long form: a row for each missing value, and for each count of skipped rows."""
    items = [
        F.struct(F.lit(v).alias("feature_name"), F.col(v + "_reason").alias("finding_class"), F.lit(0).cast("long").alias("skipped")) for v in VALUES
    ]
    for v, n in (("amount_to_mean_obs_20", "amount_skipped"), ("vol_raw_return_obs_20", "vol_skipped")):
        items.append(F.struct(F.lit(v).alias("feature_name"), F.when(F.col(n) > 0, "OPTIONAL_INPUT_MISSING").alias("finding_class"), F.col(n).alias("skipped")))
    return (
        features.select("security_id", "trade_date", F.explode(F.array(*items)).alias("f"))
        .where("f.finding_class is not null")
        .select("security_id", "trade_date", "f.*")
    )


def guard(bars: DataFrame, as_of: Column, run: Run | None = None) -> DataFrame:
    """Violations by row: a (security, date) or a canonical key that comes twice, rows available after ``as_of``, rows of another snapshot or run.

    Identities are compared where ``run`` is given and the bars carry ``snapshot_id`` and ``canonical_run_id``.
    """
    twice = lambda *keys: F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    checks = [F.when(F.col("__day"), "DUPLICATE_SECURITY_DATE"), F.when(F.col("available_on") > as_of, "AVAILABLE_AFTER_AS_OF")]
    out = bars.withColumn("__day", twice("security_id", "trade_date"))
    if "canonical_key" in bars.columns:
        out = out.withColumn("__key", twice("canonical_key"))
        checks.append(F.when(F.col("__key"), "DUPLICATE_CANONICAL_KEY"))
    if run is not None:
        for c, own, name in (("snapshot_id", run.snapshot_id, "FOREIGN_SNAPSHOT"), ("canonical_run_id", run.canonical_run_id, "FOREIGN_CANONICAL_RUN")):
            checks.append(F.when(~F.col(c).eqNullSafe(own), name))
    return out.select("security_id", "trade_date", F.explode(F.array(*checks)).alias("violation")).where("violation is not null")
