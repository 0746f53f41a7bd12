"""Order-free sums, and the registry of features and states."""

from __future__ import annotations

import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def _joined(parts: pd.Series) -> pd.Series:
    """The mean of each array of ``(e, total, n)``: exact sums of mantissas by exponent, of finite values."""

    def mean(row) -> float | None:
        total = sum((Fraction(int(p["total"])) * Fraction(2) ** p["e"] for p in row), Fraction(0))
        n = sum(p["n"] for p in row)
        return _float(total) / n if n else None

    return parts.map(mean)


def _float(x: Fraction) -> float:
    try:
        return float(x)
    except OverflowError:
        return math.inf if x > 0 else -math.inf


def exact_mean(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys`` and ``exact_mean``: the mean from an exactly rounded sum, the same in any order.

    A value is a mantissa, a whole number below 2**56, times a power of two. Mantissas of one key and exponent are summed
    as decimals, in partial aggregates; what comes together for a key is a row for each exponent, at most
    2,200. Nulls don't count, a key without values has a null; NaN and infinities give what ``avg`` gives.
    """
    x = F.col(value).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) != math.inf)
    top = F.when(x == 0, 0).otherwise(F.floor(F.log2(F.abs(x)))).cast("int")
    up = 53 - top  # in two steps, as one power could overflow; a logarithm that is one off changes nothing
    half = F.floor(up / 2).cast("int")
    scaled = x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), up - half)
    parts = (
        rows.select(*keys, F.when(finite, -up).alias("e"), F.when(finite, scaled.cast("long").cast("decimal(20,0)")).alias("m"), F.when(~finite, x).alias("odd"), x.alias("x"))
        .groupBy(*keys, "e")
        .agg(F.sum("m").alias("total"), F.count("x").alias("n"), F.sum("odd").alias("odd"))
    )
    whole = parts.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("e").isNotNull(), F.struct("e", F.col("total").cast("string").alias("total"), "n"))).alias("parts"), F.sum("odd").alias("odd")
    )
    return whole.select(*keys, F.when(F.col("odd").isNotNull(), F.col("odd")).otherwise(_joined("parts")).alias("exact_mean"))


#: (name, kind, inputs, window, denominator)
REGISTRY = (
    *[(f"ma_close_obs_{n}", "security", "close", n, None) for n in (5, 20, 60)],
    *[(f"close_to_ma_obs_{n}", "security", "close", n, f"ma_close_obs_{n}") for n in (5, 20, 60)],
    *[(f"return_lag_obs_{n}", "security", "close", n + 1, f"lag({n})") for n in (5, 20, 60)],
    ("raw_return_1", "security", "close,pre_close", 1, "pre_close"), ("gap_open_raw", "security", "open,pre_close", 1, "pre_close"),
    ("intraday_return_raw", "security", "close,open", 1, "open"), ("amplitude_preclose_raw", "security", "high,low,pre_close", 1, "pre_close"),
    ("amount_to_mean_obs_20", "security", "amount", 20, "mean"), ("vol_raw_return_obs_20", "security", "raw_return_1", 20, None),
    *[(n, "market", "raw_return_1", 1, None) for n in ("valid_raw_return_count", "advancer_count", "decliner_count", "unchanged_count", "mean_raw_return_observed", "median_raw_return_observed")],
    ("observed_security_count", "market", "", 1, None), ("advancer_ratio_observed", "market", "advancer_count", 1, "valid_raw_return_count"),
    ("valid_ma20_count", "market", "ma_close_obs_20", 1, None), ("pct_above_ma20_observed", "market", "close_to_ma_obs_20", 1, "valid_ma20_count"),
    ("valid_mom20_count", "market", "return_lag_obs_20", 1, None), ("pct_positive_mom20_observed", "market", "return_lag_obs_20", 1, "valid_mom20_count"),
    ("total_amount_observed", "market", "amount", 1, None),
    *[(n, "state", "market", 1, None) for n in ("return_center_state", "daily_participation_state", "trend_participation_state", "market_structure_state")],
)


def registry_table(spark: SparkSession) -> DataFrame:
    """The registry as rows; callers can't add formulas to it."""
    return spark.createDataFrame(REGISTRY, "name string, kind string, inputs string, window_rows int, denominator string")
