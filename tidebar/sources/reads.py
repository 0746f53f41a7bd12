"""Reads of stored tables that touch only the partitions, files and columns they need.

The research table is partitioned by route, split, year and month; requests become conditions on these columns and on
the rows', so Spark lists only the folders in question and pushes the rest to the files. Requests that reach
beyond a split's window or beyond the months that were written are errors, not empty results.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import LAYOUTS

#: Fixed windows of the splits that can be read.
WINDOWS = {
    "development": (dt.date(2020, 1, 1), dt.date(2023, 12, 31)),
    "validation_a": (dt.date(2024, 1, 1), dt.date(2025, 12, 31)),
    "holdout": (dt.date(2026, 1, 1), dt.date(2026, 6, 30)),
}
ROUTES = ("enabled", "disabled", "experimental")
PARTITIONS = ("route", "split", "year", "month")


class ReadError(ValueError):
    """A request that the stored table can't answer."""


def write_panel(panel: DataFrame, path: str) -> None:
    """The research table by route, split, year and month, time first within each file; rows of a month are dealt by day."""
    rows = panel.withColumns({"year": F.year("trade_date"), "month": F.month("trade_date")})
    rows.repartition(*PARTITIONS, F.dayofmonth("trade_date")).sortWithinPartitions(*PARTITIONS, "trade_date", "security_id").write.partitionBy(*PARTITIONS).parquet(path)


def _date(x: dt.date | str | None, default: dt.date) -> dt.date:
    return default if x is None else x if isinstance(x, dt.date) else dt.date.fromisoformat(x)


def requested(split: str, start=None, end=None) -> tuple[dt.date, dt.date]:
    """The dates asked for, the split's whole window by default."""
    if split not in WINDOWS:
        raise ReadError(f"{split!r} is no split that can be read")
    first, last = WINDOWS[split]
    a, b = _date(start, first), _date(end, last)
    if a < first or b > last or a > b:
        raise ReadError(f"{a}..{b} crosses the bounds of {split}")
    return a, b


def _months(first: dt.date, last: dt.date) -> Column:
    """Condition on the partition columns; plain comparisons, so that it prunes."""
    y, m = F.col("year"), F.col("month")
    return ((y > first.year) | (y == first.year) & (m >= first.month)) & ((y < last.year) | (y == last.year) & (m <= last.month))


def _columns(df: DataFrame, columns: list[str] | None) -> DataFrame:
    stored = [c for c in df.columns if c not in ("year", "month")]
    if columns is None:
        return df.select(*stored)
    if unknown := sorted(set(columns) - set(stored)):
        raise ReadError(f"unknown columns {unknown}")
    if len(set(columns)) != len(columns):
        raise ReadError("columns come twice")
    return df.select(*columns)


def _ids(df: DataFrame, ids: list[str] | DataFrame | None) -> DataFrame:
    """Rows of exactly these ids; a table of ids, of any size, is a semi join."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select("security_id"), "security_id", "left_semi")
    if isinstance(ids, str) or any(not isinstance(i, str) or not i.strip() for i in ids):
        raise ReadError("ids must be a list of non-empty texts")
    if len(set(ids)) != len(ids):
        raise ReadError("ids come twice")
    return df.where(F.col("security_id").isin(list(ids)) if ids else F.lit(False))


def load_security_daily(spark: SparkSession, path: str, split: str, start=None, end=None, ids=None, columns: list[str] | None = None) -> DataFrame:
    """Enabled rows of one split, within its window; no ids give no rows."""
    a, b = requested(split, start, end)
    rows = spark.read.parquet(path).where((F.col("route") == "enabled") & (F.col("split") == split) & _months(a, b) & F.col("trade_date").between(a, b))
    return _columns(_ids(rows, ids), columns)


def load_disabled(spark: SparkSession, path: str, ids=None, columns: list[str] | None = None) -> DataFrame:
    """Disabled rows of all splits, apart from ordinary reads so that those never take them in."""
    return _columns(_ids(spark.read.parquet(path).where("route = 'disabled'"), ids), columns)


def load_history(spark: SparkSession, path: str, scope: DataFrame, split: str, start=None, end=None, ids=None, columns: list[str] | None = None) -> DataFrame:
    """Enabled rows over the months of ``scope`` (split, year, month), in order of date and id; every month asked for must be in it.

    The scope prunes the scan at run time (dynamic partition pruning): folders of other months aren't read.
    """
    a, b = requested(split, start, end)
    held = {(r.year, r.month) for r in scope.where((F.col("split") == split) & _months(a, b)).select("year", "month").distinct().collect()}  # at most the window's months
    asked = {(m // 12, m % 12 + 1) for m in range(a.year * 12 + a.month - 1, b.year * 12 + b.month)}
    if asked - held:
        raise ReadError(f"{len(asked - held)} months of the range are not in the committed scope")
    rows = spark.read.parquet(path).where((F.col("route") == "enabled") & F.col("trade_date").between(a, b))
    rows = rows.join(F.broadcast(scope.where(F.col("split") == split).select("split", "year", "month").distinct()), ["split", "year", "month"], "left_semi")
    return _columns(_ids(rows, ids), columns).orderBy("trade_date", "security_id")


def project_daily(spark: SparkSession, path: str, split: str | None = None, start=None, end=None, ids=None, columns: list[str] | None = None) -> DataFrame:
    """Rows of all routes within the part of the range that the split's window holds, ids and columns pushed to the scan.

    Without a split the range stands as it is. An empty overlap gives no rows. Batches come by
    ``toLocalIterator`` or ``mapInArrow`` on the result.
    """
    if columns is not None and not columns:
        raise ReadError("no columns")
    first, last = WINDOWS[split] if split in WINDOWS else (dt.date.min, dt.date.max)
    if split is not None and split not in WINDOWS:
        raise ReadError(f"{split!r} is no split that can be read")
    a, b = max(first, _date(start, first)), min(last, _date(end, last))
    rows = spark.read.parquet(path)
    if split is not None:
        rows = rows.where(F.col("split") == split)
    return _columns(_ids(rows.where(_months(a, b) & F.col("trade_date").between(a, b)) if a <= b else rows.where(F.lit(False)), ids), columns)


# ---- minute bars -------------------------------------------------------------


def minutes_of_keys(spark: SparkSession, path: str, layout: str, keys: list[int], first=None, last=None, buckets: int = 16) -> DataFrame:
    """Rows of some keys over a range of days; months, and buckets where the layout has them, are pruned."""
    rows = spark.read.parquet(path).where(F.col("security_key").isin(keys))
    if "bucket" in LAYOUTS[layout]:
        rows = rows.where(F.col("bucket").isin(sorted({k % buckets for k in keys})))
    for bound, keep in ((first, lambda c, v: c >= v), (last, lambda c, v: c <= v)):
        if bound is not None:
            rows = rows.where(keep(F.col("month"), bound.year * 100 + bound.month) & keep(F.col("trade_date"), F.lit(bound)))
    return rows


def cross_section(spark: SparkSession, path: str, minute: dt.datetime) -> DataFrame:
    """(n, files, avg_close) of the whole market in one minute: one month's folders, and of each file the row groups of that minute."""
    rows = spark.read.parquet(path).where((F.col("month") == minute.year * 100 + minute.month) & (F.col("bar_time") == F.lit(minute).cast("timestamp_ntz")))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_metadata.file_path").alias("files"), F.avg("close").alias("avg_close"))
