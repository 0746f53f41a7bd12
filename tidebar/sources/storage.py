"""Partitioned tables: bar months, research splits, history, minute layouts."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.canonical import key_json, value_json


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, name: str, build, mark: str = "_SUCCESS") -> str:
    """The path of a table that ``build(path)`` writes once for an application; one that was not finished is written again."""
    path = f"{_root(spark)}/stored-{sha256(f'{spark.sparkContext.applicationId} {name}'.encode()).hexdigest()[:32]}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{mark}")
    files = done.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(done):
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
        build(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``scratch`` that nothing unwritten stands on any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def month_of(date: Column) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("int")


def _by_month(bars: DataFrame) -> DataFrame:
    """Rows are dealt by ranges of (month, date, id): a large month goes to several tasks, small ones share one.

    So there is about a file for each month and one for each task; dealt by hash, there would be one for each task and month.
    """
    keys = ("month", "trade_date", "security_id")
    return bars.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_months(bars: DataFrame, path: str, lineage: tuple = ("available_on",)) -> None:
    """Facts by month, sorted by (date, id), and their lineage split in two.

    A lineage column that has one value in a month (null is one) is lifted out to ``constants``, a row for each month;
    ``lineage`` is a sidecar with the keys of the months in which something varies, and no column that never does. One
    aggregation over all columns finds out which. A UUID text column ``security_uuid`` is stored as 16 bytes. Rows are worked out
    once and held until the end.
    """
    spark = bars.sparkSession
    bars.withColumn("month", month_of(F.col("trade_date"))).write.parquet(f"{path}/held")
    rows = spark.read.parquet(f"{path}/held")
    kinds = {f.name: f.dataType for f in bars.schema.fields}
    json = {c: F.when(F.col(c).isNotNull(), value_json(F.col(c), kinds[c])) for c in lineage}
    found = [F.struct(F.min(j).alias("low"), F.max(j).alias("high"), F.count(j).alias("known"), F.first(c, ignorenulls=True).alias("value")).alias(c) for c, j in json.items()]
    held = rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), *found)
    constant = {c: (F.col(f"{c}.known") == 0) | (F.col(f"{c}.known") == F.col("n")) & (F.col(f"{c}.low") == F.col(f"{c}.high")) for c in lineage}
    table = held.select("month", *[F.when(k, F.col(f"{c}.value")).alias(c) for c, k in constant.items()], *[k.alias(f"{c}__constant") for c, k in constant.items()])
    table.coalesce(1).write.parquet(f"{path}/constants")  # a row for each month
    facts = rows.drop(*lineage)
    if "security_uuid" in bars.columns:
        facts = facts.withColumn("security_uuid", F.unhex(F.replace("security_uuid", F.lit("-"), F.lit(""))))
    _by_month(facts).write.partitionBy("month").parquet(f"{path}/facts")
    constants = spark.read.parquet(f"{path}/constants")
    varies = constants.agg(*[F.bool_and(f"{c}__constant").alias(c) for c in lineage]).first()
    columns = [c for c in lineage if varies[c] is False]
    some = constants.where(reduce(lambda a, c: a | ~F.col(f"{c}__constant"), columns, F.lit(False)))
    sidecar = rows.join(F.broadcast(some.select("month", *[f"{c}__constant" for c in columns])), "month")
    sidecar = sidecar.select("security_id", "trade_date", "month", *[F.when(~F.col(f"{c}__constant"), F.col(c)).alias(c) for c in columns])
    _by_month(sidecar).write.partitionBy("month").parquet(f"{path}/lineage")
    drop(spark, f"{path}/held")


def read_months(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Facts with their lineage put back from the sidecar and the constants; months outside the range are not read.

    A stored ``security_uuid`` comes back as text, with the ``canonical_key`` of it and the date.
    """
    constants = spark.read.parquet(f"{path}/constants")
    lineage = [c.removesuffix("__constant") for c in constants.columns if c.endswith("__constant")]
    facts = spark.read.parquet(f"{path}/facts")
    columns = [c for c in facts.columns if c != "month"]
    sidecar = spark.read.schema(_sidecar_schema(spark, path, facts, constants, lineage)).parquet(f"{path}/lineage")
    varying = [c for c in lineage if c in sidecar.columns]
    for bound, keep in ((first, lambda c, v: c >= v), (last, lambda c, v: c <= v)):
        if bound is not None:
            facts, sidecar, constants = (x.where(keep(F.col("month"), bound)) for x in (facts, sidecar, constants))
    side = sidecar.select("month", "security_id", "trade_date", *[F.col(c).alias(f"{c}__own") for c in varying])
    out = facts.join(side, ["month", "security_id", "trade_date"], "left").join(constants, "month")
    value = {c: F.when(F.col(f"{c}__constant"), F.col(c)).otherwise(F.col(f"{c}__own")) if c in varying else F.col(c) for c in lineage}
    if "security_uuid" in columns:
        h = F.lower(F.hex("security_uuid"))
        cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        out = out.withColumn("security_uuid", F.concat_ws("-", *cut))
        value["canonical_key"] = key_json(F.col("security_uuid"), F.date_format("trade_date", "yyyy-MM-dd"))
    return out.select("month", *columns, *[v.alias(c) for c, v in value.items()])


def _sidecar_schema(spark: SparkSession, path: str, facts: DataFrame, constants: DataFrame, lineage: list[str]) -> StructType:
    """Keys and the columns that vary in a month; stated, as a sidecar without rows has no files to infer from."""
    varies = constants.agg(*[F.bool_and(f"{c}__constant").alias(c) for c in lineage]).first()
    fields = [facts.schema[c] for c in ("security_id", "trade_date")] + [constants.schema[c] for c in lineage if varies[c] is False]
    return StructType([*fields, facts.schema["month"]])


def write_routed(panel: DataFrame, path: str, *keys: str) -> None:
    """Rows by route, split and the like, time first within each file."""
    panel.repartition(*keys, F.dayofyear("trade_date")).sortWithinPartitions(*keys, "trade_date", "security_id").write.partitionBy(*keys).parquet(path)


LAYOUTS = {"L0": ("month",), "L1": ("month", "bucket"), "L2": ("month", "bucket")}


def write_minutes(minutes: DataFrame, path: str, layout: str, buckets: int = 16) -> None:
    """Minute bars by month, or by month and key bucket, time or security first."""
    order = ("security_key", "bar_time") if layout == "L2" else ("bar_time", "security_key")
    rows = minutes.withColumns({"month": month_of(F.col("trade_date")), "bucket": F.pmod("security_key", F.lit(buckets))})
    keys = LAYOUTS[layout]
    rows.repartition(*keys, "trade_date").sortWithinPartitions(*keys, *order).write.partitionBy(*keys).parquet(path)


def compact(spark: SparkSession, source: str, target: str, keys: list[str], order: list[str], file_bytes: int = 128 << 20) -> None:
    """Many fragments as files of about ``file_bytes`` at a new path; the source stays.

    The fragments' sizes, from file metadata, say how many files there will be. Rows are dealt by ranges of (keys, order), so a large
    partition goes to several tasks, small ones share one, and no task holds more than its share. A file holds one partition's rows in order.
    """
    rows = spark.read.parquet(source)
    total = rows.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
    packed = rows.repartitionByRange(max(1, -(-total // file_bytes)), *keys, *order).sortWithinPartitions(*keys, *order)
    packed.write.partitionBy(*keys).parquet(target)


def read_keys(spark: SparkSession, path: str, keys: list[int], buckets: int = 16) -> DataFrame:
    """Rows of the asked keys; only their buckets' folders are read."""
    held = sorted({k % buckets for k in keys})
    return spark.read.parquet(path).where(F.col("bucket").isin(held) & F.col("security_key").isin(keys))
