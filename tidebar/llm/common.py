"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (local tests) a temporary folder of this machine takes its place.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def cut(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here.

    The table survives the loss of executors. Python stages run once, unlike
    with ``checkpoint()``, which evaluates its last stage twice. Spark drops the shuffle files of a
    finished write when the driver collects garbage, which is asked for here.
    """
    return cut_parts([df], compression)


def cut_parts(parts: Iterable[DataFrame], compression: str = "snappy") -> DataFrame:
    """``cut`` of the rows of all ``parts``, written one after another, so that only one part's shuffle files are there at a time."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path, compression=compression)
        free(spark)
    out = spark.read.schema(schema).parquet(path)
    out.cut_path = path
    return out


def free(spark: SparkSession) -> None:
    """Collects garbage in the driver: plans that only cycles of Python objects still hold, then the JVM's, and with it the shuffle files of finished jobs."""
    gc.collect()
    spark._jvm.System.gc()


def share(c: Column, i: int, n: int) -> Column:
    """Whether a value is in the ``i``-th of ``n`` shares by hash; the shares are all values, each once (null is in the first)."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit(47), c), F.lit(n)), F.lit(0)) == i


def discard(*cuts: DataFrame) -> None:
    """Deletes the tables of ``cut`` that nothing unwritten stands on any more."""
    for df in cuts:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def own_id(id_col: str, text_col: str) -> Column:
    """The id as a number: a hash of an id that is none, and for a row without an id a number by its text, below all ids."""
    return F.coalesce(
        F.col(id_col).try_cast("long"),
        F.when(F.col(id_col).isNotNull(), F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 2)),
        F.lit(-(1 << 62)) - F.pmod(F.xxhash64(text_col), F.lit(1 << 60)),
    )


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; other letters keep their case."""
    return F.translate(c, UPPER, LOWER)


def n_words(c: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def map_texts(
    df: DataFrame, columns: list[str], kernel: Callable[..., list[list]], schema: str
) -> DataFrame:
    """Runs ``kernel`` on the columns' Python lists, one Arrow batch at a time.

    ``kernel`` gets a list for each of ``columns`` and returns a list for each
    column of ``schema``. Rows stay in their partition; nothing is shuffled.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                got = kernel(*(b.column(i).slice(at, 1000).to_pylist() for i in range(b.num_columns)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(got, target)], schema=target
                )

    return df.select(*columns).mapInArrow(run, schema)


def bounded_sample(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows, by a seeded hash of the id, the same ones on each run.

    Only ids are ranked; the texts of the chosen ones follow by a semi join
    against at most ``n`` ids, which is the size bound of the broadcast.
    """
    ids = (
        df.select(F.col(id_col).alias("__id"))
        .where(F.col("__id").isNotNull())
        .distinct()
        .orderBy(F.xxhash64(F.lit(seed), F.col("__id")), "__id")
        .limit(n)
    )
    return df.join(F.broadcast(ids), F.col(id_col) == F.col("__id"), "left_semi")
