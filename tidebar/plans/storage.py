"""Queries that write and read tables, stream, or aggregate in Python (SRC, SS, UD, TB builds)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..functions.dialect import DUCK, SPARK
from ..functions.exact import exact_mean, registry_table
from ..operators import features as ft
from ..operators import market as mk
from ..sources import derived as dv
from ..sources import storage as st
from ..streaming import feed as fd
from .bars import FEATURES_SQL, MARKET_TABLE_SQL, MARKET_WIDE, RUN
from .base import query
from .keys import PROVIDED_SQL, provided_bars
from .reads import minutes
from .relations import duck, frame

LINEAGE = ("available_on", "provider", "run_id", "quality")
_PROVIDED = f"SELECT *, {DUCK.uuid5('security_id')} AS security_uuid FROM ({PROVIDED_SQL}) q"


def _months(spark, sf_dir):
    bars = provided_bars(spark, sf_dir).drop("month").selectExpr("*", f"{SPARK.uuid5('security_id')} AS security_uuid")
    return st.stored(spark, f"months {sf_dir}", lambda path: st.write_months(bars, path, LINEAGE))


_FLAGS = ", ".join(f"count(DISTINCT coalesce(CAST({c} AS VARCHAR), '?')) = 1 AS {c}_constant" for c in LINEAGE)


@query("SRC-07", duck(f"""WITH p AS ({_PROVIDED}), m AS (SELECT month, count(*) AS facts, min(trade_date) AS first_day, max(trade_date) AS last_day, {_FLAGS} FROM p GROUP BY month)
SELECT *, CASE WHEN {' AND '.join(f'{c}_constant' for c in LINEAGE)} THEN 0 ELSE facts END AS sidecar_rows FROM m"""))
def month_write(spark, sf_dir):
    """What the written files hold: facts, sidecar rows (none where nothing varies) and the columns that were lifted out."""
    at = _months(spark, sf_dir)
    facts = spark.read.parquet(f"{at}/facts").groupBy("month").agg(F.count("*").alias("facts"), F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))
    sidecar = spark.read.parquet(f"{at}/lineage").groupBy("month").agg(F.count("*").alias("sidecar_rows"))
    constants = spark.read.parquet(f"{at}/constants").select("month", *[F.col(f"{c}__constant").alias(f"{c}_constant") for c in LINEAGE])
    return facts.join(constants, "month").join(sidecar, "month", "left").fillna(0, ["sidecar_rows"])


@query("SRC-08", duck(f"""SELECT *, '["' || security_uuid || '","' || strftime(trade_date, '%Y-%m-%d') || '"]' AS canonical_key FROM ({_PROVIDED}) p WHERE month BETWEEN 199501 AND 199512"""))
def month_read(spark, sf_dir):
    """All columns of a year, as they were before the split, with the key rebuilt."""
    return st.read_months(spark, _months(spark, sf_dir), 199501, 199512)


def _features(spark, sf_dir):
    return ft.security_features(dv.bars(spark, sf_dir))


def _routed(keys, spark, sf_dir):
    at = st.scratch(spark, "routed")
    rows = frame(spark, sf_dir, "routed").withColumns({"y": F.year("trade_date"), "m": F.month("trade_date")})
    st.write_routed(rows, at, *keys)
    return spark.read.parquet(at).groupBy(*keys).agg(F.count("*").alias("n"), F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))


query("SRC-13", duck("SELECT route, split, count(*) AS n, min(trade_date) AS first_day, max(trade_date) AS last_day FROM :routed GROUP BY route, split"))(partial(_routed, ["route", "split"]))
query("SRC-14", duck("SELECT route, split, CAST(year(trade_date) AS INT) AS y, CAST(month(trade_date) AS INT) AS m, count(*) AS n, min(trade_date) AS first_day, max(trade_date) AS last_day FROM :routed GROUP BY 1, 2, 3, 4"))(
    partial(_routed, ["route", "split", "y", "m"])
)
_LAYOUTS = duck("SELECT l.layout, m.security_key % 16 AS bucket, count(*) AS n, count(DISTINCT m.security_key) AS keys FROM :minutes m CROSS JOIN (SELECT 'L0' AS layout UNION ALL SELECT 'L1' UNION ALL SELECT 'L2') l GROUP BY 1, 2")


@query("SRC-19", _LAYOUTS)
def minute_layouts(spark, sf_dir):
    out = None
    for layout in st.LAYOUTS:
        at = minutes(spark, sf_dir, layout)
        part = spark.read.parquet(at).groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.count("*").alias("n"), F.countDistinct("security_key").alias("keys")).withColumn("layout", F.lit(layout))
        out = part if out is None else out.unionByName(part)
    return out


@query("SRC-20", duck("SELECT security_key % 16 AS bucket, count(*) AS n, count(*) AS before_n FROM :minutes GROUP BY 1"))
def compaction(spark, sf_dir):
    """Day fragments of each bucket as files of a target size at a new path."""
    a, b = minutes(spark, sf_dir, "L1"), st.scratch(spark, "compacted")
    st.compact(spark, a, b, ["month", "bucket"], ["bar_time", "security_key"])
    count = lambda p, n: spark.read.parquet(p).groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.count("*").alias(n))
    return count(b, "n").join(count(a, "before_n"), "bucket")


@query("SRC-21", duck("SELECT security_key, bar_time, trade_date, close, volume FROM :minutes WHERE security_key IN (3, 19, 20)"))
def bucket_read(spark, sf_dir):
    return st.read_keys(spark, minutes(spark, sf_dir, "L1"), [3, 19, 20]).select("security_key", "bar_time", "trade_date", "close", "volume")


@query("ST-14", duck("SELECT security_id, trade_date, close, NULL AS IS_ST_SEC FROM :bars UNION ALL SELECT security_id, trade_date, NULL, IS_ST_SEC FROM :status"))
def aligned_union(spark, sf_dir):
    a = dv.bars(spark, sf_dir).select("security_id", "trade_date", "close")
    return a.unionByName(dv.status(spark, sf_dir).select("security_id", "trade_date", "IS_ST_SEC"), allowMissingColumns=True)


@query("TB-16", f"WITH {MARKET_TABLE_SQL} SELECT {', '.join(MARKET_WIDE)} FROM market_table WHERE year(trade_date) = 1996")
def slice_pipeline(spark, sf_dir):
    """Bars to month files, read back, features, breadth, one year published."""
    at = st.scratch(spark, "months")
    st.write_months(dv.bars(spark, sf_dir), at)
    market = mk.breadth(ft.security_features(st.read_months(spark, at).drop("month")))
    return mk.market_table(market.where(F.year("trade_date") == 1996), RUN).selectExpr(*MARKET_WIDE)


@query("SS-01", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, user_id AS feed, count(*) AS events, max(CASE WHEN event_id % 10 = 0 THEN 90 ELSE event_id % 60 END) AS max_latency, count(*) FILTER (WHERE event_id % 10 = 0) AS late_events FROM events GROUP BY ALL")
def feed_monitor(spark, sf_dir):
    events = dv.table(spark, sf_dir, "events")
    lag = F.when(F.col("event_id") % 10 == 0, 90).otherwise(F.col("event_id") % 60).cast("int")
    feed = fd.stream(spark, sf_dir, "events*.parquet", events).select(
        F.col("user_id").alias("feed"), F.col("ts").cast("timestamp").alias("event_at"), F.timestamp_seconds(F.unix_timestamp(F.col("ts").cast("timestamp")) + lag).alias("received_at")
    )
    return fd.drain(fd.monitor(feed), ["window_start", "feed"], st.scratch(spark, "out"), st.scratch(spark, "state"))


_SUBS = """WITH f AS (SELECT user_id AS feed, event_id AS seq, CASE WHEN event_id % 97 = 5 THEN 'START' WHEN event_id % 389 = 17 THEN 'STOP' ELSE 'EVENT' END AS kind FROM events),
e AS (SELECT feed, min(CASE WHEN kind = 'START' THEN seq END) AS s, min(CASE WHEN kind = 'STOP' THEN seq END) AS t FROM f GROUP BY feed)
SELECT f.feed, CASE WHEN max(e.t) IS NOT NULL THEN 'UNSUBSCRIBED' WHEN count(*) FILTER (WHERE kind = 'EVENT' AND seq > e.s) > 0 THEN 'ACTIVE' WHEN max(e.s) IS NOT NULL THEN 'STARTED' ELSE 'NEW' END AS status,
  count(*) FILTER (WHERE kind = 'EVENT' AND seq > e.s AND (e.t IS NULL OR seq < e.t)) AS events, count(*) FILTER (WHERE kind = 'EVENT' AND seq > e.t) AS late,
  count(*) FILTER (WHERE kind = 'EVENT' AND (e.s IS NULL OR seq < e.s) AND (e.t IS NULL OR seq < e.t)) AS orphan FROM f JOIN e ON f.feed = e.feed GROUP BY f.feed"""


@query("SS-02", _SUBS)
def subscription_state(spark, sf_dir):
    """The stream itself: events land in three thirds by sequence, each of several files, and micro-batches carry state from one to the next."""
    kinds = feed_kinds(dv.table(spark, sf_dir, "events"))
    at = st.scratch(spark, "landed")
    bounds = [int(x) for x in kinds.approxQuantile("seq", [1 / 3, 2 / 3], 0.01)]
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = kinds.where((F.lit(True) if low is None else F.col("seq") > low) & (F.lit(True) if high is None else F.col("seq") <= high))
        part.repartition(4, "feed").write.mode("append").parquet(at)
    feed = fd.stream(spark, at, "*.parquet", kinds, 4)
    return fd.drain(fd.subscriptions(feed), ["feed"], st.scratch(spark, "out"), st.scratch(spark, "state"))


def feed_kinds(events):
    kind = F.when(F.col("event_id") % 97 == 5, "START").when(F.col("event_id") % 389 == 17, "STOP").otherwise("EVENT")
    return events.select(F.col("user_id").alias("feed"), F.col("event_id").alias("seq"), kind.alias("kind"))


@query("SS-03", duck("SELECT CAST(year(trade_date) * 100 + month(trade_date) AS INT) AS month, count(*) AS n FROM :bars WHERE year(trade_date) >= 1997 GROUP BY 1"))
def day_append(spark, sf_dir):
    at, out = st.scratch(spark, "days"), st.scratch(spark, "appended")
    bars = dv.bars(spark, sf_dir)
    bars.repartition(6, "trade_date").write.parquet(at)
    fd.append_days(fd.stream(spark, at, "*.parquet", bars, 2), out, st.scratch(spark, "state"), 199701)
    return spark.read.parquet(out).groupBy("month").agg(F.count("*").alias("n"))


@query("UD-01", duck("SELECT 'status' AS output, count(*) AS n FROM :status UNION ALL SELECT 'limit_price', count(*) FROM :status UNION ALL SELECT 'action_flags', count(*) FROM :status WHERE IS_XR_SEC = '1'"))
def row_outputs(spark, sf_dir):
    """One row to several outputs, as one scan with an array of outputs."""
    flags = F.when(F.col("IS_XR_SEC") == "1", "action_flags")
    outputs = F.explode(F.array_compact(F.array(F.lit("status"), F.lit("limit_price"), flags)))
    return dv.status(spark, sf_dir).select(outputs.alias("output")).groupBy("output").agg(F.count("*").alias("n"))


@query("UD-02", duck("SELECT security_id, CAST(CAST(avg(close) AS FLOAT) AS DOUBLE) AS exact_mean FROM :bars GROUP BY security_id"))
def exact(spark, sf_dir):
    means = exact_mean(dv.bars(spark, sf_dir), ["security_id"], "close")
    return means.select("security_id", F.col("exact_mean").cast("float").cast("double").alias("exact_mean"))


@query("UD-03", f"WITH {FEATURES_SQL} " + " UNION ALL ".join(f"SELECT '{v}' AS name, count({v}) AS n FROM features" for v in ft.VALUES))
def registered(spark, sf_dir):
    """Registered security features with the number of values that they have."""
    names = registry_table(spark).where("kind = 'security'").select("name")
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).alias("value")) for v in ft.VALUES])).alias("p")
    return _features(spark, sf_dir).select(pairs).groupBy(F.col("p.name").alias("name")).agg(F.count("p.value").alias("n")).join(F.broadcast(names), "name")


@query("UD-04", duck("SELECT f.security_id, i.security_id IS NULL AS is_missing, count(*) AS n FROM :fact_ids f LEFT JOIN :identities i ON f.security_id = i.security_id GROUP BY ALL"))
def checker(spark, sf_dir):
    """A checker's two steps: resolve the input, evaluate it."""
    ids = frame(spark, sf_dir, "identities").select(F.col("security_id").alias("known"))
    resolved = frame(spark, sf_dir, "fact_ids").join(ids, F.col("security_id") == F.col("known"), "left")
    return resolved.groupBy("security_id", F.col("known").isNull().alias("is_missing")).agg(F.count("*").alias("n"))
