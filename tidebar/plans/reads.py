"""Queries that read stored layouts (SRC-15 to SRC-18, AG-35 to AG-38).

A layout is written once for a session and table folder and read by all of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..sources import derived as dv
from ..sources import reads as rd
from ..sources import storage as st
from .base import query
from .relations import duck, frame


def _panel(spark, sf_dir):
    def build(path):
        panel = frame(spark, sf_dir, "panel_priced")  # in one pass, as panel and its input by key would take three shuffles more
        route = F.when((F.col("eligibility") == "RESEARCH_ENABLED") & (F.col("exchange") != "BJ"), "enabled").when(F.col("eligibility") == "RESEARCH_EXPERIMENTAL", "experimental").otherwise("disabled")
        rd.write_panel(panel.withColumn("route", route).select("security_id", "trade_date", "split", "route", "reason", "close", "volume"), path)

    return st.stored(spark, f"panel {sf_dir}", build)


def minutes(spark, sf_dir, layout="L1"):
    return st.stored(spark, f"minutes {layout} {sf_dir}", lambda path: st.write_minutes(dv.minute_bars(spark, sf_dir), path, layout))


_PANEL = "(SELECT r.*, i.close, i.volume, p.reason FROM :routed r JOIN :panel_input i ON r.security_id = i.security_id AND r.trade_date = i.trade_date JOIN :panel p ON r.security_id = p.security_id AND r.trade_date = p.trade_date)"
IDS = [f"S{k:06d}" for k in range(1, 20)]
_IN = ", ".join(f"'{i}'" for i in IDS)


@query("SRC-15", duck(f"SELECT security_id, trade_date, close FROM {_PANEL} q WHERE route = 'enabled' AND split = 'development' AND trade_date BETWEEN DATE '2020-03-15' AND DATE '2022-02-10' AND security_id IN ({_IN})"))
def research_read(spark, sf_dir):
    return rd.load_security_daily(spark, _panel(spark, sf_dir), "development", "2020-03-15", "2022-02-10", IDS, ["security_id", "trade_date", "close"])


@query("SRC-16", duck(f"SELECT security_id, trade_date, reason FROM {_PANEL} q WHERE route = 'disabled'"))
def disabled_read(spark, sf_dir):
    return rd.load_disabled(spark, _panel(spark, sf_dir), columns=["security_id", "trade_date", "reason"])


@query("SRC-17", duck(f"SELECT security_id, trade_date, close FROM {_PANEL} q WHERE route = 'enabled' AND split = 'development' AND trade_date BETWEEN DATE '2021-01-10' AND DATE '2021-06-20'"))
def history_read(spark, sf_dir):
    """The scope is every month of the development split that the panel was written for."""
    path = _panel(spark, sf_dir)
    scope = spark.read.parquet(path).where("split = 'development'").select("split", "year", "month").distinct()
    return rd.load_history(spark, path, scope, "development", "2021-01-10", "2021-06-20", columns=["security_id", "trade_date", "close"])


@query("SRC-18", duck("SELECT security_id, trade_date, close, volume FROM :panel_input WHERE trade_date BETWEEN DATE '2020-01-01' AND DATE '2021-12-31' AND security_id IN ('S000004', 'S000005')"))
def projected_read(spark, sf_dir):
    """The range begins before the split's window, which cuts it."""
    return rd.project_daily(spark, _panel(spark, sf_dir), "development", "2019-06-01", "2021-12-31", ["S000004", "S000005"], ["security_id", "trade_date", "close", "volume"])


@query("AG-35", duck("SELECT count(*) AS n, count(DISTINCT security_key % 16) AS files, round(avg(close), 6) AS avg_close FROM :minutes WHERE bar_time = (SELECT min(bar_time) FROM :minutes)"))
def one_minute(spark, sf_dir):
    """W4 on the bucketed, time-first layout: a minute's rows lie in one file of each bucket."""
    path = minutes(spark, sf_dir)
    first_month = min(int(r.month) for r in spark.read.parquet(path).select("month").distinct().collect())  # folder names
    minute = spark.read.parquet(path).where(F.col("month") == first_month).agg(F.min("bar_time")).first()[0]
    return rd.cross_section(spark, path, minute).select("n", "files", F.round("avg_close", 6).alias("avg_close"))


@query("AG-36", duck("SELECT count(*) AS n FROM :minutes WHERE security_key = 7"))
def one_security(spark, sf_dir):
    return rd.minutes_of_keys(spark, minutes(spark, sf_dir), "L1", [7]).agg(F.count(F.lit(1)).alias("n"))


@query("AG-37", duck("SELECT security_key, count(*) AS n FROM :minutes WHERE security_key < 100 AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY security_key"))
def key_list(spark, sf_dir):
    """W6: a hundred keys."""
    return rd.minutes_of_keys(spark, minutes(spark, sf_dir), "L1", list(range(100)), dt.date(2024, 1, 5), dt.date(2024, 1, 20)).groupBy("security_key").agg(F.count(F.lit(1)).alias("n"))


@query("AG-38", duck("SELECT count(*) AS securities, round(sum(avg_close), 4) AS total FROM (SELECT security_key, avg(close) AS avg_close FROM :minutes GROUP BY security_key) q"))
def all_securities(spark, sf_dir):
    each = spark.read.parquet(minutes(spark, sf_dir)).groupBy("security_key").agg(F.avg("close").alias("avg_close"))
    return each.agg(F.count(F.lit(1)).alias("securities"), F.round(F.sum("avg_close"), 4).alias("total"))
