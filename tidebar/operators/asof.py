"""As-of joins, and the checks that stand on them: continuity of adjusted prices, corporate actions, first sessions.

An as-of join is one union and one running frame by key: each left row takes the values of the last right row before it in the
sort. It is linear in both sides, whatever a key's history; a range join would pair each event with all bars before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, values: dict[str, str], forward: bool = False, strict: bool = False) -> DataFrame:
    """``left`` with ``values`` (new name: right column) of the nearest right row at or before ``left_on``; at or after it if ``forward``.

    ``strict`` leaves out rows of the same time. Right rows without a key or a time never match, nor do left rows without. Of right rows
    of the same key and time the one with the greatest values is taken. Without ``by`` all rows go through one task: for
    calendars only.
    """
    known = reduce(lambda a, c: a & F.col(c).isNotNull(), [*by, right_on], F.lit(True))
    held = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    first = F.lit(1 if strict else 0)  # right rows of the same time come first unless strict
    r = right.where(known).select(*by, F.col(right_on).alias("__t"), first.alias("__side"), held.alias("__held"), F.lit(None).cast(left.schema).alias("__row"))
    own = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    x = left.select(*by, F.col(left_on).alias("__t"), F.lit(1 - (1 if strict else 0)).alias("__side"), F.lit(None).cast(r.schema["__held"].dataType).alias("__held"), own.alias("__row"))
    t = F.desc("__t") if forward else F.asc("__t")
    run = Window.partitionBy(*by).orderBy(t, "__side", F.asc_nulls_first("__held")).rowsBetween(Window.unboundedPreceding, 0)
    found = r.unionByName(x).withColumn("__found", F.last("__held", ignorenulls=True).over(run)).where("__row is not null")
    usable = reduce(lambda a, c: a & F.col(c).isNotNull(), [*by, "__t"], F.lit(True))
    return found.select("__row.*", *[F.when(usable, F.col(f"__found.{n}")).alias(n) for n in values])


def first_session(rows: DataFrame, date: str, calendar: DataFrame, name: str = "first_session") -> DataFrame:
    """``rows`` with the first session at or after ``date``, null after the last one.

    The distinct dates meet the calendar, days against days, in one task; rows join the few results by equality.
    """
    dates = rows.select(F.col(date).alias("__day")).distinct()
    near = as_of(dates, calendar.select("trade_date").distinct(), [], "__day", "trade_date", {name: "trade_date"}, forward=True)
    return rows.join(near, F.col(date).eqNullSafe(F.col("__day")), "left").drop("__day")


def continuity(factors: DataFrame, bars: DataFrame, limit: float = 0.02) -> DataFrame:
    """(security_id, ex_date, verdict): the last close before the ex-date by the factor against the first one from it.

    Factors below zero, and ex-dates that come before the one before them by ``factor_no``, fail first.
    """
    closes = bars.where("close is not null")
    before = F.lag("ex_date").over(Window.partitionBy("security_id").orderBy("factor_no"))
    out = factors.withColumn("__before", before)
    out = as_of(out, closes, ["security_id"], "ex_date", "trade_date", {"__last": "close"}, strict=True)
    out = as_of(out, closes, ["security_id"], "ex_date", "trade_date", {"__next": "close"}, forward=True)
    gap = F.abs(F.col("__last") * F.col("factor") / F.col("__next") - 1)
    verdict = (
        F.when(F.col("factor") < 0, "NEGATIVE_FACTOR").when(F.col("ex_date") < F.col("__before"), "ORDER_BREAK").when(F.col("__last").isNull() | F.col("__next").isNull(), "MISSING_BAR")
        .when((F.col("__last") <= 0) | (F.col("__next") <= 0) | F.col("factor").isNull(), "NOT_CHECKED").when(gap <= limit, "PASS").otherwise("FAIL")
    )
    return out.select("security_id", "ex_date", verdict.alias("verdict"))


def sessions_around(calendar: DataFrame) -> DataFrame:
    """(trade_date, before, after): each session with its neighbours; one task over the calendar's days."""
    w = Window.orderBy("trade_date")
    return calendar.select("trade_date").distinct().select("trade_date", F.lag("trade_date").over(w).alias("before"), F.lead("trade_date").over(w).alias("after"))


def corporate_actions(cases: DataFrame, calendar: DataFrame, bars: DataFrame, events: DataFrame, factors: DataFrame, suspended: DataFrame, limit: float = 0.35) -> DataFrame:
    """(case_id, reason) of corporate-action cases at T; the first condition that fails names the reason.

    T and its neighbours must be sessions with bars (a suspension on T excuses missing ones), an event record of the
    exact date and type must exist, and the factor must change at T so that the return over it is continuous and differs from the raw one.

    ``cases``: case_id, security_id, trade_date, event_type. ``events``: security_id, ex_date, event_type.
    ``factors``: security_id, ex_date, factor. ``suspended``: security_id, trade_date.
    """
    key = ["security_id", "trade_date"]
    out = cases.join(sessions_around(calendar), "trade_date", "left").withColumn("__session", F.col("before").isNotNull() | F.col("after").isNotNull())
    days = out.select("case_id", "security_id", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(c).alias("trade_date")) for n, c in ((0, "before"), (1, "trade_date"), (2, "after"))])).alias("d"))
    closes = days.select("case_id", "security_id", "d.*").join(bars.select(*key, "close", F.lit(1).alias("__bar")), key)
    around = closes.groupBy("case_id").agg(F.count_if(F.col("__bar") == 1).alias("__bars"), *[F.max(F.when(F.col("n") == n, F.col("close"))).alias(f"__c{n}") for n in (0, 1)])
    known = events.where("security_id is not null").groupBy("security_id").agg(F.count(F.lit(1)).alias("__events"))
    at = events.groupBy("security_id", F.col("ex_date").alias("trade_date")).agg(F.collect_set("event_type").alias("__types"))
    own = factors.groupBy("security_id", F.col("ex_date").alias("trade_date")).agg(F.max("factor").alias("__factor"), F.count(F.lit(1)).alias("__factors"))
    still = suspended.select(*key).distinct().withColumn("__still", F.lit(True))
    out = out.join(around, "case_id", "left").join(known, "security_id", "left").join(at, key, "left").join(own, key, "left").join(still, key, "left")
    out = as_of(out, factors, ["security_id"], "trade_date", "ex_date", {"__previous": "factor"}, strict=True)
    f, p = F.coalesce("__factor", F.lit(0.0)), F.coalesce("__previous", F.lit(1.0))
    c0, c1 = F.coalesce("__c0", F.lit(0.0)), F.coalesce("__c1", F.lit(0.0))
    raw, adjusted = F.try_divide(c1, c0) - 1, F.try_divide(c1 * f, c0 * p) - 1
    reason = (
        F.when(~F.coalesce("__session", F.lit(False)), "CALENDAR_MISSING_EVENT_DAY").when(F.col("before").isNull() | F.col("after").isNull(), "CALENDAR_WINDOW_EDGE")
        .when((F.coalesce("__bars", F.lit(0)) < 3) & F.col("__still").isNotNull(), "SUSPENSION_AT_EVENT").when(F.coalesce("__bars", F.lit(0)) < 3, "KLINE_CONTEXT_MISSING")
        .when(F.col("event_type").isNull(), "EVENT_TYPE_UNRESOLVED").when(F.col("__events").isNull(), "EVENT_SOURCE_MISSING").when(F.col("__types").isNull(), "EVENT_DATE_MISMATCH")
        .when(~F.array_contains("__types", F.col("event_type")), "EVENT_TYPE_MISMATCH").when(F.col("__factors").isNull(), "ADJ_EVENT_DATE_MISSING")
        .when(f <= 0, "ADJ_FACTOR_INVALID").when(f == p, "ADJ_NO_TRANSITION").when((c0 <= 0) | (c1 <= 0), "KLINE_CLOSE_INVALID")
        .when(F.abs(adjusted) > limit, "ADJ_CONTINUITY_BROKEN").when((f != 1.0) & (F.abs(raw - adjusted) < 1e-12), "RAW_DISCONTINUITY_UNEXPLAINED").otherwise("PASS")
    )
    return out.select("case_id", reason.alias("reason"))


def within_first_sessions(bars: DataFrame, listing: DataFrame, calendar: DataFrame, n: int = 5) -> DataFrame:
    """(security_id, trade_date, in_first_n): whether a bar lies within the first n sessions from its security's listing on."""
    numbers = calendar.select("trade_date").distinct().withColumn("k", F.row_number().over(Window.orderBy("trade_date")))
    first = first_session(listing, "list_date", calendar).join(numbers.select(F.col("trade_date").alias("first_session"), F.col("k").alias("__first")), "first_session")
    out = bars.join(numbers, "trade_date").join(first.select("security_id", "__first"), "security_id")
    return out.select("security_id", "trade_date", ((F.col("k") >= F.col("__first")) & (F.col("k") - F.col("__first") < n)).alias("in_first_n"))


def history_coverage(listing: DataFrame, bars: DataFrame, calendar: DataFrame, baseline: Column) -> DataFrame:
    """(security_id, first_bar, first_session, verdict): the earliest bar is no later than the first session from the later of listing and baseline."""
    first_bar = bars.groupBy("security_id").agg(F.min("trade_date").alias("first_bar"))
    out = first_session(listing.withColumn("__bound", F.greatest("list_date", baseline)), "__bound", calendar).join(first_bar, "security_id", "left")
    verdict = F.when(F.col("first_bar").isNull(), "NO_BARS").when(F.col("first_bar") <= F.col("first_session"), "PASS").otherwise("LATE")
    return out.select("security_id", "first_bar", "first_session", verdict.alias("verdict"))
