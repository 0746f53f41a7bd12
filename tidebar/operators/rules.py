"""Trading rules: which rule holds for a security on a day, and what follows from it.

Rules hold exchanges and code patterns as arrays. Both are exploded once to keys of (exchange, length, fixed
prefix), so codes find their rules by an equi join; the rest of a pattern is checked then. A code has few
rules, which stay in one array, so days take one join by code and resolve in their own row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RULES_SCHEMA = """rule_id string, board string, exchanges array<string>, code_patterns array<string>, effective_from date, effective_to date,
  st_state boolean, age_rule string, up_rate decimal(6,4), down_rate decimal(6,4), tick decimal(6,4)"""
_MAIN = "60xxxx 000xxx 001xxx 002xxx 003xxx"
_BSE = "43xxxx 83xxxx 87xxxx 92xxxx"
# The rules of the exchanges from 2020 on (board, exchanges, patterns, from, to, ST state, listing-age rule, up, down).
RULES = (
    ("MAIN_BOARD_NORMAL", "MAIN", "SH SZ", _MAIN, "2020-01-01", "2099-12-31", False, "NONE", "0.10", "0.10"),
    ("MAIN_BOARD_ST_HISTORICAL_SH", "MAIN", "SH", "60xxxx", "2020-01-01", "2026-07-05", True, "NONE", "0.05", "0.05"),
    ("MAIN_BOARD_ST_HISTORICAL_SZ", "MAIN", "SZ", "000xxx 001xxx 002xxx 003xxx", "2020-01-01", "2026-07-05", True, "NONE", "0.05", "0.05"),
    ("MAIN_BOARD_ST_CURRENT", "MAIN", "SH SZ", _MAIN, "2026-07-06", "2099-12-31", True, "NONE", "0.10", "0.10"),
    ("MAIN_BOARD_IPO_DAY", "MAIN", "SH SZ", _MAIN, "2020-01-01", "2023-04-09", False, "IPO_DAY_44_36", "0.44", "0.36"),
    ("MAIN_BOARD_FIRST5_NO_LIMIT", "MAIN", "SH SZ", _MAIN, "2023-04-10", "2099-12-31", None, "FIRST_5_DAYS_NO_LIMIT", "0", "0"),
    ("CHINEXT_PRE_REGISTRATION_NORMAL", "CHINEXT", "SZ", "30xxxx", "2020-01-01", "2020-08-23", False, "NONE", "0.10", "0.10"),
    ("CHINEXT_PRE_REGISTRATION_ST", "CHINEXT", "SZ", "30xxxx", "2020-01-01", "2020-08-23", True, "NONE", "0.05", "0.05"),
    ("CHINEXT_REGISTRATION", "CHINEXT", "SZ", "30xxxx", "2020-08-24", "2099-12-31", None, "NONE", "0.20", "0.20"),
    ("CHINEXT_REGISTRATION_FIRST5", "CHINEXT", "SZ", "30xxxx", "2020-08-24", "2099-12-31", None, "FIRST_5_DAYS_NO_LIMIT", "0", "0"),
    ("STAR_MARKET", "STAR", "SH", "688xxx 689xxx", "2020-01-01", "2099-12-31", None, "NONE", "0.20", "0.20"),
    ("STAR_MARKET_FIRST5", "STAR", "SH", "688xxx 689xxx", "2020-01-01", "2099-12-31", None, "FIRST_5_DAYS_NO_LIMIT", "0", "0"),
    ("BSE_LIMIT", "BSE", "BJ", _BSE, "2021-11-15", "2099-12-31", None, "NONE", "0.30", "0.30"),
    ("BSE_IPO_DAY_NO_LIMIT", "BSE", "BJ", _BSE, "2021-11-15", "2099-12-31", None, "IPO_DAY_NO_LIMIT", "0", "0"),
)
FIRST_N = 5


def rule_table(spark: SparkSession, rules: tuple = RULES, tick: str = "0.01") -> DataFrame:
    """The rules as typed rows."""
    texts = [(i, b, e.split(), p.split(), f, t, st, age, up, down, tick) for i, b, e, p, f, t, st, age, up, down in rules]
    raw = spark.createDataFrame(texts, "rule_id string, board string, exchanges array<string>, code_patterns array<string>, f string, t string, st_state boolean, age_rule string, up string, down string, tick string")
    decimal = lambda c: F.col(c).cast("decimal(6,4)")
    return raw.select(
        "rule_id", "board", "exchanges", "code_patterns", F.to_date("f").alias("effective_from"), F.to_date("t").alias("effective_to"), "st_state", "age_rule",
        decimal("up").alias("up_rate"), decimal("down").alias("down_rate"), decimal("tick").alias("tick"),
    )


def pattern_matches(pattern: Column, code: Column) -> Column:
    """Equal length, and every character equal but where the pattern has an x."""
    return (F.length(pattern) == F.length(code)) & F.rlike(code, F.concat(F.lit("^"), F.replace(pattern, F.lit("x"), F.lit(".")), F.lit("$")))


def match_patterns(codes: DataFrame, patterns: DataFrame, keys: tuple = ()) -> DataFrame:
    """Rows of ``codes`` (``code``) with rows of ``patterns`` (``pattern``) that match, also equal in ``keys``.

    Patterns are keyed by length and the part before their first x. A code is looked up by each of its
    beginnings, as many as it has characters and one; no code meets a pattern with another fixed beginning.
    """
    prefix = F.regexp_extract("pattern", "^[^x]*", 0)
    indexed = patterns.withColumns({"__n": F.length("pattern"), "__prefix": prefix})
    looked = codes.withColumn("__n", F.length("code")).withColumn("__prefix", F.explode(F.transform(F.sequence(F.lit(0), F.length("code")), lambda i: F.substring("code", F.lit(1), i))))
    return looked.join(indexed, [*keys, "__n", "__prefix"]).where(pattern_matches(F.col("pattern"), F.col("code"))).drop("__n", "__prefix")


_RULE = ("rule_id", "effective_from", "effective_to", "st_state", "age_rule", "up_rate", "down_rate", "tick")


def rules_of_codes(codes: DataFrame, rules: DataFrame) -> DataFrame:
    """(exchange, code, rules): the rules whose exchange and pattern fit, in one array of at most as many as there are rules."""
    keyed = rules.select(*_RULE, F.explode("exchanges").alias("exchange"), "code_patterns").withColumn("pattern", F.explode("code_patterns")).drop("code_patterns")
    found = match_patterns(codes.select("exchange", "code").distinct(), keyed, ("exchange",))
    return found.groupBy("exchange", "code").agg(F.array_sort(F.collect_set(F.struct(*_RULE))).alias("rules"))


def session_numbers(calendar: DataFrame) -> DataFrame:
    """(trade_date, session_no), from 1. One task ranks the calendar's days, as many as there are sessions."""
    return calendar.select("trade_date").distinct().withColumn("session_no", F.row_number().over(Window.orderBy("trade_date")))


@dataclass(frozen=True)
class _Day:
    """Expressions over one day's rules."""

    date: Column
    is_st: Column

    def candidates(self, rules: Column) -> Column:
        """Rules in force; those for the day's ST state go before those for any state, within each listing-age rule."""
        live = F.filter(rules, lambda r: (r.effective_from <= self.date) & (self.date <= r.effective_to) & (r.st_state.isNull() | (r.st_state == self.is_st)))
        return F.filter(live, lambda r: r.st_state.isNotNull() | ~F.exists(live, lambda o: o.st_state.isNotNull() & (o.age_rule == r.age_rule)))


def resolve(days: DataFrame, rules: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """``days`` with ``rule`` (a struct, null where unresolved), ``unresolved`` (why) and ``first_n``.

    ``days`` has exchange, code, trade_date, is_st and, with a ``calendar``, listing_date. Without one the limit regime is
    resolved: rules without a listing age only, for days that are known to have limits. None or several rules, a listing
    date that the calendar lacks, and a day before the listing leave a day unresolved.
    """
    out = days.join(rules_of_codes(days, rules), ["exchange", "code"], "left")
    day = _Day(F.col("trade_date"), F.col("is_st"))
    out = out.withColumn("__c", day.candidates(F.coalesce("rules", F.array().cast(out.schema["rules"].dataType))))
    c, age = F.col("__c"), lambda *ages: F.filter("__c", lambda r: r.age_rule.isin(*ages))
    plain = age("NONE")
    if calendar is None:
        out = out.withColumns({"__chosen": plain, "first_n": F.lit(False), "__why": F.when(F.size(c) == 0, "NO_RULE")})
    else:
        numbers = session_numbers(calendar)
        first_day = numbers.where("session_no = 1").select(F.col("trade_date").alias("__first_day"))
        listed = numbers.select(F.col("trade_date").alias("listing_date"), F.col("session_no").alias("__listed_no"))
        out = out.join(numbers, "trade_date", "left").join(listed, "listing_date", "left").join(F.broadcast(first_day), how="left")
        ageing = F.exists(c, lambda r: r.age_rule != "NONE")
        ipo, first = age("IPO_DAY_44_36", "IPO_DAY_NO_LIMIT"), age("FIRST_5_DAYS_NO_LIMIT")
        on_ipo = (F.col("listing_date") == F.col("trade_date")) & (F.size(ipo) > 0)
        before_all = F.col("__listed_no").isNull() & (F.col("listing_date") < F.col("__first_day"))
        within = F.coalesce(F.col("session_no") - F.col("__listed_no") < FIRST_N, F.lit(False))
        fault = (
            F.when(F.col("listing_date").isNull(), "NO_LISTING_DATE").when(on_ipo, None).when(F.col("session_no").isNull(), "DAY_NOT_IN_CALENDAR")
            .when(F.col("__listed_no").isNull() & ~before_all, "LISTING_NOT_IN_CALENDAR").when(F.col("trade_date") < F.col("listing_date"), "BEFORE_LISTING")
        )
        by_age = F.when(on_ipo, ipo).when(within & (F.size(first) > 0), first).otherwise(plain)
        out = out.withColumns({
            "__chosen": F.when(ageing, by_age).otherwise(plain),
            "first_n": ageing & F.coalesce(on_ipo | within & (F.size(first) > 0), F.lit(False)),
            "__why": F.when(F.size(c) == 0, "NO_RULE").when(ageing, fault),
        })
    why = F.coalesce(F.col("__why"), F.when(F.size("__chosen") == 0, "NO_AGE_RULE").when(F.size("__chosen") > 1, "AMBIGUOUS"))
    out = out.withColumn("unresolved", why)
    rule = F.when(F.col("unresolved").isNull(), F.element_at("__chosen", 1))
    out = out.withColumn("rule", rule).withColumn("first_n", F.col("first_n") & F.col("unresolved").isNull())
    return out.select(*days.columns, "rule", "unresolved", "first_n")


def no_limit(rule: Column) -> Column:
    return (rule.up_rate == 0) & (rule.down_rate == 0)


def limit_price(pre_close: Column, rule: Column, up: bool) -> Column:
    """pre_close by 1 +- rate in decimals, half up to the tick."""
    rate = (F.lit(1) + rule.up_rate if up else F.lit(1) - rule.down_rate).cast("decimal(6,4)")
    price = pre_close.cast("decimal(18,4)") * rate
    return (F.round((price / rule.tick).cast("decimal(28,8)"), 0) * rule.tick).cast("decimal(18,4)").cast("double")


def limit_check(status: DataFrame, rules: DataFrame, slack: float = 0.011) -> DataFrame:
    """``status`` with ``verdict``: the vendor's limits against those of the regime, and the close between them.

    Rows without a limit or a pre_close are NOT_CHECKED.
    """
    out = resolve(status, rules)
    up, down, rule = F.col("high_limit"), F.col("low_limit"), F.col("rule")
    verdict = (
        F.when(up.isNull() | down.isNull() | F.col("pre_close").isNull(), "NOT_CHECKED").when(rule.isNull(), "RULE_UNRESOLVED")
        .when(F.abs(up - limit_price(F.col("pre_close"), rule, True)) > slack, "UP_MISMATCH")
        .when(F.abs(down - limit_price(F.col("pre_close"), rule, False)) > slack, "DOWN_MISMATCH")
        .when((F.col("close") < down - 1e-9) | (F.col("close") > up + 1e-9), "CLOSE_OUTSIDE").otherwise("PASS")
    )
    return out.withColumn("verdict", verdict).select(*status.columns, F.col("rule.rule_id").alias("rule_id"), "verdict")


def limit_case(cases: DataFrame, status: DataFrame, listing: DataFrame, rules: DataFrame, calendar: DataFrame) -> DataFrame:
    """(case_id, reason): each case needs one status row, a listing date and a rule that agrees in rates and, within a tick, in prices.

    ``cases``: case_id, exchange, code, trade_date, expected_up, expected_down. ``status``: exchange, code, trade_date, is_st,
    pre_close, high_limit, low_limit. ``listing``: exchange, code, listing_date.
    """
    key = ["exchange", "code", "trade_date"]
    one = status.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"), *[F.max(c).alias(c) for c in ("is_st", "pre_close", "high_limit", "low_limit")])
    out = resolve(cases.join(one, key, "left").join(listing, ["exchange", "code"], "left"), rules, calendar)
    rule, tick = F.col("rule"), F.col("rule.tick").cast("double")
    away = lambda c, up: F.col(c).isNotNull() & (F.col(c) != 0) & (F.col("pre_close") != 0) & (F.abs(F.col(c) - limit_price(F.col("pre_close"), rule, up)) > tick + 1e-9)
    rate = lambda c, r: F.col(c).isNotNull() & (F.abs(F.col(c) - rule[r].cast("double")) > 1e-9)
    stated = F.coalesce(F.col("high_limit") != 0, F.lit(False))
    reason = (
        F.when(F.coalesce("__rows", F.lit(0)) != 1, "STATUS_EXACT_MATCH_FAILURE").when(F.col("listing_date").isNull(), "LISTING_DATE_MISSING")
        .when(rule.isNull(), "RULE_UNRESOLVED").when(no_limit(rule) & stated, "NO_LIMIT_CONTRADICTION").when(no_limit(rule), "PASS")
        .when(rate("expected_up", "up_rate") | rate("expected_down", "down_rate"), "LIMIT_RATE_MISMATCH")
        .when(F.coalesce(away("high_limit", True) | away("low_limit", False), F.lit(False)), "LIMIT_PRICE_MISMATCH").otherwise("PASS")
    )
    return out.select("case_id", reason.alias("reason"), F.col("rule.rule_id").alias("rule_id"))
