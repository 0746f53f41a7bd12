"""Spellings that Spark SQL and the checking engine's SQL do not share."""

from __future__ import annotations


class SparkSql:
    sha = staticmethod(lambda x: f"sha2({x}, 256)")
    like = staticmethod(lambda x, p: f"regexp_like({x}, '{p}')")
    strip = staticmethod(lambda x, p: f"regexp_replace({x}, '{p}', '')")
    joined = staticmethod(lambda x: f"array_join(array_sort(collect_list({x})), ',')")
    joined_set = staticmethod(lambda x: f"array_join(array_sort(collect_set({x})), ',')")
    each = staticmethod(lambda *x: f"explode(array({', '.join(x)}))")
    days = staticmethod(lambda a, b: f"datediff({a}, {b})")
    plus = staticmethod(lambda d, n: f"date_add({d}, {n})")
    ymd = staticmethod(lambda d: f"date_format({d}, 'yyyyMMdd')")
    date = staticmethod(lambda s: f"try_to_date({s}, 'yyyyMMdd')")
    number = staticmethod(lambda s: f"try_cast({s} AS DOUBLE)")
    months = staticmethod(lambda a, b: f"explode(sequence({a}, {b}, INTERVAL 1 MONTH))")
    text = staticmethod(lambda x: f"CAST({x} AS STRING)")
    long = staticmethod(lambda x: f"CAST({x} AS BIGINT)")
    median = staticmethod(lambda x: f"median({x})")
    weekday = staticmethod(lambda d: f"weekday({d})")
    words = staticmethod(lambda s: f"explode(split({s}, ';'))")
    shanghai = staticmethod(lambda d, h: f"date_format(to_utc_timestamp(CAST(concat(CAST({d} AS STRING), ' {h}') AS TIMESTAMP), 'Asia/Shanghai'), 'yyyy-MM-dd HH:mm:ss')")
    uuid5 = staticmethod(lambda key: _uuid_spark(key))
    decimal2 = staticmethod(lambda x: f"CAST(round(CAST({x} AS DECIMAL(18, 6)), 2) AS DOUBLE)")
    last = staticmethod(lambda x, w: f"last_value({x}) IGNORE NULLS OVER ({w})")
    stamp = staticmethod(lambda t: f"date_format({t}, 'yyyy-MM-dd HH:mm:ss')")
    micros = staticmethod(lambda t: f"unix_micros(CAST({t} AS TIMESTAMP))")
    from_ms = staticmethod(lambda x: f"date_format(timestamp_millis({x}), 'yyyy-MM-dd HH:mm:ss')")
    split = staticmethod(lambda s, i: f"split_part({s}, '.', {i})")
    hex32 = staticmethod(lambda x: f"CAST(conv({x}, 16, 10) AS BIGINT)")


class DuckSql(SparkSql):
    sha = staticmethod(lambda x: f"sha256({x})")
    like = staticmethod(lambda x, p: f"regexp_matches({x}, '{p}')")
    strip = staticmethod(lambda x, p: f"regexp_replace({x}, '{p}', '', 'g')")
    joined = staticmethod(lambda x: f"string_agg({x}, ',' ORDER BY {x})")
    joined_set = staticmethod(lambda x: f"string_agg(DISTINCT {x}, ',' ORDER BY {x})")
    each = staticmethod(lambda *x: f"unnest([{', '.join(x)}])")
    days = staticmethod(lambda a, b: f"date_diff('day', {b}, {a})")
    plus = staticmethod(lambda d, n: f"CAST({d} + CAST({n} AS INTEGER) AS DATE)")
    ymd = staticmethod(lambda d: f"strftime({d}, '%Y%m%d')")
    date = staticmethod(lambda s: f"CAST(try_strptime({s}, '%Y%m%d') AS DATE)")
    number = staticmethod(lambda s: f"TRY_CAST({s} AS DOUBLE)")
    months = staticmethod(lambda a, b: f"CAST(unnest(generate_series({a}, {b}, INTERVAL 1 MONTH)) AS DATE)")
    text = staticmethod(lambda x: f"CAST({x} AS VARCHAR)")
    long = staticmethod(lambda x: x)  # whole numbers as they stand
    weekday = staticmethod(lambda d: f"(isodow({d}) - 1)")
    words = staticmethod(lambda s: f"unnest(string_split({s}, ';'))")
    shanghai = staticmethod(lambda d, h: f"strftime(CAST({d} || ' {h}' AS TIMESTAMP) - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')")
    uuid5 = staticmethod(lambda key: _uuid_duck(key))
    decimal2 = staticmethod(lambda x: f"CAST(round(CAST({x} AS DECIMAL(18, 6)), 2) AS DOUBLE)")
    last = staticmethod(lambda x, w: f"last_value({x} IGNORE NULLS) OVER ({w})")
    stamp = staticmethod(lambda t: f"strftime({t}, '%Y-%m-%d %H:%M:%S')")
    micros = staticmethod(lambda t: f"epoch_us({t})")
    hex32 = staticmethod(lambda x: f"CAST('0x' || {x} AS BIGINT)")
    from_ms = staticmethod(lambda x: f"strftime(make_timestamp(CAST({x} AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S')")


#: The namespace of stable ids: UUIDv5 of the URL namespace and this library's name.
NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
_PARTS = "substr({x}, 1, 8) || '-' || substr({x}, 9, 4) || '-5' || substr({x}, 14, 3) || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr({x}, 17, 1)), 1) || substr({x}, 18, 3) || '-' || substr({x}, 21, 12)"


def _uuid_spark(key: str) -> str:
    return _PARTS.format(x=f"sha1(concat(unhex('{NAMESPACE}'), encode({key}, 'UTF-8')))")


def _uuid_duck(key: str) -> str:
    return _PARTS.format(x=f"sha1(unhex('{NAMESPACE}') || encode({key}))")


SPARK, DUCK = SparkSql(), DuckSql()
