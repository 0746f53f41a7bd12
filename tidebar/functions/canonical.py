"""Canonical JSON of any row, from its schema, and hashes that stand on it.

Names are in order, texts are escaped, dates and times are ISO texts in UTC. What two engines print for a
double differs, and so may two versions of one, so a double is exact whole numbers: ``{"f":2251799813685248,"i":1}`` is 1.5,
its floor and the rest in steps of 2^-52; where that is not exact (below 1 or from 2^52 on) ``{"e":-55,"m":14411518807585588}``
is 0.4, mantissa and exponent. -0.0 is 0.0. A row with a NaN or an infinity has
no JSON (null) unless ``strict`` is off, when these are texts in place of the mantissa.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")
#: Escapes with letters, the backslash first of all.
_SHORT = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"))


def finite(c: Column) -> Column:
    """Neither NaN, which is above all numbers, nor infinite; null for null."""
    return F.abs(c) < INF


def _escaped(c: Column) -> Column:
    short = reduce(lambda y, p: F.replace(y, F.lit(p[0]), F.lit(p[1])), _SHORT, c)
    code = lambda i: F.concat(F.lit("\\u00"), F.lpad(F.lower(F.hex(i)), 2, "0"))
    others = F.aggregate(F.sequence(F.lit(0), F.lit(31)), short, lambda text, i: F.replace(text, F.char(i), code(i)))
    marks = reduce(lambda y, p: F.replace(y, F.lit(p[0]), F.lit(p[1])), _SHORT[:2], c)  # all that most texts need, as keys in JSON do
    return F.when(~c.rlike(r"[\x00-\x1f\\\"]"), c).when(c.rlike(r"[\x00-\x1f]"), others).otherwise(marks)


def text_json(c: Column) -> Column:
    return F.concat(F.lit('"'), _escaped(c), F.lit('"'))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scaled(c: Column) -> Column:
    """Mantissa from 2^53 up to 2^54 and exponent, exact for every finite double but 0."""

    def of_top(top: Column) -> Column:
        up = 53 - top  # in two steps, as one power could overflow
        half = F.floor(up / 2).cast("int")
        return let(c * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), up - half), lambda m: of_mantissa(m, up))

    def of_mantissa(m: Column, up: Column) -> Column:
        # the logarithm may be one off beside a power of two
        shift = F.when(F.abs(m) >= 2.0**54, 1).when(F.abs(m) < 2.0**53, -1).otherwise(0)
        whole = F.when(shift == 1, m / 2).when(shift == -1, m * 2).otherwise(m).cast("long")
        return F.concat(F.lit('{"e":'), (shift - up).cast("string"), F.lit(',"m":'), whole.cast("string"), F.lit("}"))

    return let(F.floor(F.log2(F.abs(c))).cast("int"), of_top)


def _scaled_near(c: Column) -> Column:
    """As ``_scaled``, where no power of two can overflow. Parts are spelled out, as a function bound to a value is many times the work of these few steps."""
    up = F.lit(53) - F.floor(F.log2(F.abs(c))).cast("int")
    m = c * F.pow(F.lit(2.0), up)
    big, small = F.abs(m) >= 2.0**54, F.abs(m) < 2.0**53
    whole = F.when(big, m / 2).when(small, m * 2).otherwise(m).cast("long")
    return F.concat(F.lit('{"e":'), (F.when(big, 1).when(small, -1).otherwise(0) - up).cast("string"), F.lit(',"m":'), whole.cast("string"), F.lit("}"))


def double_json(c: Column) -> Column:
    whole = F.floor(c)
    parts = F.concat(F.lit('{"f":'), ((c - whole) * 2.0**52).cast("long").cast("string"), F.lit(',"i":'), whole.cast("string"), F.lit("}"))
    odd = F.concat(F.lit('{"e":0,"m":"'), F.when(F.isnan(c), "NaN").when(c > 0, "Infinity").otherwise("-Infinity"), F.lit('"}'))
    plain = (F.abs(c) >= 1.0) & (F.abs(c) < 2.0**52) | (c == 0)
    near = (F.abs(c) > 2.0**-900) & (F.abs(c) < 2.0**900)
    return F.when(plain, parts).when(near, _scaled_near(c)).when(~finite(c), odd).otherwise(_scaled(c))


def value_json(c: Column, kind: T.DataType) -> Column:
    """JSON of one value; null is spelled out."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        out = double_json(c.cast("double"))
    elif isinstance(kind, T.DateType):
        out = F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    elif isinstance(kind, T.TimestampType):
        out = text_json(F.concat(F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")))
    elif isinstance(kind, T.TimestampNTZType):
        out = text_json(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    elif isinstance(kind, T.BinaryType):
        out = text_json(F.lower(F.hex(c)))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: value_json(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        pairs = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(text_json(e.key.cast("string")), F.lit(":"), value_json(e.value, kind.valueType)))
        out = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    elif isinstance(kind, T.StructType):
        out = struct_json({f.name: (c[f.name], f.dataType) for f in kind.fields})
    elif isinstance(kind, T.StringType):
        out = text_json(c)
    else:  # whole numbers, decimals, booleans
        out = c.cast("string")
    return F.when(c.isNull(), "null").otherwise(out)


def struct_json(fields: dict[str, tuple[Column, T.DataType]]) -> Column:
    """An object with its names in order."""
    parts = []
    for name in sorted(fields):
        parts += [F.lit(("," if parts else "") + json.dumps(name, ensure_ascii=False) + ":"), value_json(*fields[name])]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def has_non_finite(c: Column, kind: T.DataType) -> Column:
    """Whether a NaN or an infinity stands anywhere in the value."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(~finite(c), F.lit(False))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: has_non_finite(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.exists(F.map_values(c), lambda x: has_non_finite(x, kind.valueType)), F.lit(False))
    if isinstance(kind, T.StructType):
        return reduce(lambda a, f: a | has_non_finite(c[f.name], f.dataType), kind.fields, F.lit(False))
    return F.lit(False)


def row_json(df: DataFrame, columns: list[str] | None = None, strict: bool = True) -> Column:
    """Canonical JSON of a row of ``df``; null where ``strict`` and a number is not finite."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = {n: (F.col(f"`{n}`"), kinds[n]) for n in columns or df.columns}
    text = struct_json(fields)
    if not strict:
        return text
    odd = reduce(lambda a, n: a | has_non_finite(*fields[n]), fields, F.lit(False))
    return F.when(~odd, text)


def row_hash(df: DataFrame, columns: list[str] | None = None, strict: bool = True) -> Column:
    """SHA-256 of the row's canonical JSON: one changed bit of any column changes it."""
    return F.sha2(row_json(df, columns, strict), 256)


def key_json(*parts: Column) -> Column:
    """A natural key: a JSON array of its parts as texts; null if one is null."""
    texts = [x for p in parts for x in (F.lit(","), text_json(p.cast("string")))][1:]
    return F.concat(F.lit("["), *texts, F.lit("]"))


# ---- hashes of many rows -----------------------------------------------------

#: A row's hash is cut into lanes whose sums don't depend on order.
LANES, LANE_DIGITS = 4, 10


def lanes(hash_: Column, n: int = LANES, digits: int = LANE_DIGITS) -> list[Column]:
    """The first ``n`` groups of hexadecimal digits as whole numbers."""
    return [F.conv(F.substring(hash_, digits * i + 1, digits), 16, 10).cast("long") for i in range(n)]


def wide_lanes(hash_: Column) -> list[Column]:
    """A SHA-256 as four longs of sixteen hexadecimal digits each."""
    return [F.conv(F.substring(hash_, 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]


def lane_sums(wide: list[Column]) -> list[Column]:
    """Exact sums over rows of the eight groups of eight digits in ``wide_lanes``.

    Each is summed as two longs of 16 bits a row, which don't overflow below 2^47 rows; sums of decimals are several times the work.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(20,0)")
    part = lambda w, at: F.shiftright(w, at).bitwiseAND(F.lit(65_535).cast("long"))
    return [total(part(w, at + 16)) * 65_536 + total(part(w, at)) for w in wide for at in (32, 0)]


def sums_hash(*sums: Column) -> Column:
    """SHA-256 over a count and sums of lanes."""
    return F.sha2(F.concat_ws("|", *[s.cast("string") for s in sums]), 256)


def table_hash(df: DataFrame, keys: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """(keys, table_hash, n, non_finite): one hash for all rows, whatever their order, with partial aggregates only.

    Rows that have no JSON are counted in ``non_finite``; with any of them the hash is null.
    """
    h = df.select(*(keys or []), row_hash(df, columns).alias("h"))
    h = h.withColumns({f"w{i}": w for i, w in enumerate(wide_lanes(F.col("h")))})
    sums = h.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("h").isNull()).alias("non_finite"), *[s.alias(f"p{i}") for i, s in enumerate(lane_sums([F.col(f"w{i}") for i in range(4)]))]
    )
    whole = F.when(F.col("non_finite") == 0, sums_hash(F.col("n"), *[F.coalesce(F.col(f"p{i}"), F.lit(0)) for i in range(8)]))
    return sums.select(*(keys or []), whole.alias("table_hash"), "n", "non_finite")
