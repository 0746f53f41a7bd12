"""Canonical JSON in DuckDB SQL, for checks: doubles come from their IEEE 754 bits, not from arithmetic."""

from __future__ import annotations


def text(x: str) -> str:
    return f"""coalesce('"' || replace(replace({x}, '\\', '\\\\'), '"', '\\"') || '"', 'null')"""


def date(x: str) -> str:
    return f"""coalesce('"' || strftime({x}, '%Y-%m-%d') || '"', 'null')"""


def whole(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'null')"


def double(x: str) -> str:
    """From 1 up to 2^52 the bits of the mantissa are cut at the point; a negative number's floor is one lower if any are behind it."""
    bits = f"CAST(CAST({x} AS DOUBLE) AS BIT)::VARCHAR"
    power, digits = f"(CAST('0b' || substr({bits}, 2, 11) AS BIGINT) - 1023)", f"('1' || substr({bits}, 13, 52))"
    number = lambda b: f"coalesce(CAST(lpad({b}, 64, '0')::BIT AS BIGINT), 0)"
    i, f = number(f"substr({digits}, 1, CAST({power} AS INT) + 1)"), number(f"(rpad(substr({digits}, CAST({power} AS INT) + 2, 52), 52, '0'))")
    up = f"""'{{"f":' || {f} || ',"i":' || {i} || '}}'"""
    down = f"""'{{"f":' || CASE WHEN {f} = 0 THEN 0 ELSE 4503599627370496 - {f} END || ',"i":' || (-{i} - CASE WHEN {f} = 0 THEN 0 ELSE 1 END) || '}}'"""
    m = f"((CASE WHEN {x} < 0 THEN -2 ELSE 2 END) * {number(digits)})"
    return f"""CASE WHEN {x} IS NULL THEN 'null' WHEN {x} = 0 THEN '{{"f":0,"i":0}}' WHEN {power} BETWEEN 0 AND 51 AND {x} > 0 THEN {up} WHEN {power} BETWEEN 0 AND 51 THEN {down}
  ELSE '{{"e":' || ({power} - 53) || ',"m":' || {m} || '}}' END"""


def row(**columns: str) -> str:
    """An object of the given JSON expressions, names in order."""
    return "'{' || " + " || ',' || ".join(f"""'"{n}":' || {columns[n]}""" for n in sorted(columns)) + " || '}'"


def lanes(h: str, n: int = 4, digits: int = 10) -> list[str]:
    return [f"CAST('0x' || substr({h}, {digits * i + 1}, {digits}) AS BIGINT)" for i in range(n)]


BARS = {
    "security_id": text("security_id"), "trade_date": date("trade_date"), "available_on": date("available_on"), "volume": whole("volume"),
    **{c: double(c) for c in ("open", "high", "low", "close", "pre_close", "amount")},
}
BARS_ROW = row(**BARS)
