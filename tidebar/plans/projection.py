"""Queries on strict projection, scrubbed contexts and quarantine (PRJ-21, PRJ-27, PRJ-43)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import projection as pj
from ..sources import builds as bd
from ..sources import payloads as pl
from ..sources import storage as st
from .base import query
from .payloads import _FLAT, _landed
from .relations import D, K, duck, frame, rel

_Q = """'"' || {} || '"'"""
_OBJECT = lambda **x: "chr(123) || " + " || ',' || ".join(f"""'"{k}":' || {v}""" for k, v in x.items()) + " || chr(125)"

# ---- projection --------------------------------------------------------------

_CONSTANT = {n: "'\"x\"'" for n, kind in pj.LINEAGE.items() if kind == "string"}
_DOC = _OBJECT(
    canonical_domain=_Q.format("domain"), canonical_key=_Q.format("""'[' || chr(92) || '"' || security_id || chr(92) || '"' || ',' || chr(92) || '"' || key_day || chr(92) || '"' || tail || ']'"""),
    security_id="CASE WHEN n % 61 = 0 THEN 'null' ELSE '\"' || security_id || '\"' END", trade_date=_Q.format("CASE WHEN n % 53 = 0 THEN '1995-02-30' ELSE day_text END"),
    available_at=_Q.format("available || 'T09:00:00' || CASE WHEN n % 47 = 0 THEN '' ELSE '+08:00' END"), ingested_at="'\"1999-01-01T00:00:00Z\"'", source_row_ordinal="CASE WHEN n % 43 = 0 THEN '1.5' ELSE n || '' END",
    close="CASE WHEN n % 41 = 0 THEN '\"1\"' WHEN n % 37 = 0 THEN 'null' ELSE cents || '' END", adj_factor="cents || ''", **_CONSTANT,
)
rel("selected_rows", lambda d: f"""SELECT security_id, CASE WHEN {K} % 3 = 0 THEN 'adjustment_factor' ELSE 'daily_bar' END AS domain, {d.text('trade_date')} AS day_text, CASE WHEN ({D(d)} + {K}) % 31 = 0 THEN '2001-01-01' ELSE {d.text('trade_date')} END AS key_day, {d.text('available_on')} AS available, available_on,
  CASE WHEN {K} % 3 = 0 THEN ',' || chr(92) || '"SINGLE' || chr(92) || '"' ELSE '' END AS tail, {D(d)} + {K} AS n, CAST(floor(close * 100 + 0.5) AS BIGINT) AS cents FROM :bars""")
_VIOLATION = """CASE WHEN n % 61 = 0 THEN 'NULL:security_id' WHEN domain = 'daily_bar' AND n % 41 = 0 THEN 'TYPE:close' WHEN n % 53 = 0 THEN 'TYPE:trade_date' WHEN n % 47 = 0 THEN 'TYPE:available_at' WHEN n % 43 = 0 THEN 'TYPE:source_row_ordinal'
  WHEN key_day <> day_text THEN 'PARTS_DISAGREE' WHEN available_on >= DATE '1998-06-01' THEN 'FUTURE' END"""


@query("PRJ-27", duck(f"""SELECT domain, CASE WHEN n % 61 <> 0 THEN security_id END AS security_id, CASE WHEN n % 53 <> 0 THEN day_text END AS trade_day, CASE WHEN n % 43 <> 0 THEN CAST(n AS BIGINT) END AS source_row_ordinal,
  CASE WHEN domain = 'adjustment_factor' THEN CAST(cents AS DOUBLE) WHEN n % 41 = 0 OR n % 37 = 0 THEN NULL ELSE CAST(cents AS DOUBLE) END AS amount, CASE WHEN domain = 'adjustment_factor' THEN 'SINGLE' END AS factor_type, {_VIOLATION} AS violation FROM :selected_rows"""))
def strict_projection(spark, sf_dir):
    """Two domains; ``amount`` is the close of one and the factor of the other."""
    rows = frame(spark, sf_dir, "selected_rows").selectExpr("domain", f"parse_json({_DOC}) AS doc")
    out = []
    for domain, amount, part in (("daily_bar", "close", "CAST(NULL AS STRING)"), ("adjustment_factor", "adj_factor", "factor_type")):
        typed = pj.project(rows.where(F.col("domain") == domain), domain, "run", "snapshot", F.lit("1998-06-01 00:00:00 UTC").cast("timestamp"))
        out.append(typed.selectExpr(f"'{domain}' AS domain", "security_id", "date_format(trade_date, 'yyyy-MM-dd') AS trade_day", "source_row_ordinal", f"{amount} AS amount", f"{part} AS factor_type", "violation"))
    return out[0].unionByName(out[1])


# ---- contexts ----------------------------------------------------------------


def _context(token: str, nested: str, password: str) -> str:
    inner = _OBJECT(Secret_key=nested, rows="'[1,' || chr(123) || '\"db_password\":' || " + password + " || ',\"row\":' || event_id || chr(125) || ']'")
    return _OBJECT(api_token=token, dataset=_Q.format("event_type"), request=inner)


_HIDDEN = f"'\"{pj.REDACTED}\"'"
rel("nested_contexts", "SELECT event_id, event_type FROM :events")


@query("PRJ-43", duck(f"SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN {_context(_HIDDEN, _HIDDEN, _HIDDEN)} END AS context FROM :nested_contexts"))
def scrubbed_contexts(spark, sf_dir):
    """Contexts of three levels, some broken."""
    text = _context("'[1,2]'", "chr(123) || '\"a\":1' || chr(125)", "'\"p\"'")
    rows = frame(spark, sf_dir, "nested_contexts").selectExpr("event_id", f"CASE WHEN event_id % 19 = 0 THEN '{{\"token\": ' ELSE {text} END AS context")
    return rows.select("event_id", pj.scrub_json(F.col("context")).alias("context"))


# ---- quarantine --------------------------------------------------------------

_BAD = "CASE WHEN reason IS NOT NULL THEN reason WHEN date_text = '19950230' THEN 'DATE_MISSING_OR_INVALID' END"


@query("PRJ-21", duck(f"""WITH f AS (SELECT *, {_BAD} AS error_class FROM ({_FLAT}) x)
SELECT CASE WHEN error_class IS NULL THEN 'mapped' ELSE 'quarantine' END AS output, provider, request_id, symbol, ordinal, error_class, CASE WHEN error_class IS NOT NULL THEN chr(123) || '"api_token":"{pj.REDACTED}","date_text":' || coalesce('"' || date_text || '"', 'null') || chr(125) END AS context FROM f
UNION ALL SELECT 'accounted', 'total', 'total', 'total', CAST(count(*) AS INT), NULL, NULL FROM f"""))
def quarantined(spark, sf_dir):
    """Both tables of the build as they were read back, and the number of input rows in its manifest."""
    at = st.scratch(spark, "quarantine")
    flat = pl.flatten(pl.read_rows(spark, _landed(spark, sf_dir)))
    rows = flat.select(*pl.REQUEST, "symbol", "ordinal", "marker", "reason", F.col("row")["TRADE_DATE"].alias("date_text"), F.col("symbol").alias("api_token"))
    error = F.coalesce("reason", F.when((F.col("marker") == "ROW") & F.expr("try_to_date(date_text, 'yyyyMMdd')").isNull(), "DATE_MISSING_OR_INVALID"))
    pj.quarantine(spark, at, rows, error, [*pl.REQUEST, "symbol", "ordinal"], ["api_token", "date_text"])
    shown = ["provider", "request_id", "symbol", "ordinal"]
    good = bd.read_table(spark, at, "mapped").selectExpr("'mapped' AS output", *shown, "CAST(NULL AS STRING) AS error_class", "CAST(NULL AS STRING) AS context")
    bad = bd.read_table(spark, at, "quarantine").selectExpr("'quarantine' AS output", *shown, "error_class", "context")
    total = bd.manifest(spark, at).where("table_name = 'mapped'").selectExpr("'accounted' AS output", "'total' AS provider", "'total' AS request_id", "'total' AS symbol", "CAST(facts['input_rows'] AS INT) AS ordinal", "CAST(NULL AS STRING) AS error_class", "CAST(NULL AS STRING) AS context")
    return good.unionByName(bad).unionByName(total)
