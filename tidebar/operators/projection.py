"""Strict projection of untyped rows to a domain's schema, quarantine of what fails, and contexts without secrets."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical as cj
from ..sources.builds import Build, BuildError
from .keys import key_verdict

# ---- strict projection -------------------------------------------------------

#: Columns of every domain and those of each, with their types; ``?`` may be null. Fixed values.
LINEAGE = {
    "trade_date": "date", "available_at": "timestamp", "ingested_at": "timestamp", "availability_basis": "string", "availability_policy_version": "string", "selected_provider": "string",
    "source_normalization_run_id": "string", "source_output_name": "string", "source_row_ordinal": "bigint", "source_row_identity_hash": "string", "source_raw_request_id": "string",
    "source_raw_evidence_hash": "string", "source_mapper_identity": "string", "source_policy_version": "string", "canonical_contract_version": "string",
}
_PRICES = dict.fromkeys(("open", "high", "low", "close", "pre_close", "volume", "amount"), "double?")
_STATUS = dict.fromkeys(("pre_close", "high_limited", "low_limited", "price_high_lmt_rate", "price_low_lmt_rate"), "double?") | dict.fromkeys(("is_st_sec", "is_susp_sec", "is_wd_sec", "is_xr_sec"), "bigint?")
_LIMITS = dict.fromkeys(("pre_close", "up_limit", "down_limit", "up_limit_rate", "down_limit_rate"), "double?")
PAYLOADS = {"trade_calendar": {"market": "string"}, "daily_bar": _PRICES, "security_status": _STATUS, "limit_price": _LIMITS, "adjustment_factor": {"adj_factor": "double?", "backward_factor": "double?"}}
#: Columns that are parts of the key, by place.
KEY_PARTS = {"adjustment_factor": {"factor_type": 2}}

_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})$"


def columns_of(domain: str) -> dict[str, str]:
    """Names and types of a domain's columns that come from a row, in order."""
    identity = {} if domain == "trade_calendar" else {"security_id": "string"}
    return {"canonical_domain": "string", "canonical_key": "string"} | identity | PAYLOADS[domain] | LINEAGE


def _typed(v: Column, held: Column, kind: str) -> Column:
    """The value, of variant schema ``held``, in its type, null if it isn't of it: no number from a text or a boolean, no whole number from a fraction, no time without an offset."""
    get = lambda t: F.try_variant_get(v, "$", t)
    text = F.when(held == "STRING", get("string"))
    if kind == "double":
        return F.when(held.isin("BIGINT", "DOUBLE", "FLOAT") | held.startswith("DECIMAL"), get("double"))
    if kind == "bigint":
        return F.when(held == "BIGINT", get("bigint"))
    if kind == "date":
        return F.when(text.rlike(_DAY), text.try_cast("date"))
    if kind == "timestamp":
        return F.when(text.rlike(_MOMENT), text.try_cast("timestamp"))
    return text


def project(rows: DataFrame, domain: str, run_id: str, snapshot_id: str, as_of: Column) -> DataFrame:
    """Rows of a variant column ``doc`` in the domain's schema, with ``violation``, the first that holds, or null.

    FOREIGN_DOMAIN; KEY:<fault> as in ``key_verdict``; NULL:<column> and TYPE:<column> in the order of the schema; PARTS_DISAGREE (the key's
    parts against the typed columns); FUTURE (available after ``as_of``). A row that violates keeps what could be typed; callers keep
    the ones without violation. Other fields of ``doc`` don't matter.
    """
    names, c = columns_of(domain), F.col
    # each step is a column that the next ones look at, so that a document, a field and a key are taken apart once
    fields = rows.select(F.try_variant_get("doc", "$", "map<string,variant>").alias("__fields"))
    raw = fields.select(*[F.try_element_at("__fields", F.lit(n)).alias(n) for n in names])
    kinds = raw.select(*names, *[F.when(~F.is_variant_null(n), F.schema_of_variant(n)).alias(f"__{n}") for n in names])
    typed = kinds.select(*[_typed(c(n), c(f"__{n}"), kind.rstrip("?")).alias(n) for n, kind in names.items()], *[c(f"__{n}").isNotNull().alias(f"__{n}") for n in names])
    typed = typed.withColumn("__key", key_verdict(F.lit(domain), c("canonical_key")))
    typed = typed.withColumn("__parts", F.from_json(F.when(c("__key") == "VALID", c("canonical_key")), "array<string>"))
    key, parts = c("__key"), c("__parts")
    checks = [F.when(~c("canonical_domain").eqNullSafe(domain), "FOREIGN_DOMAIN"), F.when(c("canonical_key").isNull(), "KEY:MISSING"), F.when(key != "VALID", F.concat(F.lit("KEY:"), key))]
    for n, kind in names.items():
        given = c(f"__{n}")
        checks.append(F.when(given & c(n).isNull(), f"TYPE:{n}") if kind.endswith("?") else F.when(~given, f"NULL:{n}").when(c(n).isNull(), f"TYPE:{n}"))
    owner = "market" if domain == "trade_calendar" else "security_id"
    checks.append(F.when((F.get(parts, F.lit(0)) != c(owner)) | (F.get(parts, F.lit(1)) != F.date_format("trade_date", "yyyy-MM-dd")), "PARTS_DISAGREE"))
    checks.append(F.when(c("available_at") > as_of, "FUTURE"))
    projected = [F.get(parts, F.lit(i)).alias(n) for n, i in KEY_PARTS.get(domain, {}).items()]
    return typed.select(*names, F.lit(run_id).alias("canonical_run_id"), F.lit(snapshot_id).alias("snapshot_id"), *projected, F.coalesce(*checks).alias("violation"))


# ---- contexts without secrets ------------------------------------------------

#: A name that holds one of these, in any case, is secret. Fixed values.
SECRET = ("password", "token", "secret", "credential")
REDACTED = "[REDACTED]"


def _clean(value, mark):
    if isinstance(value, dict):
        secret = {k for k in value if any(s in k.lower() for s in SECRET)}
        return {k: mark if k in secret else _clean(v, mark) for k, v in value.items() if mark is not None or k not in secret}
    return [_clean(v, mark) for v in value] if isinstance(value, list) else value


def scrub_json(text: Column, mark: str | None = REDACTED) -> Column:
    """JSON text with ``mark`` in place of what secret names hold, at any depth and within lists; with None the names go as well.

    Names come in order, without blanks. A text that is no JSON, holds a number beyond doubles or is nested beyond reading is null, so that
    nothing of it leaks. Batches of Arrow, as the depth isn't known when the query is written; for typed columns see ``scrub``.
    """

    @F.pandas_udf("string")
    def scrubbed(texts: pd.Series) -> pd.Series:
        def one(x):
            try:
                return None if x is None else json.dumps(_clean(json.loads(x), mark), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
            except (ValueError, RecursionError):
                return None

        return texts.map(one)

    return scrubbed(text)


def _is_secret(name: str | Column) -> Column | bool:
    if isinstance(name, str):
        return any(s in name.lower() for s in SECRET)
    return F.lower(name).rlike("|".join(SECRET))


def scrub(value: Column, kind: cj.T.DataType) -> Column:
    """A typed value without what secret names hold: null in structs, no entry in maps; in lists, maps and structs at any depth."""
    if isinstance(kind, cj.T.StructType):
        fields = [(F.lit(None).cast(f.dataType) if _is_secret(f.name) else scrub(value[f.name], f.dataType)).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, cj.T.ArrayType):
        return F.transform(value, lambda x: scrub(x, kind.elementType))
    if isinstance(kind, cj.T.MapType):
        kept = F.map_filter(value, lambda k, v: ~_is_secret(k)) if isinstance(kind.keyType, cj.T.StringType) else value
        return F.transform_values(kept, lambda k, v: scrub(v, kind.valueType))
    return value


# ---- quarantine --------------------------------------------------------------


def quarantine(spark: SparkSession, path: str, rows: DataFrame, error: Column, locator: list[str], context: list[str]) -> str:
    """Splits ``rows`` into the tables ``mapped`` and ``quarantine`` of a build at ``path``: every row is in one of them.

    ``error`` is a row's error class, null for a good one; ``rows`` have no columns error_class and context. A quarantined row has
    its locator, the class, a context without secrets and an id, a hash of locator and class. The input is written once and counted; a build whose two tables don't add up to it is not closed.
    """
    build = Build(spark, path)
    plain = F.when(error.isNotNull(), cj.row_json(rows, context, strict=False))
    held = build.hold("input", rows.withColumns({"error_class": error, "context": plain}))
    bad = held.where("error_class IS NOT NULL")
    ids = bad.select(cj.row_hash(bad, [*locator, "error_class"]).alias("quarantine_id"), *locator, "error_class", scrub_json(F.col("context")).alias("context"))
    ids = build.hold("bad", ids)  # scrubbed once, before its rows are hashed
    n = build.write("mapped", held.where("error_class IS NULL").drop("error_class", "context")).count()
    m = build.write("quarantine", ids).count()
    if (given := held.count()) != n + m:
        raise BuildError(f"{given} rows came in, {n} are mapped and {m} in quarantine")
    return build.close(input_rows=str(given), mapped_rows=str(n), quarantined_rows=str(m))
