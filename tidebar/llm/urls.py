"""URL filters: block decisions spread over redirect and canonical-link edges.

Edge cases: a null url, or one without ``://``, has an empty host and path, no
rule and no aliases, and is allowed; null html has no edges; repeated urls are
one node; an empty table gives no rows; of rules of the same length, none of which can fit the same url twice, the later one wins;
html of any length is searched whole, by patterns that look at each tag once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table
from .components import connected_components

#: (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(h: Column, p: Column, rules=RULES) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``; null if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rh, rp, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        out = F.when(fits, F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def address(url: Column) -> Column:
    """What equal addresses share: no scheme, fragment, closing slash or tracking parameters."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    kept = F.regexp_replace(rest, r"([?&])(?:utm_[^=&]*|ref|fbclid|gclid)=[^&]*(?=&|$)", "$1")
    kept = F.regexp_replace(F.regexp_replace(kept, r"([?&])&+", "$1"), r"[?&/]+$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host(url), kept))


_ATTR = r"""\s*=\s*["']?\s*([^"'\s>]+)"""


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(url, target)``: a page's canonical link, shared address and refresh redirect."""
    html = F.col(html_col)
    tag = {
        "canonical": r"""(?is)(<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>)""",
        "og:url": r"""(?is)(<meta\b[^>]*["']og:url["'][^>]*>)""",
        "refresh": r"""(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>)""",
    }
    value = {
        "canonical": r"(?is)\bhref" + _ATTR,
        "og:url": r"(?is)\bcontent" + _ATTR,
        "refresh": r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""",
    }
    found = [
        F.when(F.contains(F.lower(html), F.lit(word)), F.regexp_extract(F.regexp_extract(html, tag[word], 1), value[word], 1))
        for word in tag
    ]
    raw = pages.select(F.col(url_col).alias("url"), F.explode(F.array(*found)).alias("to")).where("to <> ''")
    to, url = F.replace(F.col("to"), F.lit("&amp;"), F.lit("&")), F.col("url")
    root = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^?#]*/)", 1)
    full = (
        F.when(F.instr(to, "://") > 0, to)
        .when(to.startswith("//"), F.concat(scheme, to))
        .when(to.startswith("/"), F.concat(root, to))
        .otherwise(F.concat(F.when(folder != "", folder).otherwise(F.concat(root, F.lit("/"))), to))
    )
    return raw.select("url", full.alias("target"))


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    Urls with the same address, and the two ends of each redirect or canonical
    link, form one component. A page's own rule decides it. Without one, a page is allowed
    if its component holds an address that a rule allows, else blocked if it
    holds one that a rule blocks, else allowed. All columns of ``pages`` stay, but for those of the four names, which are replaced.
    """
    own_names = ["host", "path", "rule", "verdict"]
    if clash := [c for c in pages.columns if c.startswith("__op10_")]:
        raise ValueError(f"names taken by this operator: {clash}")
    pages = pages.drop(*own_names)
    edges = links(pages, url_col, html_col).select(
        address(F.col("url")).alias("a"), address(F.col("target")).alias("b"), "target"
    ).where("a is not null and b is not null and a <> b")
    edges = edges.checkpoint() if _dir(edges) else edges
    own = pages.select("*", host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"), address(F.col(url_col)).alias("__op10_a"))
    own = own.withColumn("__op10_r", rule(F.col("host"), F.col("path"), rules))
    # Names of nodes are strings; the least one names a component.
    labels = connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("__op10_n"), F.col("component").alias("__op10_p"))
    known = own.where("__op10_r is not null and __op10_a is not null").select("__op10_a", F.col("__op10_r.verdict").alias("v")).unionByName(
        edges.select(F.col("b").alias("__op10_a"), rule(host(F.col("target")), path(F.col("target")), rules)["verdict"].alias("v")).where("v is not null")
    )
    # One row for each address that a rule names, then one for each component.
    named = known.groupBy("__op10_a").agg(F.max((F.col("v") == "allow").cast("int")).alias("__op10_allow"), F.max((F.col("v") == "block").cast("int")).alias("__op10_block"))
    class_of = F.coalesce("__op10_p", "__op10_a")
    classes = (
        named.join(labels, F.col("__op10_a") == F.col("__op10_n"), "left")
        .groupBy(class_of.alias("__op10_k"))
        .agg(F.max("__op10_allow").alias("__op10_allow"), F.max("__op10_block").alias("__op10_block"))
    )
    inherited = F.when(F.col("__op10_allow") == 1, "allow").when(F.col("__op10_block") == 1, "block").otherwise("allow")
    ruled = own.where("__op10_r is not null").withColumn("verdict", F.col("__op10_r.verdict"))
    # Only pages without a rule need their component.
    open_ = (
        own.where("__op10_r is null")
        .join(labels, F.col("__op10_a") == F.col("__op10_n"), "left")
        .withColumn("__op10_c", class_of)
        .join(classes, F.col("__op10_c") == F.col("__op10_k"), "left")
        .withColumn("verdict", inherited)
    )
    keep = [*pages.columns, "host", "path", F.col("__op10_r.rule").alias("rule"), "verdict"]
    return ruled.select(*keep).unionByName(open_.select(*keep))


def _dir(df: DataFrame) -> str:
    from .common import shared_dir

    return shared_dir(df.sparkSession)


def op10_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "host", "path", "rule", "verdict"
    )
