"""URL filters with redirect equivalence.

Urls that lead to the same page are one class: those that differ only in scheme, `www.`, trailing slash, index page,
fragment or tracking parameters, and those tied by a canonical link or a redirect. A url that a rule fits has that
rule's verdict. Any other url is blocked if a block rule fits some alias of its class and no allow rule fits any; aliases
that have no page of their own count as well.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.components import components
from tidemart.llm.text import ascii_lower, free_name
from tidemart.sources.scratch import materialise

#: (verdict, host, path)
Rule = tuple[str, str, str]

TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
CANONICAL = r"""(?is)<link\s[^>]*rel\s*=\s*["']?canonical["']?[^>]*>"""
REFRESH = r"""(?is)<meta\s[^>]*http-equiv\s*=\s*["']?refresh["']?[^>]*>"""
HREF = r"""(?is)[\s"']href\s*=\s*["']?([^"'\s>]+)"""
REFRESH_URL = r"""(?is)url\s*=\s*["']?([^"'\s>]+)"""


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def alias_key(url: Column) -> Column:
    """The form that equivalent spellings of a url share; NULL where there is no host."""
    query = F.regexp_extract(after_scheme(url), r"^[^/?#]*[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))))
    bare = F.regexp_replace(F.regexp_replace(path(url), "/index[.]html?$", "/"), "/+$", "")
    key = F.concat(F.regexp_replace(host(url), "^www[.]", ""), bare, F.lit("?"), F.array_join(kept, "&"))
    return F.when(host(url) != "", key)


def _absolute(link: Column, url: Column) -> Column:
    """A link of a page as a whole url."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, "(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host(url))
    folder = F.regexp_replace(path(url), "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when((link == "") | link.isNull() | (host(url) == ""), None)
        .when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(root, folder, link))
    )


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`source`, `target` urls of the canonical links and meta redirects in the pages."""
    url, html = F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    links = F.array(
        F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1),
        F.regexp_extract(F.regexp_extract(html, REFRESH, 0), REFRESH_URL, 1),
    )
    found = pages.select(url.alias("source"), F.explode(links).alias("link")).where("link <> ''")
    return found.select("source", _absolute(F.col("link"), F.col("source")).alias("target"))


def rule_of(url: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of `length`, `rule`, `verdict`; NULL if none does.

    A rule fits its host and all subdomains of it when the url's path starts with the rule's.
    """
    fitting = [
        F.when(
            ((host(url) == h) | host(url).endswith("." + h)) & path(url).startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    empty = F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array_compact(F.array(empty, *fitting)))


def _explicit(judged: DataFrame, found: str, key: str) -> DataFrame:
    """`node`, `verdict` of the rows that a rule fits."""
    return judged.where(F.col(found).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("node"), F.col(f"{found}.verdict").alias("verdict")
    )


def verdicts(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, url_col: str = "url"
) -> DataFrame:
    """The rows of `pages` with `host`, `path`, `rule` (NULL if none fits) and `verdict`, `allow` or `block`.

    `redirects` has the columns `source` and `target`, whole urls; without it, urls are tied by spelling alone.
    NULL urls, and urls without `://`, have an empty host and path, no alias, and are allowed. Repeated rows get equal
    verdicts. Own columns replace columns of `pages` with the same names.
    """
    url = F.col(f"`{url_col}`")
    found, key = free_name(pages, "found"), free_name(pages, "alias")
    judged = pages.withColumns({found: rule_of(url, rules), key: F.md5(alias_key(url))})
    explicit = _explicit(judged, found, key)
    node = free_name(pages, "node")
    if redirects is None:
        judged = judged.withColumnRenamed(key, node)
    else:
        redirects = materialise(redirects.select("source", "target"), "redirects")
        ends = redirects.select(F.explode(F.array("source", "target")).alias("url"))
        ends = ends.select(rule_of(F.col("url"), rules).alias(found), F.md5(alias_key(F.col("url"))).alias(key))
        explicit = explicit.unionByName(_explicit(ends, found, key))
        labels = components(
            redirects.select(F.md5(alias_key(F.col("source"))).alias("a"), F.md5(alias_key(F.col("target"))).alias("b"))
        )
        explicit = explicit.join(labels, "node", "left").select(
            F.coalesce("component", "node").alias("node"), "verdict"
        )
        judged = (
            judged.join(labels.select(F.col("node").alias(key), F.col("component").alias(node)), key, "left")
            .withColumn(node, F.coalesce(node, key)).drop(key)
        )
    blocked = (
        explicit.groupBy(F.col("node").alias(node))
        .agg(F.max("verdict").alias("top"), F.min("verdict").alias("low"))
        .where("low = 'block' AND top = 'block'")
        .select(node, F.lit("block").alias("_inherited"))
    )
    verdict = F.coalesce(F.col(f"{found}.verdict"), F.col("_inherited"), F.lit("allow"))
    joined = judged.join(blocked, node, "left")
    return joined.withColumns(
        {"host": F.coalesce(host(url), F.lit("")), "path": F.coalesce(path(url), F.lit("")),
         "rule": F.col(f"{found}.rule"), "verdict": verdict}
    ).drop(found, node, "_inherited")
