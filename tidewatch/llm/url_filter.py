"""URL rules with redirect equivalence.

A rule (``host/path``) fits the urls of its host and of all subdomains whose path starts with the rule's path; the
longest rule that fits decides. Urls that redirect to each other or name each other as canonical are aliases: connected
components over those links carry decisions to the urls that no rule fits. In a component an explicit allow of any
member comes before a block; without either the url is allowed.

Links are resolved against the url of their page after the entities of the attribute are decoded; the SQL only resolves a leading slash.

* NULL urls and urls without ``://`` have an empty host and path, fit no rule, have no aliases, and are allowed.
* Repeated pages are judged alike. Links that lead nowhere or to the page itself change nothing.
* An empty table gives an empty table. Further columns stay as they are.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import connected_components
from tidewatch.sources.staging import stage

#: Query parameters that do not change what a url shows.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|msclkid|mc_cid|mc_eid)(=|$)"

ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"
#: Named entities without & and ;.
NAMED = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}

#: (verdict, rule), fixed values.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one and for NULL."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)


def fitting(host_: Column, path_: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULL. ``rules`` is a list in the caller's code."""
    rule = verdict = F
    for decision, text in sorted(rules, key=lambda r: -len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host_ == domain) | F.endswith(host_, F.lit("." + domain))) & F.startswith(path_, F.lit(slash + rest))
        rule, verdict = rule.when(fits, F.lit(text)), verdict.when(fits, F.lit(decision))
    none = F.lit(None).cast("string")
    return (rule.otherwise(none), verdict.otherwise(none)) if rules else (none, none)


def without_dots(path_: Column) -> Column:
    """A path without the segments ``.`` and ``..``; a slash that they leave at the end goes too."""
    none = F.array().cast("array<string>")

    def step(kept: Column, segment: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(segment == ".", kept).when(segment == "..", up).otherwise(F.concat(kept, F.array(segment)))

    segments = F.split(F.regexp_replace(path_, "^/", ""), "/", -1)
    return F.when(
        path_.rlike(r"/\.{1,2}(?:/|$)"), F.concat(F.lit("/"), F.array_join(F.aggregate(segments, none, step), "/"))
    ).otherwise(path_)


def decoded(value: Column) -> Column:
    """An attribute value with its entities decoded, once; unknown ones stay."""
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def character(e: Column) -> Column:
        number = F.when(
            e.rlike("^&#[xX]"), F.conv(F.regexp_extract(e, "^&#[xX]([0-9A-Fa-f]+)", 1), 16, 10).cast("int")
        ).otherwise(F.regexp_extract(e, "^&#([0-9]+)", 1).try_cast("int"))
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        text = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(F.startswith(e, F.lit("&#")), F.when(valid, text).otherwise(e)).otherwise(
            F.coalesce(F.try_element_at(named, F.regexp_extract(e, "^&(.*);$", 1)), e)
        )

    ends = F.concat(F.transform(F.regexp_extract_all(value, F.lit(ENTITY), F.lit(0)), character), F.array(F.lit("")))
    parts = F.zip_with(F.split(value, ENTITY, -1), ends, lambda gap, end: F.concat(gap, end))
    return F.when(F.contains(value, F.lit("&")), F.array_join(parts, "")).otherwise(value)


def resolved(target: Column, url: Column) -> Column:
    """The absolute url of a link on the page ``url``; dot segments are left to ``address``."""
    root = F.concat(F.lit("http://"), host(url))
    here = F.concat(root, path(url))
    asked = F.when(query(url) == "", "").otherwise(F.concat(F.lit("?"), query(url)))
    folder = F.concat(root, F.coalesce(F.nullif(F.regexp_extract(path(url), "^.*/", 0), F.lit("")), F.lit("/")))
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .when(F.startswith(target, F.lit("?")), F.concat(here, target))
        .when(F.startswith(target, F.lit("#")), F.concat(here, asked))
        .otherwise(F.concat(folder, target))
    )


def address(url: Column) -> Column:
    """The implied canonical form: no scheme, default port, fragment, tracking parameter, dot segment or trailing slash,
    parameters in order. NULL without a host."""
    name = F.regexp_replace(F.regexp_replace(host(url), r":(80|443)$", ""), r"\.$", "")
    asked = F.array_join(
        F.array_sort(F.filter(F.split(query(url), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&"
    )
    plain = F.concat(name, F.regexp_replace(without_dots(path(url)), r"/+$", ""), F.when(asked == "", "").otherwise(F.concat(F.lit("?"), asked)))
    return F.when(name != "", plain)


def node(url: Column) -> Column:
    """The number of an address; NULL without one."""
    return F.when(address(url).isNotNull(), F.xxhash64(address(url)))


def linked(html: Column, url: Column) -> Column:
    """Targets of the canonical link and of the refresh of a page, absolute."""
    page = F.coalesce(html, F.lit(""))
    tags = F.filter(
        F.regexp_extract_all(page, F.lit(r"<(?i:link|meta)\b[^>]*>"), F.lit(0)),
        lambda t: t.rlike(r"""(?i)\brel\s*=\s*["']?canonical\b|\bhttp-equiv\s*=\s*["']?refresh\b"""),
    )
    targets = F.transform(
        tags,
        lambda t: F.coalesce(
            F.nullif(F.regexp_extract(t, r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1), F.lit("")),
            F.nullif(F.regexp_extract(t, r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1), F.lit("")),
        ),
    )
    absolute = F.transform(F.transform(targets, decoded), lambda t: resolved(t, url))
    return F.when(
        F.contains(F.lower(page), F.lit("canonical")) | F.contains(F.lower(page), F.lit("refresh")), absolute
    ).otherwise(F.array().cast("array<string>"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    *,
    redirects: DataFrame | None = None,
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(row, host, path, rule, verdict): the page as a struct and what was decided.

    ``redirects`` (from_url, to_url) adds links that are known from elsewhere, e.g. from a crawl log.
    """
    row_columns = [F.col(f"`{c}`") for c in pages.columns if c != html]
    base = (
        pages.select(F.struct(*row_columns).alias("row"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
        .withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
        .withColumn("node", node(F.col("url")))
        .withColumn("links", linked(F.col("html"), F.col("url")))
        .drop("html")
    )
    rule, verdict = fitting(F.col("host"), F.col("path"), rules)
    judged = stage(base.withColumns({"rule": rule, "own": verdict}).drop("url"), "url-rules")
    edges = judged.select(F.col("node").alias("a"), F.explode("links").alias("to")).select("a", node(F.col("to")).alias("b"))
    if redirects is not None:
        edges = edges.union(redirects.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b")))
    components = connected_components(edges)
    placed = (
        judged.join(components, "node", "left")
        .withColumn("alias_of", F.coalesce("component", "node"))
        .drop("component", "node", "links")
    )
    # Only components with a decision take part in the join back.
    decided = (
        placed.where("own IS NOT NULL AND alias_of IS NOT NULL")
        .groupBy("alias_of")
        .agg(F.max(F.when(F.col("own") == "allow", 2).otherwise(1)).alias("strongest"))
    )
    inherited = F.when(F.col("strongest") == 1, "block").otherwise("allow")
    return placed.join(decided, "alias_of", "left").select(
        "row", "host", "path", "rule", F.coalesce("own", inherited).alias("verdict")
    )
