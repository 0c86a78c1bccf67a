"""URL filters by redirect equivalence, with DataFrame operations only.

Rules judge the urls they fit; the longest fitting rule wins (of equally long ones, one that allows). Other urls take the decision of
their aliases: urls are nodes of a graph, edges lead from a url to its canonical form, to the
canonical link that its page declares and to where the page's refresh redirects. Distributed
connected components group the aliases (all canonical links and refreshes of a page count, in any spelling of
their tags, relative ones too); a group with any explicitly allowed member is allowed,
else one with any blocked member is blocked, else it is allowed.

The canonical form drops what servers redirect by convention: scheme, ``www.``, fragment, tracking
parameters (``utm_*``, ``ref``) and slashes at the path's end.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
is allowed; repeated rows are judged each; an empty table gives no rows; other columns are left
out.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components


class Rule(NamedTuple):
    """``verdict`` (allow or block) for a host, its subdomains, and paths that start so."""

    verdict: str
    host: str
    path: str


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between the name of a link, meta or base tag and its end; quoted values may hold ``>``.
TAG = r"""(?is)<%s(?=[\s/])((?:=\s*+(?:"[^"]*+"|'[^']*+')|=|[^>=]++)*+)>"""
#: An attribute's name and value. Taken one after another, so that none is seen inside a value.
ATTRIBUTE = r"""([^\s"'=<>/]++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
#: The target in the content of a refresh, in its three quotings.
REFRESH = r"""(?is)^\s*[^\s;,]*\s*[;,\s]\s*(?:url\s*=\s*)?(?:"([^"]*).*|'([^']*).*|([^"'].*))$"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), CAPITALS, SMALL), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The canonical form of a url; null without ``://``."""
    rest = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    rest = F.regexp_replace(rest, r"([?&])(utm_[a-z]*|ref)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, r"&&+", "&"), r"\?&+", "?"), r"[?&]+$", "")
    rest = F.regexp_replace(rest, r"/+(\?|$)", "$1")
    return F.when(url.contains("://"), F.concat(F.regexp_replace(url_host(url), r"^www\.", ""), rest))


def own_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct (size, allows, rule, verdict); null if none does. Of
    rules of one length, those that allow come first, then the greatest host and path."""
    fitting = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(
                F.lit(len(r.host + r.path)).alias("size"), F.lit(r.verdict == "allow").alias("allows"),
                F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"),
            ),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fitting)) if fitting else F.lit(None).cast("struct<size:int,allows:boolean,rule:string,verdict:string>")


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of this name; null if it has none."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), lambda n: F.translate(n, CAPITALS, SMALL))
    value = F.get(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2)), (F.array_position(names, name) - 1).cast("int"))
    return F.trim(F.replace(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"), F.lit("&amp;"), F.lit("&")))


def _without_dots(path: Column) -> Column:
    """A path without its segments ``.`` and ``..``."""
    kept = F.aggregate(
        F.split(F.regexp_replace(path, "^/", ""), "/"),
        F.array().cast("array<string>"),
        lambda held, x: F.when(x == ".", held)
        .when(x == "..", F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(0))))
        .otherwise(F.array_append(held, x)),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolved(base: Column, target: Column) -> Column:
    """``target`` as it stands on the page ``base``: with host and path; null if it is no other page."""
    path, rest = F.regexp_extract(target, r"^[^?#]*", 0), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(url_path(base), r"^/(.*/)?", 1))
    host = F.concat(F.lit("http://"), url_host(base))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when((target == "") | target.startswith("#") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("?"), F.concat(host, url_path(base), target))
        .when(target.startswith("/"), F.concat(host, _without_dots(path), rest))
        .otherwise(F.concat(host, _without_dots(F.concat(folder, path)), rest))
    )


def declared(url: Column, html: Column) -> Column:
    """The targets of all canonical links and refreshes of a page: attributes in any order, quoted or
    not, relative targets resolved (against the page's ``base``, if it has one)."""

    def tags(name):
        return F.regexp_extract_all(html, F.lit(TAG % name), F.lit(1))

    def link(tag):
        rel = F.split(F.translate(attribute(tag, "rel"), CAPITALS, SMALL), r"\s+")
        return F.when(F.array_contains(rel, "canonical"), resolved(base, attribute(tag, "href")))

    def refresh(tag):
        content = attribute(tag, "content")
        to = F.trim(F.concat(*[F.regexp_extract(content, REFRESH, k) for k in (1, 2, 3)]))
        return F.when(F.translate(attribute(tag, "http-equiv"), CAPITALS, SMALL) == "refresh", resolved(base, to))

    bases = F.filter(F.transform(tags("base"), lambda tag: resolved(url, attribute(tag, "href"))), lambda x: x.isNotNull())
    base = F.coalesce(F.get(bases, 0), url)
    return F.coalesce(F.concat(F.transform(tags("link"), link), F.transform(tags("meta"), refresh)), F.array().cast("array<string>"))


def alias_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst)``: digests of a url and of what it is an alias of."""
    url = F.col("url")
    targets = F.concat(F.array(canonical(url)), F.transform(declared(url, F.col("html")), canonical))
    return (
        pages.where(url.contains("://"))
        .select(F.md5(url).alias("src"), F.explode(F.array_distinct(targets)).alias("to"))
        .where("to is not null")
        .select("src", F.md5(F.concat(F.lit("canonical "), F.col("to"))).alias("dst"))
    )


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (``page_id, url, html``).

    ``rules`` become part of the plan: hundreds, not millions.
    """
    base = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    base = base.withColumn("own", own_rule(rules, F.col("host"), F.col("path"))).withColumn("node", F.md5("url"))
    groups = components(alias_edges(pages))
    said = base.where("own is not null").select("node", F.col("own.verdict").alias("v")).distinct()
    decided = (
        said.join(groups, "node")
        .groupBy("component")
        .agg(F.min("v").alias("group_verdict"))  # allow comes before block
    )
    verdicts = groups.join(decided, "component").select("node", "group_verdict")
    return base.join(verdicts, "node", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "group_verdict", F.lit("allow")).alias("verdict"),
    )
