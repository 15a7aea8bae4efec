"""Judging urls by host and path rules, and by what their aliases are judged.

A rule fits its host and all subdomains where the path starts with the rule's;
the longest rule decides. Urls that redirect to each other, or name each other
as canonical, are one page under several names: they form the components of a
graph, and a url without a rule of its own is blocked if a name of its page is,
unless a name of its page is explicitly allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.components import connected_components
from paperloom.llm.rows import packed, quoted, unpacked, without
from paperloom.operators.joins import join_unique
from paperloom.staging import once, stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What a page only talks about, and the tags in which it says under which other name it is known.
_UNSEEN = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)|<style\b.*?(?:</style|$)"
_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
_REFRESH_URL = r"""(?is)url\s*=\s*["']?([^"']*)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule, and its verdict; null where none fits."""
    fits = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(str(r)), -len(r.host), r.verdict))
    if not ordered:
        return fits
    cases = None
    for rule in ordered:
        met = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        cases = F.when(met, value) if cases is None else cases.when(met, value)
    return cases["rule"], cases["verdict"]


def page_name(url: Column) -> Column:
    """What a url names: scheme and host in lower case, no fragment, ``/`` for an empty path; null without ``://``."""
    scheme = F.translate(F.regexp_extract(url, r"(?s)^(.*?)://", 1), _UPPER, _LOWER)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host_of(url), rest))


def resolve(target: Column, base: Column) -> Column:
    """A link as an absolute url: absolute, scheme-relative, host-relative or relative to the folder."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    origin = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    trimmed = F.trim(target)
    return (
        F.when(trimmed.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), trimmed)
        .when(trimmed.startswith("//"), F.concat(scheme, F.lit(":"), trimmed))
        .when(trimmed.startswith("/"), F.concat(origin, trimmed))
        .when(trimmed.startswith("?"), F.concat(origin, path_of(base), trimmed))
        .otherwise(F.concat(origin, folder, trimmed))
    )


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, however it is quoted; null if it is empty or not there."""
    pattern = rf"""(?is)[\s"'/]{name}{_VALUE}"""
    return F.coalesce(*[F.nullif(F.regexp_extract(tag, pattern, i), F.lit("")) for i in (1, 2, 3)])


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Redirect and canonical edges ``(source, target)`` that the pages themselves name.

    Every ``link`` whose ``rel`` has the word canonical and every refresh tag
    with a target gives an edge, so a page may name several; those in comments,
    scripts and styles, and empty ones, give none. Pages without url or html
    name nothing. Repeated rows repeat their edges.
    """
    body = F.coalesce(F.col(quoted(html)), F.lit(""))
    small = F.lower(body)
    # the tests for a substring keep the patterns from pages without such a tag
    named = pages.select(F.col(quoted(url)).alias("source"), body.alias("body")).filter(F.col(quoted(url)).isNotNull() & (small.contains("canonical") | small.contains("refresh")))
    seen = once(named, _seen=F.regexp_replace("body", _UNSEEN, " "))
    words = lambda tag: F.split(F.lower(F.trim(_attribute(tag, "rel"))), r"\s+")
    links = F.transform(F.regexp_extract_all("_seen", F.lit(_LINK), F.lit(0)), lambda t: F.when(F.array_contains(words(t), "canonical"), _attribute(t, "href")))
    goes = lambda tag: F.nullif(F.trim(F.regexp_extract(_attribute(tag, "content"), _REFRESH_URL, 1)), F.lit(""))
    metas = F.transform(F.regexp_extract_all("_seen", F.lit(_META), F.lit(0)), lambda t: F.when(F.lower(F.trim(_attribute(t, "http-equiv"))) == "refresh", goes(t)))
    edges = seen.select("source", F.explode(F.concat(links, metas)).alias("target")).filter("target IS NOT NULL")
    return edges.select("source", resolve(F.replace(F.col("target"), F.lit("&amp;"), F.lit("&")), F.col("source")).alias("target"))


def judge_urls(urls: DataFrame, rules: list[Rule], edges: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``).

    ``edges`` has ``source`` and ``target`` urls, taken both ways. A url with a
    fitting rule has that rule's verdict. Any other is judged by its names,
    the urls in its component and its own other spellings: allowed if one is
    explicitly allowed, else blocked if one is blocked, else allowed. A null
    url and one without ``://`` name nothing, have an empty host and path, and
    are allowed unless a rule fits. Urls that edges name count even where no row has
    them. Repeated urls are judged alike; rows and other columns stay, but
    columns of the new names are replaced.
    """
    kept = without(urls.columns, ["host", "path", "rule", "verdict"])
    spelled = edges.select(page_name(F.col("source")).alias("s"), page_name(F.col("target")).alias("t"), "source", "target")
    linked = stage(spelled.filter("s IS NOT NULL AND t IS NOT NULL AND s <> t"), "url-edges")
    u = F.col("u")
    placed = urls.select(packed(urls, kept), F.col(quoted(url)).alias("u"), host_of(F.col(quoted(url))).alias("host"), path_of(F.col(quoted(url))).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = placed.select("*", rule.alias("rule"), verdict.alias("own"), page_name(u).alias("name"))

    ends = linked.select(F.col("s").alias("name"), F.col("source").alias("u")).unionByName(linked.select(F.col("t").alias("name"), F.col("target").alias("u")))
    said = rule_of(host_of(u), path_of(u), rules)[1]
    spellings = ends.unionByName(own.filter("name IS NOT NULL").select("name", "u")).select("name", said.alias("said"))
    # of each name: is a spelling allowed, is one blocked
    judged = lambda verdict: F.max(F.coalesce(F.col("said") == verdict, F.lit(False)))
    marks = spellings.groupBy("name").agg(judged("allow").alias("allow"), judged("block").alias("block"))
    # nodes of the graph are hashes of names
    labels = connected_components(linked.select(F.xxhash64("s").alias("a"), F.xxhash64("t").alias("b")))
    roots = ends.select("name").distinct().withColumn("node", F.xxhash64("name")).join(labels, "node").select("name", "root")
    marked = marks.join(roots, "name", "left")
    pages = marked.filter("root IS NOT NULL").groupBy("root").agg(F.max("allow").alias("any_allow"), F.max("block").alias("any_block"))
    allow, block = F.coalesce("any_allow", "allow"), F.coalesce("any_block", "block")
    blocked = marked.join(pages, "root", "left").filter(block & ~allow).select("name", F.lit("block").alias("passed"))
    out = join_unique(own, blocked, ["name"])
    final = F.coalesce("own", "passed", F.lit("allow"))
    return out.select(*unpacked(kept), "host", "path", "rule", final.alias("verdict"))
