"""URL verdicts: host/path rules, and block decisions carried over to aliases.

Two URLs are aliases if a chain of redirects (meta refresh), canonical links, or the
canonical spelling of an address (no ``www.``, trailing slash or tracking parameters)
joins them. Components of that graph are found by Spark; within one, a blocked address
blocks every alias that no rule judges, unless the component also holds an explicitly
allowed address: allow takes precedence.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealhouse.llm.common import materialize
from dealhouse.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# An attribute starts after white space, a quote or a slash, so that data-href is none.
CANONICAL_TAG = r"""(?is)<link(?:[\s"'/][^>]*)?[\s"'/]rel\s*=\s*["']?canonical["'\s>/][^>]*>?"""
HREF = r"""(?is)[\s"'/]href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFRESH_TAG = r"""(?is)<meta(?:[\s"'/][^>]*)?[\s"'/]http-equiv\s*=\s*["']?refresh["'\s>/][^>]*>?"""
REFRESH_URL = r"""(?is)url\s*=\s*["']?([^"'\s>]+)"""
SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"
TRACKING = "&(utm_[a-z]*|ref|fbclid|gclid)=[^&]*"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, all its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rule list of the registered query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _query(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^?#]*[?]([^#]*)", 1)


def _address(host: Column, path: Column, query: Column) -> Column:
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def address_of(url: Column) -> Column:
    """A URL without scheme and fragment: the node that it is in the alias graph. Null without a host part."""
    return F.when(_rest(url).isNotNull(), _address(host_of(url), path_of(url), _query(url)))


def canonical_of(url: Column) -> Column:
    """The canonical spelling of the address."""
    query = F.regexp_replace(F.concat(F.lit("&"), _query(url)), TRACKING, "")
    return F.when(_rest(url).isNotNull(), _address(
        F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", ""),
        F.regexp_replace(query, "^&", "")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without_dots(path: Column) -> Column:
    """``path`` without ``.`` and ``..`` segments; what would climb above the root stays at it."""
    def folded(parts: Column) -> Column:
        last = F.element_at(parts, -1)
        kept = F.aggregate(
            F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
            lambda done, x: F.when(x == ".", done)
            .when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(x))))
        return _let(F.concat(F.lit("/"), F.array_join(kept, "/")), lambda whole: F.when(
            last.isin(".", "..") & ~whole.endswith("/"), F.concat(whole, F.lit("/"))).otherwise(whole))

    return F.when(path == "", path).otherwise(_let(F.split(path, "/"), folded))


def _placed(url: Column, ref: Column) -> Column:
    """``ref`` put onto ``url``, dot segments and all; null where it leads to no other page."""
    scheme = F.lower(F.regexp_extract(ref, SCHEME, 1))
    base = F.concat(F.lit("http://"), host_of(url))
    folder = F.when(path_of(url) == "", F.lit("/")).otherwise(F.regexp_replace(path_of(url), "[^/]*$", ""))
    return (F.when((ref == "") | _rest(url).isNull(), F.lit(None).cast("string"))
            .when(scheme.isin("http", "https"), F.when(F.regexp_like(ref, F.lit("^[^:]*://")), ref))
            .when(scheme != "", F.lit(None).cast("string"))
            .when(ref.startswith("//"), F.concat(F.lit("http:"), ref))
            .when(ref.startswith("/"), F.concat(base, ref))
            .when(ref.startswith("?"), F.concat(base, path_of(url), ref))
            .otherwise(F.concat(base, folder, ref)))


def resolve(url: Column, href: Column) -> Column:
    """The address that ``href`` leads to from ``url``, by the rules of RFC 3986.

    ``&amp;`` stands for ``&``. Null where it leads to no other page: an empty one, a fragment
    alone, a scheme other than http and https, or a ``url`` without a host part to stand on.
    """
    ref = F.replace(F.btrim(href, F.lit(" \t\n\f\r")), F.lit("&amp;"), F.lit("&"))
    return _let(F.regexp_replace(ref, "(?s)#.*$", ""), lambda r: _let(_placed(url, r), lambda whole: F.when(
        whole.isNotNull(), _address(host_of(whole), without_dots(path_of(whole)), _query(whole)))))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null; allow wins between equally long ones."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "allow"))

    def fits(r: Rule) -> Column:
        return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)

    found = reduce(lambda case, r: case.when(fits(r), F.lit(value(r))) if case is not None
                   else F.when(fits(r), F.lit(value(r))), ordered, None)
    return F.lit(None).cast("string") if found is None else found.otherwise(F.lit(None).cast("string"))


def _attribute(tag: Column, pattern: str) -> Column:
    """The value of an attribute, from whichever of the pattern's groups holds it."""
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def _node(address: Column) -> Column:
    """128 bits that stand for an address in the graph: rounds shuffle these, not long URLs."""
    return F.unhex(F.md5(address))


def alias_links(pages: DataFrame) -> DataFrame:
    """``(a, b, from_address, to_address)``: the nodes and addresses of two aliases."""
    url, html = F.col("url"), F.col("html")
    canonical = _attribute(F.regexp_extract(html, CANONICAL_TAG, 0), HREF)
    refresh = F.regexp_extract(F.regexp_extract(html, REFRESH_TAG, 0), REFRESH_URL, 1)
    others = F.array(
        canonical_of(url),
        F.when(F.instr(F.lower(html), "canonical") > 0, resolve(url, canonical)),
        F.when(F.instr(F.lower(html), "refresh") > 0, resolve(url, refresh)))
    return (pages.select(address_of(url).alias("from_address"), F.explode(others).alias("to_address"))
            .filter(F.col("from_address") != F.col("to_address")).distinct()
            .select(_node(F.col("from_address")).alias("a"), _node(F.col("to_address")).alias("b"),
                    "from_address", "to_address"))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages`` (page_id, url, html).

    A page that a rule fits gets the rule's verdict; another is blocked if an alias of it
    is blocked and none is explicitly allowed, else allowed. A null url, or one without
    ``://``, has empty host and path, no aliases, and is allowed; null html has no links.
    Repeated rows are each judged; an empty table gives an empty table.
    """
    def verdict(r: Rule) -> str:
        return r.verdict

    url = F.col("url")
    links = materialize(alias_links(pages), "alias-links")
    roots = connected_components(links, "a", "b", "alias-rounds")
    ends = links.select(F.col("a").alias("node"), F.col("from_address").alias("address")).unionByName(
        links.select(F.col("b").alias("node"), F.col("to_address").alias("address")))
    as_url = F.concat(F.lit("http://"), F.col("address"))
    decided = ends.select("node", rule_of(host_of(as_url), path_of(as_url), rules, verdict).alias("decision")).filter(
        "decision is not null").distinct()
    known = roots.join(decided, "node")
    blocked = known.groupBy("root").agg(
        F.max((F.col("decision") == "block").cast("int")).alias("block"),
        F.max((F.col("decision") == "allow").cast("int")).alias("allow"),
    ).filter((F.col("block") == 1) & (F.coalesce("allow", F.lit(0)) == 0)).select("root")
    guilty = roots.join(blocked, "root").select(F.col("node").alias("guilty"))
    judged = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"),
        _node(address_of(url)).alias("node"))
    judged = judged.withColumns({
        "rule": rule_of(F.col("host"), F.col("path"), rules, lambda r: r.name),
        "ruled": rule_of(F.col("host"), F.col("path"), rules, verdict)})
    return judged.join(guilty, F.col("node") == F.col("guilty"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("guilty").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
        .alias("verdict"))
