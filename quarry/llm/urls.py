"""URL rules with redirect equivalence: decisions spread over redirect and canonical-link components."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.components import connected_components
from quarry.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``action`` ("allow" or "block") for a host with its subdomains and the paths that start with ``path``."""

    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def url_part(url: Column, group: int) -> Column:
    """1: the host, A-Z lower-cased; 2: the path. Both empty for null or where there is no ``://``."""
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))
    return F.translate(found, UPPER, LOWER) if group == 1 else found


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, else null; of equally long ones the first in the list."""
    out = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


def node_of(url: Column) -> Column:
    """Identity of a url as an alias: scheme, its default port and fragment dropped, host lower-cased; null if it has no host."""
    host = url_part(url, 1)
    scheme = F.lower(F.regexp_extract(url, r"(?s)^\s*([^:/?#]*)://", 1))
    port = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host != "", F.concat(port, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def without_dots(path: Column) -> Column:
    """A path that starts with ``/``, its ``.`` and ``..`` segments resolved; what follows ``?`` is left alone."""
    parts = F.split(F.regexp_extract(path, r"(?s)^([^?]*)", 1), "/")
    query = F.regexp_extract(path, r"(?s)^[^?]*(.*)$", 1)
    last = F.element_at(parts, -1)
    parts = F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    up = lambda acc: F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(x == "..", up(acc)).otherwise(F.concat(acc, F.array(x))))
    return F.concat(F.array_join(kept, "/"), query)


def resolved(target: Column, base: Column) -> Column:
    """The absolute url of a link's target on a page at ``base``; null for other schemes (mailto:, data:) and hostless bases."""
    t = F.trim(target)
    scheme, origin = F.regexp_extract(base, r"(?s)^(.*?):", 1), F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    return (
        F.when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), t)
        .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
        .when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*:") | (origin == ""), F.lit(None))
        .when(t.startswith("/"), F.concat(origin, without_dots(t)))
        .when(t.startswith("?"), F.concat(origin, path, t))
        .when(t.startswith("#"), base)
        .otherwise(F.concat(origin, without_dots(F.concat(folder, t))))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): redirect and canonical edges that a page's own markup declares, as alias identities.

    Reads every ``<link rel=canonical>``, ``<meta property=og:url>`` and ``<meta http-equiv=refresh>``. Relative targets are
    resolved against the page's ``<base href>`` or its own url. Null urls or markup add no edge.
    """
    h, u = F.col(f"`{html}`"), F.col(f"`{url}`")
    attr = lambda tag, name: F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']?([^\"'\s>]+)", 1)
    tags = lambda pattern: F.regexp_extract_all(h, F.lit(rf"(?is)({pattern})"), F.lit(1))
    canonical = F.transform(tags(r"<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), lambda t: attr(t, "href"))
    og = F.transform(tags(r"<meta\b[^>]*\bproperty\s*=\s*[\"']?og:url\b[^>]*>"), lambda t: attr(t, "content"))
    refresh = F.transform(tags(r"<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*['\"]?([^\"'\s>]+)", 1))
    said = h.rlike(r"(?i)\bcanonical\b|\bog:url\b|\brefresh\b")
    base = F.regexp_extract(h, r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    links = pages.where(said).select(u.alias("u"), base.alias("base"), F.explode(F.concat(canonical, og, refresh)).alias("t")).where("t <> ''")
    links = materialize(links, "targets")  # few rows: what is computed of them is computed once and compiled small
    if links.isEmpty():
        return links.select(F.col("u").alias("a"), F.col("t").alias("b"))
    links = links.withColumn("base", F.coalesce(F.when(F.col("base") != "", resolved(F.col("base"), F.col("u"))), F.col("u")))
    links = links.withColumn("to", resolved(F.col("t"), F.col("base")))
    return links.select(node_of(F.col("u")).alias("a"), node_of(F.col("to")).alias("b")).where("a is not null and b is not null and a <> b")


def judge_urls(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A page that a rule fits gets the rule's action. Any other page takes the decision of its component under
    ``edges`` (columns a, b: alias identities as ``node_of`` gives them): allow if a member is explicitly allowed,
    else block if a member is blocked, else allow. A member of a component is any end of an edge, page or not.
    Null or hostless urls: empty host and path, no rule, allow. Columns of ``pages`` that have the four names are
    replaced. Rows are kept as they are, repeats included. Without edges no shuffle runs.
    """
    actions = {r.name: r.action for r in reversed(rules)}
    act = F.element_at(F.create_map(*[F.lit(x) for kv in actions.items() for x in kv]), F.col("rule")) if rules else F.lit(None).cast("string")
    u = F.col(f"`{url}`")
    out = pages.withColumns({"host": url_part(u, 1), "path": url_part(u, 2)}).withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    if edges is not None:
        edges = materialize(edges.select("a", "b").distinct(), "links")
    if edges is None or edges.isEmpty():
        return out.withColumn("verdict", F.coalesce(act, F.lit("allow")))
    member = connected_components(edges)
    at = F.concat(F.lit("x://"), F.col("node"))
    member = member.withColumn("rule", matching_rule(url_part(at, 1), url_part(at, 2), rules)).withColumn("act", act)
    decided = member.groupBy("component").agg(F.max(F.col("act") == "allow").alias("ok"), F.max(F.col("act") == "block").alias("bad"))
    spread = member.join(decided.where("ok or bad"), "component").select(F.col("node").alias("__node"), F.when(F.coalesce("ok", F.lit(False)), "allow").otherwise("block").alias("__spread"))
    out = out.withColumn("__key", F.when(F.col("rule").isNull(), node_of(u)))
    out = out.join(spread, F.col("__key") == F.col("__node"), "left")
    return out.withColumn("verdict", F.coalesce(act, "__spread", F.lit("allow"))).drop("__key", "__node", "__spread")
