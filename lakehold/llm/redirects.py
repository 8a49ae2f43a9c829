"""URL filter with redirect equivalence.

Explicit rules (host and its subdomains, path prefix, longest wins) judge every URL first. URLs that
are the same resource share a decision: an edge joins a page's URL and the target of its meta
refresh, its canonical link, and its plain form (no scheme, fragment, tracking parameters, index
page or closing slash). Connected components over these edges carry block decisions to aliases
without a rule of their own. An explicit allow comes before a block: a URL's own rule stands, and an
alias set with an allowed member allows its members without a rule.

Each page gives a few short edges; components come from star steps that never gather one URL's
edges in a task, and verdicts of a component are two pre-aggregated booleans.

Defined cases. A null URL, or one without ``://``, has empty host and path, no rule and the verdict
allow; so has a URL that neither a rule nor an alias decides. Null html has no links. Repeated
pages are judged alike. Very long html is searched whole. Relative targets resolve as in RFC 3986, dot segments
and query-only links included, against the page's ``<base>`` or its URL.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.llm._graph import components

TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def host_of(url: Column) -> Column:
    """A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules: list[tuple[str, str, str]], what: int | None = None) -> Column:
    """The longest rule (host and path, its text) that fits, or with ``what=0`` its verdict."""
    best = F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        best = F.when(fits, F.lit(verdict if what == 0 else rule_host + rule_path)).otherwise(best)
    return best


def plain(url: Column) -> Column:
    """The form in which spellings of one resource agree; null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?i:{TRACKING})(=|$)")))
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", "/"), r"(\.html?|/)$", "")
    whole = F.concat(host_of(url), path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(url.contains("://"), whole)


SCHEME = "[A-Za-z][A-Za-z0-9+.-]*"


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved; ``..`` at the root goes nowhere."""
    parts = F.slice(F.split(path, "/"), 2, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, part: F.when(
        part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done).otherwise(F.concat(done, F.array(part))))
    # a path that ends with a dot segment is a folder
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.concat(
        F.lit("/"), F.array_join(kept, "/"), F.when(path.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), "/").otherwise(""))).otherwise(path)


def resolved(base: Column, link: Column) -> Column:
    """An absolute URL for a link of a page at ``base``. Null: empty links, links within the page
    (fragment only) and those that name no host (``mailto:``, ``javascript:``)."""
    link = F.regexp_replace(F.trim(link), "&amp;", "&")
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    root = F.concat(scheme, F.lit("//"), F.regexp_extract(base, r"(?s)^.*?://([^/?#]*)", 1))
    here = F.when(path_of(base) == "", "/").otherwise(path_of(base))
    to, rest = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    path = F.when(to == "", here).when(to.startswith("/"), to).otherwise(F.concat(F.regexp_replace(here, r"[^/]*$", ""), to))
    return (F.when(F.coalesce(link, F.lit("")).rlike("^(#|$)"), None).when(link.rlike(f"^{SCHEME}://"), link)
            .when(link.rlike(f"^{SCHEME}:"), None)
            .when(link.startswith("//"), F.concat(scheme, link))
            .otherwise(F.concat(root, _without_dots(path), rest)))


def links(pages: DataFrame) -> DataFrame:
    """(url, alias): canonical links and meta refreshes of the pages, both as URLs. Tags within
    comments do not count; links are relative to the page's ``<base>``, if it has one."""
    url = F.col("url")
    html = F.regexp_replace("html", "(?s)<!--.*?(-->|$)", "")
    quoted = lambda tag, name: F.coalesce(*[F.nullif(F.regexp_extract(tag, rf"(?is)[\s\"']{name}\s*=\s*{how}", 1), F.lit(""))
                                            for how in (r"\"\s*([^\"]*)", r"'\s*([^']*)", r"([^\"'\s>]+)")], F.lit(""))
    tag = lambda name, mark: F.regexp_extract(F.col("kept"), rf"(?is)<{name}\b(?=[^>]*{mark})[^>]*>", 0)
    tags = pages.where(url.contains("://") & F.col("html").rlike("(?i)<(link|meta)")).select(url, html.alias("kept")).select(
        url, tag("link", r"rel\s*=\s*[\"']?[^\"'>]*\bcanonical\b").alias("canonical"),
        tag("meta", r"http-equiv\s*=\s*[\"']?\s*refresh\b").alias("refresh"), tag("base", r"\bhref\s*=").alias("base"))
    to = F.regexp_extract(quoted(F.col("refresh"), "content"), r"(?is)\burl\s*=\s*['\"]?([^'\"]*)", 1)
    found = tags.select(url, F.coalesce(resolved(url, quoted(F.col("base"), "href")), url).alias("base"),
                        quoted(F.col("canonical"), "href").alias("href"), F.trim(to).alias("to"))
    return found.select(url, F.explode(F.array(resolved(F.col("base"), F.col("href")), resolved(F.col("base"), F.col("to")))).alias("alias")).where(
        "alias is not null")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], spellings: bool = True) -> DataFrame:
    """(page_id, url, html) -> page_id, host, path, rule, verdict. Rules are (verdict, host, path).

    ``spellings=False`` leaves the plain forms out: only redirects and canonical links join URLs."""
    url = F.col("url")
    own = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    own = own.select("*", rule_column(F.col("host"), F.col("path"), rules).alias("rule"),
                     rule_column(F.col("host"), F.col("path"), rules, 0).alias("said"))

    named = links(pages).where(plain(F.col("alias")).isNotNull())
    urls = own.select("url").unionByName(named.select(F.col("alias").alias("url"))).where(url.contains("://")).distinct()
    # spellings and plain forms are nodes of two kinds
    spelled = lambda c: F.concat(F.lit("u "), c)
    edges = named.select(spelled(url).alias("u"), spelled(F.col("alias")).alias("v"))
    if spellings:
        edges = urls.select(spelled(url).alias("u"), F.concat(F.lit("p "), plain(url)).alias("v")).unionByName(edges)
    # a component of one URL and its plain form decides nothing: only forms that several share matter
    shared = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("v")
    linked = named.select(spelled(url).alias("u")).unionByName(named.select(spelled(F.col("alias")).alias("u"))).distinct()
    meeting = edges.join(shared, "v", "left_semi").unionByName(edges.join(linked, "u", "left_semi")).distinct()
    member = components(meeting)

    ruled = urls.select(url, rule_column(host_of(url), path_of(url), rules, 0).alias("said")).where("said is not null")
    found = ruled.join(member.withColumnRenamed("node", "key"), spelled(url) == F.col("key")).groupBy("component").agg(
        F.max(F.col("said") == "allow").alias("allowed"))
    decided = member.join(found, "component").select(F.col("node").alias("key"), "allowed")
    free = own.where("said is null").withColumn("key", spelled(url)).join(decided, "key", "left").select(
        "page_id", "host", "path", "rule", F.when(F.col("allowed"), "allow").when(~F.col("allowed"), "block").otherwise("allow").alias("verdict"))
    return own.where("said is not null").select("page_id", "host", "path", "rule", F.col("said").alias("verdict")).unionByName(free)
