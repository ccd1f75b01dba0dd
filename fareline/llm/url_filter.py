"""Allow and block rules for URLs, carried over to aliases by redirects and canonical links.

1. Every URL is judged by the rules: a rule names a host, which stands for its subdomains too,
   and the beginning of a path; the longest fitting rule wins.
2. Pages name other addresses of themselves: canonical links and refresh redirects in the
   html, and redirects that a crawler has logged. These edges make connected components.
3. A URL with a rule of its own keeps that rule's verdict. Any other is blocked if its component
   holds a blocked URL and none that is explicitly allowed; without a component it is allowed.

Rules are looked up, not tried one by one: hosts are reduced to distinct ones and meet the rules
by host suffix, which tells how long the paths of the fitting rules are; URLs of such hosts then
meet the rules by suffix and path prefix. All joins are on equal keys, so neither the number of
rules nor a host with most of the URLs matters. Only DataFrame functions are used.

Defined results. The identity of a URL is the URL without fragment, scheme and host in small
letters; a null URL or one without `://` has none, has no aliases, fits no rule and is allowed.
Pages with the same URL, and repeated rows, are judged alike, one row each. Of rules of equal
length, allow wins over block, then the larger host. Null, empty and very long html gives the
links it has: a tag ends at its first `>`; tags in comments, scripts and styles do not count.
Links that are empty, name the page itself or another scheme than one with `://` give no edge. An empty
table gives no rows. Columns are resolved by name for the id, URL and html only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import components, small_side, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
RULES = [
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
]


# --- Parts of a URL ---------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _scheme_of(url: Column) -> Column:
    return F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)


def identity(url: Column) -> Column:
    """The URL without fragment, scheme and host lower-cased; null without `://`."""
    rest = F.regexp_extract(url, "://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(_scheme_of(url), F.lit("://"), host_of(url), rest))


def _without_dots(path: Column) -> Column:
    """`.` and `..` segments of a path taken out."""
    parts = F.split(path, "/", -1)

    def step(kept: Column, part: Column) -> Column:
        # The first segment is the empty one before the leading slash; it stays.
        shorter = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", shorter).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    folder = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.array_join(kept, "/"), F.when(folder, "/").otherwise(""))


def resolved(link: Column, base: Column) -> Column:
    """The identity of what `link` names on the page `base`; null if it names nothing else."""
    bare = F.regexp_replace(F.regexp_replace(link, r"[\t\n\r]", ""), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    site = F.concat(_scheme_of(base), F.lit("://"), host_of(base))
    path = path_of(base)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "(?s)^(.*/)", 1))
    link_path, tail = F.regexp_extract(bare, "^([^?#]*)", 1), F.regexp_extract(bare, "^[^?#]*(.*)$", 1)

    def on_site(path: Column) -> Column:
        return F.concat(site, _without_dots(path), tail)

    target = (
        F.when(bare.rlike("^([?].*)?(#.*)?$"), F.when(bare.startswith("?"), F.concat(site, path, bare)))
        .when(bare.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(bare.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), bare))
        .when(bare.startswith("//"), F.concat(_scheme_of(base), F.lit(":"), bare))
        .when(bare.startswith("/"), on_site(link_path))
        .otherwise(on_site(F.concat(folder, link_path)))
    )
    return F.when(base.contains("://"), identity(target))


# --- Links of a page --------------------------------------------------------------------


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, without its quotes; empty if the tag has none."""
    value = F.regexp_extract(tag, rf"(?i)[\s\"'/]{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.regexp_replace(value, "^[\"']|[\"']$", "")


def page_links(html: Column) -> Column:
    """Canonical links and refresh redirects, as written in the tags."""
    seen = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1", "")
    tags = F.regexp_extract_all(seen, F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), 0)

    def link(tag: Column) -> Column:
        canonical = F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical")
        refresh = F.trim(F.lower(_attribute(tag, "http-equiv"))) == "refresh"
        goes_to = F.regexp_extract(
            _attribute(tag, "content"), r"(?i)^[\s\d.]*[;,]?\s*url\s*=\s*[\"']?([^\"']*)", 1
        )
        found = F.when(canonical, _attribute(tag, "href")).when(refresh, goes_to).otherwise("")
        return F.regexp_replace(found, "(?i)&(?:amp|#38|#x26);", "&")

    return F.filter(F.transform(tags, link), lambda found: found != "")


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """a, b: identities of a page's URL and of the URLs it names as its own."""
    html, url = F.col(html_col).cast("string"), F.col(url_col).cast("string")
    # Most pages name none; they are passed over without taking their tags apart.
    named = pages.filter(html.rlike("(?i)canonical|http-equiv")).select(
        url.alias("url"), F.explode(page_links(html)).alias("link")
    )
    return named.select(identity(F.col("url")).alias("a"), resolved(F.col("link"), F.col("url")).alias("b"))


def logged_edges(redirects: DataFrame, from_col: str = "from_url", to_col: str = "to_url") -> DataFrame:
    """a, b of redirects that a crawler has followed."""
    origin, target = F.col(from_col).cast("string"), F.col(to_col).cast("string")
    return redirects.select(identity(origin).alias("a"), resolved(target, origin).alias("b"))


# --- Rules ------------------------------------------------------------------------------


def rule_table(spark, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """verdict, host, path of rules given as a list."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def fitting(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict: the longest rule of every place that has one.

    `places` holds host and path, `rules` verdict, host and path.
    """
    shapes = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.length("path")).alias("sizes"))
    labels = F.split("host", r"\.", -1)
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    shapes, spark_places = stored(shapes, "rule-shapes"), stored(places.select("host", "path").distinct(), "places")
    hosts = stored(
        spark_places.filter("host <> ''").select("host").distinct().withColumn("suffix", F.explode(ends))
        .join(small_side(shapes), "suffix").select(F.col("host").alias("h"), "suffix", F.explode("sizes").alias("size")),
        "rule-hosts",
    )
    tried = spark_places.join(small_side(hosts), F.col("host") == F.col("h")).filter(
        F.length("path") >= F.col("size")
    ).select("host", "path", "suffix", F.substring("path", F.lit(1), F.col("size")).alias("prefix"))
    named = stored(
        rules.select(
            F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict",
            F.concat("host", "path").alias("rule"),
        ),
        "rules",
    )
    # Of equal length: allow, as the smaller word, then the larger rule.
    rank = F.struct(F.length("rule"), F.col("verdict") == ALLOW, F.col("rule"))
    return stored(
        tried.join(small_side(named), ["suffix", "prefix"]).groupBy("host", "path").agg(
            F.max_by(F.struct("rule", "verdict"), rank).alias("best")
        ).select("host", "path", "best.rule", "best.verdict"),
        "fitting",
    )


def blocked_aliases(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """url: identities in components with a blocked URL and none that a rule allows."""
    edges = stored(edges.filter("a is not null and b is not null and a <> b").distinct(), "url-edges")
    # Components are found on numbers: shorter to shuffle than URLs, and exact, unlike hashes.
    nodes = stored(
        edges.select(F.explode(F.array("a", "b")).alias("url")).distinct().select(
            "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "url-nodes",
    )
    numbers = nodes.select("url", "node")
    numbered = stored(
        edges.join(numbers.toDF("a", "from"), "a").join(numbers.toDF("b", "to"), "b").select(
            F.col("from").alias("a"), F.col("to").alias("b")
        ),
        "url-links",
    )
    judged = nodes.join(fitting(nodes, rules), ["host", "path"], "left").select("url", "node", "verdict")
    members = stored(judged.join(components(numbered, "aliases"), "node"), "url-members")
    bad = members.groupBy("component").agg(
        F.max(F.col("verdict") == BLOCK).alias("blocked"), F.max(F.col("verdict") == ALLOW).alias("allowed")
    ).filter(F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False)))
    return stored(members.join(bad.select("component"), "component").select("url"), "blocked-aliases")


def judged(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits), verdict, inherited.

    `redirects` holds from_url and to_url. `inherited` marks pages blocked by an alias.
    """
    url = F.col(url_col).cast("string")
    places = stored(
        pages.select(
            F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
            identity(url).alias("alias"),
        ),
        "page-places",
    )
    edges = places.select(F.col("alias").alias("a"), F.col("alias").alias("b")).limit(0)
    if html_col:
        edges = edges.unionByName(page_edges(pages, url_col, html_col))
    if redirects is not None:
        edges = edges.unionByName(logged_edges(redirects))
    bad = blocked_aliases(edges, rules).select(F.col("url").alias("alias"), F.lit(True).alias("bad"))
    best = fitting(places, rules)
    out = places.join(best, ["host", "path"], "left").join(small_side(bad), "alias", "left")
    inherits = F.col("verdict").isNull() & F.coalesce("bad", F.lit(False))
    return out.select(
        "id", "host", "path", "rule",
        F.coalesce("verdict", F.when(inherits, BLOCK).otherwise(ALLOW)).alias("verdict"),
        inherits.alias("inherited"),
    )


def op13_url_filter(spark, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "pages"), rule_table(spark))
    return found.withColumnRenamed("id", "page_id")


OP13_SQL = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), tags AS (
  SELECT url, unnest(regexp_extract_all(
           regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script|<style\b.*?</style', '', 'g'),
           '(?i)<(?:link|meta)\b[^>]*>')) AS tag
  FROM pages
), attributes AS (
  SELECT url,
         lower(trim(regexp_extract(tag, '(?i)[\s"''/]rel\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '"''')) AS rel,
         trim(regexp_extract(tag, '(?i)[\s"''/]href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '"''') AS href,
         lower(trim(regexp_extract(tag, '(?i)[\s"''/]http-equiv\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '"'' ')) AS equiv,
         regexp_replace(regexp_extract(tag, '(?i)[\s"''/]content\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '^["'']|["'']$', '', 'g') AS content
  FROM tags
), links AS (
  SELECT url,
         regexp_replace(regexp_replace(regexp_replace(
           CASE WHEN list_contains(regexp_split_to_array(rel, '\s+'), 'canonical') THEN href
                WHEN equiv = 'refresh' THEN regexp_extract(content, '(?i)^[\s\d.]*[;,]?\s*url\s*=\s*["'']?([^"'']*)', 1)
                ELSE '' END,
           '(?i)&(?:amp|#38|#x26);', '&', 'g'), '[\t\n\r]', '', 'g'), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS link,
         lower(split_part(url, '://', 1)) || '://' || lower(regexp_extract(url, '://([^/?#]*)', 1)) AS site,
         regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS base
  FROM attributes WHERE url LIKE '%://%'
), placed AS (
  SELECT *,
         CASE WHEN link LIKE '/%' THEN '' WHEN base = '' THEN '/' ELSE regexp_extract(base, '(?s)^(.*/)', 1) END
           || regexp_extract(link, '^([^?#]*)', 1) AS joined
  FROM links
), targets AS (
  SELECT url,
         CASE WHEN regexp_full_match(link, '([?].*)?(#.*)?')
              THEN CASE WHEN link LIKE '?%' THEN site || base || link END
              WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:')
              THEN CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link END
              WHEN link LIKE '//%' THEN split_part(site, '://', 1) || ':' || link
              ELSE site || array_to_string(list_reduce(string_split(joined, '/'),
                     lambda kept, part: CASE WHEN part = '.' THEN kept
                       WHEN part = '..' THEN list_slice(kept, 1, greatest(len(kept) - 1, 1))
                       ELSE list_append(kept, part) END, []::VARCHAR[]), '/')
                   || CASE WHEN regexp_matches(joined, '(^|/)[.][.]?$') THEN '/' ELSE '' END
                   || regexp_extract(link, '^[^?#]*(.*)$', 1) END AS target
  FROM placed
), raw_edges AS (
  SELECT url AS a, target AS b FROM targets WHERE target LIKE '%://%'
), edges AS (
  SELECT lower(split_part(a, '://', 1)) || '://' || lower(regexp_extract(a, '://([^/?#]*)', 1)) || regexp_extract(a, '://[^/?#]*([^#]*)', 1) AS a,
         lower(split_part(b, '://', 1)) || '://' || lower(regexp_extract(b, '://([^/?#]*)', 1)) || regexp_extract(b, '://[^/?#]*([^#]*)', 1) AS b
  FROM raw_edges
), near AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
), reach(a, b) AS (
  SELECT a, a FROM near
  UNION
  SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a
), parts AS (
  SELECT page_id, url,
         CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
         CASE WHEN url LIKE '%://%' THEN lower(split_part(url, '://', 1)) || '://' || lower(regexp_extract(url, '://([^/?#]*)', 1)) || regexp_extract(url, '://[^/?#]*([^#]*)', 1) END AS alias
  FROM pages
), places AS (
  SELECT host, path FROM parts
  UNION
  SELECT regexp_extract(a, '://([^/?#]*)', 1), regexp_extract(a, '://[^/?#]*([^?#]*)', 1) FROM near
), best AS (
  SELECT p.host, p.path, max({'size': length(r.host || r.path), 'allow': r.verdict = 'allow', 'rule': r.host || r.path}) AS best
  FROM places p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path
), bad AS (
  SELECT reach.a AS alias
  FROM reach LEFT JOIN best
    ON best.host = regexp_extract(reach.b, '://([^/?#]*)', 1) AND best.path = regexp_extract(reach.b, '://[^/?#]*([^?#]*)', 1)
  GROUP BY reach.a
  HAVING coalesce(bool_or(NOT best.best.allow), false) AND NOT coalesce(bool_or(best.best.allow), false)
)
SELECT parts.page_id, parts.host, parts.path, best.best.rule AS rule,
       CASE WHEN best.best IS NOT NULL THEN CASE WHEN best.best.allow THEN 'allow' ELSE 'block' END
            WHEN bad.alias IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       best.best IS NULL AND bad.alias IS NOT NULL AS inherited
FROM parts
LEFT JOIN best ON best.host = parts.host AND best.path = parts.path
LEFT JOIN bad ON bad.alias = parts.alias
"""
