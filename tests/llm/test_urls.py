"""The URL filter against a plain version and its SQL twin."""

import re
from urllib.parse import urljoin

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fareline.llm import url_filter

PAGES = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType())])


def link(href):
    return f'<html><head><link rel="canonical" href="{href}"></head></html>'


def refresh(href):
    return f"<meta http-equiv=refresh content='0; URL={href}'>"


FIXTURE = [
    (0, "http://a.example.org/es/1", ""),  # blocked by a rule
    (1, "http://Other.net/1", link("http://a.example.org/es/1")),  # inherits
    (2, "http://other.net/2", refresh("/1")),  # two steps away
    (3, "http://other.net/2#part", None),  # the same address
    (4, "http://x.example.org/fr/1", link("http://other.net/1")),  # an explicit allow among them
    (5, "http://third.net/1", link("https://shop.com/de/9")),  # blocked through a page nobody has
    (6, "https://shop.com/de/1", link("https://shop.com/fr/1")),  # own rule blocks
    (7, "https://shop.com/en/1", link("../de/1")),  # an allowed alias wins
    (8, None, link("https://shop.com/de/9")),
    (9, "no scheme", link("https://shop.com/de/9")),
    (10, "ftp://org", ""),  # no path: no rule
    (11, "http://fourth.net/a/b?x=1", link("?x=2&amp;y=3")),
    (12, "http://fourth.net/a/b?x=2&y=3", '<LINK href=./c REL="next Canonical">'),
    (13, "http://fourth.net/a/c", refresh("//shop.com/de/")),
    (14, "http://fifth.net/1", "<!-- " + link("https://shop.com/de/1") + " --><script>" + link("https://shop.com/de/1")),
    (15, "http://fifth.net/2", "<script>x</script>" + link("mailto:a@b") + link("") + link("#top") + "<b>canonical"),
    (16, "http://notexample.org/es/1", ""),  # org, but no subdomain of example.org
    (17, "http://EXAMPLE.ORG/en/12", ""),
    (18, "http://example.org/EN/12", ""),
    (19, "http://sixth.net/x/", link("y/../../../z/.")),
    (20, "http://sixth.net/z/", link("http://shop.com/de/x y")),
    (None, "http://sixth.net/z/", "x" * 100_000 + "<link rel=canonical " * 50),
    (21, "http://sixth.net/z/", "x"),
    (21, "http://sixth.net/z/", "x"),
    (22, "", ""),
    (23, "://", ""),
    *[(100 + k, f"http://hub.net/{k}", link("http://hub.net/")) for k in range(40)],
    *[(200 + k, f"http://chain.net/{k}", link(str(k + 1))) for k in range(30)],
    (300, "http://chain.net/30", link("https://shop.com/de/")),
]


def plain(rows, rules=url_filter.RULES):
    """Every rule tried on every URL, and aliases by walking the links."""

    def lowered(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    def parts(url):
        found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        return (lowered(found[1]), found[2]) if found else ("", "")

    def identity(url):
        if url is None or "://" not in url:
            return None
        scheme, rest = url.split("://", 1)
        host = re.match("[^/?#]*", rest)[0]
        return lowered(scheme) + "://" + lowered(host) + rest[len(host):].split("#")[0]

    def ruled(url):
        host, path = parts(url)
        fits = [
            (len(h + p), v == "allow", h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        return max(fits, default=None)

    near = {}
    for _, url, html in rows:
        seen = re.sub(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1", "", html or "")
        for tag in re.findall(r"(?i)<(?:link|meta)\b[^>]*>", seen):
            values = dict(
                (k.lower(), v.strip("\"'")) for k, v in re.findall(r"([\w-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", tag)
            )
            target = ""
            if "canonical" in values.get("rel", "").lower().split():
                target = values.get("href", "")
            elif values.get("http-equiv", "").lower() == "refresh":
                target = re.sub(r"(?i)^[\s\d.]*[;,]?\s*url\s*=\s*", "", values["content"])
            target = target.replace("&amp;", "&")
            if not target or target[0] == "#" or identity(url) is None:
                continue
            a, b = identity(url), identity(urljoin(url, target))
            if b and a != b:
                near.setdefault(a, set()).add(b)
                near.setdefault(b, set()).add(a)
    out = []
    for page_id, url, _ in rows:
        todo, reached = [identity(url)], set()
        while todo:
            at = todo.pop()
            if at not in reached:
                reached.add(at)
                todo += near.get(at, ())
        own, others = ruled(url), [ruled(u) for u in reached]
        bad = own is None and any(o and not o[1] for o in others) and not any(o and o[1] for o in others)
        verdict = ("allow" if own[1] else "block") if own else "block" if bad else "allow"
        out.append((page_id, *parts(url), own and own[2], verdict, bad))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict", "inherited").collect()), key=repr)


def judged(spark, rows, rules=url_filter.RULES, **options):
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    return url_filter.judged(pages, url_filter.rule_table(spark, rules), **options).withColumnRenamed("id", "page_id")


def test_verdicts_equal_the_plain_ones(spark):
    found = rows_of(judged(spark, FIXTURE))
    assert found == plain(FIXTURE)
    by_id = {r[0]: r for r in found}
    assert [by_id[k][4] for k in (0, 1, 2, 3, 4, 5, 6, 7)] == ["block", "allow", "allow", "allow", "allow", "block", "block", "allow"]
    assert by_id[13][4] == by_id[12][4] == by_id[11][4] == by_id[20][4] == by_id[200][4] == "block"
    assert {by_id[k][4] for k in (8, 9, 10, 14, 15, 22, 23)} == {"allow"}


def test_twin_gives_the_same(spark):
    columns = zip(*FIXTURE)
    pages = pa.table(dict(zip(PAGES.names, (pa.array(c) for c in columns))))
    duck = duckdb.connect()
    duck.register("pages", pages)
    twin = duck.execute(
        f"SELECT page_id, host, path, rule, verdict, inherited FROM ({url_filter.OP13_SQL})"
    ).fetchall()
    assert sorted(twin, key=repr) == plain(FIXTURE)


def test_many_rules_of_one_host(spark, monkeypatch):
    """Ties go to allow; rules are looked up also where they are no small side."""
    monkeypatch.setattr("fareline.llm.common.SMALL_ROWS", 0)
    rules = [*url_filter.RULES, *[("block", "net", f"/{k}") for k in range(300)], ("allow", "net", "/17"), ("block", "", "/")]
    assert rows_of(judged(spark, FIXTURE, rules)) == plain(FIXTURE, rules)


def test_logged_redirects(spark):
    logged = spark.createDataFrame(
        [("http://fifth.net/1", "https://shop.com/de/1"), ("http://fifth.net/2#x", "1"), (None, "x"), ("x", None)],
        "from_url string, to_url string",
    )
    found = {r.page_id: r.verdict for r in judged(spark, FIXTURE, redirects=logged).collect()}
    # shop.com/de/1 has an allowed alias, /fr/1, through page 6.
    assert found[14] == found[15] == "allow"
    alone = {r.page_id: r.verdict for r in judged(spark, FIXTURE[14:16], redirects=logged).collect()}
    assert alone[14] == alone[15] == "block"


@pytest.mark.parametrize("rows", [[], FIXTURE[8:9]])
def test_empty_tables_and_clashing_columns(spark, rows):
    names = ["id", "host", "path", "rule", "alias", "verdict", "link", "suffix", "node"]
    pages = spark.createDataFrame(
        [(*r, *names) for r in rows], StructType([*PAGES.fields, *(StructField(n, StringType()) for n in names)])
    )
    found = url_filter.judged(pages, url_filter.rule_table(spark))
    assert [tuple(r) for r in found.collect()] == [(8, "", "", None, "allow", False)] * len(rows)


def test_no_python_on_the_way(spark):
    plan = judged(spark, FIXTURE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
