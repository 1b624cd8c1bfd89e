"""Queries of the page audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.plans.registry import query
from lodestar.plans.stand_ins import load
from lodestar.sources import files, pages

POLICY = "default-src 'self'; script-src 'self'; style-src-elem 'self' 'unsafe-inline'; style-src-attr 'none'; img-src 'self' data: https://*.example.com"

#: Start tags of the site outside comments, scripts and styles, with what is needed of their attributes (all are in double quotes there).
_TAGS = """, cut AS (SELECT path, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(<script[^>]*>).*?</script>', '\\1', 'gs') AS html FROM site), bare AS (SELECT path, regexp_replace(html, '(<style[^>]*>).*?</style>', '\\1', 'gs') AS html FROM cut),
many AS (SELECT path, regexp_extract_all(html, '<[a-zA-Z][^>]*>') AS ts FROM bare), tg AS (SELECT path, i - 1 AS pos, ts[i] AS t, lower(regexp_extract(ts[i], '^<([a-zA-Z0-9]+)', 1)) AS tag FROM many, unnest(range(1, len(ts) + 1)) AS u(i)),
tags AS (SELECT *, regexp_extract(t, ' src="([^"]*)"', 1) AS src, regexp_extract(t, ' href="([^"]*)"', 1) AS href, regexp_extract(t, ' id="([^"]*)"', 1) AS ident, regexp_extract(t, ' rel="([^"]*)"', 1) AS rel FROM tg)"""
_SELF = "NOT regexp_matches({0}, '^([A-Za-z][A-Za-z0-9+.-]*:|//)')"
_FINDINGS = _TAGS + f""", fi AS (SELECT path, pos, 'inline style on <' || tag || '>' AS finding FROM tags WHERE contains(t, ' style="')
 UNION ALL SELECT path, pos, 'inline handler ' || unnest(regexp_extract_all(t, ' (on[a-z]+)="', 1)) || ' on <' || tag || '>' FROM tags
 UNION ALL SELECT path, pos, CASE WHEN contains(t, ' src="') THEN 'script not admitted: ' || src ELSE 'inline <script>' END FROM tags WHERE tag = 'script' AND CASE WHEN contains(t, ' src="') THEN NOT ({_SELF.format("src")}) ELSE NOT contains(t, 'type="application/ld+json"') END
 UNION ALL SELECT path, pos, 'stylesheet not admitted: ' || href FROM tags WHERE tag = 'link' AND rel = 'stylesheet' AND NOT ({_SELF.format("href")})
 UNION ALL SELECT path, pos, 'image not admitted: ' || left(src, 80) FROM tags WHERE tag = 'img' AND src <> '' AND NOT ({_SELF.format("src")} OR starts_with(src, 'data:') OR regexp_matches(src, '^https://[^/]+[.]example[.]com(/|$)'))
 UNION ALL SELECT path, pos, 'new-tab link without noopener: ' || href FROM tags WHERE tag = 'a' AND regexp_matches(href, '^([a-z]+:)?//') AND contains(t, ' target="_blank"') AND NOT contains(rel, 'noopener') AND NOT contains(rel, 'noreferrer'))"""


def _tags(spark, sf):
    return pages.tags(load(spark, sf, "site"))


@query(_TAGS + " SELECT path, tag, count(*) AS n FROM tags GROUP BY path, tag")
def tag_counts(spark, sf):
    return _tags(spark, sf).groupBy("path", "tag").agg(F.count("*").alias("n"))


@query(_FINDINGS + " SELECT path, pos::INTEGER AS pos, finding FROM fi")
def page_lint(spark, sf):
    """Every tag against the policy."""
    return pages.findings(_tags(spark, sf), files.policy(POLICY)).withColumnRenamed("at", "pos")


@query(_FINDINGS + ", k AS (SELECT split_part(split_part(finding, ':', 1), ' on <', 1) AS kind, path, pos, finding FROM fi), c AS (SELECT kind, count(*) AS n, arg_min(path || ' ' || finding, (path, pos, finding)) AS example FROM k GROUP BY kind) SELECT *, row_number() OVER (ORDER BY n DESC, kind)::INTEGER AS place FROM c")
def lint_tally(spark, sf):
    return pages.tally(pages.findings(_tags(spark, sf), files.policy(POLICY)))


@query(_TAGS + " SELECT path, ident AS id, count(*) AS n FROM tags WHERE contains(t, ' id=\"') GROUP BY path, ident HAVING count(*) > 1")
def dup_ids(spark, sf):
    return pages.duplicate_ids(_tags(spark, sf))


_RESOLVED = """list_reduce(list_prepend([]::VARCHAR[], list_transform(list_filter(string_split(full_path, '/'), lambda p: p <> '' AND p <> '.'), lambda p: [p])), lambda a, p: CASE WHEN p[1] = '..' THEN a[1:len(a) - 1] ELSE list_concat(a, p) END)"""


@query(_TAGS + f""", l AS (SELECT path, pos, href, url_decode(replace(regexp_extract(href, '^([^?#]*)', 1), '+', '%2B')) AS p, regexp_extract(href, '#(.*)$', 1) AS frag FROM tags WHERE tag = 'a' AND href <> '' AND {_SELF.format("href")}),
 f AS (SELECT *, CASE WHEN starts_with(p, '/') THEN p ELSE regexp_replace(path, '[^/]*$', '') || p END AS full_path FROM l), w AS (SELECT *, '/' || array_to_string({_RESOLVED}, '/') AS walked, regexp_matches(full_path, '(^|/)[.]{{0,2}}$') AS ends FROM f),
 folders AS (SELECT DISTINCT unnest(list_transform(range(1, len(string_split(path, '/'))), lambda i: array_to_string(string_split(path, '/')[1:i], '/'))) AS folder FROM site),
 x AS (SELECT *, CASE WHEN p = '' THEN path WHEN ends OR rtrim(walked, '/') IN (SELECT folder FROM folders) THEN rtrim(walked, '/') || '/index.html' WHEN walked IN (SELECT path FROM site) OR regexp_matches(walked, '[.][^./]+$') THEN walked ELSE walked || '.html' END AS target FROM w)
 SELECT path, pos::INTEGER AS pos, href, 'dead link' AS finding FROM x WHERE target NOT IN (SELECT path FROM site) UNION ALL
 SELECT path, pos::INTEGER, href, 'dead fragment' FROM x WHERE target IN (SELECT path FROM site) AND frag <> '' AND NOT contains(frag, ':~:') AND NOT EXISTS (SELECT 1 FROM tags t WHERE t.path = x.target AND t.ident = x.frag AND contains(t.t, ' id="'))""")
def dead_links(spark, sf):
    """Internal links that lead to no page, or to no id of one."""
    return pages.broken_links(load(spark, sf, "site"), _tags(spark, sf)).withColumnRenamed("at", "pos")


@query(_TAGS + " SELECT path, pos::INTEGER AS pos, src, " + _SELF.format("src") + " OR starts_with(src, 'data:') OR regexp_matches(src, '^https://[^/]+[.]example[.]com(/|$)') AS admitted FROM tags WHERE tag = 'img'")
def csp_admits(spark, sf):
    img = files.sources_of(files.policy(POLICY), "img-src")
    rows = _tags(spark, sf).where("tag = 'img'").select("path", "at", F.col("attrs")["src"].alias("src"))
    return rows.select("path", F.col("at").alias("pos"), "src", files.admits(img, F.col("src")).alias("admitted"))
