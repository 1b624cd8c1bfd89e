"""Pages of a site: tags and attributes, findings against a content policy, where links lead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.sources.files import admits, sources_of

TAGS = "path string, at int, tag string, attrs map<string,string>"
#: Types of scripts that hold data and are not run (fixed values).
DATA_SCRIPTS = ("application/ld+json", "application/json")


def tags(pages: DataFrame) -> DataFrame:
    """(path, at, tag, attrs) of every start tag of pages (path, html), in order, by the rules of HTML: no tags in comments, scripts and styles; names in lower case, entities resolved; of
    an attribute given twice the last counts; one without a value is empty."""
    import pyarrow as pa

    def run(batches):
        from html.parser import HTMLParser

        schema = pa.schema([("path", pa.string()), ("at", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string()))])

        class Tags(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.found = []

            def handle_starttag(self, tag, attrs):
                self.found.append((tag, list({k: v or "" for k, v in attrs}.items())))

        for b in batches:
            for path, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parser = Tags()
                parser.feed(html or "")
                parser.close()
                n = len(parser.found)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array([t for t, _ in parser.found], pa.string()), pa.array([a for _, a in parser.found], schema.field("attrs").type)], schema=schema)

    spark = pages.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return pages.select("path", "html").mapInArrow(run, TAGS)


def has_host(url: Column) -> Column:
    return url.rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]")


def has_scheme(url: Column) -> Column:
    return url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")


def findings(found: DataFrame, policy: dict[str, list[str]]) -> DataFrame:
    """(path, at, finding) of tags against a policy: inline styles, handlers and scripts that it does not allow, sources that it does not admit, new-tab links without noopener or noreferrer."""
    a = lambda k: F.coalesce(F.col("attrs")[k], F.lit(""))
    has = lambda k: F.array_contains(F.map_keys("attrs"), k)
    tag = F.col("tag")
    unsafe = lambda *names: "'unsafe-inline'" in sources_of(policy, *names)
    in_words = lambda c, w: F.array_contains(F.split(c, "\\s+"), w)
    rules: list[Column] = []
    if not unsafe("style-src-attr", "style-src"):
        rules.append(F.when(has("style"), F.array(F.concat(F.lit("inline style on <"), tag, F.lit(">")))))
    if not unsafe("script-src"):
        handlers = F.filter(F.map_keys("attrs"), lambda k: F.startswith(k, F.lit("on")))
        rules.append(F.transform(handlers, lambda k: F.concat(F.lit("inline handler "), k, F.lit(" on <"), tag, F.lit(">"))))
    if not unsafe("style-src-elem", "style-src"):
        rules.append(F.when(tag == "style", F.array(F.lit("<style> block"))))
    bad = F.when(has("src"), F.when(~admits(sources_of(policy, "script-src-elem", "script-src"), a("src")), F.concat(F.lit("script not admitted: "), a("src"))))
    if not unsafe("script-src"):
        bad = bad.when(~F.lower(a("type")).isin(*DATA_SCRIPTS), F.lit("inline <script>"))
    rules.append(F.when((tag == "script") & bad.isNotNull(), F.array(bad)))
    sheet = (tag == "link") & in_words(a("rel"), "stylesheet") & ~admits(sources_of(policy, "style-src-elem", "style-src"), a("href"))
    rules.append(F.when(sheet, F.array(F.concat(F.lit("stylesheet not admitted: "), a("href")))))
    image = (tag == "img") & (a("src") != "") & ~admits(sources_of(policy, "img-src"), a("src"))
    rules.append(F.when(image, F.array(F.concat(F.lit("image not admitted: "), F.substring(a("src"), 1, 80)))))
    open_ = (tag == "a") & has_host(a("href")) & (a("target") == "_blank") & ~F.contains(a("rel"), F.lit("noopener")) & ~F.contains(a("rel"), F.lit("noreferrer"))
    rules.append(F.when(open_, F.array(F.concat(F.lit("new-tab link without noopener: "), a("href")))))
    every = F.flatten(F.array_compact(F.array(*rules)))
    return found.select("path", "at", F.explode(every).alias("finding"))


def kind_of(finding: Column) -> Column:
    """What a finding is, without where and which."""
    return F.substring_index(F.substring_index(finding, ":", 1), " on <", 1)


def tally(rows: DataFrame) -> DataFrame:
    """(kind, n, example, place): findings (path, at, finding) by kind, the most frequent first (place from 1), the first of each as example."""
    from pyspark.sql import Window

    n = rows.groupBy(kind_of(F.col("finding")).alias("kind")).agg(F.count("*").alias("n"), F.min_by(F.concat_ws(" ", "path", "finding"), F.struct("path", "at", "finding")).alias("example"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "kind")))  # a row a kind


def duplicate_ids(found: DataFrame) -> DataFrame:
    """(path, id, n) of ids that a page has more than once."""
    ids = found.select("path", F.col("attrs")["id"].alias("id")).where("id is not null")
    return ids.groupBy("path", "id").agg(F.count("*").alias("n")).where("n > 1")


def resolved(page: Column, href: Column) -> tuple[Column, Column]:
    """(absolute path below the site, fragment) that an internal link of a page leads to: percent-decoded, dots resolved, the page itself where the link has no path."""
    bare = F.regexp_extract(href, "^([^?#]*)", 1)
    path = F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))
    path = F.coalesce(path, bare)
    full = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.regexp_replace(page, "[^/]*$", ""), path))
    parts = F.filter(F.split(full, "/"), lambda p: (p != "") & (p != "."))
    start = F.array().cast("array<string>")
    walked = F.aggregate(parts, start, lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p))))
    target = F.concat(F.lit("/"), F.array_join(walked, "/"), F.when(full.rlike("(^|/)\\.{0,2}$") & (F.size(walked) > 0), "/").otherwise(""))
    return F.when(path == "", page).otherwise(target), F.regexp_extract(href, "#(.*)$", 1)


def broken_links(pages: DataFrame, found: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(path, at, href, finding) of internal links whose target is no file (dead link), or whose fragment is no id of the target page (dead fragment).

    A path that ends in a slash, or that is a folder, means its index.html; one without suffix that is no file means the .html beside it. files (path) adds targets that are no pages. Fragments of text (``:~:``) are
    not looked up.
    """
    there = pages.select("path") if files is None else pages.select("path").union(files.select("path"))
    there = there.distinct()
    folders = there.select(F.explode(F.expr("transform(sequence(1, size(split(path, '/')) - 1), i -> array_join(slice(split(path, '/'), 1, i), '/'))")).alias("folder")).distinct()
    href = F.coalesce(F.col("attrs")["href"], F.lit(""))
    links = found.where((F.col("tag") == "a") & (href != "") & ~has_host(href) & ~has_scheme(href) & ~F.startswith(href, F.lit("//"))).select("path", "at", href.alias("href"))
    target, fragment = resolved(F.col("path"), F.col("href"))
    links = links.select("*", target.alias("target"), fragment.alias("fragment")).withColumn("bare", F.regexp_replace("target", "/$", ""))
    links = links.join(folders.select(F.col("folder").alias("bare"), F.lit(True).alias("is_folder")), "bare", "left").join(there.select(F.col("path").alias("target"), F.lit(True).alias("is_file")), "target", "left")
    html = F.concat("target", F.lit(".html"))
    final = F.when(F.endswith("target", F.lit("/")) | F.col("is_folder"), F.concat("bare", F.lit("/index.html"))).when(F.col("is_file"), F.col("target")).when(~F.col("target").rlike("\\.[^./]+$"), html).otherwise(F.col("target"))
    links = links.select("path", "at", "href", "fragment", final.alias("to")).join(there.select(F.col("path").alias("to"), F.lit(True).alias("ok")), "to", "left")
    dead = links.where("ok is null").select("path", "at", "href", F.lit("dead link").alias("finding"))
    ids = found.where(F.col("attrs")["id"].isNotNull()).select(F.col("path").alias("to"), F.col("attrs")["id"].alias("fragment")).distinct()
    parsed = pages.select(F.col("path").alias("to")).distinct()
    asked = links.where((F.col("ok")) & (F.col("fragment") != "") & ~F.contains("fragment", F.lit(":~:"))).join(parsed, "to", "left_semi")
    return dead.union(asked.join(ids, ["to", "fragment"], "left_anti").select("path", "at", "href", F.lit("dead fragment").alias("finding")))
