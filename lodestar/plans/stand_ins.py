"""The tables of the domain, derived from the driver's tables. Each is one SELECT that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Gazetteer: id, name, municipi, tipus and whole-pixel coordinates (1 px = 40 m).
GAZETTEER = """SELECT p_partkey AS id, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' || translate(CAST(p_partkey AS STRING), '0123456789', 'abcdefghij') ELSE '' END AS name,
  p_brand AS municipi, p_type AS tipus, (p_partkey * 7919) % 3840 AS gx, (p_partkey * 104729) % 2849 AS gy FROM part"""

#: Toponyms: every tenth gazetteer row (by the definition of the stand-in), misread and displaced by rule; graf is the reading as drawn, now and then better than nom.
TOPONYMS = f"""SELECT id, CASE WHEN id % 110 = 0 THEN reverse(r2) ELSE r2 END AS nom, CASE WHEN id % 60 = 0 THEN name WHEN id % 90 = 0 THEN '' ELSE r2 END AS graf, gx + o + (id % 61 - 30) AS x, gy + (id % 61 - 30) AS y, tipus
  FROM (SELECT *, CASE WHEN id % 30 = 0 THEN substr(r1, 1, length(r1) - 1) ELSE r1 END AS r2 FROM (SELECT *, CASE WHEN id % 20 = 0 THEN replace(name, 'i', 'y') ELSE name END AS r1,
  CASE WHEN id % 70 = 0 THEN 1200 WHEN id % 40 = 0 THEN 175 WHEN id % 50 = 0 THEN 30 ELSE 0 END AS o FROM ({GAZETTEER}) g WHERE id % 10 = 0) a) b"""

#: Edit log: one action an event.
EDITS = """SELECT user_id AS id, event_id AS seq, CASE event_type WHEN 'click' THEN 'ok' WHEN 'signup' THEN 'pick' WHEN 'view' THEN 'graf' WHEN 'error' THEN 'undo' ELSE 'trash' END AS action,
  CASE WHEN event_type = 'signup' THEN props END AS grafia, CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 5 = 0 THEN '' ELSE 'g' || CAST(event_id % 97 AS STRING) END END AS graf FROM events"""

#: Matches as a table of their own: the row's decision, what it was matched with, and lists of types and orders joined by a bar.
MATCHES = f"""SELECT id, name AS nom, CASE WHEN id % 60 = 0 THEN '' ELSE lower(name) END AS graf, CASE WHEN id % 40 = 0 THEN tipus || '|altre' WHEN id % 130 = 0 THEN '' ELSE tipus END AS tipus,
  CASE WHEN id % 50 = 0 THEN 'OP' WHEN id % 120 = 0 THEN 'OP|OFM' END AS ordre, CASE id % 50 WHEN 0 THEN 'sense' WHEN 10 THEN 'confirmat' WHEN 20 THEN 'probable' WHEN 30 THEN 'suggerit' ELSE 'posicional' END AS decision,
  CASE WHEN id % 80 = 0 THEN 'revisat' WHEN id % 140 = 0 THEN 'corregit' END AS review, CASE WHEN id % 50 <> 0 THEN name END AS ngib, CASE WHEN id % 50 <> 0 THEN municipi END AS municipi,
  CASE WHEN id % 50 <> 0 THEN id % 61 / CAST(10 AS DOUBLE) END AS km, CASE WHEN id % 50 <> 0 THEN CAST(100 - id % 37 AS DOUBLE) / 100 ELSE CAST(0 AS DOUBLE) END AS sim FROM ({GAZETTEER}) g WHERE id % 10 = 0"""

#: The curation of those matches, their geometry, flags (joined by a bar) and offered candidates; gazetteer points for them.
CURATION = f"""SELECT id, CASE id % 110 WHEN 0 THEN 'trash' WHEN 10 THEN 'ok' WHEN 20 THEN 'pick' WHEN 30 THEN '' END AS verdict, CASE WHEN id % 110 = 20 THEN name END AS match,
  CASE WHEN id % 70 = 0 THEN 'New ' || name WHEN id % 100 = 0 THEN lower(name) END AS graf, CASE WHEN id % 90 = 0 THEN '' WHEN id % 80 = 0 THEN 'altre|Castell' WHEN id % 140 = 0 THEN 'altre' END AS tipus, CASE WHEN id % 150 = 0 THEN 'OP' WHEN id % 250 = 0 THEN '' END AS ordre FROM ({GAZETTEER}) g WHERE id % 10 = 0 AND id % 20 = 0 OR id % 70 = 0"""
GEOMETRY = f"SELECT id, gx AS x, gy AS y, CAST(gx AS DOUBLE) AS lon, CASE WHEN id % 120 <> 0 THEN CAST(gy AS DOUBLE) END AS lat, id % 90 = 0 AS dubte FROM ({GAZETTEER}) g WHERE id % 10 = 0 AND id % 170 <> 0"
FLAGGED = f"SELECT id, CASE WHEN id % 60 = 0 THEN 'odd_char|has_digit' ELSE 'short_single' END AS codes FROM ({GAZETTEER}) g WHERE id % 30 = 0"
OFFERED = f"""SELECT id - id % 10 AS id, CASE WHEN id % 10 = 0 THEN 10 ELSE id % 10 END AS rank, CASE WHEN id % 10 = 3 THEN 'nowhere' ELSE name END AS grafia, CASE id % 10 WHEN 4 THEN 'elsewhere' WHEN 5 THEN NULL ELSE municipi END AS municipi FROM ({GAZETTEER}) g WHERE id >= 10 AND id % 100 < 90"""
POINTS = f"SELECT id, name, municipi, tipus, CAST(gx AS DOUBLE) AS lon, CAST(gy AS DOUBLE) AS lat FROM ({GAZETTEER}) g"

#: Curation by toponym: what the log of user n says of toponym 10 n, its pick a gazetteer name (now and then none that exists).
CURATED = f"""SELECT id * 10 AS id, verdict, CASE WHEN match IS NULL THEN NULL WHEN id % 7 = 3 THEN 'no such place' ELSE pick END AS match, graf
  FROM folded LEFT JOIN (SELECT id AS pid, name AS pick FROM ({GAZETTEER}) pg) p ON pid = folded.id * 10 + CASE WHEN folded.id % 3 = 0 THEN 0 ELSE folded.id % 50 * 3 END"""

#: A site: pages with a path, and by rule some tags that a lint has to judge.
SITE = """SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/s' || page_id || '.html' WHEN 1 THEN '/d' || page_id % 10 || '/p' || page_id || '.html' ELSE '/d' || page_id % 10 || '/' || page_id || '/index.html' END AS path,
  html || '<h2 id="t' || page_id % 7 || '">x</h2>' || CASE WHEN page_id % 5 = 0 THEN '<b id="t' || page_id % 7 || '">y</b><i id="u">z</i>' ELSE '' END
  || '<a href="/s' || (page_id + 3) || '.html#t' || page_id % 6 || '">a</a>' || CASE WHEN page_id % 3 = 1 THEN '<a href="p' || (page_id + 30) || '">b</a><a href="./">c</a>' ELSE '' END
  || CASE WHEN page_id % 4 = 0 THEN '<a href="/s%33.html">d</a><a href="#t9">e</a><a href="#t' || page_id % 7 || ':~:text=x">f</a>' ELSE '' END || CASE WHEN page_id % 3 = 2 THEN '<a href="../' || (page_id + 30) || '/">g</a>' ELSE '' END
  || CASE page_id % 6 WHEN 0 THEN '<a href="https://out.org/x" target="_blank">h</a>' WHEN 1 THEN '<a href="https://out.org/y" target="_blank" rel="noopener">h</a>' WHEN 2 THEN '<a href="mailto:a@b.org">h</a>' ELSE '' END
  || CASE page_id % 8 WHEN 0 THEN '<img src="data:image/png;base64,AA">' WHEN 1 THEN '<img src="https://cdn.example.com/a.png">' WHEN 2 THEN '<img src="https://evil.org/a.png">' WHEN 3 THEN '<img src="/a.png">' WHEN 4 THEN '<p style="color:red">k</p>' WHEN 5 THEN '<p onclick="go()">l</p>' ELSE '' END
  || CASE page_id % 9 WHEN 0 THEN '<script src="/app.js"></script>' WHEN 1 THEN '<script src="https://evil.org/x.js"></script>' WHEN 2 THEN '<script type="application/ld+json">[]</script>' WHEN 3 THEN '<link rel="stylesheet" href="https://evil.org/a.css">' ELSE '' END AS html FROM pages"""

_E = "CAST({e}[{k}] AS DOUBLE)"
#: Boxes with a score: whole pixels, from embeddings (list positions: DuckDB counts from 1, Spark from 0).
BOXES = """SELECT vec_id AS id, CAST(floor(({0} + 0.5) * 3840) AS BIGINT) AS x, CAST(floor(({1} + 0.5) * 2849) AS BIGINT) AS y, CAST(floor(abs({2}) * 900) AS BIGINT) + 20 AS w, CAST(floor(abs({3}) * 500) AS BIGINT) + 12 AS h, label AS score, vec_id % 6 AS win FROM embeddings"""
TABLES = {"gazetteer": ("part", GAZETTEER), "toponyms": ("part", TOPONYMS), "matches": ("part", MATCHES), "curation": ("part", CURATION), "geometry": ("part", GEOMETRY), "flagged": ("part", FLAGGED), "offered": ("part", OFFERED), "points": ("part", POINTS), "edits": ("events", EDITS), "site": ("pages", SITE)}
#: Detections: boxes as slanted polygons of four corners, the upper edge first; word polygons of the spotter.
DETECTIONS = "SELECT id, x, y, w, h, score, win, id % 90 - 30 AS s FROM boxes"


def boxes_sql(first: int) -> str:
    return BOXES.format(*[_E.format(e="embedding", k=first + k) for k in range(4)])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in, or one of the driver's own tables."""
    source, sql = ("embeddings", boxes_sql(0)) if name == "boxes" else TABLES.get(name, (name, f"SELECT * FROM {name}"))
    return spark.sql(sql.replace(f"FROM {source}", "FROM {src}"), src=spark.read.parquet(f"{sf_dir}/{source}.parquet"))


def curated(spark: SparkSession, sf_dir: str, folded: DataFrame) -> DataFrame:
    """(id, verdict, match, graf) by toponym id, from the folded log."""
    return spark.sql(CURATED.replace("FROM folded", "FROM {folded} AS folded").replace("FROM part", "FROM {src}"), folded=folded, src=spark.read.parquet(f"{sf_dir}/part.parquet"))


#: The same for DuckDB, as the head of a statement.
WITH = f"WITH RECURSIVE gazetteer AS ({GAZETTEER}), toponyms AS ({TOPONYMS}), matches AS ({MATCHES}), curation AS ({CURATION}), geometry AS ({GEOMETRY}), flagged AS ({FLAGGED}), offered AS ({OFFERED}), points AS ({POINTS}), edits AS ({EDITS}), site AS ({SITE}), boxes AS ({boxes_sql(1)})"
