"""Queries of the curation tool and the published table: items, facets, look-ups, verdicts, remaps, formats."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import facets, items, joins, overlay, windows
from lodestar.plans.registry import FOLD, NORM, query, root
from lodestar.plans.stand_ins import load

_LISTS = "CASE WHEN {0} IS NULL OR {0} = '' THEN [] ELSE string_split({0}, '|') END"
_LOCATED = """, pb AS (SELECT name, municipi, arg_min(lon, id) AS lon, arg_min(lat, id) AS lat FROM points GROUP BY name, municipi), ps AS (SELECT name, arg_min(lon, id) AS lon, arg_min(lat, id) AS lat FROM points GROUP BY name),
loc AS (SELECT o.id, o.rank, o.grafia, o.municipi, CASE WHEN pb.name IS NOT NULL THEN pb.lon ELSE ps.lon END AS lon, CASE WHEN pb.name IS NOT NULL THEN pb.lat ELSE ps.lat END AS lat
 FROM offered o LEFT JOIN pb ON pb.name = o.grafia AND pb.municipi IS NOT DISTINCT FROM o.municipi LEFT JOIN ps ON ps.name = o.grafia)"""
_ITEMS = _LOCATED + f""", cl AS (SELECT id, string_agg(grafia || '@' || coalesce(municipi, '') || '@' || coalesce(lon::BIGINT::VARCHAR, '') || ',' || coalesce(lat::BIGINT::VARCHAR, ''), ';' ORDER BY rank) AS cands FROM loc WHERE rank <= 6 GROUP BY id),
it AS (SELECT m.id, g.x, g.y, g.lon, g.lat, coalesce(g.dubte, false) AS dubte, {_LISTS.format("f.codes")} AS flags, coalesce(c.graf, m.graf) AS graf, m.graf AS graf0, m.nom, {_LISTS.format("coalesce(c.tipus, m.tipus)")} AS tipus, {_LISTS.format("m.tipus")} AS tipus0,
 {_LISTS.format("coalesce(c.ordre, m.ordre)")} AS ordre, {_LISTS.format("m.ordre")} AS ordre0, c.tipus IS NOT NULL AS ct, c.ordre IS NOT NULL AS co, m.decision, nullif(m.review, '') AS review, nullif(m.ngib, '') AS ngib, nullif(m.municipi, '') AS municipi, m.km, m.sim, coalesce(cl.cands, '') AS cands,
 nullif(c.verdict, '') AS pend, nullif(c.match, '') AS pend_pick, c.graf IS NOT NULL AND c.graf IS DISTINCT FROM m.graf AS graf_edited, coalesce(c.verdict = 'trash', false) AS discarded
 FROM matches m LEFT JOIN curation c ON c.id = m.id LEFT JOIN geometry g ON g.id = m.id LEFT JOIN flagged f ON f.id = m.id LEFT JOIN cl ON cl.id = m.id)"""


def _items(spark, sf):
    cands = items.candidate_lists(items.located(load(spark, sf, "offered"), load(spark, sf, "points")))
    flags = load(spark, sf, "flagged").select("id", items.as_list(F.col("codes")).alias("flags"))
    return items.assemble(load(spark, sf, "matches"), load(spark, sf, "curation"), load(spark, sf, "geometry"), flags, cands)


def _whole(c):
    return F.coalesce(c.cast("long").cast("string"), F.lit(""))


@query(_ITEMS + """ SELECT id, x, y, lon, lat, dubte, array_to_string(flags, '|') AS flags, graf, graf0, nom, array_to_string(tipus, '|') AS tipus, array_to_string(tipus0, '|') AS tipus0, ct AND tipus <> tipus0 AS tipus_edited,
 array_to_string(ordre, '|') AS ordre, array_to_string(ordre0, '|') AS ordre0, co AND ordre <> ordre0 AS ordre_edited, decision, review, ngib, municipi, km, sim, cands AS candidates, pend, pend_pick, graf_edited, discarded FROM it""")
def item_table(spark, sf):
    """Matches with curation, geometry, flags and located candidates: one row an item."""
    it = _items(spark, sf)
    one = lambda r: F.concat(r["grafia"], F.lit("@"), F.coalesce(r["municipi"], F.lit("")), F.lit("@"), _whole(r["lon"]), F.lit(","), _whole(r["lat"]))
    lists = {c: F.array_join(c, "|") for c in ("flags", "tipus", "tipus0", "ordre", "ordre0")}
    return it.withColumns({**lists, "candidates": F.array_join(F.transform("candidates", one), ";")})


@query(_LOCATED + " SELECT * FROM loc")
def candidate_points(spark, sf):
    return items.located(load(spark, sf, "offered"), load(spark, sf, "points")).select("id", "rank", "grafia", "municipi", "lon", "lat")


@query(_LOCATED + ", c AS (SELECT id, list(grafia ORDER BY rank) AS names FROM loc WHERE rank <= 6 GROUP BY id) SELECT m.id, array_to_string((CASE WHEN m.ngib IS NULL OR m.ngib = '' OR list_contains(coalesce(names, []), m.ngib) THEN coalesce(names, []) ELSE list_concat([m.ngib], coalesce(names, [])) END)[1:6], ';') AS names FROM matches m LEFT JOIN c ON c.id = m.id")
def current_first(spark, sf):
    """Candidates with the current match at the front where it is none of them."""
    it = _items(spark, sf)
    return it.select("id", F.array_join(F.transform(items.with_current(F.col("candidates"), F.col("ngib"), F.col("municipi")), lambda r: r["grafia"]), ";").alias("names"))


@query("SELECT t.id, t.nom, c.verdict, m.decision, m.km FROM toponyms t LEFT JOIN curation c ON c.id = t.id LEFT JOIN matches m ON m.id = t.id WHERE c.verdict IS NULL OR c.verdict <> 'trash'")
def audit_rows(spark, sf):
    """What the audit looks at: toponyms with their curation and match, without the discarded ones."""
    c, m = load(spark, sf, "curation").select("id", "verdict"), load(spark, sf, "matches").select("id", "decision", "km")
    return load(spark, sf, "toponyms").select("id", "nom").join(c, "id", "left").join(m, "id", "left").where("verdict is null or verdict <> 'trash'")


_TEXT = "contains(lower(concat_ws(' ', coalesce(graf, ''), coalesce(nom, ''), coalesce(ngib, ''), coalesce(municipi, ''))), '{0}')"
_PUBLISHED = {
    "text": (dict(text=" AL "), _TEXT.format("al")),
    "kind": (dict(decision="suggerit", kind="altre"), "decision = 'suggerit' AND list_contains(tipus, 'altre')"),
    "order": (dict(order="OP", matched="no"), "list_contains(ordre, 'OP') AND coalesce(ngib, '') = ''"),
    "near": (dict(km="lt1", matched="si"), "km < 1 AND coalesce(ngib, '') <> ''"),
    "middle": (dict(km="1-3", review="none"), "km BETWEEN 1 AND 3 AND coalesce(review, '') = ''"),
    "far": (dict(km="gt3", review="any"), "km > 3 AND coalesce(review, '') <> ''"),
    "corrected": (dict(review="corregit"), "review = 'corregit'"),
    "place": (dict(place="Brand#1"), "municipi = 'Brand#1'"),
    "all": ({}, "true"),
}
_CURATED = {
    "any order": (dict(order="__any", problems="prob"), "len(ordre) > 0 AND len(flags) > 0"),
    "no order": (dict(order="__none", review="none", text="e"), "len(ordre) = 0 AND coalesce(review, '') = '' AND " + _TEXT.format("e")),
    "clean": (dict(problems="no", decision="posicional"), "len(flags) = 0 AND decision = 'posicional'"),
    "kind": (dict(kind="Castell"), "list_contains(tipus, 'Castell')"),
}


def _union(name: str, cases: dict, extra: str = "true") -> str:
    return " UNION ALL ".join(f"SELECT '{name}: {k}' AS facet, id FROM it WHERE {extra} AND {sql}" for k, (_, sql) in cases.items())


def _each(df, name: str, preset, cases: dict):
    out = None
    for k, (given, _) in cases.items():
        rows = preset(df, **given).select(F.lit(f"{name}: {k}").alias("facet"), "id")
        out = rows if out is None else out.union(rows)
    return out


@query(_ITEMS + f" {_union('table', _PUBLISHED)}")
def facets_published(spark, sf):
    return _each(_items(spark, sf), "table", facets.published, _PUBLISHED)


@query(_ITEMS + f" {_union('curation', _CURATED)} UNION ALL {_union('map', _CURATED, 'lon IS NOT NULL AND lat IS NOT NULL AND NOT discarded')} UNION ALL {_union('cards', {k: v for k, v in _CURATED.items() if 'review' not in v[0]}, 'pend IS NULL')}")
def facets_curation(spark, sf):
    """The same facets for the curation table, the map and the card queue."""
    it = _items(spark, sf)
    cards = {k: v for k, v in _CURATED.items() if "review" not in v[0]}
    return _each(it, "curation", facets.curated, _CURATED).union(_each(it, "map", facets.on_map, _CURATED)).union(_each(it, "cards", facets.queue, cards))


@query(_ITEMS + ", q AS (SELECT id, 1 AS r FROM it WHERE pend IS NULL AND decision = 'probable' UNION ALL SELECT id, 0 FROM it WHERE id = 120 AND NOT (pend IS NULL AND decision = 'probable')) SELECT id, row_number() OVER (ORDER BY r, id)::INTEGER AS place FROM q")
def card_queue(spark, sf):
    """The queue with a wanted card put at its front."""
    return facets.queue_with(_items(spark, sf), 120, "id", decision="probable").select("id", "place")


@query(_ITEMS + " SELECT count(*) AS total, count(*) FILTER (coalesce(pend, '') <> '' OR coalesce(review, '') <> '') AS done, count(*) FILTER (discarded) AS discarded FROM it")
def progress_counts(spark, sf):
    return facets.progress(_items(spark, sf))


@query(_ITEMS + ", v AS (SELECT DISTINCT unnest(tipus) AS value FROM it) SELECT value, row_number() OVER (ORDER BY CASE value WHEN 'altre' THEN 1 WHEN 'Castell' THEN 2 ELSE 3 END, value)::INTEGER AS place FROM v")
def facet_choices(spark, sf):
    return facets.choices(_items(spark, sf), "tipus", ("altre", "Castell"))


@query("SELECT id, name FROM points WHERE lon BETWEEN 1000 AND 2500 AND lat BETWEEN 500 AND 1900 ORDER BY id LIMIT 700")
def viewport_points(spark, sf):
    """The first 700 points in view; the limit is the feature."""
    return facets.viewport(load(spark, sf, "points"), 13, 1000, 500, 2500, 1900).select("id", "name")


@query("SELECT id, coalesce(nullif(graf, ''), nom) AS shown, CASE WHEN km IS NULL OR km = 0 THEN -1.0::DOUBLE ELSE km END AS km, coalesce(graf, nom) AS kept FROM matches")
def fallbacks(spark, sf):
    """A fallback for null alone against one for anything that counts as nothing."""
    m = load(spark, sf, "matches")
    return m.select("id", items.falsy(F.col("graf"), F.col("nom")).alias("shown"), items.falsy(F.col("km"), F.lit(-1.0)).alias("km"), F.coalesce("graf", "nom").alias("kept"))


@query(f", k AS (SELECT id, list_distinct(list_filter({_LISTS.format('tipus')}, lambda v: v IN ('PROMO', 'LARGE', 'altre'))) AS v FROM matches) SELECT id, CASE WHEN len(v) > 0 THEN array_to_string(list_sort(v), '|') END AS tipus, CASE WHEN len(v) = 1 THEN v[1] END AS single FROM k")
def legal_kinds(spark, sf):
    """Values that are allowed: none is null, one is also given by itself."""
    m = load(spark, sf, "matches").select("id", items.legal(items.as_list(F.col("tipus")), ("PROMO", "LARGE", "altre")).alias("v"))
    return m.select("id", F.array_join(F.sort_array("v"), "|").alias("tipus"), F.when(F.size("v") == 1, F.get("v", F.lit(0))).alias("single"))


@query(", o AS (SELECT id, tipus, row_number() OVER (ORDER BY id) - 1 AS k FROM matches WHERE tipus <> ''), r AS (SELECT k, k // 12 AS batch, CASE WHEN id % 110 = 0 THEN 99 ELSE k % 12 END AS idx, CASE id % 40 WHEN 0 THEN 'Castell' WHEN 10 THEN 'Vila' WHEN 20 THEN 'legend?' ELSE 'Port' END AS tipus, CASE id % 30 WHEN 0 THEN 'high' WHEN 10 THEN 'med' ELSE 'low' END AS conf FROM o) SELECT o.id, coalesce(CASE WHEN conf IN ('high', 'med') AND r.tipus IN ('Castell', 'Vila', 'Port') THEN r.tipus END, o.tipus) AS tipus FROM o LEFT JOIN r ON r.batch = o.k // 12 AND r.idx = o.k % 12")
def symbol_apply(spark, sf):
    """Results by place in a batch of twelve, joined to ids by the manifest; only confident ones of a legend's class count, those out of bounds are ignored."""
    m = windows.numbered(load(spark, sf, "matches").where("tipus <> ''").select("id", "tipus"), root(spark), F.col("id"))
    manifest = m.select("id", "tipus", F.expr("number div 12").alias("batch"), F.expr("number % 12").alias("idx"))
    i = F.col("id")
    kind = F.when(i % 40 == 0, "Castell").when(i % 40 == 10, "Vila").when(i % 40 == 20, "legend?").otherwise("Port")
    results = manifest.select("batch", F.when(i % 110 == 0, 99).otherwise(F.col("idx")).alias("idx"), kind.alias("kind"), F.when(i % 30 == 0, "high").when(i % 30 == 10, "med").otherwise("low").alias("conf"))
    sure = results.where(F.col("conf").isin("high", "med") & F.col("kind").isin("Castell", "Vila", "Port"))
    return manifest.join(sure, ["batch", "idx"], "left").select("id", F.coalesce("kind", "tipus").alias("tipus"))


@query(f", n AS (SELECT DISTINCT {NORM.format('name')} AS key FROM gazetteer WHERE id % 3 <> 0), r AS (SELECT id, {NORM.format('name')} AS key, tipus FROM gazetteer) SELECT n.key, arg_min(r.id, (CASE tipus WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 2 ELSE 3 END, r.id)) AS id FROM n JOIN r USING (key) GROUP BY n.key")
def resolve_names(spark, sf):
    """Names looked up by preferred class, else any; one that has no row would fail the query."""
    g = load(spark, sf, "gazetteer")
    rows = g.select("id", T.norm(F.col("name")).alias("key"), "tipus")
    names = g.where("id % 3 <> 0").select(T.norm(F.col("name")).alias("key")).distinct()
    return joins.required(joins.resolve(names, rows, "key", "tipus", ["PROMO", "LARGE"], F.col("id")), "id").select("key", "id")


@query(""", p AS (SELECT t.id AS old_id, g.id AS new_id, (t.x - g.gx) * (t.x - g.gx) + (t.y - g.gy) * (t.y - g.gy) AS d2, t.nom = g.name AS same FROM toponyms t JOIN gazetteer g ON (t.x - g.gx) * (t.x - g.gx) + (t.y - g.gy) * (t.y - g.gy) <= 160000),
 q AS (SELECT *, CASE WHEN same THEN 1 WHEN d2 <= 6400 THEN 2 END AS tier FROM p), c AS (SELECT * FROM q WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY old_id ORDER BY tier, d2, new_id) = 1)
 SELECT t.id AS old_id, new_id, tier, d2, first_value(old_id) OVER (PARTITION BY new_id ORDER BY tier, d2, old_id) AS winner FROM toponyms t LEFT JOIN c ON c.old_id = t.id WHERE new_id IS NOT NULL UNION ALL SELECT id, NULL, NULL, NULL, NULL FROM toponyms WHERE id NOT IN (SELECT old_id FROM c)""")
def remap_report(spark, sf):
    """All old rows with their claim and who holds what they claim: losers and rows without a claim too."""
    old = load(spark, sf, "toponyms").select(F.col("id").alias("old_id"), F.col("nom").alias("key"), "x", "y")
    new = load(spark, sf, "gazetteer").select(F.col("id").alias("new_id"), F.col("name").alias("nkey"), "gx", "gy")
    return joins.remap_report(old, new, 400, 80)


@query("SELECT m.id, m.nom, g.x, g.y FROM matches m JOIN geometry g ON g.id = m.id WHERE m.decision IN ('suggerit', 'posicional') AND m.id IN (SELECT id FROM flagged)")
def render_list(spark, sf):
    """Rows of wanted decisions that have geometry and whose crop is in a listing."""
    wanted = F.col("decision").isin("suggerit", "posicional")
    rows = load(spark, sf, "matches").where(wanted).select("id", "nom").join(load(spark, sf, "geometry").select("id", "x", "y"), "id")
    return rows.join(load(spark, sf, "flagged").select("id"), "id", "left_semi")


@query("SELECT '[' || to_json(round(lon, 5))::VARCHAR || ',' || to_json(round(lat, 5))::VARCHAR || ',' || to_json(m.decision)::VARCHAR || ',' || to_json(coalesce(m.tipus, ''))::VARCHAR || ',' || to_json(m.nom)::VARCHAR || ',' || to_json(coalesce(m.ngib, ''))::VARCHAR || ']' AS row FROM matches m JOIN geometry g ON g.id = m.id WHERE lon IS NOT NULL AND lat IS NOT NULL")
def compact_rows(spark, sf):
    """Placed rows as compact arrays of a payload."""
    m = load(spark, sf, "matches").join(load(spark, sf, "geometry").select("id", "lon", "lat"), "id").where("lon is not null and lat is not null")
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(F.coalesce(F.col(c), F.lit("")))), r"^\[(.*)\]$", 1)
    number = lambda c: F.round(c, 5).cast("string")
    return m.select(F.concat(F.lit("["), F.concat_ws(",", number("lon"), number("lat"), *map(quoted, ("decision", "tipus", "nom", "ngib"))), F.lit("]")).alias("row"))


@query(", k AS (SELECT id, CASE id % 7 WHEN 0 THEN 'castell ' || name WHEN 1 THEN 'palma' WHEN 2 THEN 'Alcudia vella' WHEN 3 THEN 'castillo' ELSE lower(name) END AS key FROM gazetteer) SELECT id, CASE WHEN split_part(key, ' ', 1) IN ('mallorca', 'palma', 'alcudia', 'alcvdia') OR key IN ('mallorca', 'palma', 'alcudia', 'alcvdia') THEN 'Ciutat' WHEN split_part(key, ' ', 1) IN ('castell', 'castillo') THEN 'Castell' ELSE 'altre' END AS kind FROM (SELECT id, lower(key) AS key FROM k)")
def kinds(spark, sf):
    n = F.col("id") % 7
    key = F.when(n == 0, F.concat(F.lit("castell "), "name")).when(n == 1, "palma").when(n == 2, "Alcudia vella").when(n == 3, "castillo").otherwise(F.lower("name"))
    return load(spark, sf, "gazetteer").select("id", T.kind_of(T.key(key)).alias("kind"))


@query("SELECT id, coalesce(printf('%.1f', km) || ' km', '') AS km, replace(format('{:,}', id * 1000), ',', '.') AS number, concat_ws(' · ', nullif(replace(coalesce(tipus, ''), '|', ' · '), ''), nullif(ngib, '')) AS line FROM matches")
def formats(spark, sf):
    m = load(spark, sf, "matches")
    line = F.concat_ws(" · ", F.nullif(F.array_join(items.as_list(F.col("tipus")), " · "), F.lit("")), F.nullif(F.col("ngib"), F.lit("")))
    return m.select("id", T.km_text(F.col("km")).alias("km"), T.grouped(F.col("id") * 1000).alias("number"), line.alias("line"))


_NATURAL = "(CASE id % 6 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'Pou ' || id % 23 || ' ' || name END)"


@query(f", k AS (SELECT id, {NORM.format(_NATURAL)} AS w FROM gazetteer), s AS (SELECT id, nullif(list_aggregate(list_transform(string_split(w, ' '), lambda t: CASE WHEN regexp_full_match(t, '[0-9]+') THEN lpad(t, 12, '0') ELSE t END), 'string_agg', ' '), '') AS key FROM k) SELECT id, row_number() OVER (ORDER BY key ASC NULLS LAST, id)::INTEGER AS up, row_number() OVER (ORDER BY key DESC NULLS LAST, id)::INTEGER AS down FROM s QUALIFY up <= 100 OR down <= 100")
def natural_sort(spark, sf):
    """The first hundred rows either way by name, numbers by their value, empty names last both ways."""
    name = F.when(F.col("id") % 6 == 0, "").when(F.col("id") % 6 != 1, F.concat(F.lit("Pou "), (F.col("id") % 23).cast("string"), F.lit(" "), "name"))
    rows = load(spark, sf, "gazetteer").select("id", T.natural(name).alias("key"))
    up = windows.numbered(rows, root(spark), F.col("key").asc_nulls_last(), F.col("id")).select("id", (F.col("number") + 1).cast("int").alias("up"))
    down = windows.numbered(rows, root(spark), F.col("key").desc_nulls_last(), F.col("id")).select("id", (F.col("number") + 1).cast("int").alias("down"))
    return up.join(down, "id").where("up <= 100 or down <= 100")


@query("SELECT id, 't' || printf('%04d', row_number() OVER (ORDER BY y, x, id) - 1) AS name, 'B' || printf('%02d', win) || '_' || row_number() OVER (PARTITION BY win ORDER BY y, x, id) AS inner_name FROM boxes")
def sequential_ids(spark, sf):
    """Names by place in the whole sheet and in a window, after a sort by y, x."""
    b = windows.numbered(load(spark, sf, "boxes").select("id", "x", "y", "win"), root(spark), F.col("y"), F.col("x"), F.col("id"))
    inner = F.row_number().over(Window.partitionBy("win").orderBy("y", "x", "id"))
    return b.select("id", F.format_string("t%04d", "number").alias("name"), F.concat(F.format_string("B%02d", "win"), F.lit("_"), inner.cast("string")).alias("inner_name"))


@query("SELECT name, arg_min(id, id) AS first, arg_max(id, id) AS last FROM gazetteer GROUP BY name")
def map_first_last(spark, sf):
    return items.first_and_last(load(spark, sf, "gazetteer"), "name", "id", "id")


_REVERT = ", lg AS (SELECT id, seq, CASE WHEN action = 'undo' THEN 'revert' ELSE action END AS action, grafia, graf FROM edits), st AS (SELECT id, list_reduce(list_prepend([]::BIGINT[], list(CASE WHEN action = 'revert' THEN [-1]::BIGINT[] ELSE [seq] END ORDER BY seq)), lambda a, x: CASE WHEN x = [-1]::BIGINT[] THEN a[1:len(a) - 1] ELSE list_concat(a, x) END) AS kept FROM lg GROUP BY id)"


@query(_REVERT + " SELECT id, unnest(kept) AS seq FROM st")
def undo_stack(spark, sf):
    """Edits that stand after each undo took back the one before it."""
    e = load(spark, sf, "edits").withColumn("action", F.when(F.col("action") == "undo", "revert").otherwise(F.col("action")))
    return overlay.retract(e, depth=1 << 30).select("id", "seq")


@query(", s AS (SELECT id, id AS seq FROM gazetteer), stop AS (SELECT coalesce(min(seq), 9223372036854775807) AS m FROM s WHERE id NOT IN (SELECT id FROM gazetteer WHERE id % 1999 <> 150)) SELECT id, seq, 'ok' AS action FROM s, stop WHERE seq < m")
def batch_verdict(spark, sf):
    """A verdict on a selection in order, which stops at the first row that is not there."""
    g = load(spark, sf, "gazetteer")
    picked = g.select("id", F.col("id").alias("seq"))
    log = load(spark, sf, "edits").limit(0)
    return overlay.batch(log, picked, g.where("id % 1999 <> 150"), "ok").select("id", "seq", "action")


@query(FOLD + ", u AS (SELECT DISTINCT id, 'folded' AS src FROM folded) SELECT count(*) AS folded, (SELECT count(*) FROM edits) AS edits, (SELECT count(DISTINCT id) FROM edits) - count(*) AS emptied FROM u")
def fold_audit(spark, sf):
    """Edits in, records out, ids whose record is empty."""
    e = load(spark, sf, "edits")
    n = overlay.fold(e).agg(F.count("*").alias("folded"))
    return n.join(F.broadcast(e.agg(F.count("*").alias("edits"), F.countDistinct("id").alias("ids")))).select("folded", "edits", (F.col("ids") - F.col("folded")).alias("emptied"))


@query(_ITEMS + " SELECT id, nom FROM it WHERE tipus = ['altre']")
def unclassified(spark, sf):
    """Items that have no class but the catch-all."""
    return _items(spark, sf).where(F.col("tipus") == F.array(F.lit("altre"))).select("id", "nom")


@query("SELECT page_id, '/base' || CASE WHEN starts_with(p, '/') THEN p ELSE '/' || p END AS url FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN path ELSE ltrim(path, '/') END AS p FROM site)")
def based_urls(spark, sf):
    """Paths below a site's base, with one slash between."""
    p = load(spark, sf, "site").select("page_id", F.when(F.col("page_id") % 2 == 0, F.col("path")).otherwise(F.ltrim("path", F.lit("/"))).alias("p"))
    return p.select("page_id", T.below("/base/", F.col("p")).alias("url"))
