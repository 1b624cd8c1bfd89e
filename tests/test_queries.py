"""Every query of the core against its SQL, and the operators against brute force."""

import glob
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import fit, joins, overlay, windows
from lodestar.operators.graph import component_ids
from lodestar.plans import registry
from lodestar.sources import files
from lodestar.streaming import edits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {p.split('/')[-1][:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    got = registry.QUERIES[name](spark, SF)
    rows = [tuple(r[c] for c in sorted(got.columns)) for r in got.collect()]
    if name in registry.ORACLE_SQL:
        want = con.sql(registry.ORACLE_SQL[name])
        assert sorted(want.columns) == sorted(got.columns)
        order = [want.columns.index(c) for c in sorted(want.columns)]
        assert sorted(map(str, rows)) == sorted(str(tuple(r[k] for k in order)) for r in want.fetchall())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_indel_ratio_is_the_lcs_ratio(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choice("abcé ") for _ in range(rng.randint(0, 12))), "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 12)))) for _ in range(300)] + [("sineu", "sinau"), ("", ""), (None, "a")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", T.indel_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    for a, b, r in got:
        a, b = a or "", b or ""
        assert r == (2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0)


def test_grid_join_and_components(spark, tmp_path):
    rng = random.Random(2)
    pts = [(i, rng.randint(-300, 300), rng.randint(-300, 300)) for i in range(150)]
    a = spark.createDataFrame(pts, "id long, x long, y long")
    b = spark.createDataFrame(pts, "other long, gx long, gy long")
    got = {(r.id, r.other) for r in joins.grid_join(a, b, 40).collect()}
    assert got == {(i, j) for i, x, y in pts for j, u, v in pts if (x - u) ** 2 + (y - v) ** 2 <= 1600}
    edges = [(i, j) for i, j in got if i < j]
    label = {i: i for e in edges for i in e}
    for _ in pts:
        for i, j in edges:
            label[i] = label[j] = min(label[i], label[j])
    found = component_ids(spark.createDataFrame(edges, "src long, dst long"), f"file://{tmp_path}")
    assert {r.node: r.component for r in found.collect()} == label


def test_components_of_a_descending_chain_take_few_rounds(spark, tmp_path, monkeypatch):
    from lodestar.operators import graph

    n, saved, rounds = 256, graph._saved, []
    monkeypatch.setattr(graph, "_saved", lambda df, root, made=None: rounds.append(1) or saved(df, root, made))
    chain = [(0, n), *((k, k - 1) for k in range(n, 1, -1))]
    found = component_ids(spark.createDataFrame(chain, "src long, dst long"), f"file://{tmp_path}")
    assert {r.component for r in found.collect()} == {0} and found.count() == n + 1
    assert len(rounds) < 30
    assert component_ids(spark.createDataFrame([], "src long, dst long"), f"file://{tmp_path}").count() == 0
    assert component_ids(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long"), f"file://{tmp_path}").count() == 0


def test_greedy_keep_takes_boxes_in_order(spark, tmp_path):
    rng = random.Random(3)
    n, clash = 40, {tuple(sorted(rng.sample(range(40), 2))) for _ in range(60)}
    kept = []
    for i in range(n):
        if not any((min(i, k), max(i, k)) in clash for k in kept):
            kept.append(i)
    boxes = spark.createDataFrame([(i, i) for i in range(n)], "id long, rank long")
    got = joins.greedy_keep(boxes, spark.createDataFrame(list(clash), "id long, over long"), f"file://{tmp_path}")
    assert sorted(r.id for r in got.collect()) == kept


def test_greedy_keep_sees_overlaps_of_wide_boxes(spark, con):
    boxes = con.sql(f"{registry.WITH} SELECT id, x, y, w, h, score FROM boxes").fetchall()

    def clash(p, q):
        common = max(0, min(p[1] + p[3], q[1] + q[3]) - max(p[1], q[1])) * max(0, min(p[2] + p[4], q[2] + q[4]) - max(p[2], q[2]))
        return common > 0.45 * (p[3] * p[4] + q[3] * q[4] - common) or common > 0.60 * min(p[3] * p[4], q[3] * q[4])

    kept = []
    for r in sorted(boxes, key=lambda r: (-r[5], -r[3] * r[4], r[0])):
        if not any(clash(r, k) for k in kept):
            kept.append(r)
    assert sorted(r.id for r in registry.QUERIES["greedy_keep"](spark, SF).collect()) == sorted(r[0] for r in kept)


def test_fits():
    rng = np.random.default_rng(4)
    xy = rng.uniform(0, 4000, (15, 2))
    p = np.hstack([xy, np.stack([2.5 + xy[:, 0] * 2e-4 - xy[:, 1] * 1e-5, 39.9 + xy[:, 0] * 1e-5 - xy[:, 1] * 1.5e-4], 1)])
    assert np.abs(fit.design(xy[:, 0], xy[:, 1], 1) @ fit.polynomial(p, 1) - p[:, 2:]).max() < 1e-9
    assert np.abs(fit.thin_plate(p)(xy[:, 0], xy[:, 1]) - p[:, 2:]).max() < 1e-6
    assert fit.select_model(p)[1]["poly1"][0] < 1e-3
    bad = p.copy()
    bad[3, 2] += 0.5
    assert not fit.robust(bad, np.zeros(15, bool))[1][3] and fit.robust(bad, np.ones(15, bool))[1].all()


def test_overlay_rules_and_stream(spark, tmp_path):
    log = [(1, 1, "pick", "A", None), (1, 2, "none", None, None), (2, 1, "graf", None, "x"), (2, 2, "undo", None, None), (3, 1, "graf", None, ""), (4, 1, "ok", None, "y"), (4, 2, "pick", "B", None), (5, 1, "trash", None, None)]
    df = spark.createDataFrame(log, overlay.SCHEMA)
    want = {1: ("none", None, None), 2: (None, None, "x"), 4: ("pick", "B", "y"), 5: ("trash", None, None)}
    assert {r.id: tuple(r)[1:] for r in overlay.fold(df).collect()} == want
    src = str(tmp_path / "in")
    df.repartition(3).write.parquet(src)
    q = edits.follow(spark.readStream.schema(overlay.SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), str(tmp_path / "log"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert {r.id: tuple(r)[1:] for r in edits.folded(spark, str(tmp_path / "log")).collect()} == want
    base = spark.createDataFrame([(2, "a"), (5, "b"), (9, "c")], "id long, nom string")
    assert {r.id: r.nom_curated for r in overlay.apply(base, overlay.fold(df)).collect()} == {2: "x", 9: "c"}


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"toponims": [{"id": "B01_1", "x": 3}, {"id": "B01_2", "x": null}]}')
    (tmp_path / "m.json").write_text('{"k": {"verdict": "ok"}, "l": {"verdict": null}}')
    (tmp_path / "w.json").write_text('{"result": {"windows": [{"w": 1}]}}')
    (tmp_path / "bad.json").write_text('{"x": 1}\nnot json\n')
    assert files.json_records(spark, f"{tmp_path}/a.json", "toponims", "id STRING, x INT").count() == 2
    assert files.json_records(spark, f"{tmp_path}/none.json", "toponims", "id STRING, x INT").count() == 0
    assert {r.id: r.verdict for r in files.json_map(spark, f"{tmp_path}/m.json", "verdict STRING").collect()} == {"k": "ok", "l": None}
    assert files.either_root(spark, f"{tmp_path}/w.json", "windows", "w INT").first().w == 1
    good, bad = files.tolerant_json(spark, f"{tmp_path}/bad.json", "x INT")
    assert good.count() == 1
    assert files.policy("a 'self' x; b y") == {"a": ["'self'", "x"], "b": ["y"]}


def test_without_llm_the_queries_stay(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here = Path(registry.__file__).parent.parent.parent
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    shutil.copytree(here / "lodestar", tmp_path / "lodestar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for leftover in (False, True):  # an empty folder may stay behind
        if leftover:
            (tmp_path / "lodestar" / "llm").mkdir()
        out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True)
        assert out.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLE_SQL))], out.stderr


def test_without_llm_the_rest_imports():
    import ast
    from pathlib import Path

    for p in Path(registry.__file__).parent.parent.rglob("*.py"):
        if "llm" not in p.parts:
            assert "lodestar.llm" not in p.read_text(), p
            ast.parse(p.read_text())


def test_gap_split_stops_at_the_levels_of_its_sql(spark, con, tmp_path):
    boxes = spark.read.parquet(f"{SF}/embeddings.parquet").selectExpr("vec_id as id", "cast(floor((embedding[0] + 0.5) * 3840) as bigint) as x", "cast(floor((embedding[1] + 0.5) * 2849) as bigint) as y")
    for levels, target in ((2, 8), (3, 20)):
        want = con.sql(f"{registry.WITH}{registry._split_sql(levels, target)}").fetchall()
        assert max(map(len, [r[1] for r in want])) == levels
        got = windows.gap_split(boxes, target, str(tmp_path), levels).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert windows.gap_split(boxes, 8, str(tmp_path)).groupBy("path").count().where("count > 8").count() == 0
