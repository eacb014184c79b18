"""Commits that happen once, conflicts between writers and rows, indexes, and plans without Python over points."""

import random

import pytest
from pyspark.sql import functions as F

from meshlark import Attribute, Query, Relationship, Resource, calc, catalogue, func, testgraph
from meshlark.errors import EdgeConflict, Rollback, SaveConflict, UpsertConflict
from meshlark.functions import codec, geo
from meshlark.operators import mutate, spatial, vectors
from meshlark.schema import Array, Geometry, TensorOf
from meshlark.sources import commit

SF = "/root/testdata/sf0.001"
THING = Resource("Thing", (Attribute("id", "string"), Attribute("name", "string"), Attribute("size", "integer")), identities=(("name",),), relationships=(Relationship("parts", "Thing", "many", "HAS", "out"),))
E = ("HAS", "Thing", "Thing")


@pytest.fixture
def snap(spark):
    return mutate.Snapshot(spark, {"Thing": THING}).create("Thing", {"id": "1", "name": "a", "size": 1}, {"id": "2", "name": "b", "size": 2}, {"id": "3", "name": "c", "size": 3})


def test_a_name_is_made_once(spark, tmp_path):
    path = f"file://{tmp_path}/folder/v1"
    assert commit.create_once(spark, path, b"first") and not commit.create_once(spark, path, b"second")
    assert commit.read(spark, path) == b"first" and commit.names(spark, f"file://{tmp_path}/folder") == ["v1"]


def test_the_second_of_two_writers_gets_a_conflict(spark, snap, tmp_path):
    path = f"file://{tmp_path}/graph"
    assert snap.sandboxed().update("Thing", {"id": "1"}, {"size": 9}).save(path) is None and not (tmp_path / "graph").exists()
    snap.save(path)
    one, two = (mutate.Snapshot.open(spark, path, snap.resources) for _ in range(2))
    one.update("Thing", {"id": "1"}, {"size": 10}).save(path)
    before = sorted(p.name for p in (tmp_path / "graph").iterdir())
    with pytest.raises(SaveConflict):
        two.update("Thing", {"id": "1"}, {"size": 20}).save(path)
    assert sorted(p.name for p in (tmp_path / "graph").iterdir()) == before
    assert mutate.Snapshot.open(spark, path, snap.resources).node("Thing").where("uuid = '1'").first()["size"] == 10


def test_transactions_nest_and_roll_back(snap):
    def inner(s):
        s = s.update("Thing", {"id": "1"}, {"size": 5})
        mutate.rollback("enough")
        return s

    def outer(s):
        s, error = s.update("Thing", {"id": "2"}, {"size": 6}).transaction(inner)
        assert isinstance(error, Rollback) and error.reason == "enough"
        return s.update("Thing", {"id": "3"}, {"size": 7})

    after, error = snap.transaction(outer)
    assert error is None and sorted(r["size"] for r in after.node("Thing").collect()) == [1, 6, 7]
    bad = F.udf(lambda x: 1 // (x - x), "long")
    same, error = snap.transaction(lambda s: s._with_nodes("Thing", s.node("Thing").withColumn("size", bad("size"))))
    assert same is snap and error is not None


def test_conflicts_among_new_rows_and_edges(spark, snap, monkeypatch):
    with pytest.raises(EdgeConflict):
        snap.relate_all(E, spark.createDataFrame([("1", "2"), ("1", "3")], "src string, dst string"), source_exclusive=True)
    assert snap.relate_all(E, spark.createDataFrame([("1", "2"), ("1", "2")], "src string, dst string"), source_exclusive=True).edge(E).count() == 1
    monkeypatch.setattr(mutate, "RELATE_ROWS", 2)
    with pytest.raises(ValueError):
        snap.relate(E, {"id": "1"}, {})
    new = spark.createDataFrame([("9", "a", None), ("4", "d", 4)], "uuid string, name string, size long")
    out = snap.upsert_all("Thing", new, ("name",)).node("Thing")
    assert sorted((r["uuid"], r["name"], r["size"]) for r in out.collect()) == [("2", "b", 2), ("3", "c", 3), ("4", "d", 4), ("9", "a", None)]
    assert out.where("_labels is null").count() == 0
    with pytest.raises(UpsertConflict):
        snap.upsert_all("Thing", new.union(new), ("name",))
    with pytest.raises(UpsertConflict):
        snap.create("Thing", {"id": "7", "name": "a"}).upsert_all("Thing", new, ("name",))


def test_manage_takes_away_what_is_not_named(snap):
    s = snap.manage("Thing", {"id": "1"}, "parts", "append", [{"id": "2"}, {"id": "3"}])
    pairs = lambda x: sorted(map(tuple, x.edge(E).collect()))
    assert pairs(s) == [("1", "2"), ("1", "3")]
    assert pairs(s.manage("Thing", {"id": "1"}, "parts", "remove", [{"id": "2"}])) == [("1", "3")]
    assert pairs(s.manage("Thing", {"id": "1"}, "parts", "append_and_remove", [{"id": "3"}, {"id": "1"}])) == [("1", "1"), ("1", "3")]
    assert pairs(s.manage("Thing", {"id": "1"}, "parts", "append_and_remove", [])) == []


@pytest.mark.parametrize("name", ["geo_contains_point", "geo_contains_hole", "geo_within", "geo_not_contains", "geo_traverse_contains", "geo_set_difference", "geo_distance", "geo_dwithin"])
def test_no_python_in_plans_over_points(spark, name):
    plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_points_of_an_attribute_are_known(spark):
    spots = Resource("Spot", (Attribute("id", "integer", "id"), Attribute("place", Geometry(("Point",)), "place")))
    from meshlark import Graph, attr

    g = Graph(spark).add(spots, spark.range(5).select("id", geo.point(F.col("id").cast("double"), F.lit(0.5)).alias("place")))
    area = geo.geometry("Polygon", [[(0.5, 0), (3.5, 0), (3.5, 1), (0.5, 1), (0.5, 0)]])
    df = Query(g, "Spot").filter(func(lambda p: geo.st_contains(geo.literal(area), p), attr("place"))).df()
    assert sorted(r["id"] for r in df.collect()) == [1, 2, 3] and "Arrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_near_pairs_around_the_globe(spark):
    r = random.Random(4)
    places = [(r.uniform(-180, 180), r.choice([r.uniform(-90, 90), r.uniform(85, 90), -89.9])) for _ in range(120)] + [(180.0, 10.0), (-180.0, 10.0), (179.99, 10.0), (-179.99, 10.0), (0.0, 90.0), (0.0, -90.0)]
    a = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "a long, x double, y double")
    b = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "b long, u double, v double")
    for meters in (1.0, 30_000.0, 900_000.0, 9_000_000.0, 30_000_000.0):
        want = sorted((i, j) for i, p in enumerate(places) for j, q in enumerate(places) if geo.meters(p, q) <= meters)
        assert sorted((x["a"], x["b"]) for x in spatial.near_pairs(a, b, ("x", "u"), ("y", "v"), meters).collect()) == want


def test_large_and_small_areas_find_their_points(spark):
    r = random.Random(3)
    points = [(k, r.uniform(-170, 170), r.uniform(-80, 80)) for k in range(200)]
    boxes = [(k, x - w, y - w, x + w, y + w) for k, w in enumerate((0.5, 2, 7, 30, 70)) for x, y in ((r.uniform(-80, 80), r.uniform(-10, 10)),)]
    shapes = [(k, geo.geometry("Polygon", [[(w, s), (e, s), (e, n), (w, n), (w, s)]])) for k, w, s, e, n in boxes] + [(9, None)]
    found = spatial.points_in_areas(spark.createDataFrame(points, "p long, x double, y double"), spark.createDataFrame(shapes, f"k long, area {geo.GEOMETRY_DDL}"), "x", "y", "area", 1.0)
    assert sorted((f["p"], f["k"]) for f in found.collect()) == sorted((p, k) for p, x, y in points for k, w, s, e, n in boxes if w < x < e and s < y < n)


def test_indexes_are_made_kept_and_dropped(spark, tmp_path):
    path = f"file://{tmp_path}/places"
    spark.range(50).select("id", F.struct(geo.point(F.col("id").cast("double"), F.lit(1.0)).alias("at")).alias("spot")).write.parquet(path)
    assert len(spatial.create_index(spark, path, "spot.at", dry_run=True)) == 1 and spatial.drop_index(spark, path, "spot.at") == []
    assert len(spatial.create_index(spark, path, "spot.at")) == 1 and spatial.create_index(spark, path, "spot.at") == []
    assert len(spatial.create_index(spark, path, "spot.at", recreate=True)) == 2
    assert spatial.open_index(spark, path, "spot.at").where("spot_at_x between 3 and 7").count() == 5 and spark.read.parquet(path).count() == 50
    assert len(spatial.drop_index(spark, path, "spot.at")) == 1 and spatial.drop_index(spark, path, "spot.at") == []


@pytest.mark.parametrize("kind", vectors.KINDS)
def test_vector_index_has_recall(spark, tmp_path, kind):
    path = f"file://{tmp_path}/vectors"
    source = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    source.unionByName(spark.createDataFrame([(-1, None, None)], source.schema)).write.parquet(path)
    vectors.create_index(spark, path, "embedding", kind, lists=16)
    assert spark.read.parquet(f"{path}/_vector/embedding/rows").count() == source.count() + 1
    hits = total = 0
    for q in source.where("vec_id % 50 = 0").orderBy("vec_id").limit(8).collect():
        exact = [r["vec_id"] for r in vectors.search(spark, path, "embedding", q["embedding"], 10, probes=None).collect()]
        near = [r["vec_id"] for r in vectors.search(spark, path, "embedding", q["embedding"], 10, probes=14).collect()]
        assert len(exact) == 10 and exact[0] == q["vec_id"]
        hits, total = hits + len(set(exact) & set(near)), total + 10
    assert hits >= 0.9 * total
    assert len(vectors.create_index(spark, path, "embedding", kind, dry_run=True)) == 0 and len(vectors.drop_index(spark, path, "embedding")) == 1
    with pytest.raises(ValueError):
        vectors.create_index(spark, path, "embedding", "manhattan")


def test_reading_in_types(spark):
    from meshlark import Graph

    r = Resource("Row", (Attribute("id", "integer", "id"), Attribute("day", "date", "day"), Attribute("words", Array("string"), "words"), Attribute("ok", "boolean", "ok")))
    rows = [("1", "2020-01-02", '["a","b"]', "true"), ("2", "soon", None, "maybe"), ("x", None, "[]", None)]
    out = Query(Graph(spark).add(r, spark.createDataFrame(rows, "id string, day string, words string, ok string")), "Row").cast().df().collect()
    assert [(x["id"], str(x["day"]), x["words"], x["ok"], x["_errors"]) for x in out] == [(1, "2020-01-02", ["a", "b"], True, []), (2, "None", None, None, ["day", "ok"]), (None, "None", [], None, ["id"])]


def test_tensor_columns_check_shapes(spark):
    df = spark.createDataFrame([([[1, 2], [3, 4]],)], "t array<array<bigint>>")
    assert df.select(codec.tensor_column(F.col("t"), TensorOf((2, 2), "s64"))).first()[0] == [1, 2, 3, 4]
    assert df.select(codec.tensor_column(F.col("t"), TensorOf((2, 2), "f32", packed=True))).first()[0] == codec.dump_tensor([[1, 2], [3, 4]], TensorOf((2, 2), "f32", packed=True))
    with pytest.raises(Exception, match="shape"):
        df.select(codec.tensor_column(F.col("t"), TensorOf((4, 1), "s64"))).collect()


def test_chains_load_records_once(spark):
    g = testgraph.load(spark, SF)
    df = Query(g, "Customer").load_along("suppliers", "orders", "items", "supplier", where=calc("lng") < 0).df()
    for r in df.where(F.size("suppliers") > 1).limit(5).collect():
        ids = [s["id"] for s in r["suppliers"]]
        assert ids == sorted(set(ids))


def test_bulk_updates_clear_and_refuse_repeated_keys(spark, snap):
    kinds = "id string, name string, size long"
    df = snap.node("Thing")
    key, size = snap.key("Thing"), THING.stored("size")
    change = lambda *rows: spark.createDataFrame(rows, f"`{key}` string, name string, `{size}` long")
    read = lambda s: sorted((r[key], r["name"], r[size]) for r in s.node("Thing").collect())
    assert kinds and df.count() == 3
    assert read(snap.update_all("Thing", change(("1", None, 7), (None, "x", 1), ("9", "y", 2)))) == [("1", "a", 7), ("2", "b", 2), ("3", "c", 3)]
    assert read(snap.update_all("Thing", change(("1", None, None), ("2", "z", None)), clear=("name",))) == [("1", None, 1), ("2", "z", 2), ("3", "c", 3)]
    with pytest.raises(UpsertConflict):
        snap.update_all("Thing", change(("1", "x", 1), ("1", "y", 2)))
    with pytest.raises(ValueError):
        snap.update_all("Thing", change(("1", "x", 1)), clear=("other",))


def test_an_index_that_was_never_finished_is_built_again(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/v"
    spark.createDataFrame([(k, [float(k % 7), 1.0, float(k)]) for k in range(60)], "id long, v array<double>").write.parquet(path)
    real = commit.create_once
    monkeypatch.setattr(commit, "create_once", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        vectors.create_index(spark, path, "v", "euclidean", lists=4)
    monkeypatch.setattr(commit, "create_once", real)
    monkeypatch.setattr(vectors, "FILE_ROWS", 5)
    assert vectors.create_index(spark, path, "v", "euclidean", lists=4) and not vectors.create_index(spark, path, "v", "euclidean", lists=4)
    assert [r["id"] for r in vectors.search(spark, path, "v", [3.0, 1.0, 3.0], 1).collect()] == [3]
    places = f"file://{tmp_path}/p"
    spark.range(20).select("id", geo.point(F.col("id").cast("double"), F.lit(1.0)).alias("g")).write.parquet(places)
    (tmp_path / "p" / "_spatial" / "g").mkdir(parents=True)
    assert spatial.create_index(spark, places, "g") and not spatial.create_index(spark, places, "g")
    assert spatial.open_index(spark, places, "g").count() == 20
