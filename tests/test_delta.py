"""Versions kept as changes: what they write, what they read, and who comes second."""

import random

import pytest
from pyspark.sql import functions as F

from meshlark import Attribute, Resource
from meshlark.errors import SaveConflict, UpsertConflict
from meshlark.operators import mutate
from meshlark.sources import delta

THING = Resource("Thing", (Attribute("id", "integer", "id"), Attribute("name"), Attribute("size", "integer")))
E = ("HAS", "Thing", "Thing")
ROWS = "id long, name string, size long"


@pytest.fixture
def store(spark, tmp_path):
    return delta.Store(spark, f"file://{tmp_path}/store")


def change(spark, rows=None, gone=None):
    make = lambda x, s: None if x is None else spark.createDataFrame(x, s)
    return {"t": delta.Change(("id",), make(rows, ROWS), make([(k,) for k in gone] if gone is not None else None, "id long"))}


def read(store, version=None):
    return sorted(map(tuple, store.read("t", version).collect()))


@pytest.mark.parametrize("sent", [0, 32 << 20])
def test_any_sequence_of_changes_reads_as_it_should(spark, store, monkeypatch, sent):
    monkeypatch.setattr(delta, "SENT_BYTES", sent)
    r, state, history = random.Random(1), {}, [{}]
    for step in range(7):
        rows = {k: (k, r.choice([None, "a", "b"]), r.randint(0, 3)) for k in r.sample(range(20), r.randint(0, 8))}
        gone = [k for k in r.sample(range(20), 5) if k not in rows]
        state = {k: v for k, v in {**state, **rows}.items() if k not in gone}
        store.commit(change(spark, list(rows.values()), gone if step % 3 else None) if step % 3 else change(spark, list(rows.values())))
        state = history[-1] | rows if not step % 3 else state
        history.append(dict(state))
    for v, s in enumerate(history[1:], 1):
        assert read(store, v) == sorted(s.values())

    def net(a, b):
        return sorted((k, "insert" if k not in history[a] else "delete" if k not in history[b] else "update", history[a].get(k), history[b].get(k)) for k in {*history[a], *history[b]} if history[a].get(k) != history[b].get(k))

    def found(a, b):
        return sorted((x.id, x.change, x.before and tuple(x.before), x.after and tuple(x.after)) for x in store.changes("t", a, b).collect())

    for a, b in ((0, 3), (1, 2), (2, 7), (4, 4)):
        assert found(a, b) == net(a, b)
    v = store.compact(folders=3)
    assert v == 8 and len(store.manifest()["tables"]["t"]["rows"]) == 1 and read(store) == read(store, 7) and read(store, 5) == sorted(history[5].values())
    assert store.compact(folders=3) == 8
    store.commit(change(spark, [(100, "z", 1)], [k for k in history[7]][:1]))
    history += [history[7], {k: x for k, x in history[7].items() if k != next(iter(history[7]))} | {100: (100, "z", 1)}]
    assert read(store) == sorted(history[9].values()) and found(6, 9) == net(6, 9)


def test_the_second_writer_and_a_bad_change_leave_nothing(spark, store, tmp_path):
    store.commit(change(spark, [(1, "a", 1), (2, "b", 2)]))
    base = store.version()
    store.commit(change(spark, [(1, "c", 1)]), base)
    before = sorted(p.name for p in (tmp_path / "store" / "t").iterdir())
    with pytest.raises(SaveConflict):
        store.commit(change(spark, [(1, "d", 1)], [2]), base)
    with pytest.raises(UpsertConflict):
        store.commit(change(spark, [(1, "d", 1), (1, "e", 1)]))
    with pytest.raises(ValueError):
        store.commit({"t": delta.Change(("id",), spark.createDataFrame([(1,)], "id long"))})
    failing = spark.range(1).select("id", F.lit("x").alias("name"), F.raise_error(F.lit("broken")).cast("long").alias("size"))
    with pytest.raises(Exception, match="broken"):
        store.commit({"t": delta.Change(("id",), failing)})
    now = sorted(p.name for p in (tmp_path / "store" / "t").iterdir())
    assert store.version() == 2 and read(store) == [(1, "c", 1), (2, "b", 2)] and [n for n in before if n not in now] == []


def test_a_snapshot_saves_only_what_changed(spark, store):
    things = spark.range(20_000).selectExpr("id", "concat('name ', uuid()) as name", "id % 7 as size")
    first = mutate.Snapshot(spark, {"Thing": THING}).create_all("Thing", things)
    first = first.relate_all(E, spark.range(500).selectExpr("cast(id as string) as src", "cast(id + 1 as string) as dst"))
    assert first.save_changes(store) == 1
    opened = mutate.Snapshot.open_store(store, first.resources)
    rows = opened.node("Thing").where("id % 100 = 5").withColumn("size", F.lit(9).cast("long"))
    assert opened.save_changes(store) == 1 and opened.sandboxed().delete("Thing", {"id": 3}).save_changes(store) is None
    assert opened.upsert_all("Thing", rows, ("id",)).save_changes(store) == 2
    m = store.manifest()
    whole, part = m["tables"]["nodes/Thing"]["rows"][0]["bytes"], sum(f["bytes"] for x in m["changed"]["nodes/Thing"].values() for f in x)
    assert list(m["changed"]) == ["nodes/Thing"] and part < 0.05 * whole
    with pytest.raises(SaveConflict):
        opened.delete("Thing", {"id": 3}).save_changes(store)
    latest = mutate.Snapshot.open_store(store, first.resources)
    assert latest.node("Thing").where("size = 9").count() == 200 and latest.node("Thing").count() == 20_000
    assert latest.delete("Thing", {"id": 4}).save_changes(store) == 3
    after = mutate.Snapshot.open_store(store, first.resources)
    assert after.node("Thing").count() == 19_999 and after.edge(E).count() == 498
    assert sorted(x.change for x in store.changes("edges/HAS-Thing-Thing", 2).collect()) == ["delete", "delete"]
    assert store.changes("nodes/Thing", 1).groupBy("change").count().orderBy("change").collect() == [("delete", 1), ("update", 200)]


def test_changes_as_a_source(spark, store, tmp_path):
    from meshlark.sources import changes

    changes.register(spark)
    path = store.path
    write = lambda rows, **more: spark.createDataFrame(rows, ROWS + ", at timestamp").write.format("graph_changes").options(path=path, table="t", key="id", **more).mode("append").save()
    from datetime import datetime

    day = datetime(2024, 2, 3, 4, 5, 6)
    write([(k, "a", k, day) for k in range(50)])
    write([(1, "b", None, None), (2, "b", 2, day)])
    store.commit({"t": delta.Change(("id",), None, spark.createDataFrame([(3,)], "id long")), "u": delta.Change(("x",), spark.createDataFrame([("k", [1, 2])], "x string, y array<int>"))})
    assert store.version() == 3 and store.read("t").count() == 49 and {r["name"] for r in store.read("t").where("id < 3").collect()} == {"a", "b"}
    read = lambda **o: spark.read.format("graph_changes").options(path=path, **o).load()
    t = read(table="t")
    where = lambda test, table="t": changes.read_changes(spark, path, test, table)
    assert t.groupBy("_version", "_change").count().orderBy("_version").collect() == [(1, "row", 50), (2, "row", 2), (3, "gone", 1)]
    assert t.where("_version = 2 and id = 1").collect() == [(1, "b", None, None, 2, "row")] and t.where("_change = 'gone'").select("id", "name").collect() == [(3, None)]
    assert read().where("_table = 'u'").select("_version", "record").collect() == [(3, '{"x": "k", "y": [1, 2]}')]
    # Files of other versions are not opened: they need not be there.
    for f in store.manifest(1)["changed"]["t"]["rows"]:
        for x in (tmp_path / "store" / f["folder"]).iterdir():
            x.write_bytes(b"broken")
    assert where("_version > 1").count() == 3 and where("_version in (2, 3) and _change = 'row'").count() == 2
    assert where("_table = 'u' and _version >= 3", None).count() == 1 and where("_version < 3 and _version >= 2 and id = 2").count() == 1
    with pytest.raises(Exception):  # noqa: B017
        t.collect()


def test_a_write_that_fails_leaves_nothing(spark, store, tmp_path):
    from meshlark.sources import changes

    changes.register(spark)
    out = lambda df, **o: df.write.format("graph_changes").options(path=store.path, table="t", key="id", **o).mode("append").save()
    out(spark.range(10))
    before = sorted(p.name for p in (tmp_path / "store").rglob("*"))
    with pytest.raises(Exception, match="broken"):
        out(spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id")))
    with pytest.raises(Exception, match="exists"):
        out(spark.range(10), base="0")
    with pytest.raises(Exception, match="other columns"):
        out(spark.range(10).withColumn("more", F.lit(1)))
    assert sorted(p.name for p in (tmp_path / "store").rglob("*")) == before and store.version() == 1


def test_changes_as_a_stream(spark, store, tmp_path):
    from meshlark.sources import changes

    changes.register(spark)
    store.commit(change(spark, [(1, "a", 1)]))
    store.commit(change(spark, [(2, "b", 2)], [1]))
    seen = []

    def run():
        stream = spark.readStream.format("graph_changes").options(path=store.path, table="t").load()
        started = stream.writeStream.option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).foreachBatch(lambda df, n: seen.append(sorted((r["_version"], r["_change"], r["id"]) for r in df.collect()))).start()
        started.awaitTermination(120)

    run()
    assert sorted(x for b in seen for x in b) == [(1, "row", 1), (2, "gone", 1), (2, "row", 2)]
    store.commit(change(spark, [(9, "z", 9)]))
    run()
    assert seen[-1] == [(3, "row", 9)]
