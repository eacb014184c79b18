"""Declarations, codecs and snapshots."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pytest

from meshlark import Attribute, Domain, Guard, Relationship, Resource
from meshlark.errors import GuardViolation, MissingNode, UpsertConflict
from meshlark.functions import codec, naming
from meshlark.operators.mutate import Snapshot
from meshlark.schema import Array, Geometry, Struct, TensorOf, Union, VectorOf, spark_type

INV = Domain("Inventory", "Inv")
SPEC = Resource("Specification", (Attribute("id"), Attribute("name"), Attribute("major_version", "integer", "versionMajor", default=1)), domain=INV, relationships=(Relationship("services", "Service", "many", "SPECIFIES"),), identities=(("name",),))
SERVICE = Resource("Service", (Attribute("id"), Attribute("name"), Attribute("service_id", source="serviceId"), Attribute("location", Geometry(("Point",)))), domain=INV, relationships=(Relationship("specification", "Specification", "one", "SPECIFIES", "in", None, allow_nil=False), Relationship("parent", "Service", "one", "MANAGES", "in")), skip=("service_id",))
E = ("SPECIFIES", "Specification", "Service")


@pytest.fixture
def snap(spark):
    s = Snapshot(spark, {"Specification": SPEC, "Service": SERVICE})
    return s.create("Specification", {"id": "1", "name": "a"}, {"id": "2", "name": "b"}).create("Service", {"id": "10", "name": "x"}, {"id": "11", "name": "y"})


def names(df):
    return sorted(map(tuple, df.collect()))


def test_names():
    assert naming.camel("pen_name") == "penName" and naming.pascal("typed_instance") == "TypedInstance" and naming.macro("placeRef") == "PLACE_REF"
    assert SPEC.labels == ("Inv", "Specification") and SPEC.stored("id") == "uuid" and SPEC.stored("major_version") == "versionMajor"
    assert SPEC.stored_map({"id": 1, "other": 2}) == {"uuid": 1, "other": 2}
    assert SERVICE.source_exclusive(SERVICE.relationship("parent")) and SPEC.destination_exclusive(SPEC.relationship("services"), SERVICE)
    assert SPEC.all_guards((SERVICE,)) == (Guard("SPECIFIES", "out", "Service"),)


@pytest.mark.parametrize(
    "bad",
    [
        replace(SPEC, name="specification"), replace(SPEC, attributes=(Attribute("id"), Attribute("x", source="Bad"))), replace(SPEC, attributes=(Attribute("id"), Attribute("x", "file"))), replace(SPEC, attributes=(Attribute("id"), Attribute("x", Array(Array("term"))))),
        replace(SPEC, relationships=(Relationship("a", "Service", edge="bad"),)), replace(SPEC, relationships=(Relationship("a", "Service", edge="A", direction="up"),)), replace(SPEC, relationships=(Relationship("a", "Service", edge="A"), Relationship("b", "Service", edge="A"))),
        replace(SPEC, guards=(Guard("A", "sideways", "Service"),)), replace(SPEC, key=("nothing",)), replace(SPEC, relationships=(Relationship("a", "service", edge="A"),)),
    ],
)
def test_verifiers(bad):
    with pytest.raises(ValueError):
        bad.validate()


def test_types_and_codecs():
    assert spark_type(Array(Array("integer"))).simpleString() == "array<array<bigint>>" and spark_type(Union((("a", "string"),))).simpleString() == "struct<type:string,value:string>"
    assert spark_type(Struct((("name", "string"), ("age", "integer")))).simpleString() == "struct<name:string,age:bigint>" and spark_type(VectorOf(3)).simpleString() == "array<float>"
    assert codec.dump_nested([[1, 2], [3, 4]]) == ["[1,2]", "[3,4]"] and codec.load_nested(["[1,2]"]) == [[1, 2]]
    assert codec.to_json({"b": None, "a": [dt.date(2020, 1, 2), {"z": 1, "y": 2}]}) == '{"a":["2020-01-02",{"y":2,"z":1}]}'
    assert codec.from_base64(codec.to_base64(b"\xff\xfe", url=True), url=True) == b"\xff\xfe" and codec.untag_union(codec.tag_union("int", 5)) == ("int", 5)
    for kind, value in ((TensorOf((3,), "s64"), [1, 2, 3]), (TensorOf((2, 2), "f32", packed=True), [[1.5, 2], [3, 4]]), (TensorOf((2, 2, 2), "u8", packed=True), np.arange(8).reshape(2, 2, 2))):
        assert np.array_equal(codec.load_tensor(codec.dump_tensor(value, kind), kind), np.asarray(value))
    with pytest.raises(ValueError):
        codec.dump_tensor([1, 2], TensorOf((3,)))
    with pytest.raises(ValueError):
        spark_type(TensorOf((1, 1, 1, 1)))


def test_create_update_upsert(snap):
    s = snap.update("Specification", {"name": "a"}, {"major_version": 7}, remove=("name",))
    assert names(s.node("Specification").select("uuid", "name", "versionMajor").where("uuid = '1'")) == [("1", None, 7)]
    assert snap.node("Specification").where("versionMajor = 1").count() == 2  # the first snapshot is what it was
    s = snap.upsert("Specification", {"id": "9", "name": "a", "major_version": 3}).upsert("Specification", {"id": "3", "name": "c"})
    assert names(s.node("Specification").select("uuid", "name", "versionMajor")) == [("2", "b", 1), ("3", "c", 1), ("9", "a", 3)]
    with pytest.raises(UpsertConflict):
        snap.create("Specification", {"id": "5", "name": "a"}).upsert("Specification", {"id": "6", "name": "a"})
    with pytest.raises(ValueError):
        snap.create("Specification", {"name": "no key"})
    assert snap.merge("Specification", {"id": "1", "name": "a"}).node("Specification").count() == 2
    assert snap.merge("Specification", {"id": "1", "name": "z"}).node("Specification").count() == 3


def test_edges_and_guards(snap):
    s = snap.relate(E, {"id": "1"}, {"id": "10"}).relate(E, {"id": "1"}, {"id": "10"})
    assert names(s.edge(E)) == [("1", "10")] and s.related(E, {"id": "1"}, {"id": "10"}) and not s.related(E, {"id": "2"}, {"id": "10"})
    assert names(s.relate(E, {"id": "2"}, {"id": "10"}, destination_exclusive=True).edge(E)) == [("2", "10")]
    assert names(s.relate_each([(E, {"id": "2"}, {"id": "10"}), (E, {"id": "2"}, {"id": "11"})]).edge(E)) == [("2", "10"), ("2", "11")]
    assert names(s.relate(E, {"id": "1"}, {"id": "11"}, source_exclusive=True).edge(E)) == [("1", "11")]
    assert names(s.replace_edges(E, {"id": "1"}, [{"id": "11"}]).edge(E)) == [("1", "11")]
    assert names(s.unrelate(E, {"id": "1"}, {"id": "10"}).edge(E)) == []
    with pytest.raises(MissingNode):
        s.relate(E, {"id": "1"}, {"id": "404"})
    with pytest.raises(GuardViolation):
        s.delete_guarded("Specification", {"id": "1"})
    assert s.delete_guarded("Specification", {"id": "2"}).node("Specification").count() == 1
    gone = s.delete("Service", {"id": "10"})
    assert gone.node("Service").count() == 1 and gone.edge(E).count() == 0
    assert s.delete_all().node("Service").count() == 0
    labels = s.update_labels("Service", {"id": "10"}, add=("Extra",), remove=("Inv",)).node("Service").where("uuid = '10'").first()["_labels"]
    assert sorted(labels) == ["Extra", "Service"]


def test_transactions_and_versions(snap, tmp_path, spark):
    def fails(s):
        s.create("Service", {"id": "12", "name": "z"})
        raise RuntimeError("no")

    after, error = snap.transaction(fails)
    assert after is snap and isinstance(error, RuntimeError)
    after, error = snap.transaction(lambda s: s.create("Service", {"id": "12", "name": "z"}))
    assert error is None and after.node("Service").count() == 3
    path = f"file://{tmp_path}/graph"
    first = snap.relate(E, {"id": "1"}, {"id": "10"}).save(path)
    after.save(path)
    assert Snapshot.open(spark, path, snap.resources).node("Service").count() == 3
    old = Snapshot.open(spark, path, snap.resources, first)
    assert old.node("Service").count() == 2 and names(old.edge(E)) == [("1", "10")]
    from meshlark import Query, attr, traverse

    assert [r["id"] for r in Query(old.graph(), "Service").filter(traverse("specification").field("name") == "a").df().collect()] == ["10"]
    assert Query(old.graph(), "Service").filter(attr("name") == "y").df().count() == 1
