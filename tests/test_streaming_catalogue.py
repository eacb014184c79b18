"""Every registered query against its SQL on the smallest tables; windows over a stream."""

import duckdb
import pytest

from meshlark import catalogue, catalogue_joins  # noqa: F401  the second adds its queries to the first's
from meshlark.streaming import windows
from meshlark.testgraph import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.values():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    found = duck.sql(catalogue.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(found.columns)
    mine = sorted(repr([r[c] for c in cols]) for r in df.collect())
    assert mine == sorted(repr([r[found.columns.index(c)] for c in cols]) for r in found.fetchall())


def test_windows_over_a_stream(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/events.parquet")
    table.select("ts", "event_type").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "in"))
    job = windows.tumbling(stream, "ts", "1 hour", ["event_type"], late="10 minutes").writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    job.awaitTermination(120)
    assert spark.table("w").groupBy().sum("n").first()[0] == table.count()
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, windows.tumbling(table, "ts", "1 hour", ["event_type"]).collect()))


def test_bulk_upsert_where_new_ids_are_taken(spark, duck, tmp_path):
    for t in TABLES.values():
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    (tmp_path / "customer.parquet").unlink()
    duckdb.sql(f"COPY (SELECT * FROM '{SF}/customer.parquet' UNION ALL SELECT * REPLACE (c_custkey + 800000 AS c_custkey) FROM '{SF}/customer.parquet') TO '{tmp_path}/customer.parquet'")
    found = duckdb.sql(catalogue.ORACLE_SQL["mut_upsert_bulk"].replace("FROM customer", f"FROM '{tmp_path}/customer.parquet'")).fetchall()
    df = catalogue.QUERIES["mut_upsert_bulk"](spark, str(tmp_path)).select("id", "name")
    assert sorted(map(tuple, df.collect())) == sorted(found) and len(found) > len(set(found))
