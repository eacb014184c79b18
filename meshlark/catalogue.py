"""Registered queries over the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testgraph
from .errors import MeshError
from .functions import codec, geo, vector
from .operators import mutate, spatial, vectors
from .operators.reach import connected, related_pairs
from .plans.expr import attr, calc, ci, exists, func, traverse
from .plans.query import Query, combine, ordered
from .schema import Aggregate as A
from .schema import Array, Attribute, Domain, Geometry, Guard, Relationship, Resource, Struct, TensorOf
from .sources import commit
from .sources.graph import LABELS, Graph
from .streaming import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SYDNEY = (151.2093, -33.8688)


def query(name: str, sql: str | None):
    def register(build: Callable[[Graph], DataFrame]) -> Callable[[Graph], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(testgraph.load(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


def q(g: Graph, name: str) -> Query:
    return Query(g, name)


def simple(name: str, resource: str, columns: dict[str, str], build: Callable[[Query], Query], sql: str) -> None:
    """A query whose result is some attributes under new names; sql: what stands after SELECT ... FROM."""
    def run(g: Graph) -> DataFrame:
        return build(q(g, resource)).df().select(*[F.col(a).alias(c) for a, c in columns.items()])

    r = next(x for x in testgraph.RESOURCES if x.name == resource)
    listed = ", ".join(f"{r.stored(a)} AS {c}" for a, c in columns.items())
    query(name, f"SELECT {listed} FROM {sql}")(run)


CUST, ORD, ID = {"id": "id", "name": "name"}, {"id": "id", "total": "total"}, {"id": "id"}

# scans, projections, predicates
simple("scan_label", "Customer", {"id": "id", "name": "name", "balance": "balance", "segment": "segment"}, lambda x: x, "customer")
simple("project_translate", "Order", {"id": "order_id", "priority": "urgency", "customer_id": "customer"}, lambda x: x, "orders")
simple("match_properties", "Order", ID, lambda x: x.where_stored({"status": "F", "priority": "1-URGENT"}), "orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
simple("filter_eq", "Order", ORD, lambda x: x.filter(attr("status") == "F"), "orders WHERE o_orderstatus = 'F'")
simple("filter_ne", "Order", ORD, lambda x: x.filter(attr("status") != "F"), "orders WHERE o_orderstatus <> 'F'")
simple("filter_in", "Order", ORD, lambda x: x.filter(attr("priority").isin({"1-URGENT", "2-HIGH"})), "orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
simple("filter_in_empty", "Order", ORD, lambda x: x.filter(attr("status").isin([])), "orders WHERE false")
simple("filter_lt", "Customer", CUST, lambda x: x.filter(attr("balance") < 0), "customer WHERE c_acctbal < 0")
simple("filter_lte", "Part", CUST, lambda x: x.filter(attr("size") <= 10), "part WHERE p_size <= 10")
simple("filter_gt", "Customer", CUST, lambda x: x.filter(attr("balance") > 5000), "customer WHERE c_acctbal > 5000")
simple("filter_gte", "Part", CUST, lambda x: x.filter(attr("size") >= 40), "part WHERE p_size >= 40")
simple("filter_is_nil", "Part", CUST, lambda x: x.filter(func(F.nullif, attr("size"), 24).is_nil()), "part WHERE nullif(p_size, 24) IS NULL")
simple("filter_is_not_nil", "Part", CUST, lambda x: x.filter(func(F.nullif, attr("size"), 24).is_nil(False)), "part WHERE nullif(p_size, 24) IS NOT NULL")
simple("filter_contains", "Customer", CUST, lambda x: x.filter(attr("name").contains("99")), "customer WHERE contains(c_name, '99')")
simple("filter_ci_eq", "Customer", CUST, lambda x: x.filter(attr("segment") == "building"), "customer WHERE lower(c_mktsegment) = 'building'")
simple("filter_ci_in", "Customer", CUST, lambda x: x.filter(attr("segment").isin(["Building", "machinery"])), "customer WHERE lower(c_mktsegment) IN ('building', 'machinery')")
simple("filter_ci_contains", "Part", CUST, lambda x: x.filter(attr("brand").contains(ci("BRAND#1"))), "part WHERE contains(lower(p_brand), 'brand#1')")
simple("filter_and", "Order", ORD, lambda x: x.filter((attr("status") == "O") & (attr("total") > 200000)), "orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000")
simple("filter_or", "Order", ORD, lambda x: x.filter((attr("status") == "P") | (attr("total") > 300000)), "orders WHERE o_orderstatus = 'P' OR o_totalprice > 300000")
simple("filter_not", "Order", ORD, lambda x: x.filter(~(attr("status") == "O")), "orders WHERE NOT o_orderstatus = 'O'")
simple("filter_nested", "Order", ORD, lambda x: x.filter(~((attr("status") == "O") | (attr("total") < 100000)) & ((attr("priority") == "1-URGENT") | (attr("priority") == "5-LOW"))), "orders WHERE NOT (o_orderstatus = 'O' OR o_totalprice < 100000) AND (o_orderpriority = '1-URGENT' OR o_orderpriority = '5-LOW')")
simple("filter_fk_eq", "Order", ORD, lambda x: x.filter(attr("customer_id") == 7), "orders WHERE o_custkey = 7")
simple("filter_fk_in", "Order", ORD, lambda x: x.filter(attr("customer_id").isin([1, 2, 3, 5, 8, 13])), "orders WHERE o_custkey IN (1, 2, 3, 5, 8, 13)")
simple("filter_fk_multi", "LineItem", {"order_id": "order_id", "number": "number", "quantity": "quantity"}, lambda x: x.filter((attr("supplier_id") == 3) & (attr("part_id") < 200)), "lineitem WHERE l_suppkey = 3 AND l_partkey < 200")
simple("filter_calc", "Customer", CUST, lambda x: x.filter(calc("double_balance") > 15000), "customer WHERE c_acctbal * 2 > 15000")


@query("read_by_ids", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 350000)")
def _(g):
    ids = q(g, "Order").filter(attr("total") > 350000).df().select(F.col("customer_id").alias("id"))
    return q(g, "Customer").by_keys(ids).df().select("id", "name")


@query("read_limited", "SELECT CAST(least(10, count(*)) AS BIGINT) AS n FROM nation")
def _(g):
    return q(g, "Nation").limit(10).df().agg(F.count(F.lit(1)).alias("n"))


@query("raw_sql", "SELECT n_name AS name, CAST(count(*) AS BIGINT) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000 GROUP BY n_name")
def _(g):
    return g.sql("SELECT n_name AS name, count(*) AS n FROM Customer JOIN Nation ON c_nationkey = n_nationkey WHERE c_acctbal > :least GROUP BY n_name", least=9000)


@query("load_calc", "SELECT c_custkey AS id, c_acctbal * 2 AS double_balance, c_name || ' (' || c_mktsegment || ')' AS title, CAST(c_custkey AS VARCHAR) AS code FROM customer")
def _(g):
    return q(g, "Customer").calculate("double_balance", "title", code=attr("id").cast("string")).df().select("id", "double_balance", "title", "code")


@query("sort_calc", "SELECT c_custkey AS id, c_acctbal * 2 AS v FROM customer ORDER BY c_acctbal * 2 DESC, c_custkey LIMIT 25")
def _(g):
    return q(g, "Customer").sort((calc("double_balance"), "desc"), "id").limit(25).calculate(v=calc("double_balance")).df().select("id", "v")


@query("get_path_json", "SELECT event_id AS id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 50")
def _(g):
    k = func(lambda c: F.from_json(c, "k int"), attr("props")).get_path("k")
    return q(g, "Event").filter(k > 50).calculate(k=k).df().select("id", "k")


# traversals
R, FWD = "reverse", "forward"
simple("traverse_field_1hop", "Nation", CUST, lambda x: x.filter(traverse("region").field("name") == "EUROPE"), "nation WHERE EXISTS (SELECT 1 FROM region WHERE r_regionkey = n_regionkey AND r_name = 'EUROPE')")
simple("traverse_field_2hop", "Customer", CUST, lambda x: x.filter(traverse("orders", "items").field("quantity") >= 50), "customer WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey AND l_quantity >= 50)")
simple("traverse_field_3hop", "Order", ORD, lambda x: x.filter(traverse("customer", "nation", "region").field("name") == "ASIA"), "orders WHERE EXISTS (SELECT 1 FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE c_custkey = o_custkey AND r_name = 'ASIA')")
simple("traverse_through_joiner", "Part", CUST, lambda x: x.filter(traverse("items", "supplier").field("balance") < 500), "part WHERE EXISTS (SELECT 1 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_partkey = p_partkey AND s_acctbal < 500)")
simple("traverse_reverse_edge", "Customer", CUST, lambda x: x.filter(traverse((R, ("PLACED_BY",))).field("total") > 390000), "customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 390000)")
simple("traverse_typed", "Customer", CUST, lambda x: x.filter(traverse((R, ("PLACED_BY", "Order")), (R, ("PART_OF", "LineItem")), (FWD, ("OF_PART", "Part"))).field("size") == 50), "customer WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_custkey = c_custkey AND p_size = 50)")
simple("traverse_reverse_relation", "Region", CUST, lambda x: x.filter(traverse((R, ("IN_REGION", "Nation")), (FWD, "customers")).field("balance") > 9990), "region WHERE EXISTS (SELECT 1 FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey AND c_acctbal > 9990)")
simple("traverse_exists", "Document", ID, lambda x: x.filter(traverse("labels").exists()), "documents WHERE EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
simple("traverse_not_exists", "Order", ID, lambda x: x.filter(~traverse("items").exists()), "orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
simple("traverse_count_gt", "Order", ID, lambda x: x.filter(traverse("items", "part").count() > 6), "orders WHERE (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) > 6")
simple("traverse_count_zero", "Order", ID, lambda x: x.filter(traverse("items", "supplier").count() == 0), "orders WHERE (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) = 0")
simple("traverse_min", "Order", ID, lambda x: x.filter(traverse("items").min("quantity") > 30), "orders WHERE (SELECT min(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey) > 30")
simple("traverse_max", "Customer", ID, lambda x: x.filter(traverse("orders").max("total") <= 200000), "customer WHERE (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) <= 200000")
simple("traverse_avg", "Order", ID, lambda x: x.filter(traverse("items").avg("quantity") >= 40), "orders WHERE (SELECT avg(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey) >= 40")
simple("traverse_sum", "Order", ID, lambda x: x.filter(traverse("items").sum("quantity") > 200), "orders WHERE (SELECT sum(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey) > 200")
simple("traverse_sum_empty", "Order", ID, lambda x: x.filter(traverse("items").sum("quantity") < 3), "orders WHERE coalesce((SELECT sum(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey), 0) < 3")
simple("traverse_multi", "Customer", ID, lambda x: x.filter((traverse("nation", "region").field("name") == "AMERICA") & (traverse("orders").field("total") > 300000)), "customer WHERE EXISTS (SELECT 1 FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey = c_nationkey AND r_name = 'AMERICA') AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
simple("traverse_or", "Customer", ID, lambda x: x.filter((traverse("nation", "region").field("name") == "AFRICA") | (traverse("orders").count() > 15) | (attr("balance") < -900)), "customer WHERE EXISTS (SELECT 1 FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey = c_nationkey AND r_name = 'AFRICA') OR (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) > 15 OR c_acctbal < -900")
simple("traverse_not", "Customer", ID, lambda x: x.filter(~(traverse("orders").field("status") == "F")), "customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
simple("traverse_edge_unique", "Order", ID, lambda x: x.filter(traverse("customer", "orders").field("total") > 380000), "orders o1 WHERE EXISTS (SELECT 1 FROM orders o2 WHERE o2.o_custkey = o1.o_custkey AND o2.o_orderkey <> o1.o_orderkey AND o2.o_totalprice > 380000)")
simple("exists_rel_pred", "Customer", ID, lambda x: x.filter(exists("orders", (attr("status") == "O") & (attr("total") > 250000))), "customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O' AND o_totalprice > 250000)")
simple("not_exists_rel_pred", "Customer", ID, lambda x: x.filter(~exists("orders", attr("total") > 150000)), "customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)")
simple("self_relation", "Order", ID, lambda x: x.filter(traverse("next").field("status") == "P"), "orders o1 WHERE EXISTS (SELECT 1 FROM orders o2 WHERE o2.o_orderkey = o1.o_orderkey + 1 AND o2.o_orderstatus = 'P')")
simple("self_relation_2hop", "Order", ID, lambda x: x.filter(traverse("previous", "previous").field("total") > 350000), "orders o1 WHERE EXISTS (SELECT 1 FROM orders o2, orders o3 WHERE o2.o_orderkey = o1.o_orderkey - 1 AND o3.o_orderkey = o2.o_orderkey - 1 AND o3.o_totalprice > 350000)")


# aggregates
def agg(name: str, resource: str, aggs: list[A], sql: str, test=None, columns: dict | None = None) -> None:
    def run(g: Graph) -> DataFrame:
        x = q(g, resource)
        df = (x.filter(test) if test is not None else x).aggregate(*aggs).df()
        return df.select("id", *[(columns or {}).get(a.name, lambda c: c)(F.col(f"`{a.name}`")).alias(a.name) for a in aggs])

    query(name, sql)(run)


def money(c):
    return F.round(c, 2)


def joined(c):
    return F.array_join(F.transform(c, lambda v: v.cast("string")), ",")


C_O = "FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"
agg("agg_count", "Customer", [A("n", "count", ("orders",))], f"SELECT c_custkey AS id, CAST(count(o_orderkey) AS BIGINT) AS n {C_O}")
agg("agg_exists", "Order", [A("has", "exists", ("items",))], "SELECT o_orderkey AS id, count(l_orderkey) > 0 AS has FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
agg("agg_exists_question", "Order", [A("has_items?", "exists", ("items",))], 'SELECT o_orderkey AS id, count(l_orderkey) > 0 AS "has_items?" FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey')
agg("agg_sum", "Order", [A("v", "sum", ("items",), "quantity")], "SELECT o_orderkey AS id, round(coalesce(sum(l_quantity), 0), 2) AS v FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey", columns={"v": money})
agg("agg_avg", "Order", [A("v", "avg", ("items",), "quantity")], "SELECT o_orderkey AS id, round(avg(l_quantity), 2) AS v FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey", columns={"v": money})
agg("agg_min_max", "Customer", [A("lo", "min", ("orders",), "total"), A("hi", "max", ("orders",), "total")], f"SELECT c_custkey AS id, min(o_totalprice) AS lo, max(o_totalprice) AS hi {C_O}")
agg("agg_list", "Customer", [A("v", "list", ("orders",), "status")], f"SELECT c_custkey AS id, coalesce(string_agg(o_orderstatus, ',' ORDER BY o_orderkey), '') AS v {C_O}", columns={"v": joined})
agg("agg_list_uniq", "Customer", [A("v", "list", ("orders",), "priority", uniq=True)], f"SELECT c_custkey AS id, coalesce(string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority), '') AS v {C_O}", columns={"v": lambda c: joined(F.array_sort(c))})
agg("agg_first", "Customer", [A("v", "first", ("orders",), "priority")], f"SELECT c_custkey AS id, arg_min(o_orderpriority, o_orderkey) AS v {C_O}")
agg("agg_count_uniq", "Order", [A("n", "count", ("items", "part"), uniq=True)], "SELECT o_orderkey AS id, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
agg("agg_sum_uniq", "Order", [A("v", "sum", ("items",), "quantity", uniq=True)], "SELECT o_orderkey AS id, coalesce(sum(DISTINCT l_quantity), 0) AS v FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey", columns={"v": lambda c: c.cast("double")})
agg("agg_avg_uniq", "Order", [A("v", "avg", ("items",), "quantity", uniq=True)], "SELECT o_orderkey AS id, round(avg(DISTINCT l_quantity), 4) AS v FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey", columns={"v": lambda c: F.round(c, 4)})
agg("agg_multi_hop", "Customer", [A("n", "count", ("orders", "items"))], "SELECT c_custkey AS id, CAST(count(l_orderkey) AS BIGINT) AS n FROM customer LEFT JOIN (orders JOIN lineitem ON l_orderkey = o_orderkey) ON o_custkey = c_custkey GROUP BY c_custkey")
agg("agg_shared_path", "Customer", [A("n", "count", ("orders",)), A("open", "count", ("orders",), filter=attr("status") == "O"), A("top", "max", ("orders",), "total")], f"SELECT c_custkey AS id, CAST(count(o_orderkey) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS open, max(o_totalprice) AS top {C_O}")
agg("agg_filtered_eq", "Customer", [A("n", "count", ("orders",), filter=attr("status") == "F"), A("any", "exists", ("orders",), filter=attr("status") == "P")], f"SELECT c_custkey AS id, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') > 0 AS any {C_O}")
agg("agg_filtered_expr", "Customer", [A("n", "count", ("orders",), filter=(attr("total") > 200000) | (attr("priority") == "5-LOW"))], f"SELECT c_custkey AS id, CAST(count(*) FILTER (WHERE o_totalprice > 200000 OR o_orderpriority = '5-LOW') AS BIGINT) AS n {C_O}")
agg("agg_expr", "Order", [A("v", "sum", ("items",), expr=attr("price") * (1 - attr("discount")))], "SELECT o_orderkey AS id, round(sum(l_extendedprice * (1 - l_discount)), 5) AS v FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey", columns={"v": lambda c: F.round(c, 5)})
agg("agg_named", "Customer", [testgraph.RESOURCES[2].aggregates[0]], f"SELECT c_custkey AS id, CAST(count(o_orderkey) AS BIGINT) AS order_count {C_O}", test=attr("balance") > 0)
ORACLE_SQL["agg_named"] = "SELECT c_custkey AS id, CAST(count(o_orderkey) AS BIGINT) AS order_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY c_custkey"


@query("agg_json_field", "SELECT CAST(max(CAST(json_extract(props, '$.k') AS INTEGER)) AS INTEGER) AS hi, CAST(count(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS n FROM events WHERE event_type <> 'view'")
def _(g):
    k = func(lambda c: F.get_json_object(c, "$.k").cast("int"), attr("props"))
    return q(g, "Event").filter(attr("kind") != "view").total(A("hi", "max", expr=k), A("n", "count", filter=k.is_nil(False)))


@query("agg_total", "SELECT CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS v FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def _(g):
    return q(g, "Customer").filter(attr("balance") > 5000).total(A("n", "count", ("orders",)), A("v", "sum", ("orders",), "total")).select("n", money(F.col("v")).alias("v"))


@query("agg_total_filtered", "SELECT CAST(count(*) FILTER (WHERE l_quantity > 45) AS BIGINT) AS n, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500) JOIN lineitem ON l_orderkey = o_orderkey")
def _(g):
    return q(g, "Order").sort(("total", "desc"), "id").limit(500).total(A("n", "count", ("items",), filter=attr("quantity") > 45), A("parts", "count", ("items", "part"), uniq=True))


@query("agg_root", "SELECT CAST(count(*) AS BIGINT) AS n, min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(*) > 0 AS found FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(g):
    return q(g, "Customer").filter(attr("segment") == "BUILDING").total(A("n", "count"), A("lo", "min", field="balance"), A("hi", "max", field="balance"), A("found", "exists"))


@query("agg_root_empty", "SELECT count(*) > 0 AS found, CAST(count(*) AS BIGINT) AS n FROM customer WHERE c_custkey < 0")
def _(g):
    return q(g, "Customer").filter(attr("id") < 0).total(A("found", "exists"), A("n", "count"))


# sort, limit, offset
simple("sort_multi", "Order", ORD, lambda x: x.sort(("priority", "asc"), ("total", "desc"), "id").limit(50), "(SELECT * FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50)")
for _o, _sql in {"asc": "ASC NULLS LAST", "desc": "DESC NULLS FIRST", "asc_nulls_first": "ASC NULLS FIRST", "desc_nulls_last": "DESC NULLS LAST"}.items():
    simple(f"sort_nulls_{_o}", "Part", {"id": "id", "size": "size"}, lambda x, o=_o: x.sort((func(F.nullif, attr("size"), 24), o), "id").limit(60), f"(SELECT * FROM part ORDER BY nullif(p_size, 24) {_sql}, p_partkey LIMIT 60)")
simple("offset_limit", "Customer", CUST, lambda x: x.sort(("balance", "desc"), "id").offset(5).limit(20), "(SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 5)")
simple("latest_version", "Order", ORD, lambda x: x.filter(attr("customer_id") == 4).sort(("placed", "desc"), ("id", "desc")).limit(1), "(SELECT * FROM orders WHERE o_custkey = 4 ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)")
agg_sql = "SELECT id, CAST(count(l_orderkey) AS BIGINT) AS n FROM (SELECT o_orderkey AS id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30) LEFT JOIN lineitem ON l_orderkey = id GROUP BY id"


@query("limit_nodes", agg_sql)
def _(g):
    return q(g, "Order").sort(("total", "desc"), "id").limit(30).aggregate(A("n", "count", ("items",))).df().select("id", "n")


# combinations
def _branches(g):
    a = q(g, "Customer").filter(attr("segment") == "BUILDING")
    b = q(g, "Customer").filter(attr("balance") > 5000)
    c = q(g, "Customer").filter(traverse("nation", "region").field("name") == "EUROPE")
    return a, b, c


SA, SB = "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 5000"
SC = "SELECT c_custkey AS id, c_name AS name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'EUROPE'"
for _n, _kinds, _s in [("union", ["union"], f"{SA} UNION {SB}"), ("union_all", ["union_all"], f"{SA} UNION {SB}"), ("intersect", ["intersect"], f"{SA} INTERSECT {SB}"), ("except", ["except"], f"{SA} EXCEPT {SB}"), ("mixed", ["union", "except"], f"({SA} UNION {SB}) EXCEPT {SC}"), ("mixed_intersect", ["except", "intersect"], f"({SA} EXCEPT {SB}) INTERSECT {SC}")]:
    query(f"comb_{_n}", _s)(lambda g, kinds=_kinds: combine(("base", _branches(g)[0]), *zip(kinds, _branches(g)[1:])).select("id", "name"))


@query("comb_union_all_raw", f"{SA} UNION ALL {SB}")
def _(g):
    a, b, _ = _branches(g)
    return combine(("base", a), ("union_all", b), raw=True).select("id", "name")


@query("comb_outer_sort", f"SELECT id, name FROM ({SA} UNION {SB}) WHERE id <> 10 ORDER BY name DESC LIMIT 15 OFFSET 3")
def _(g):
    a, b, _ = _branches(g)
    return ordered(combine(("base", a), ("union", b)).where("id <> 10"), ("name", "desc"), offset=3, limit=15).select("id", "name")


# loads, projections, labels
@query("enrich_belongs_to", "SELECT o_orderkey AS id, c_custkey AS customer_id, c_name AS customer_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 300000")
def _(g):
    return q(g, "Order").filter(attr("total") > 300000).load("customer").df().select("id", F.col("customer.id").alias("customer_id"), F.col("customer.name").alias("customer_name"))


@query("enrich_has_one", "SELECT o1.o_orderkey AS id, o2.o_orderkey AS next_id, o2.o_totalprice AS next_total FROM orders o1 LEFT JOIN orders o2 ON o2.o_orderkey = o1.o_orderkey + 1")
def _(g):
    return q(g, "Order").load("next").df().select("id", F.col("next.id").alias("next_id"), F.col("next.total").alias("next_total"))


@query("load_many", f"SELECT c_custkey AS id, CAST(count(o_orderkey) AS BIGINT) AS n, coalesce(string_agg(o_orderpriority, ',' ORDER BY o_orderkey), '') AS priorities {C_O}")
def _(g):
    df = q(g, "Customer").load("orders").df()
    return df.select("id", F.size("orders").cast("long").alias("n"), F.array_join(F.transform("orders", lambda o: o["priority"]), ",").alias("priorities"))


@query("load_many_to_many", "SELECT p_partkey AS id, coalesce(string_agg(DISTINCT s_name, ',' ORDER BY s_name), '') AS suppliers FROM part LEFT JOIN (lineitem JOIN supplier ON s_suppkey = l_suppkey) ON l_partkey = p_partkey GROUP BY p_partkey")
def _(g):
    df = q(g, "Part").aggregate(A("names", "list", ("items", "supplier"), "name", uniq=True)).df()
    return df.select("id", F.array_join(F.array_sort("names"), ",").alias("suppliers"))


@query("projection_late_bound", "SELECT o_orderkey AS id, 'concrete' AS status, 'Customer' AS resource, c_name AS name FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'unknown', NULL, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 3 = 0")
def _(g):
    labels = F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit("Customer"))).otherwise(F.array(F.lit("Trade"), F.lit("Customer")))
    g.frames["Customer"] = g.frame("Customer").withColumn(LABELS, labels)
    df = q(g, "Order").project("who", ((FWD, "customer"),)).df()
    return df.select("id", F.col("who.status").alias("status"), F.col("who.resource").alias("resource"), F.get_json_object("who.record", "$.c_name").alias("name"))


@query("worlds", "SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'Trade/Customer' WHEN 1 THEN 'Trade/Supplier' WHEN 2 THEN '' ELSE 'Text/Page,Trade/Part' END AS worlds FROM customer")
def _(g):
    kinds = F.array(F.array(F.lit("Trade"), F.lit("Customer")), F.array(F.lit("Supplier"), F.lit("Trade"), F.lit("Other")), F.array(F.lit("Customer")), F.array(F.lit("Trade"), F.lit("Part"), F.lit("Text"), F.lit("Page")))
    found = g.worlds(F.get(kinds, (F.col("c_custkey") % 4).cast("int")))
    return g.frame("Customer").select(F.col("c_custkey").alias("id"), F.array_join(F.transform(found, lambda w: F.concat_ws("/", w["domain"], w["resource"])), ",").alias("worlds"))


# vectors
_V0 = "(SELECT list_transform(embedding, lambda e: CAST(e AS DOUBLE)) FROM embeddings WHERE vec_id = 0)"
_SIM = f"((1 + list_cosine_similarity(list_transform(embedding, lambda e: CAST(e AS DOUBLE)), {_V0})) / 2)"


def _vectors(g):
    v = q(g, "Embedding").filter(attr("id") == 0).df().select("vector").first()[0]
    return q(g, "Embedding"), func(lambda c: vector.vector_similarity(c, list(v)), attr("vector")), func(lambda c: vector.vector_cosine_distance(c, list(v)), attr("vector"))


@query("vector_similarity_filter", f"SELECT vec_id AS id, round({_SIM}, 4) AS sim FROM embeddings WHERE {_SIM} > 0.55")
def _(g):
    x, sim, _ = _vectors(g)
    return x.filter(sim > 0.55).calculate(sim=func(lambda c: F.round(c, 4), sim)).df().select("id", "sim")


@query("vector_distance_filter", f"SELECT vec_id AS id FROM embeddings WHERE 2 - 2 * {_SIM} <= 0.9")
def _(g):
    x, _, dist = _vectors(g)
    return x.filter(dist <= 0.9).df().select("id")


@query("vector_topk", f"SELECT vec_id AS id, round(2 - 2 * {_SIM}, 4) AS dist FROM embeddings ORDER BY round(2 - 2 * {_SIM}, 9), vec_id LIMIT 20")
def _(g):
    x, _, dist = _vectors(g)
    return x.sort((func(lambda c: F.round(c, 9), dist), "asc"), "id").limit(20).calculate(dist=func(lambda c: F.round(c, 4), dist)).df().select("id", "dist")


# places
_LNG, _LAT = "(-180.0::DOUBLE + ({k} * 7919 % 36000) / 100.0::DOUBLE)", "(-60.0::DOUBLE + ({k} * 104729 % 12000) / 100.0::DOUBLE)"


def hav(lng1, lat1, lng2, lat2):
    a = f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))"
    return f"(2 * 6378137.0::DOUBLE * atan2(sqrt({a}), sqrt(1 - {a})))"


_CX, _CY = _LNG.format(k="c_custkey"), _LAT.format(k="c_custkey")
_SX, _SY = _LNG.format(k="s_suppkey"), _LAT.format(k="s_suppkey")
_D = hav(_CX, _CY, "151.2093::DOUBLE", "(-33.8688::DOUBLE)")
_there = geo.geometry("Point", SYDNEY)


@query("geo_distance", f"SELECT c_custkey AS id, round({_D}, 3) AS meters FROM customer")
def _(g):
    d = func(lambda p: F.round(geo.st_distance(p, geo.literal(_there)), 3), calc("place"))
    return q(g, "Customer").calculate(meters=d).df().select("id", "meters")


@query("geo_distance_filter", f"SELECT c_custkey AS id FROM customer WHERE {_D} > 15000000")
def _(g):
    return q(g, "Customer").filter(func(lambda p: geo.st_distance_in_meters(p, geo.literal(_there)), calc("place")) > 15_000_000).df().select("id")


@query("geo_dwithin", f"SELECT c_custkey AS id FROM customer WHERE {_D} <= 2000000")
def _(g):
    return q(g, "Customer").filter(func(lambda x, y: geo.dwithin_xy(x, y, SYDNEY, 2_000_000), calc("lng"), calc("lat"))).df().select("id")


@query("geo_order_by_distance", f"SELECT c_custkey AS id, round({_D}, 3) AS meters FROM customer ORDER BY round({_D}, 6), c_custkey LIMIT 25")
def _(g):
    d = func(lambda x, y: geo.haversine(x, y, *SYDNEY), calc("lng"), calc("lat"))
    return q(g, "Customer").sort(func(lambda c: F.round(c, 6), d), "id").limit(25).calculate(meters=func(lambda c: F.round(c, 3), d)).df().select("id", "meters")


_H = "(c_custkey % 500)::DOUBLE"
_ARC = f"({_D} * (6378137.0::DOUBLE + ({_H} + 100.0) / 2) / 6378137.0::DOUBLE)"


@query("geo_distance_3d", f"SELECT c_custkey AS id, round(sqrt({_ARC} * {_ARC} + (100.0 - {_H}) * (100.0 - {_H})), 2) AS meters FROM customer")
def _(g):
    there = geo.literal(geo.geometry("Point", (*SYDNEY, 100.0)))
    d = func(lambda x, y, h: F.round(geo.st_distance(geo.point(x, y, h), there), 2), calc("lng"), calc("lat"), calc("height"))
    return q(g, "Customer").calculate(meters=d).df().select("id", "meters")


_SQUARE = geo.geometry("Polygon", [[(-100.005, -40.005), (80.005, -40.005), (80.005, 30.005), (-100.005, 30.005), (-100.005, -40.005)]])
_DONUT = geo.geometry("Polygon", [[(-100.005, -40.005), (80.005, -40.005), (80.005, 30.005), (-100.005, 30.005), (-100.005, -40.005)], [(-50.005, -20.005), (20.005, -20.005), (20.005, 10.005), (-50.005, 10.005), (-50.005, -20.005)]])
_IN = f"({_CX} > -100.005 AND {_CX} < 80.005 AND {_CY} > -40.005 AND {_CY} < 30.005)"
_HOLE = f"({_CX} > -50.005 AND {_CX} < 20.005 AND {_CY} > -20.005 AND {_CY} < 10.005)"
_place = calc("place")
simple("geo_contains_point", "Customer", ID, lambda x: x.filter(func(lambda p: geo.st_contains(geo.literal(_SQUARE), p), _place)), f"customer WHERE {_IN}")
simple("geo_contains_hole", "Customer", ID, lambda x: x.filter(func(lambda p: geo.st_contains(geo.literal(_DONUT), p), _place)), f"customer WHERE {_IN} AND NOT {_HOLE}")
simple("geo_within", "Customer", ID, lambda x: x.filter(func(lambda p: geo.st_within(p, geo.literal(_DONUT)), _place)), f"customer WHERE {_IN} AND NOT {_HOLE}")
simple("geo_not_contains", "Customer", ID, lambda x: x.filter(~func(lambda p: geo.st_contains(geo.literal(_DONUT), p), _place)), f"customer WHERE NOT ({_IN} AND NOT {_HOLE})")


def _box(lng, lat, half):
    """A square around a point, as a geometry column."""
    def p(dx, dy):
        return F.struct((lng + dx).alias("x"), (lat + dy).alias("y"), F.lit(None).cast("double").alias("z"))

    ring = F.array(p(-half, -half), p(half, -half), p(half, half), p(-half, half), p(-half, -half))
    return geo.of_kind(F.struct(F.lit("Polygon").alias("kind"), F.lit(4326).alias("srid"), F.array(F.array(ring)).alias("parts")), "Polygon")


def _box_test(test, area=None):
    return func(lambda x, y: test(geo.literal(area or _SQUARE), _box(x, y, 4.001)), calc("lng"), calc("lat"))


simple("geo_contains_polygon", "Customer", ID, lambda x: x.filter(_box_test(geo.st_contains)), f"customer WHERE {_CX} - 4.001 >= -100.005 AND {_CX} + 4.001 <= 80.005 AND {_CY} - 4.001 >= -40.005 AND {_CY} + 4.001 <= 30.005")
simple("geo_intersects", "Customer", ID, lambda x: x.filter(_box_test(geo.st_intersects)), f"customer WHERE {_CX} + 4.001 >= -100.005 AND {_CX} - 4.001 <= 80.005 AND {_CY} + 4.001 >= -40.005 AND {_CY} - 4.001 <= 30.005")



def _holds(west, south, east, north):
    """SQL: a box of half-width 4.001 around a customer lies in another."""
    return f"({_CX} - 4.001 >= {west} AND {_CX} + 4.001 <= {east} AND {_CY} - 4.001 >= {south} AND {_CY} + 4.001 <= {north})"


def _square(west, south, east, north):
    return [(west, south), (east, south), (east, north), (west, north), (west, south)]


_PARTS = geo.geometry("MultiPolygon", [[_square(-100.005, -40.005, -10.005, 30.005)], [_square(-10.005, -40.005, 80.005, 30.005)]])
_APART = f"({_CX} + 4.001 <= -50.005 OR {_CX} - 4.001 >= 20.005 OR {_CY} + 4.001 <= -20.005 OR {_CY} - 4.001 >= 10.005)"
simple("geo_contains_polygon_hole", "Customer", ID, lambda x: x.filter(_box_test(geo.st_contains, _DONUT)), f"customer WHERE {_holds(-100.005, -40.005, 80.005, 30.005)} AND {_APART}")
simple("geo_contains_polygon_parts", "Customer", ID, lambda x: x.filter(_box_test(geo.st_contains, _PARTS)), f"customer WHERE {_holds(-100.005, -40.005, -10.005, 30.005)} OR {_holds(-10.005, -40.005, 80.005, 30.005)}")


@query("geo_hole_is_not_contained", "SELECT * FROM (VALUES ('donut', 'hole', false), ('donut', 'ring', true), ('donut', 'within hole', false), ('donut', 'across hole', false), ('square', 'hole', true), ('square', 'square', true), ('parts', 'across parts', false), ('parts', 'point of either', true), ('nothing', 'hole', false)) t(area, other, held)")
def _(g):
    hole, ring = geo.geometry("Polygon", [_square(-50.005, -20.005, 20.005, 10.005)]), geo.geometry("Polygon", [_square(-100.005, -40.005, 80.005, 30.005), _square(-60.0, -30.0, 30.0, 20.0)])
    inner, across = (geo.geometry("Polygon", [_square(*x)]) for x in ((-40.0, -10.0, 0.0, 0.0), (-60.0, -30.0, 30.0, 20.0)))
    either = geo.geometry("MultiPoint", [(-50.0, 0.0), (50.0, 0.0)])
    cases = [("donut", "hole", _DONUT, hole), ("donut", "ring", _DONUT, ring), ("donut", "within hole", _DONUT, inner), ("donut", "across hole", _DONUT, across), ("square", "hole", _SQUARE, hole), ("square", "square", _SQUARE, _SQUARE), ("parts", "across parts", _PARTS, across), ("parts", "point of either", _PARTS, either), ("nothing", "hole", None, hole)]
    df = g.spark.createDataFrame(cases, f"area string, other string, a {geo.GEOMETRY_DDL}, b {geo.GEOMETRY_DDL}")
    return df.select("area", "other", geo.st_contains(F.col("a"), F.col("b")).alias("held"))


@query("geo_geojson", f"SELECT c_custkey AS id, {_CX} AS x, {_CY} AS y, 'Point' AS kind, {_CX} - 4.001 AS west FROM customer")
def _(g):
    text = func(lambda p: geo.geojson(p), calc("place"))
    box = func(lambda x, y: geo.geojson(_box(x, y, 4.001)), calc("lng"), calc("lat"))
    df = q(g, "Customer").calculate(text=text, box=box).df()
    p, b = geo.parse_geojson(F.col("text")), geo.parse_geojson(F.col("box"))
    return df.select("id", geo.vertex(p)["x"].alias("x"), geo.vertex(p)["y"].alias("y"), F.get_json_object("text", "$.type").alias("kind"), geo.box_columns(b)["west"].alias("west"))


@query("geo_force_2d", f"SELECT c_custkey AS id, {_CX} AS x, {_CY} AS y, NULL::DOUBLE AS z, 4326 AS srid FROM customer")
def _(g):
    flat = func(lambda x, y, h: geo.flat(geo.point(x, y, h)), calc("lng"), calc("lat"), calc("height"))
    df = q(g, "Customer").calculate(flat=flat).df()
    v = geo.vertex(F.col("flat"))
    return df.select("id", v["x"].alias("x"), v["y"].alias("y"), v["z"].alias("z"), F.col("flat.srid").alias("srid"))


@query("geo_nested_dwithin", f"SELECT c_custkey AS id FROM customer WHERE {_D} <= 2000000")
def _(g):
    spot = F.struct(geo.point(testgraph.lng(F.col("c_custkey")), testgraph.lat(F.col("c_custkey"))).alias("place"))
    r = g.resource("Customer")
    g.resources["Customer"] = replace(r, attributes=(*r.attributes, Attribute("spot", Struct((("place", Geometry(("Point",))),)), "spot")))
    g.frames["Customer"] = g.frame("Customer").withColumn("spot", spot)
    return q(g, "Customer").filter(func(lambda p: geo.st_dwithin(p, geo.literal(_there), 2_000_000), attr("spot").get_path("place"))).df().select("id")


@query("geo_nested_companions", f"SELECT c_custkey AS id, {_CX} AS x, {_CY} AS south FROM customer WHERE {_CX} BETWEEN 0 AND 90")
def _(g):
    spot = F.struct(geo.point(testgraph.lng(F.col("c_custkey")), testgraph.lat(F.col("c_custkey"))).alias("place"))
    df = spatial.with_companions(g.frame("Customer").withColumn("spot", spot), "spot.place")
    return df.where("spot_place_x between 0 and 90").select(F.col("c_custkey").alias("id"), F.col("spot_place_x").alias("x"), F.col("spot_place_south").alias("south"))


@query("geo_spatial_index", f"SELECT c_custkey AS id, 1 AS planned, 0 AS again, 1 AS dropped FROM customer WHERE {_CX} BETWEEN -20 AND 70 AND {_CY} BETWEEN -30 AND 30")
def _(g):
    path = commit.scratch(g.spark, "places")
    q(g, "Customer").calculate("place").df().select("id", "place").write.parquet(path)
    planned = spatial.create_index(g.spark, path, "place", 5.0, dry_run=True)
    spatial.create_index(g.spark, path, "place", 5.0)
    again, dropped = spatial.create_index(g.spark, path, "place", 5.0, dry_run=True), spatial.drop_index(g.spark, path, "place", dry_run=True)
    found = spatial.open_index(g.spark, path, "place").where("place_west between -20 and 70 and place_south between -30 and 30")
    return found.select("id", F.lit(len(planned)).alias("planned"), F.lit(len(again)).alias("again"), F.lit(len(dropped)).alias("dropped"))


@query("vector_index_exact", "SELECT vec_id AS id FROM embeddings ORDER BY round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)), 9) DESC, vec_id LIMIT 10")
def _(g):
    path = commit.scratch(g.spark, "vectors")
    g.frame("Embedding").write.parquet(path)
    first = g.frame("Embedding").orderBy("vec_id").first()["embedding"]
    vectors.create_index(g.spark, path, "embedding", "cosine", lists=16)
    near = vectors.search(g.spark, path, "embedding", first, 50, probes=None)
    return near.orderBy(F.round("distance", 9), "vec_id").limit(10).select(F.col("vec_id").alias("id"))


_LINE = geo.geometry("LineString", [(100.0, -33.0), (152.0, -33.0)])
_FX = f"least(152.0::DOUBLE, greatest(100.0::DOUBLE, {_CX}))"


@query("geo_linestring_distance", f"SELECT c_custkey AS id, round({hav(_CX, _CY, _FX, '(-33.0::DOUBLE)')}, 2) AS meters FROM customer")
def _(g):
    d = func(lambda p: F.round(geo.st_distance(geo.literal(_LINE), p), 2), _place)
    return q(g, "Customer").calculate(meters=d).df().select("id", "meters")


@query("geo_closest_point", f"SELECT c_custkey AS id, round({_FX}, 6) AS x, -33.0::DOUBLE AS y FROM customer")
def _(g):
    near = func(lambda p: geo.vertex(geo.st_closest_point(geo.literal(_LINE), p)), _place)
    return q(g, "Customer").calculate(x=func(lambda v: F.round(v["x"], 6), near), y=func(lambda v: F.round(v["y"], 6), near)).df().select("id", "x", "y")


_SD = hav(_SX, _SY, "151.2093::DOUBLE", "(-33.8688::DOUBLE)")
simple("geo_traverse_dwithin", "Customer", ID, lambda x: x.filter(traverse("orders", "items", "supplier").where(func(lambda a, b: geo.dwithin_xy(a, b, SYDNEY, 2_500_000), calc("lng"), calc("lat")))), f"customer WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE o_custkey = c_custkey AND {_SD} <= 2500000)")
simple("geo_traverse_distance", "Order", ID, lambda x: x.filter(traverse("customer").where(func(lambda p: geo.st_distance(p, geo.literal(_there)), _place) < 1_500_000)), f"orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND {_D} < 1500000)")
simple("geo_traverse_contains", "Order", ID, lambda x: x.filter(traverse("customer").where(func(lambda p: geo.st_contains(geo.literal(_DONUT), p), _place))), f"orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND {_IN} AND NOT {_HOLE})")


@query("geo_set_difference", f"SELECT c_custkey AS id FROM customer WHERE {_IN} AND NOT {_HOLE}")
def _(g):
    hole = geo.geometry("Polygon", [[(p["x"], p["y"]) for p in _DONUT["parts"][0][1]]])
    return combine(("base", q(g, "Customer").filter(func(lambda p: geo.st_contains(geo.literal(_SQUARE), p), _place))), ("except", q(g, "Customer").filter(func(lambda p: geo.st_contains(geo.literal(hole), p), _place)))).select("id")


_OUT = f"({_CX} > {_SX} - 5 AND {_CX} < {_SX} + 5 AND {_CY} > {_SY} - 5 AND {_CY} < {_SY} + 5)"
_INNER = f"({_CX} > {_SX} - 1.25 AND {_CX} < {_SX} + 1.25 AND {_CY} > {_SY} - 1.25 AND {_CY} < {_SY} + 1.25)"


@query("geo_points_in_areas", f"SELECT c_custkey AS customer, s_suppkey AS supplier FROM customer, supplier WHERE {_OUT.replace('5 ', '5.0003 ').replace('5)', '5.0003)')} AND NOT {_INNER.replace('1.25', '1.2503')}")
def _(g):
    points = q(g, "Customer").calculate("lng", "lat").df().select(F.col("id").alias("customer"), "lng", "lat")
    x, y = F.col("lng"), F.col("lat")

    def ring(half):
        return F.flatten(F.flatten(_box(x, y, half)["parts"]))

    area = F.struct(F.lit("Polygon").alias("kind"), F.lit(4326).alias("srid"), F.array(F.array(ring(5.0003), ring(1.2503))).alias("parts"))
    areas = q(g, "Supplier").calculate("lng", "lat").df().select(F.col("id").alias("supplier"), area.alias("area"))
    return spatial.points_in_areas(points, areas, "lng", "lat", "area", 10.0).select("customer", "supplier")


_GRID = ("151 + 0.03 * (i % 100)", "-33 + 0.03 * (i // 100)")


@query(
    "geo_grid_containment",
    f"""WITH a AS (SELECT i AS area, ({_GRID[0]})::DOUBLE AS cx, ({_GRID[1]})::DOUBLE AS cy FROM range(10000) t(i)),
p AS (SELECT i AS point, ({_GRID[0]})::DOUBLE + (i * 7919 % 260 - 129.5)::DOUBLE / 10000 AS x, ({_GRID[1]})::DOUBLE + (i * 104729 % 260 - 129.5)::DOUBLE / 10000 AS y FROM range(10000) t(i))
SELECT point, area FROM p JOIN a ON x > cx - 0.01 AND x < cx + 0.01 AND y > cy - 0.01 AND y < cy + 0.01 WHERE NOT (abs(x - cx) < 0.0025 AND abs(y - cy) < 0.0025)""",
)
def _(g):
    """10,000 points against 10,000 squares with holes, in one join."""
    i = F.col("id")
    cx, cy = F.lit(151.0) + F.lit(0.03) * (i % 100), F.lit(-33.0) + F.lit(0.03) * F.floor(i / 100)
    points = g.spark.range(10_000).select(i.alias("point"), (cx + (i * 7919 % 260 - 129.5) / 10000).alias("x"), (cy + (i * 104729 % 260 - 129.5) / 10000).alias("y"))

    def ring(half):
        return F.flatten(F.flatten(_box(cx, cy, half)["parts"]))

    donut = F.struct(F.lit("Polygon").alias("kind"), F.lit(4326).alias("srid"), F.array(F.array(ring(0.01), ring(0.0025))).alias("parts"))
    return spatial.points_in_areas(points, g.spark.range(10_000).select(i.alias("area"), donut.alias("shape")), "x", "y", "shape", 0.02).select("point", "area")


@query("geo_near_pairs", f"SELECT c_custkey AS customer, s_suppkey AS supplier FROM customer, supplier WHERE {hav(_CX, _CY, _SX, _SY)} <= 150000")
def _(g):
    left = q(g, "Customer").calculate("lng", "lat").df().select(F.col("id").alias("customer"), "lng", "lat")
    right = q(g, "Supplier").calculate(x=calc("lng"), y=calc("lat")).df().select(F.col("id").alias("supplier"), "x", "y")
    return spatial.near_pairs(left, right, ("lng", "x"), ("lat", "y"), 150_000).select("customer", "supplier")


# changes
def _snapshot(g, *names):
    nodes = {n: g.frame(n).withColumn(LABELS, F.array(*[F.lit(x) for x in g.resource(n).labels])) for n in names}
    orders = g.frame("Order")
    edges = {("PLACED_BY", "Order", "Customer"): orders.select(F.col("o_orderkey").cast("string").alias("src"), F.col("o_custkey").cast("string").alias("dst"))} if {"Order", "Customer"} <= set(names) else {}
    return mutate.Snapshot(g.spark, {r.name: r for r in testgraph.RESOURCES}, nodes, edges)


def _customers(s):
    return s.node("Customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))


_ALL = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"
_NEW = {"id": 900001, "name": "New", "balance": 1.5}


@query("mut_create", f"{_ALL} UNION ALL SELECT 900001, 'New', 1.5")
def _(g):
    return _customers(_snapshot(g, "Customer").create("Customer", _NEW))


@query("mut_merge", f"{_ALL} UNION ALL SELECT 900001, 'New', 1.5")
def _(g):
    s = _snapshot(g, "Customer").merge("Customer", _NEW)
    return _customers(s.merge("Customer", _NEW).merge("Customer", {"id": 1}))


@query("mut_update", "SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END AS balance FROM customer")
def _(g):
    return _customers(_snapshot(g, "Customer").update("Customer", {"segment": "BUILDING"}, {"balance": 0.0}, remove=("name",)))


@query("mut_update_labels", "SELECT c_custkey AS id, CASE WHEN c_nationkey = 3 THEN 'Customer,Vip' ELSE 'Customer,Trade' END AS labels FROM customer")
def _(g):
    s = _snapshot(g, "Customer").update_labels("Customer", {"nation_id": 3}, add=("Vip",), remove=("Trade",))
    return s.node("Customer").select(F.col("c_custkey").alias("id"), F.array_join(F.array_sort(LABELS), ",").alias("labels"))


@query("mut_upsert", f"SELECT id, name, CASE WHEN id = 5 THEN 77.0 ELSE balance END AS balance FROM ({_ALL}) UNION ALL SELECT 900001, 'New', 1.5")
def _(g):
    s = _snapshot(g, "Customer").upsert("Customer", {"id": 5, "balance": 77.0}, ("id",)).upsert("Customer", {**_NEW, "balance": 9.0}, ("id",))
    return _customers(s.upsert("Customer", _NEW, ("id",)))


@query("mut_upsert_bulk", "SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'again' ELSE c_name END AS name FROM customer UNION ALL SELECT c_custkey + 800000, 'again' FROM customer WHERE c_custkey % 10 = 0")
def _(g):
    """Nodes are told apart by their origin and id: what is new comes from elsewhere, and is new even where its id is taken."""
    own, other = F.lit("own").alias("origin"), F.lit("other").alias("origin")
    some = g.frame("Customer").where("c_custkey % 10 = 0").select("c_custkey", F.lit("again").alias("c_name"), own)
    more = some.unionByName(some.withColumns({"c_custkey": F.col("c_custkey") + 800000, "origin": other}))
    s = _snapshot(g, "Customer")
    r = s.resources["Customer"]
    s = replace(s, resources={**s.resources, "Customer": replace(r, attributes=(*r.attributes, Attribute("origin", "string", "origin")))}, nodes={"Customer": s.node("Customer").withColumn("origin", own)})
    return _customers(s.upsert_all("Customer", more, ("origin", "id"))).select("id", "name")


@query("mut_delete", "SELECT (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE c_mktsegment <> 'BUILDING') AS nodes, (SELECT CAST(count(*) AS BIGINT) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'BUILDING') AS edges")
def _(g):
    s = _snapshot(g, "Customer", "Order").delete("Customer", {"segment": "BUILDING"})
    n = s.node("Customer").agg(F.count(F.lit(1)).alias("nodes"))
    return n.join(s.edge(("PLACED_BY", "Order", "Customer")).agg(F.count(F.lit(1)).alias("edges")))


@query("mut_delete_guarded", "SELECT c_custkey AS id FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 380000) OR c_nationkey <> 7")
def _(g):
    s = _snapshot(g, "Customer", "Order")
    big = g.frame("Order").where("o_totalprice > 380000").select(F.col("o_orderkey").cast("string").alias("src"), F.col("o_custkey").cast("string").alias("dst"))
    r = replace(s.resources["Customer"], guards=(Guard("PLACED_BY", "in", "Order"),))
    s = replace(s, resources={**s.resources, "Customer": r}, edges={("PLACED_BY", "Order", "Customer"): big})
    return s.delete_guarded("Customer", {"nation_id": 7}).node("Customer").select(F.col("c_custkey").alias("id"))


_E = ("PLACED_BY", "Order", "Customer")


@query("mut_relate", "SELECT CAST(o_orderkey AS VARCHAR) AS src, CAST(o_custkey AS VARCHAR) AS dst FROM orders UNION SELECT '1', '2' UNION SELECT '1', '3'")
def _(g):
    s = _snapshot(g, "Customer", "Order")
    for k in (2, 3, 2):
        s = s.relate(_E, {"id": 1}, {"id": k})
    return s.edge(_E)


@query("mut_relate_exclusive", "SELECT CAST(o_orderkey AS VARCHAR) AS src, CASE WHEN o_orderkey <= 100 THEN '5' ELSE CAST(o_custkey AS VARCHAR) END AS dst FROM orders")
def _(g):
    pairs = g.frame("Order").where("o_orderkey <= 100").select(F.col("o_orderkey").alias("src"), F.lit(5).alias("dst"))
    return _snapshot(g, "Customer", "Order").relate_all(_E, pairs, source_exclusive=True).edge(_E)


@query("mut_relate_both_exclusive", "SELECT CAST(o_orderkey AS VARCHAR) AS src, CAST(o_custkey AS VARCHAR) AS dst FROM orders WHERE o_orderkey <> 1 AND o_custkey <> 2 UNION ALL SELECT '1', '2'")
def _(g):
    return _snapshot(g, "Customer", "Order").relate(_E, {"id": 1}, {"id": 2}, True, True).edge(_E)


@query("mut_unrelate", "SELECT CAST(o_orderkey AS VARCHAR) AS src, CAST(o_custkey AS VARCHAR) AS dst FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_custkey = 4)")
def _(g):
    return _snapshot(g, "Customer", "Order").unrelate(_E, {"priority": "1-URGENT"}, {"id": 4}).edge(_E)


@query("mut_delete_all", "SELECT 0::BIGINT AS nodes, 0::BIGINT AS edges")
def _(g):
    s = _snapshot(g, "Customer", "Order").delete_all()
    return s.node("Customer").agg(F.count(F.lit(1)).alias("nodes")).join(s.edge(_E).agg(F.count(F.lit(1)).alias("edges")))


@query("mut_relate_destination_exclusive", "SELECT CAST(o_orderkey AS VARCHAR) AS src, CAST(o_custkey AS VARCHAR) AS dst FROM orders WHERE o_custkey > 20 UNION ALL SELECT CAST(1000000 + c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey <= 20")
def _(g):
    pairs = g.frame("Customer").where("c_custkey <= 20").select((F.col("c_custkey") + 1000000).alias("src"), F.col("c_custkey").alias("dst"))
    return _snapshot(g, "Customer", "Order").relate_all(_E, pairs, destination_exclusive=True).edge(_E)


@query("mut_relate_each", "SELECT CAST(o_orderkey AS VARCHAR) AS src, CASE o_orderkey WHEN 1 THEN '7' WHEN 2 THEN '8' ELSE CAST(o_custkey AS VARCHAR) END AS dst FROM orders")
def _(g):
    return _snapshot(g, "Customer", "Order").relate_each([(_E, {"id": 1}, {"id": 5}), (_E, {"id": 2}, {"id": 8}), (_E, {"id": 1}, {"id": 7})]).edge(_E)


@query("mut_manage", "SELECT o_orderkey AS id, CASE WHEN o_orderkey = 1 THEN 9 ELSE o_custkey END AS customer, CASE WHEN o_orderkey = 1 THEN '9' ELSE CAST(o_custkey AS VARCHAR) END AS dst FROM orders")
def _(g):
    s = _snapshot(g, "Customer", "Order").manage("Order", {"id": 1}, "customer", "append_and_remove", [{"id": 9}])
    return s.node("Order").join(s.edge(_E), F.col("src") == F.col("o_orderkey").cast("string")).select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), "dst")


@query("mut_manage_reverse", "SELECT CAST(o_orderkey AS VARCHAR) AS src, CASE WHEN o_orderkey IN (1, 2) THEN '3' ELSE CAST(o_custkey AS VARCHAR) END AS dst FROM orders WHERE o_orderkey IN (1, 2) OR o_custkey <> 3")
def _(g):
    return _snapshot(g, "Customer", "Order").manage("Customer", {"id": 3}, "orders", "append_and_remove", [{"id": 1}, {"id": 2}]).edge(_E)


@query("mut_transaction", "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey = 2 THEN 2.0 ELSE c_acctbal END AS balance, 'Rollback,PythonException' AS errors FROM customer")
def _(g):
    found = []

    def nested(s):
        s, error = s.update("Customer", {"id": 1}, {"balance": 1.0}).transaction(lambda t: mutate.rollback("enough"))
        found.append(type(error).__name__)
        return s

    def fails_when_run(s):
        divide = F.udf(lambda x: 1 // (x - x), "long")
        return replace(s, nodes={"Customer": s.node("Customer").withColumn("c_custkey", divide("c_custkey"))})

    s = _snapshot(g, "Customer")
    inner, _ = s.transaction(lambda t: nested(t).update("Customer", {"id": 1}, {"balance": 0.0}))
    assert inner is not s
    after, error = s.update("Customer", {"id": 2}, {"balance": 2.0}).transaction(fails_when_run)
    found.append(type(error).__name__)
    return _customers(after).withColumn("errors", F.lit(",".join(found)))


@query("mut_geo_write_checks", "SELECT * FROM (VALUES ('point in 2D', 'ok'), ('tall point in 2D', 'GeoDimensionMismatch'), ('flat point in 3D', 'GeoDimensionMismatch'), ('tall line in 3D', 'Unsupported3DGeometry'), ('nothing', 'ok')) t(given, said)")
def _(g):
    tall, flat = geo.geometry("Point", (1, 2, 3)), geo.geometry("Point", (1, 2))
    cases = [("point in 2D", flat, 2), ("tall point in 2D", tall, 2), ("flat point in 3D", flat, 3), ("tall line in 3D", geo.geometry("LineString", [(1, 2, 3), (2, 3, 4)]), 3), ("nothing", None, 2)]
    out = []
    for name, value, dimensions in cases:
        r = Resource("Spot", (Attribute("id", "string"), Attribute("place", Geometry(dimensions=dimensions))))
        try:
            mutate.Snapshot(g.spark, {"Spot": r}).create("Spot", {"id": "1", "place": value})
            out.append((name, "ok"))
        except MeshError as error:
            out.append((name, type(error).__name__))
    return g.spark.createDataFrame(out, "given string, said string")


@query("traverse_errors", "SELECT * FROM (VALUES ('no hops', 'empty_chain'), ('no such hop', 'unresolved_hop'), ('no such node', 'unresolved_reached'), ('no such property', 'unmapped_property')) t(given, reason)")
def _(g):
    cases = {"no hops": lambda: traverse().field("x") == 1, "no such hop": lambda: traverse("nowhere").field("x") == 1, "no such node": lambda: traverse((FWD, ("PLACED_BY", "Nobody"))).field("x") == 1, "no such property": lambda: traverse("orders").field("nothing") == 1}
    out = []
    for name, test in cases.items():
        try:
            q(g, "Customer").filter(test()).df()
            out.append((name, "none"))
        except MeshError as error:
            out.append((name, error.reason))
    return g.spark.createDataFrame(out, "given string, reason string")


# reading in types, related records, paths
@query("read_typed", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS total, CASE WHEN o_orderkey % 7 = 0 THEN 'total' ELSE '' END AS errors FROM orders")
def _(g):
    g.frames["Order"] = g.frame("Order").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")))
    return q(g, "Order").cast().df().select("id", "total", F.array_join("_errors", ",").alias("errors"))


@query("read_metadata", "SELECT c_custkey AS id, 'Trade,Customer' AS labels FROM customer")
def _(g):
    return q(g, "Customer").metadata().df().select("id", F.array_join("_labels", ",").alias("labels"))


@query("read_map_translation", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_nationkey = 3 AND c_mktsegment = 'BUILDING'")
def _(g):
    wanted = g.resource("Customer").stored_map({"nation_id": 3, "segment": "BUILDING"})
    df = g.frame("Customer")
    for k, v in wanted.items():
        df = df.where(F.col(k) == v)
    return df.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@query("load_records_many_to_many", "WITH d AS (SELECT DISTINCT l_partkey, s_suppkey, s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) SELECT p_partkey AS id, coalesce(string_agg(s_suppkey || ':' || s_name, ',' ORDER BY s_suppkey), '') AS suppliers FROM part LEFT JOIN d ON l_partkey = p_partkey GROUP BY p_partkey")
def _(g):
    df = q(g, "Part").load_along("suppliers", "items", "supplier").df()
    return df.select("id", F.array_join(F.transform("suppliers", lambda s: F.concat_ws(":", s["id"], s["name"])), ",").alias("suppliers"))


@query("load_records_filtered", "WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders WHERE o_totalprice > 150000) SELECT c_custkey AS id, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey), '') AS orders FROM customer LEFT JOIN o ON o_custkey = c_custkey AND r <= 2 GROUP BY c_custkey")
def _(g):
    df = q(g, "Customer").load_along("big", "orders", where=attr("total") > 150000, limit=2).df()
    return df.select("id", F.array_join(F.transform("big", lambda o: o["id"].cast("string")), ",").alias("orders"))


@query("load_records_pair_edge", "SELECT o1.o_orderkey AS id, coalesce(CAST(o3.o_orderkey AS VARCHAR) || ':' || o3.o_orderstatus, '') AS later FROM orders o1 LEFT JOIN (orders o2 JOIN orders o3 ON o3.o_orderkey = o2.o_orderkey + 1) ON o2.o_orderkey = o1.o_orderkey + 1")
def _(g):
    df = q(g, "Order").load_along("later", "next", "next").df()
    return df.select("id", F.array_join(F.transform("later", lambda o: F.concat_ws(":", o["id"], o["status"])), ",").alias("later"))


@query("load_all_related", "SELECT n_nationkey AS id, r_name AS region, (SELECT CAST(count(*) AS INTEGER) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation JOIN region ON r_regionkey = n_regionkey")
def _(g):
    return q(g, "Nation").load_all().df().select("id", F.col("region.name").alias("region"), F.size("customers").alias("customers"))


@query("agg_json_field_related", "SELECT c_custkey AS id, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS most FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey")
def _(g):
    r = g.resource("Customer")
    g.resources["Customer"] = replace(r, relationships=(*r.relationships, Relationship("events", "Event", "many", "DONE_BY", "in")))
    g.key_edge("DONE_BY", "Event", "Customer", "user_id")
    k = func(lambda c: F.from_json(c, "k bigint"), attr("props")).get_path("k")
    return q(g, "Customer").aggregate(A("k", "sum", ("events",), expr=k), A("most", "max", ("events",), expr=k)).df().select("id", "k", "most")


@query("read_geometry", f"SELECT c_custkey AS id, {_CX} AS x, {_CY} AS y, 'Point' AS kind FROM customer")
def _(g):
    r = g.resource("Customer")
    g.resources["Customer"] = replace(r, attributes=(*r.attributes, Attribute("spot", Geometry(("Point",)), "spot")))
    g.frames["Customer"] = g.frame("Customer").withColumn("spot", geo.point(testgraph.lng(F.col("c_custkey")), testgraph.lat(F.col("c_custkey"))))
    v = geo.vertex(F.col("spot"))
    return q(g, "Customer").df().select("id", v["x"].alias("x"), v["y"].alias("y"), F.col("spot.kind").alias("kind"))


@query("related_pairs", "SELECT c_custkey AS source, o_orderkey AS id, o_orderstatus AS status FROM customer LEFT JOIN orders ON o_custkey = c_custkey UNION ALL SELECT 900001, NULL, NULL")
def _(g):
    ids = g.frame("Customer").select("c_custkey").union(g.spark.createDataFrame([(900001,)], "c_custkey long"))
    return related_pairs(g, "Customer", ids, ((FWD, "orders"),)).select("source", F.col("node.id").alias("id"), F.col("node.status").alias("status"))


@query("path_exists", "SELECT c_custkey AS customer, EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey AND l_suppkey = 3) AS connected FROM customer WHERE c_custkey IN (1, 2, 4, 5)")
def _(g):
    hops = ((R, ("PLACED_BY",)), (R, ("PART_OF",)), (FWD, ("SUPPLIED_BY",)))
    found = [(k, connected(g, "Customer", {"id": k}, hops, "Supplier", {"id": 3})) for k in (1, 2, 4, 5)]
    return g.spark.createDataFrame(found, "customer long, connected boolean")


def _across(g):
    """Documents are about customers, of another domain."""
    about = g.frame("Document").select(F.col("doc_id").alias("src"), (F.col("doc_id") % 97 + 1).alias("dst"))
    for name, rel in (("Document", Relationship("customer", "Customer", "one", "ABOUT", "out")), ("Customer", Relationship("documents", "Document", "many", "ABOUT", "in"))):
        g.resources[name] = replace(g.resource(name), relationships=(*g.resource(name).relationships, rel))
    return g.pair_edge("ABOUT", "Document", "Customer", about)


@query("cross_domain_filter", "SELECT doc_id AS id FROM documents WHERE EXISTS (SELECT 1 FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey = doc_id % 97 + 1 AND n_name < 'NATION_2')")
def _(g):
    return q(_across(g), "Document").filter(traverse("customer", "nation").field("name") < "NATION_2").df().select("id")


@query("cross_domain_aggregate", "SELECT c_custkey AS id, CAST(count(doc_id) AS BIGINT) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM customer LEFT JOIN documents ON doc_id % 97 + 1 = c_custkey GROUP BY c_custkey")
def _(g):
    df = q(_across(g), "Customer").aggregate(A("n", "count", ("documents",)), A("chars", "sum", ("documents",), "n_chars")).df()
    return df.select("id", "n", F.nullif("chars", F.when(F.col("n") == 0, F.lit(0))).cast("long").alias("chars"))


# values that other stores keep as text or bytes
@query("codec_json", """SELECT c_custkey AS id, '{"balance":' || c_acctbal || ',"name":"' || c_name || '"}' AS text FROM customer""")
def _(g):
    df = q(g, "Customer").df().withColumn("v", F.struct("name", "balance", F.lit(None).cast("string").alias("absent")))
    return df.select("id", codec.json_column(F.col("v"), df.schema["v"].dataType).alias("text"))


@query("codec_base64", "SELECT c_custkey AS id, to_base64(c_name::BLOB) AS text, replace(replace(to_base64(c_name::BLOB), '+', '-'), '/', '_') AS url, c_name AS back FROM customer")
def _(g):
    df, data = q(g, "Customer").df(), F.col("name").cast("binary")
    return df.select("id", codec.base64_column(data).alias("text"), codec.base64_column(data, url=True).alias("url"), codec.unbase64_column(codec.base64_column(data, url=True), url=True).cast("string").alias("back"))


@query("codec_nested_arrays", "SELECT c_custkey AS id, '[1,' || c_custkey || ']' AS first, '[]' AS second, c_custkey AS back FROM customer")
def _(g):
    nested = F.array(F.array(F.lit(1).cast("long"), F.col("id")), F.array().cast("array<bigint>"))
    df = q(g, "Customer").df().withColumn("texts", codec.nested_column(nested))
    back = codec.unnested_column(F.col("texts"), "array<bigint>")
    return df.select("id", F.get("texts", F.lit(0)).alias("first"), F.get("texts", F.lit(1)).alias("second"), F.get(F.get(back, F.lit(0)), F.lit(1)).alias("back"))


@query("codec_tensor", "SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) || ',2,3,4' AS flat, 16 AS bytes FROM customer")
def _(g):
    nested = F.array(F.array(F.col("id"), F.lit(2).cast("long")), F.array(F.lit(3).cast("long"), F.lit(4).cast("long")))
    flat = codec.tensor_column(nested, TensorOf((2, 2), "s64"))
    packed = codec.tensor_column(nested, TensorOf((2, 2), "f32", packed=True))
    return q(g, "Customer").df().select("id", F.array_join(flat.cast("array<string>"), ",").alias("flat"), F.octet_length(packed).alias("bytes"))


@query("naming", "SELECT * FROM (VALUES ('order_items', 'orderItems', 'ORDER_ITEMS'), ('id', 'id', 'ID')) t(name, camel, macro)")
def _(g):
    from .functions import naming

    return g.spark.createDataFrame([(n, naming.camel(n), naming.macro(n)) for n in ("order_items", "id")], "name string, camel string, macro string")


# extensions: what Spark offers beside the graph
@query("ext_top_orders_per_customer", "SELECT o_custkey AS customer, o_orderkey AS id, CAST(r AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def _(g):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return g.frame("Order").withColumn("place", F.row_number().over(w)).where("place <= 3").select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("id"), "place")


@query("ext_event_windows", "SELECT date_trunc('hour', ts) AS start, event_type AS kind, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL")
def _(g):
    return windows.tumbling(g.frame("Event"), "ts", "1 hour", ["event_type"]).select("start", F.col("event_type").alias("kind"), "n")


@query("ext_cube", "SELECT o_orderstatus AS status, o_orderpriority AS priority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def _(g):
    return g.frame("Order").cube(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
