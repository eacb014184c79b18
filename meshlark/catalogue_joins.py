"""Registered queries on partial results along chains, joins by time, interval and place, and chains of any length, each
with the SQL that says the same."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .catalogue import _CX, _CY, _SX, _SY, _customers, _snapshot, hav, money, q, query
from . import testgraph
from .errors import UpsertConflict
from .functions import sketches
from .operators import mutate
from .operators.asof import as_of
from .operators.depth import edges_of, hops_from
from .operators.intervals import overlapping
from .operators.nearest import nearest
from .operators.spatial import areas_meeting
from .plans.expr import attr, traverse
from .schema import Aggregate as A
from .schema import Struct
from .sources import changes, commit
from .sources.delta import Change, Store

# partial results along chains
PER_NATION = "SELECT c_nationkey AS nation, count(*) AS n, sum(l_quantity) AS quantity, avg(l_discount) AS discount, min(l_extendedprice) AS low, max(o_totalprice) AS top FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_nationkey"


@query("agg_four_hops", f"SELECT s_suppkey AS id, CAST(coalesce(n, 0) AS BIGINT) AS n, round(coalesce(quantity, 0), 2) AS quantity, round(discount, 6) AS discount, low, coalesce(n, 0) > 0 AS has FROM supplier LEFT JOIN ({PER_NATION}) ON nation = s_nationkey")
def _(g):
    path = ("nation", "customers", "orders", "items")
    aggs = A("n", "count", path), A("quantity", "sum", path, "quantity"), A("discount", "avg", path, "discount"), A("low", "min", path, "price"), A("has", "exists", path)
    df = q(g, "Supplier").aggregate(*aggs).df()
    return df.select("id", "n", money(F.col("quantity")).alias("quantity"), F.round("discount", 6).alias("discount"), "low", "has")


@query(
    "agg_distinct_four_hops",
    "SELECT n_nationkey AS id, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers, CAST(count(DISTINCT CASE WHEN p_size > 40 THEN l_partkey END) AS BIGINT) AS large, CAST(count(l_partkey) AS BIGINT) AS paths "
    "FROM nation LEFT JOIN (customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey) ON c_nationkey = n_nationkey GROUP BY n_nationkey",
)
def _(g):
    parts, suppliers = ("customers", "orders", "items", "part"), ("customers", "orders", "items", "supplier")
    aggs = A("parts", "count", parts, uniq=True), A("suppliers", "count", suppliers, uniq=True), A("large", "count", parts, filter=attr("size") > 40, uniq=True), A("paths", "count", parts)
    return q(g, "Nation").aggregate(*aggs).df().select("id", "parts", "suppliers", "large", "paths")


@query("agg_total_four_hops", f"SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(quantity), 2) AS quantity, min(low) AS low, round(sum(n * discount) / sum(n), 6) AS discount FROM supplier JOIN ({PER_NATION}) ON nation = s_nationkey WHERE s_acctbal > 0")
def _(g):
    path = ("nation", "customers", "orders", "items")
    df = q(g, "Supplier").filter(attr("balance") > 0).total(A("n", "count", path), A("quantity", "sum", path, "quantity"), A("low", "min", path, "price"), A("discount", "avg", path, "discount"))
    return df.select("n", money(F.col("quantity")).alias("quantity"), "low", F.round("discount", 6).alias("discount"))


@query("traverse_count_four_hops", "SELECT s_suppkey AS id FROM supplier WHERE (SELECT count(DISTINCT l_partkey) FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_nationkey = s_nationkey) > 100 AND (SELECT avg(o_totalprice) FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = s_nationkey) > 100000")
def _(g):
    return q(g, "Supplier").filter(traverse("nation", "customers", "orders", "items", "part").count() > 100, traverse("nation", "customers", "orders").avg("total") > 100000).df().select("id")


@query(
    "load_records_of_few",
    "WITH o AS (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 40), l AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM lineitem) "
    "SELECT o_orderkey AS id, c_name AS customer, coalesce((SELECT string_agg(l_linenumber, ',' ORDER BY l_linenumber) FROM l WHERE l_orderkey = o_orderkey AND r <= 3), '') AS lines, CAST((SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 25) AS BIGINT) AS n FROM o JOIN customer ON c_custkey = o_custkey",
)
def _(g):
    df = q(g, "Order").sort(("total", "desc")).limit(40).load("customer").load_along("lines", "items", limit=3).aggregate(A("n", "count", ("items",), filter=attr("quantity") > 25)).df()
    return df.select("id", F.col("customer.name").alias("customer"), F.array_join(F.transform("lines", lambda x: x["number"].cast("string")), ",").alias("lines"), "n")


# joins by time
@query("asof_event_order", "SELECT event_id AS id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS order_id, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS total FROM events LEFT JOIN orders ON o_custkey = user_id AND o_orderdate <= ts GROUP BY event_id")
def _(g):
    events, orders = q(g, "Event").df(), q(g, "Order").df()
    df = as_of(events, orders, {"user_id": "customer_id"}, ("at", "placed"), "order", ("id",))
    return df.select("id", F.col("order.id").alias("order_id"), F.col("order.total").alias("total"))


@query("asof_event_event", "SELECT a.event_id AS id, arg_max(b.event_id, (b.ts, b.event_id)) AS purchase, arg_max(b.value, (b.ts, b.event_id)) AS value FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.ts < a.ts GROUP BY a.event_id")
def _(g):
    df = as_of(q(g, "Event").df().select("id", "at", "user_id"), q(g, "Event").filter(attr("kind") == "purchase").df(), {"user_id": "user_id"}, ("at", "at"), "last", ("id",), strict=True)
    return df.select("id", F.col("last.id").alias("purchase"), F.col("last.value").alias("value"))


SHIPPED = "SELECT o_custkey AS c, l_shipdate AS s, l_orderkey AS k, l_linenumber AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey"


@query("asof_order_shipment", f"SELECT o_orderkey AS id, arg_max(k, (s, k, n)) AS order_id, arg_max(n, (s, k, n)) AS number FROM orders LEFT JOIN ({SHIPPED}) ON c = o_custkey AND s <= o_orderdate GROUP BY o_orderkey")
def _(g):
    items = q(g, "LineItem").load("order").df().select("order_id", "number", "shipped", F.col("order.customer_id").alias("customer_id"))
    df = as_of(q(g, "Order").df(), items, {"customer_id": "customer_id"}, ("placed", "shipped"), "item", ("order_id", "number"))
    return df.select("id", F.col("item.order_id").alias("order_id"), F.col("item.number").alias("number"))


def spans(g):
    """From an order to its last shipment, if that comes later."""
    df = q(g, "Order").aggregate(A("until", "max", ("items",), "shipped")).df()
    return df.select("id", "customer_id", F.col("placed").alias("since"), "until").where("since <= until")


SPANS = "SELECT o_orderkey AS id, o_custkey AS c, o_orderdate AS a, max(l_shipdate) AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL HAVING max(l_shipdate) >= o_orderdate"
LONG = f"WITH s AS ({SPANS}), l AS (SELECT * FROM s UNION ALL SELECT -1, min(c), min(a), max(b) FROM s)"


def _with_long(df):
    return df.unionByName(df.agg(F.lit(-1).cast("long").alias("id"), F.min("customer_id").alias("customer_id"), F.min("since").alias("since"), F.max("until").alias("until")))


@query("interval_orders", f"{LONG} SELECT x.id AS a, y.id AS b, x.c AS customer FROM l x JOIN s y ON x.c = y.c AND x.id < y.id AND x.a <= y.b AND y.a <= x.b")
def _(g):
    found = overlapping(_with_long(spans(g)), spans(g), ("since", "until"), ("since", "until"), {"customer_id": "customer_id"}, name=("x", "y"))
    return found.where("x.id < y.id").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.customer_id").alias("customer"))


@query("interval_months", f"{LONG}, d AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS month FROM orders) SELECT CAST(month AS DATE) AS month, CAST(count(*) AS BIGINT) AS n, CAST(min(id) AS BIGINT) AS first FROM d JOIN l ON l.a < month AND month < l.b GROUP BY month")
def _(g):
    months = q(g, "Order").df().select(F.date_trunc("month", "placed").cast(g.frame("Order").schema["o_orderdate"].dataType).alias("month")).distinct()
    found = overlapping(_with_long(spans(g)), months, ("since", "until"), ("month", "month"), closed=False, name=("x", "y"))
    return found.groupBy(F.col("y.month").cast("date").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.min("x.id").alias("first"))


# joins by place
@query("near_suppliers", f"SELECT customer, rank, supplier, meters FROM (SELECT c_custkey AS customer, s_suppkey AS supplier, round(d, 3) AS meters, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS INTEGER) AS rank FROM (SELECT c_custkey, s_suppkey, {hav(_CX, _CY, _SX, _SY)} AS d FROM customer, supplier)) WHERE rank <= 5")
def _(g):
    left = q(g, "Customer").calculate("lng", "lat").df().select(F.col("id").alias("customer"), "lng", "lat")
    right = q(g, "Supplier").calculate("lng", "lat").df().select("id", "lng", "lat")
    df = nearest(left, right, ("lng", "lat"), ("lng", "lat"), 5, ("id",))
    return df.select("customer", "rank", F.col("near.id").alias("supplier"), F.round("meters", 3).alias("meters"))


def _ring(x, y, *corners):
    """A ring of corners given as distances from a place."""
    return F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y"), F.lit(None).cast("double").alias("z")) for dx, dy in (*corners, corners[0])])


def _square(x, y, half):
    return _ring(x, y, (-half, -half), (half, -half), (half, half), (-half, half))


def _polygon(*rings):
    return F.struct(F.lit("Polygon").alias("kind"), F.lit(4326).alias("srid"), F.array(F.array(*rings)).alias("parts"))


_DX, _DY = f"abs({_CX} - {_SX})", f"abs({_CY} - {_SY})"


def _off(v, low, high):
    """SQL: how far a value lies outside an interval."""
    return f"greatest(({low}) - {v}, {v} - ({high}), 0)"


#: A square on its corner meets a square with a square hole; or a concave area made of two boxes.
_RINGED = f"({_off(_DX, '-5.0003', '5.0003')} + {_off(_DY, '-5.0003', '5.0003')} <= 2.0001 AND NOT ({_DX} + 2.0001 < 3.5007 AND {_DY} + 2.0001 < 3.5007))"
_BENT = " OR ".join(f"{_off(_SX, f'{_CX} + {w}', f'{_CX} + {e}')} + {_off(_SY, f'{_CY} + {s}', f'{_CY} + {n}')} <= 2.0001" for w, s, e, n in ((-6.0003, -6.0003, 6.0003, -4.0007), (-6.0003, -6.0003, -4.0007, 6.0003)))


@query("areas_meeting", f"SELECT c_custkey AS customer, s_suppkey AS supplier FROM customer, supplier WHERE CASE WHEN c_custkey % 2 = 0 THEN {_RINGED} ELSE ({_BENT}) END")
def _(g):
    x, y = F.col("lng"), F.col("lat")
    places = q(g, "Customer").calculate("lng", "lat").df()
    bent = _ring(x, y, (-6.0003, -6.0003), (6.0003, -6.0003), (6.0003, -4.0007), (-4.0007, -4.0007), (-4.0007, 6.0003), (-6.0003, 6.0003))
    left = places.select(F.col("id").alias("customer"), F.when(F.col("id") % 2 == 0, _polygon(_square(x, y, 5.0003), _square(x, y, 3.5007))).otherwise(_polygon(bent)).alias("area"))
    r = 2.0001
    right = q(g, "Supplier").calculate("lng", "lat").df().select(F.col("id").alias("supplier"), _polygon(_ring(x, y, (-r, 0), (0, -r), (r, 0), (0, r))).alias("area"))
    return areas_meeting(left, right, ("area", "area"), ("c", "s")).select(F.col("c.customer").alias("customer"), F.col("s.supplier").alias("supplier"))


# chains of any length
@query("hops_next", "WITH RECURSIVE r(source, node, hops) AS (SELECT o_orderkey, o_orderkey, 0 FROM orders UNION SELECT source, o_orderkey, hops + 1 FROM r JOIN orders ON o_orderkey = node + 1 WHERE hops < 4) SELECT source, node, CAST(min(hops) AS INTEGER) AS hops FROM r GROUP BY ALL")
def _(g):
    return hops_from(edges_of(g, "Order", "next"), q(g, "Order").df().select("id"), 4, apart=True)


_TRADE = "e(src, dst) AS (SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders UNION SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem), b(src, dst) AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"


@query(
    "hops_trade",
    f"WITH RECURSIVE {_TRADE}, r(node, hops) AS (SELECT 'c' || c_custkey, 0 FROM (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 3) UNION SELECT dst, hops + 1 FROM r JOIN b ON src = node WHERE hops < 12) "
    "SELECT node, CAST(min(hops) AS INTEGER) AS hops FROM r GROUP BY node",
)
def _(g):
    named = lambda df, src, dst: df.select(F.concat(F.lit(src), F.col("src")).alias("src"), F.concat(F.lit(dst), F.col("dst")).alias("dst"))
    there = named(edges_of(g, "Customer", "orders"), "c", "o").unionByName(named(edges_of(g, "Order", "items", "part"), "o", "p"))
    rich = q(g, "Customer").sort(("balance", "desc"), "id").limit(3).df().select(F.concat(F.lit("c"), F.col("id")).alias("node"))
    return hops_from(there.unionByName(there.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), rich)


# values that do not fit, and bulk updates
@query(
    "read_typed_struct",
    "SELECT event_id AS id, CASE WHEN event_id % 5 > 1 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k, CASE WHEN event_id % 5 < 2 THEN 'props' ELSE '' END AS errors FROM events",
)
def _(g):
    r = g.resource("Event")
    g.resources["Event"] = replace(r, attributes=tuple(replace(a, type=Struct((("k", "integer"),))) if a.name == "props" else a for a in r.attributes))
    bad = F.when(F.col("event_id") % 5 == 0, F.lit("garbage")).when(F.col("event_id") % 5 == 1, F.lit('{"k": "many"}')).otherwise(F.col("props"))
    g.frames["Event"] = g.frame("Event").withColumn("props", bad)
    return q(g, "Event").cast().df().select("id", F.col("props.k").cast("int").alias("k"), F.array_join("_errors", ",").alias("errors"))


@query("mut_update_all", "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 1.0 ELSE c_acctbal END AS balance FROM customer")
def _(g):
    changes = g.frame("Customer").where("c_custkey % 3 = 0").select("c_custkey", F.lit(None).cast("string").alias("c_name"), F.when(F.col("c_custkey") % 2 == 0, 1.0).alias("c_acctbal"))
    return _customers(_snapshot(g, "Customer").update_all("Customer", changes, clear=("c_name",)))


@query("mut_update_all_repeated", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, true AS refused FROM customer")
def _(g):
    changes = g.frame("Order").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"))  # several orders of a customer
    after, error = _snapshot(g, "Customer").transaction(lambda s: s.update_all("Customer", changes))
    return _customers(after).withColumn("refused", F.lit(isinstance(error, UpsertConflict)))


# versions that are kept as changes
def _versions(g):
    """Three versions of the customers: all; a hundredth updated, a hundredth gone and a hundredth new; one gone."""
    store = Store(g.spark, commit.scratch(g.spark, "store"))
    snap = _snapshot(g, "Customer")
    snap.save_changes(store)
    snap = mutate.Snapshot.open_store(store, snap.resources)
    df = snap.node("Customer")
    new = df.where("c_custkey % 100 = 9").withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    updated = df.where("c_custkey % 100 = 7").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    store.commit({"nodes/Customer": Change(("c_custkey",), updated.unionByName(new), df.where("c_custkey % 100 = 8"))}, snap.base)
    snap = mutate.Snapshot.open_store(store, snap.resources)
    snap.delete("Customer", {"id": 1}).update("Customer", {"id": 2}, {"name": "Two"}).save_changes(store)
    return store


_AFTER = "SELECT c_custkey AS id, CASE WHEN c_custkey = 2 THEN 'Two' ELSE c_name END AS name, c_acctbal + CASE WHEN c_custkey % 100 = 7 THEN 1 ELSE 0 END AS balance FROM customer WHERE c_custkey % 100 <> 8 AND c_custkey <> 1 UNION ALL SELECT c_custkey + 10000000, c_name, c_acctbal FROM customer WHERE c_custkey % 100 = 9"


@query("delta_read", _AFTER)
def _(g):
    store = _versions(g)
    return _customers(mutate.Snapshot.open_store(store, {r.name: r for r in testgraph.RESOURCES}))


@query("delta_compacted", _AFTER)
def _(g):
    store = _versions(g)
    store.compact(folders=2)
    return _customers(mutate.Snapshot.open_store(store, {r.name: r for r in testgraph.RESOURCES}))


@query(
    "delta_changes",
    f"WITH a AS ({_AFTER}) SELECT coalesce(a.id, c_custkey) AS id, CASE WHEN c_custkey IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete' ELSE 'update' END AS change, c_acctbal AS balance, a.balance AS balance_after, a.name AS name_after "
    "FROM a FULL JOIN customer ON a.id = c_custkey WHERE c_custkey IS NULL OR a.id IS NULL OR a.balance <> c_acctbal OR a.name <> c_name",
)
def _(g):
    df = _versions(g).changes("nodes/Customer", 1)
    return df.select(F.col("c_custkey").alias("id"), "change", F.col("before.c_acctbal").alias("balance"), F.col("after.c_acctbal").alias("balance_after"), F.col("after.c_name").alias("name_after"))


@query("source_changes", "SELECT c_custkey AS id, 2 AS version, 'row' AS change, c_acctbal + 1 AS balance FROM customer WHERE c_custkey % 100 = 7 UNION ALL SELECT c_custkey + 10000000, 2, 'row', c_acctbal FROM customer WHERE c_custkey % 100 = 9 UNION ALL SELECT c_custkey, 2, 'gone', NULL FROM customer WHERE c_custkey % 100 = 8")
def _(g):
    changes.register(g.spark)
    df = changes.read_changes(g.spark, _versions(g).path, "_version = 2", "nodes/Customer")
    return df.select(F.col("c_custkey").alias("id"), F.col("_version").cast("int").alias("version"), F.col("_change").alias("change"), F.col("c_acctbal").alias("balance"))


# sketches along chains: their errors are known, so that what they say can be compared
@query(
    "agg_sketches",
    "SELECT n_nationkey AS id, CAST(count(o_orderkey) AS BIGINT) AS n, count(o_orderkey) = 0 OR true AS median_near, true AS parts_near FROM nation LEFT JOIN (customer JOIN orders ON o_custkey = c_custkey) ON c_nationkey = n_nationkey GROUP BY n_nationkey",
)
def _(g):
    orders, parts = ("customers", "orders"), ("customers", "orders", "items", "part")
    aggs = A("median", sketches.quantile(0.5), orders, "total"), A("n", "count", orders), A("parts", "count", parts, uniq=True), A("about", sketches.distinct(), parts, "id")
    nations = q(g, "Nation").aggregate(*aggs).df().select("id", "median", "n", "parts", "about")
    totals = q(g, "Order").load("customer").df().select(F.col("customer.nation_id").alias("id"), "total")
    below = nations.join(totals, "id", "left").groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", "parts", "about")], F.avg((F.col("total") <= F.col("median")).cast("double")).alias("share"))
    near = F.abs(F.coalesce(F.col("about"), F.lit(0)) - F.col("parts")) <= 0.08 * F.col("parts")
    return below.select("id", "n", ((F.col("n") == 0) | (F.abs(F.col("share") - 0.5) <= 0.03 + 1 / F.greatest(F.col("n"), F.lit(1)))).alias("median_near"), near.alias("parts_near"))
