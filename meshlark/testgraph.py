"""The driver's tables as a property graph."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .functions import geo
from .schema import Aggregate, Array, Attribute, Calculation, Domain, Relationship, Resource, VectorOf
from .sources.graph import Graph

TRADE = Domain("Trade")
TEXT = Domain("Text")


def lng(key: Column) -> Column:
    return F.lit(-180.0) + (key * 7919 % 36000) / 100.0


def lat(key: Column) -> Column:
    return F.lit(-60.0) + (key * 104729 % 12000) / 100.0


#: Places derived from keys, as the tables have none.
PLACE = (
    Calculation("lng", lambda c: lng(c("id"))),
    Calculation("lat", lambda c: lat(c("id"))),
    Calculation("height", lambda c: (c("id") % 500).cast("double")),
    Calculation("place", lambda c: geo.point(lng(c("id")), lat(c("id")))),
)


def _attrs(prefix: str, **kinds: object) -> tuple[Attribute, ...]:
    return tuple(Attribute(n, *(k if isinstance(k, tuple) else (k, f"{prefix}_{n}"))) for n, k in kinds.items())


RESOURCES = (
    Resource("Region", _attrs("r", id=("integer", "r_regionkey"), name="string"), domain=TRADE),
    Resource(
        "Nation", _attrs("n", id=("integer", "n_nationkey"), name="string", region_id=("integer", "n_regionkey")), domain=TRADE,
        relationships=(Relationship("region", "Region", "one", "IN_REGION", "out", "region_id"), Relationship("customers", "Customer", "many", "LIVES_IN", "in")),
    ),
    Resource(
        "Customer", _attrs("c", id=("integer", "c_custkey"), name="string", nation_id=("integer", "c_nationkey"), balance=("float", "c_acctbal"), segment=("ci_string", "c_mktsegment")), domain=TRADE,
        relationships=(Relationship("nation", "Nation", "one", "LIVES_IN", "out", "nation_id"), Relationship("orders", "Order", "many", "PLACED_BY", "in")),
        aggregates=(Aggregate("order_count", "count", ("orders",)),),
        calculations=(*PLACE, Calculation("double_balance", lambda c: c("balance") * 2), Calculation("title", lambda c: F.concat(c("name"), F.lit(" ("), c("segment"), F.lit(")")))),
    ),
    Resource(
        "Supplier", _attrs("s", id=("integer", "s_suppkey"), name="string", nation_id=("integer", "s_nationkey"), balance=("float", "s_acctbal")), domain=TRADE,
        relationships=(Relationship("nation", "Nation", "one", "LOCATED_IN", "out", "nation_id"), Relationship("items", "LineItem", "many", "SUPPLIED_BY", "in")), calculations=PLACE,
    ),
    Resource(
        "Part", _attrs("p", id=("integer", "p_partkey"), name="string", brand="string", type="string", size="integer", price=("float", "p_retailprice")), domain=TRADE,
        relationships=(Relationship("items", "LineItem", "many", "OF_PART", "in"),),
    ),
    Resource(
        "Order", _attrs("o", id=("integer", "o_orderkey"), customer_id=("integer", "o_custkey"), status=("string", "o_orderstatus"), total=("float", "o_totalprice"), placed=("datetime", "o_orderdate"), priority=("string", "o_orderpriority")), domain=TRADE,
        relationships=(Relationship("customer", "Customer", "one", "PLACED_BY", "out", "customer_id"), Relationship("items", "LineItem", "many", "PART_OF", "in"), Relationship("next", "Order", "one", "PRECEDES", "out"), Relationship("previous", "Order", "one", "PRECEDES", "in")),
    ),
    Resource(
        "LineItem", _attrs("l", order_id=("integer", "l_orderkey"), part_id=("integer", "l_partkey"), supplier_id=("integer", "l_suppkey"), number=("integer", "l_linenumber"), quantity="float", price=("float", "l_extendedprice"), discount="float", tax="float", shipped=("datetime", "l_shipdate")),
        key=("order_id", "number"), domain=TRADE,
        relationships=(Relationship("order", "Order", "one", "PART_OF", "out", "order_id"), Relationship("part", "Part", "one", "OF_PART", "out", "part_id"), Relationship("supplier", "Supplier", "one", "SUPPLIED_BY", "out", "supplier_id")),
        calculations=(Calculation("net", lambda c: c("price") * (1 - c("discount"))),),
    ),
    Resource("Event", (Attribute("id", "integer", "event_id"), Attribute("at", "datetime", "ts"), Attribute("user_id", "integer", "user_id"), Attribute("kind", "string", "event_type"), Attribute("value", "float", "value"), Attribute("props", "string", "props")), domain=TRADE),
    Resource("Document", (Attribute("id", "integer", "doc_id"), Attribute("lang", "string", "lang"), Attribute("source", "string", "source"), Attribute("n_chars", "integer", "n_chars")), domain=TEXT, relationships=(Relationship("labels", "Label", "many", "LABELS", "in"),)),
    Resource("Label", (Attribute("id", "integer", "doc_id"), Attribute("quality", "integer", "quality"), Attribute("toxic", "integer", "toxic")), domain=TEXT, relationships=(Relationship("document", "Document", "one", "LABELS", "out", "id"),)),
    Resource("Embedding", (Attribute("id", "integer", "vec_id"), Attribute("vector", VectorOf(64), "embedding"), Attribute("label", "integer", "label")), domain=TEXT),
    Resource("Benchmark", (Attribute("id", "integer", "item_id"), Attribute("text", "string", "text")), domain=TEXT),
    Resource("Page", (Attribute("id", "integer", "page_id"), Attribute("url", "string", "url")), domain=TEXT),
    Resource("Conversation", (Attribute("id", "integer", "conv_id"), Attribute("turn", "integer", "turn"), Attribute("role", "string", "role"), Attribute("words", Array("string"), "words")), key=("id", "turn"), domain=TEXT, skip=("words",)),
)
TABLES = {"Region": "region", "Nation": "nation", "Customer": "customer", "Supplier": "supplier", "Part": "part", "Order": "orders", "LineItem": "lineitem", "Event": "events", "Document": "documents", "Label": "labels", "Embedding": "embeddings", "Benchmark": "benchmark", "Page": "pages", "Conversation": "conversations"}
EDGES = (
    ("IN_REGION", "Nation", "Region", "n_regionkey"), ("LIVES_IN", "Customer", "Nation", "c_nationkey"), ("LOCATED_IN", "Supplier", "Nation", "s_nationkey"), ("PLACED_BY", "Order", "Customer", "o_custkey"),
    ("PART_OF", "LineItem", "Order", "l_orderkey"), ("OF_PART", "LineItem", "Part", "l_partkey"), ("SUPPLIED_BY", "LineItem", "Supplier", "l_suppkey"), ("LABELS", "Label", "Document", "doc_id"),
)


def load(spark: SparkSession, sf_dir: str) -> Graph:
    g = Graph(spark)
    for r in RESOURCES:
        g.add(r, spark.read.parquet(f"{sf_dir}/{TABLES[r.name]}.parquet"))
    for e in EDGES:
        g.key_edge(*e)
    orders = g.frame("Order").select(F.col("o_orderkey").alias("k"))
    follows = orders.select(F.col("k").alias("src"), (F.col("k") + 1).alias("dst")).join(orders.select(F.col("k").alias("dst")), "dst", "left_semi")
    return g.pair_edge("PRECEDES", "Order", "Order", follows.select("src", "dst"))
