"""Views over the driver tables: the synthetic hierarchies and the graph that the queries run on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.edges import Loader, build


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEPT: dict[tuple[str, str, str], object] = {}


def kept(spark: SparkSession, d: str, name: str, make: Callable[[], object]):
    """What ``make`` gives for the tables of ``d``, made once in an application: an edition is built once and queried many times."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def isa_tree(spark: SparkSession, d: str) -> DataFrame:
    """child, parent: customer k under k / 10."""
    return t(spark, d, "customer").where("c_custkey > 0").select(F.col("c_custkey").alias("child"), F.expr("c_custkey div 10").alias("parent"))


def isa_poly(spark: SparkSession, d: str) -> DataFrame:
    """A second parent for each, k / 7."""
    return isa_tree(spark, d).union(t(spark, d, "customer").where("c_custkey > 0").select("c_custkey", F.expr("c_custkey div 7"))).distinct()


def ring(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("child"), ((F.col("n_nationkey") + 1) % 25).cast("long").alias("parent"))


SQL_TREE = "SELECT c_custkey AS child, c_custkey // 10 AS parent FROM customer WHERE c_custkey > 0"
SQL_POLY = f"({SQL_TREE} UNION SELECT c_custkey, c_custkey // 7 FROM customer WHERE c_custkey > 0)"
SQL_RING = "SELECT n_nationkey::BIGINT AS child, ((n_nationkey + 1) % 25)::BIGINT AS parent FROM nation"


def loaders(spark: SparkSession, d: str) -> list[Loader]:
    """Edge families over the foreign keys, with the reasons why rows are left out."""
    c, s, n, o, li = (t(spark, d, x) for x in ("customer", "supplier", "nation", "orders", "lineitem"))
    return [
        Loader("customer in nation", c, ("CUST", F.col("c_custkey")), "in_nation", ("NATION", F.col("c_nationkey")), "customer", keep=[("balance below zero", F.col("c_acctbal") >= 0), ("segment not covered", F.col("c_mktsegment") != "FURNITURE")]),
        Loader("supplier in nation", s, ("SUPP", F.col("s_suppkey")), "in_nation", ("NATION", F.col("s_nationkey")), "supplier"),
        Loader("nation in region", n, ("NATION", F.col("n_nationkey")), "in_region", ("REGION", F.col("n_regionkey")), "nation"),
        Loader("order placed by customer", o, ("ORDER", F.col("o_orderkey")), "placed_by", ("CUST", F.col("o_custkey")), "orders", keep=[("status pending", F.col("o_orderstatus") != "P"), ("low priority", ~F.col("o_orderpriority").like("5%"))], method="declared", tier="2"),
        Loader("order contains part", li, ("ORDER", F.col("l_orderkey")), "contains", ("PART", F.col("l_partkey")), "lineitem", keep=[("returned", F.col("l_returnflag") != "R")], method="line", tier="ungraded"),
        Loader("part supplied by supplier", li, ("PART", F.col("l_partkey")), "supplied_by", ("SUPP", F.col("l_suppkey")), "lineitem", keep=[("small quantity", F.col("l_quantity") >= 10), ("discounted", F.col("l_discount") < 0.05)], method="line", tier="1"),
    ]


def edge(spark: SparkSession, d: str) -> DataFrame:
    return build(loaders(spark, d))


_FAMILY = "SELECT DISTINCT '{0}' AS s_vocab, {1}::VARCHAR AS s_code, '{2}' AS predicate, '{3}' AS o_vocab, {4}::VARCHAR AS o_code, '{5}' AS source, '{6}' AS source_locator, '{7}' AS method, '{8}' AS tier, 'asserted' AS state, '' AS pin, NULL::VARCHAR AS attrs FROM {5} WHERE {9}"
SQL_EDGE = " UNION ALL ".join(
    _FAMILY.format(*x)
    for x in [
        ("CUST", "c_custkey", "in_nation", "NATION", "c_nationkey", "customer", "customer in nation", "native", "native", "c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE'"),
        ("SUPP", "s_suppkey", "in_nation", "NATION", "s_nationkey", "supplier", "supplier in nation", "native", "native", "true"),
        ("NATION", "n_nationkey", "in_region", "REGION", "n_regionkey", "nation", "nation in region", "native", "native", "true"),
        ("ORDER", "o_orderkey", "placed_by", "CUST", "o_custkey", "orders", "order placed by customer", "declared", "2", "o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '5%'"),
        ("ORDER", "l_orderkey", "contains", "PART", "l_partkey", "lineitem", "order contains part", "line", "ungraded", "l_returnflag <> 'R'"),
        ("PART", "l_partkey", "supplied_by", "SUPP", "l_suppkey", "lineitem", "part supplied by supplier", "line", "1", "l_quantity >= 10 AND l_discount < 0.05"),
    ]
)
