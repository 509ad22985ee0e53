"""Views of the driver's tables in the shapes of the operators.

They are a testing device: the tables hold no sequences, trees or samples, and results over these
views have no biological meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAXA = 5
#: Event type -> state; the last is a gap.
STATE_OF = {"click": "T", "error": "C", "purchase": "A", "signup": "G", "view": "-"}
#: Cells of events below this value take the state of their type, all others that of their site.
CHANGED_BELOW = 12.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(taxon_id, site, state): five events make a site. No shuffle: both follow from the event's number."""
    events = table(spark, sf_dir, "events")
    site = F.expr("event_id div 5 + 1")
    own = F.create_map(*[F.lit(x) for pair in STATE_OF.items() for x in pair])[F.col("event_type")]
    shared = F.substring(F.lit("TCAG"), ((site * 13 + F.expr("event_id div 35")) % 4 + 1).cast("int"), F.lit(1))
    return events.select((F.col("event_id") % TAXA + 1).cast("int").alias("taxon_id"), site.alias("site"), F.when(F.col("value") < CHANGED_BELOW, own).otherwise(shared).alias("state"))


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(node_id, father_id, branch_length, is_tip): a root over regions, nations, and customers and suppliers as tips."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")

    def nodes(df: DataFrame, node: str, father: str, length: str, tip: bool) -> DataFrame:
        return df.select(F.expr(node).cast("long").alias("node_id"), F.expr(father).cast("long").alias("father_id"), F.expr(length).cast("double").alias("branch_length"), F.lit(tip).alias("is_tip"))

    root = spark.range(1).select(F.lit(0).cast("long").alias("node_id"), F.lit(None).cast("long").alias("father_id"), F.lit(0.0).alias("branch_length"), F.lit(False).alias("is_tip"))
    parts = [
        nodes(region, "r_regionkey + 1", "0", "(r_regionkey + 1) / 10.0", False),
        nodes(nation, "n_nationkey + 100", "n_regionkey + 1", "(n_nationkey % 7 + 1) / 20.0", False),
        nodes(customer, "1000 + 2 * c_custkey", "c_nationkey + 100", "abs(c_acctbal) / 10000.0", True),
        nodes(supplier, "1001 + 2 * s_suppkey", "s_nationkey + 100", "abs(s_acctbal) / 10000.0", True),
    ]
    for part in parts:
        root = root.unionByName(part)
    return root


def tip_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a, b): customer and supplier tips that meet in an order."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    met = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
    return met.select((1000 + 2 * F.col("o_custkey")).alias("a"), (1001 + 2 * F.col("l_suppkey")).alias("b")).distinct()


def sampled_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tree_id, split): each order as a sampled tree of seven taxa; a split is what one group of parts covers."""
    items = table(spark, sf_dir, "lineitem")
    grouped = items.groupBy(F.col("l_orderkey").alias("tree_id"), (F.col("l_partkey") % 3).alias("g")).agg(F.bit_or(F.expr("shiftleft(1, l_linenumber - 1)")).alias("bits"))
    bits = F.when(F.col("bits").bitwiseAND(F.lit(1)) == 1, F.lit(127) - F.col("bits")).otherwise(F.col("bits"))
    whole = grouped.select("tree_id", bits.alias("bits")).where(F.bit_count("bits").between(2, 5)).distinct()
    return whole.select("tree_id", F.reverse(F.lpad(F.bin("bits"), 7, "0")).alias("split"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chain, iteration, quantity, extendedprice, discount, tax): each supplier's lines as a chain."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(F.col("l_suppkey").alias("chain"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("iteration"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("extendedprice"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


def site_likelihoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tree_id, site, lnf): three orders make a site, one for each of three trees."""
    orders = table(spark, sf_dir, "orders")
    return orders.select((F.col("o_orderkey") % 3).alias("tree_id"), F.expr("o_orderkey div 3").alias("site"), (-F.log1p(F.col("o_totalprice") / 1000)).alias("lnf"))


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(placement_id, edge_num, likelihood, marginal_like): each order as a placement, its lines as candidates."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(F.col("l_orderkey").alias("placement_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("candidate"), F.col("l_partkey").alias("edge_num"), (-F.col("l_extendedprice") / 1e4).alias("likelihood"), (-F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1e4).alias("marginal_like"))
