"""The driver tables seen as offers, products, branches and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.text import rounded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, retailer_id, price, in_stock (true, false, null), observed_at, ord and line (input order)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("retailer_id"),
        rounded(F.col("l_extendedprice") / F.col("l_quantity"), 100).alias("price"),
        F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False).alias("in_stock"),
        F.col("l_shipdate").alias("observed_at"),
        F.col("l_orderkey").alias("ord"),
        F.col("l_linenumber").alias("line"),
    )


OFFERS_SQL = """offers AS (SELECT l_partkey AS product_id, l_suppkey AS retailer_id, floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS price,
  CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS in_stock, l_shipdate AS observed_at, l_orderkey AS ord, l_linenumber AS line FROM lineitem)"""


def branches(spark: SparkSession, sf_dir: str, name: str, prefix: str) -> DataFrame:
    """id, nation, lat, lng of suppliers or customers, placed by a fixed formula of their keys."""
    k = F.col(f"{prefix}_{'supp' if prefix == 's' else 'cust'}key")
    lat = 24.0 + (k * 7919 % 5000) / 10000.0
    lng = 54.0 + (k * 104729 % 5000) / 10000.0
    return table(spark, sf_dir, name).select(k.alias("id"), F.col(f"{prefix}_nationkey").alias("nation"), lat.alias("lat"), lng.alias("lng"))
