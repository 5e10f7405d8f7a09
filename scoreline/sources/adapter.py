"""The raw streams ``logs``, ``summaries`` and ``messages`` from an order-entry star schema.

An order is a match, its line items are player rows of two teams, conversation turns are chat. Deliveries repeat
there as they do in a real feed, so that both stages of deduplication have work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _long(x) -> F.Column:
    return F.floor(x).cast("long")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    score = lines.groupBy(F.col("l_orderkey").alias("logid")).agg(
        F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("redscore"), F.count(F.when(F.col("l_linestatus") == "F", 1)).alias("bluescore")
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("recordid"),
        F.col("o_orderkey").alias("logid"),
        F.concat(F.lit("match "), F.col("o_orderkey")).alias("title"),
        F.col("o_orderpriority").alias("map"),
        F.col("o_orderdate").alias("match_time"),
        F.pmod(_long("o_totalprice"), F.lit(3600)).cast("long").alias("durationseconds"),
        F.col("o_custkey").cast("string").alias("uploadersteamid"),
        F.col("o_orderdate").alias("__ingest_ts"),
    ).join(score, "logid", "left")


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player rows. The join by match comes last, on rows dealt by match: they lie as deduplication needs them."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("logid"), F.col("o_orderpriority").alias("map"), F.col("o_orderdate").alias("match_time"))
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.concat_ws(", ", "p_type", "p_brand").alias("classesplayedcsv"))
    taken = ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*taken)
    classed = lines.join(part, lines.l_partkey == part.p_partkey, "left").drop("p_partkey").withColumnRenamed("l_orderkey", "logid")
    met = classed.repartition("logid").join(orders, "logid", "left")
    return met.select(
        "logid",
        F.concat_ws(":", "logid", "l_linenumber").alias("recordid"),
        F.col("l_suppkey").cast("string").alias("steamid"),
        F.when(F.col("l_linestatus") == "O", "Red").when(F.col("l_linestatus") == "F", "Blue").alias("team"),
        _long("l_quantity").alias("kills"),
        _long(F.col("l_discount") * 100 + 0.5).alias("assists"),
        F.pmod(_long("l_quantity"), F.lit(25)).cast("long").alias("deaths"),
        _long("l_extendedprice").alias("damagedealt"),
        _long(F.col("l_tax") * 1000 + 0.5).alias("healingdone"),
        F.pmod("l_linenumber", F.lit(4)).cast("long").alias("ubersused"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_shipdate").alias("__ingest_ts"),
        "map",
        "match_time",
        "classesplayedcsv",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("steamid"), F.col("l_shipdate").alias("__ingest_ts"))
    met = turns.join(lines, (turns.conv_id == lines.l_orderkey) & (turns.turn + 1 == lines.l_linenumber))
    return met.select(
        F.concat_ws(":", "conv_id", "turn").alias("recordid"),
        F.col("conv_id").alias("logid"),
        F.col("turn").alias("messageindex"),
        "steamid",
        F.col("text").alias("message"),
        F.lower("text").alias("messagelower"),
        "__ingest_ts",
    )
