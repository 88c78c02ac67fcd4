"""Raw/staging inputs derived from the TPC-H-like driver tables.

The driver ships order/line-item data, not rental listings; this module maps
it onto the staging schemas with the same operators the listing pipeline
uses (the mapping is documented in the README).  One listing snapshot row
per line item:

* listing_id = l_partkey, host_id = o_custkey, month = month of l_shipdate
* listing_neighbourhood = name of the supplier's nation
* host_neighbourhood   = NULL for customers of nation 0, else the supplier's
  nation name for line numbers above 5, else the customer's nation name
* suburb -> LGA        = supplier -> nation (k suppliers per nation)
* census               = per-nation aggregates over customers

All joins are equi-joins on keys, left to Catalyst and AQE: a side is broadcast
when it is measured small.  Suppliers and nations are hinted, after a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_code_prefix
from ..operators.joins import bounded_broadcast
from .tables import read_table

#: Suppliers that are broadcast, if their estimated bytes allow it too; more are joined by shuffle.
SUPPLIERS_MAX_ROWS = 3_000_000


def _nation(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def raw_lga_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LGA code file analogue: (lga_code int, lga_name) per nation."""
    return (read_table(spark, sf_dir, "nation")
            .select(F.col("n_nationkey").cast("int").alias("lga_code"),
                    F.col("n_name").alias("lga_name")))


def raw_lga_suburb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LGA/suburb file analogue: each supplier is a suburb of its nation."""
    s = read_table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    return (s.join(_nation(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"), "inner")
             .select(F.col("n_name").alias("lga_name"), F.col("s_name").alias("suburb_name")))


def _census_base(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal", "c_mktsegment")


def raw_census_g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census G01 analogue, code carried with its 'LGA' text prefix."""
    c = _census_base(spark, sf_dir)
    seg = F.col("c_mktsegment")
    return (c.groupBy("c_nationkey").agg(
                F.count_if(seg.isin("BUILDING", "MACHINERY", "AUTOMOBILE")).alias("tot_p_m"),
                F.count_if(~seg.isin("BUILDING", "MACHINERY", "AUTOMOBILE")).alias("tot_p_f"),
                F.count_if(seg == "BUILDING").alias("Age_20_24_yr_M"),
                F.count_if(seg == "HOUSEHOLD").alias("Age_20_24_yr_F"))
            .select(F.concat(F.lit("LGA"), F.col("c_nationkey").cast("string")).alias("lga_code"),
                    "tot_p_m", "tot_p_f", "Age_20_24_yr_M", "Age_20_24_yr_F",
                    (F.col("Age_20_24_yr_M") + F.col("Age_20_24_yr_F")).alias("Age_20_24_yr_P")))


def raw_census_g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census G02 analogue; the monthly mortgage is 6 x the nation's balances."""
    c = _census_base(spark, sf_dir)
    bal = F.col("c_acctbal").cast("decimal(15,2)")
    return (c.groupBy("c_nationkey").agg(
                F.sum(bal).alias("__bal"), F.count("*").alias("__n"))
            .select(F.concat(F.lit("LGA"), F.col("c_nationkey").cast("string")).alias("lga_code"),
                    F.round(F.col("__bal") * 6, 0).cast("bigint").alias("median_mortage_repay_monthly"),
                    F.col("__n").alias("median_age_persons")))


def staging_census_g01(spark, sf_dir) -> DataFrame:
    g = raw_census_g01(spark, sf_dir)
    return g.withColumn("lga_code", strip_code_prefix("lga_code"))


def staging_census_g02(spark, sf_dir) -> DataFrame:
    g = raw_census_g02(spark, sf_dir)
    return g.withColumn("lga_code", strip_code_prefix("lga_code"))


def staging_lga_code(spark, sf_dir) -> DataFrame:
    return raw_lga_code(spark, sf_dir).withColumn("lga_name", F.upper("lga_name"))


def staging_lga_suburb(spark, sf_dir) -> DataFrame:
    return raw_lga_suburb(spark, sf_dir).withColumn("lga_name", F.upper("lga_name"))


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item of what a listing snapshot is made of: keys, rounded values and dates,
    the nations as keys.

    Join order is chosen for shuffle volume: line items meet the supplier and part
    dimensions first, orders meet customers (orders are a quarter of line items), and the
    two sides meet once in a single shuffle join on the order key.  Suppliers are two numbers
    each and broadcast up to a checked size: by the estimate of their join with the
    nations, a product, every line item was shuffled once more."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.floor(F.col("l_quantity") / 2).alias("nights"),
        F.floor("l_extendedprice").alias("price"),
        F.round(F.col("l_discount") * 100).alias("accuracy"),
        F.round(F.col("l_tax") * 100).alias("rating"),
        (F.col("l_returnflag") != "N").alias("has_availability"),
        F.to_date("l_shipdate").alias("ship"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("since"))
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_mktsegment") == "BUILDING").alias("superhost"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    # Attributes that depend on a dimension row only are derived on the
    # dimension side, once per part / order instead of once per
    # line item, before the fan-out join.
    brand_no = F.regexp_extract("p_brand", r"[0-9]+", 0).try_cast("int")
    parts = p.select(
        "p_partkey", "p_type", (brand_no % 5).alias("room"),
        F.floor((F.col("p_size") - 1) / 10).cast("int").alias("accomodates"))
    hosts = o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")
    sup = bounded_broadcast(s, max_rows=SUPPLIERS_MAX_ROWS)
    lines = (li.join(sup, li.l_suppkey == F.col("s_suppkey"), "inner").drop("l_suppkey", "s_suppkey")
               .join(parts, li.l_partkey == parts.p_partkey, "inner").drop("p_partkey"))
    return (lines.join(hosts, lines.l_orderkey == hosts.o_orderkey, "inner").drop("o_orderkey")
                 .withColumn("year_month", F.trunc("ship", "month")))


def named_listings(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """The listings of ``listing_rows``, with names and types (nations: one row each, broadcast)."""
    n = bounded_broadcast(_nation(spark, sf_dir).select("n_nationkey", F.upper("n_name").alias("n_name")))
    cn = n.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"))
    sn = n.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    named = (rows.join(cn, F.col("c_nationkey") == F.col("cn_key"), "left")
                 .join(sn, F.col("s_nationkey") == F.col("sn_key"), "left"))
    return named.select(
        F.col("l_partkey").alias("listing_id"),
        F.col("l_orderkey").alias("scrape_id"),
        F.col("ship").alias("scraped_date"),
        F.col("o_custkey").alias("host_id"),
        F.col("c_name").alias("host_name"),
        F.col("since").cast("string").alias("host_since"),
        F.col("superhost").alias("host_is_superhost"),
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("string"))
         .when(F.col("l_linenumber") > 5, F.col("sn_name"))
         .otherwise(F.col("cn_name")).alias("host_neighbourhood"),
        F.col("sn_name").alias("listing_neighbourhood"),
        F.col("p_type").alias("property_type"),
        F.concat(F.lit("ROOM_"), F.col("room").cast("string")).alias("room_type"),
        "accomodates",
        F.col("price").cast("bigint").alias("price"),
        "has_availability",
        F.col("nights").cast("int").alias("availability_30"),
        F.col("l_linenumber").alias("number_of_reviews"),
        F.col("rating").cast("int").alias("review_scores_rating"),
        F.col("accuracy").cast("int").alias("review_scores_accuracy"),
        "year_month",
    )


def staging_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed listing-snapshot row per line item (B-01 analogue)."""
    return named_listings(spark, sf_dir, listing_rows(spark, sf_dir))


def listings_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, dealt to tasks by their month while they are narrow."""
    return named_listings(spark, sf_dir, listing_rows(spark, sf_dir).hint("rebalance", "year_month"))


def shared_suburb_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Listings whose host_neighbourhood is a suburb (supplier) name, and area tables in
    which every tenth suburb bears the next one's name, in whatever area it lies."""
    key = F.regexp_extract("suburb_name", "[0-9]+", 0).try_cast("bigint")
    shared = F.concat(F.lit("Supplier#"), F.lpad((key + 1).cast("string"), 9, "0"))
    suburb = staging_lga_suburb(spark, sf_dir).withColumn(
        "suburb_name", F.when(key % 10 == 0, shared).otherwise(F.col("suburb_name")))
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    listing = li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.col("l_orderkey").alias("scrape_id"), F.col("l_linenumber").alias("number_of_reviews"),
        F.col("l_partkey").alias("listing_id"), F.col("s_name").alias("host_neighbourhood"))
    return {"suburb": suburb, "code": staging_lga_code(spark, sf_dir), "listing": listing,
            "g01": staging_census_g01(spark, sf_dir), "g02": staging_census_g02(spark, sf_dir)}
