"""Driver query catalogue: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's whole tables through the analogue star.
Decimal metrics are exposed as DOUBLE and decimal sums as BIGINT so the
results compare engine-neutrally with the SQL oracle (``oracle_sql.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import as_double, pct_change, ratio6, rounding_int
from ..functions.text import file_name, month_from_file_name, strip_code_prefix
from ..operators.joins import join_null_safe, natural_join
from ..sources import analogue
from ..sources import csv_files as C
from ..sources.raw_files import land_all
from ..sources.storage import written_once
from ..sources.tables import read_table
from . import analysis as A
from . import marts as M
from . import sql_views as V
from . import staging as S
from .driver_star import analogue_layers, analogue_star, shared_star
from .warehouse import Star, lga_joined, listing_final

Query = Callable[[SparkSession, str], DataFrame]


NB = M.NEIGHBOURHOOD_KEYS
# Columns of the enriched listings that a query's branches read.
COUNTED = ["listing_id", "price", "has_availability", "availability_30", "review_scores_rating"]
HOSTED = ["listing_id", "host_id", "host_lga", "host_is_superhost"]
EARNED = ["listing_id", "price", "has_availability", "availability_30"]


def star_with(spark, sf, *columns) -> Star:
    """One written build of the listings with the named columns, each once."""
    return shared_star(spark, sf, list(dict.fromkeys(columns)))


def _bigint(*cols):
    return {c: F.col(c).cast("bigint") for c in cols}


# --- staging layer, from raw CSV files -----------------------------------
# Each query lands its dataset, beside one that another pattern takes, as CSV files in the shared
# folder, and stages it with the positional reader.  Listings, many times the others, are gzipped.

def q_staging_listing(spark, sf):
    raw = land_all(spark, sf, "listing", "code")
    return S.staging_listing_from_raw(C.raw_listing(spark, raw, gzipped=True))


def q_staging_census_g01(spark, sf):
    raw = land_all(spark, sf, "g01", "g02")
    return S.staging_census_g01_from_raw(C.raw_census_g01(spark, raw))


def q_staging_census_g02(spark, sf):
    raw = land_all(spark, sf, "g02", "g01")
    return S.staging_census_g02_from_raw(C.raw_census_g02(spark, raw))


def q_staging_lga_code(spark, sf):
    raw = land_all(spark, sf, "code", "suburb")
    return S.staging_lga_code_from_raw(C.raw_lga_code(spark, raw))


def q_staging_lga_suburb(spark, sf):
    raw = land_all(spark, sf, "suburb", "code")
    return S.staging_lga_suburb_from_raw(C.raw_lga_suburb(spark, raw))


# --- warehouse layer -----------------------------------------------------

def q_fact_listing(spark, sf):
    return analogue_star(spark, sf).fact


def q_dim_host_latest(spark, sf):
    return analogue_star(spark, sf).dim_host


def q_dim_listing_latest(spark, sf):
    return analogue_star(spark, sf).dim_listing


def q_lga_joined(spark, sf):
    return analogue_star(spark, sf).dim_lga_code


def q_dim_lga_copy(spark, sf):
    """CREATE TABLE .. AS SELECT * of the joined areas: a table of its own, read back (B-12)."""
    return written_once(analogue_layers(spark, sf)["lga_joined"], "dim_lga_code")


def q_dim_lga_suburb(spark, sf):
    return analogue_star(spark, sf).dim_lga_suburb


def q_enrich_left_listing(spark, sf):
    """merge1 (B-07)."""
    return analogue_layers(spark, sf)["merge1"]


def q_enrich_left_host(spark, sf):
    return analogue_star(spark, sf).listing_final


def q_enrich_host_by_suburb(spark, sf):
    """The host lookup by suburb name against the suburb-grain table (B-08, Q-13,
    Q-14), where a name that two areas share makes two rows."""
    layers = analogue.shared_suburb_layers(spark, sf)
    joined = lga_joined(layers["suburb"], layers["code"], layers["g01"], layers["g02"])
    return listing_final(layers["listing"], joined, lookup_key="suburb_name")


# --- joins ---------------------------------------------------------------

def q_natural_join_one_key(spark, sf):
    """Rows and listings of fact NATURAL JOIN dim_listing per neighbourhood."""
    star = star_with(spark, sf, "listing_id", *NB)
    w = M.listing_weights(star.dim_listing, ["listing_neighbourhood"])
    return (natural_join(star.fact.select("listing_id"), w)
            .groupBy("listing_neighbourhood")
            .agg(F.sum("w").alias("joined_rows"), F.count_distinct("listing_id").alias("listings")))


def q_natural_join_two_keys_null(spark, sf):
    """COUNT(DISTINCT host_id) of fact NATURAL JOIN dim_host NATURAL JOIN
    dim_listing per neighbourhood (two-key join, NULL host_lga drops)."""
    star = star_with(spark, sf, *HOSTED, *NB)
    h = M.listing_hosts(star, ["listing_neighbourhood"], by_month=False)
    return h.select("listing_neighbourhood", F.col("distinct_host_id").alias("distinct_hosts"))


def q_mixed_type_join(spark, sf):
    """fact.listing_lga (int) = dim_lga_code.lga_code (text), per LGA name.

    One fact scan: (code, host) counts, combined map-side, meet the k-suburb
    multiplicities; joined rows = sum(n * k) without emitting the k copies."""
    star = analogue_star(spark, sf)
    code = F.col("lga_code").cast("bigint")
    k = (star.dim_lga_code.where(code.isNotNull())
         .groupBy(code.alias("__code"), "lga_name").agg(F.count("*").alias("k")))
    g = (star.fact.select(F.col("listing_lga").cast("bigint").alias("__code"), "host_id")
         .groupBy("__code", "host_id").agg(F.count("*").alias("n")))
    return (g.join(k, "__code", "inner").groupBy("lga_name")
             .agg(F.sum(F.col("n") * F.col("k")).alias("joined_rows"),
                  F.count_distinct("host_id").alias("hosts")))


def q_fanout_join(spark, sf):
    """Row count of the host mart's k-squared self-join per LGA name."""
    return M.host_pair_rows(analogue_star(spark, sf)).withColumns(_bigint("pair_rows"))


# --- marts ---------------------------------------------------------------

def q_listing_mart_neighbourhood(spark, sf):
    return M.with_doubles(M.neighbourhood_mart(star_with(spark, sf, *COUNTED, *HOSTED, *NB)),
                          M.DECIMAL_MART_COLUMNS).withColumns(_bigint("total_num_stay"))


def q_listing_mart_property(spark, sf):
    return M.with_doubles(M.property_mart(star_with(spark, sf, *COUNTED, *HOSTED, *M.PROPERTY_KEYS)),
                          M.DECIMAL_MART_COLUMNS).withColumns(_bigint("total_num_stay"))


def q_host_mart(spark, sf):
    return (M.host_mart(analogue_star(spark, sf))
            .withColumns(_bigint("total_rev"))
            .withColumn("avg_rev_per_host", as_double("avg_rev_per_host")))


# --- metric pieces -------------------------------------------------------

def q_price_stats(spark, sf):
    """MIN/MAX/MEDIAN/AVG of available prices per neighbourhood (all months)."""
    star = star_with(spark, sf, "listing_id", "price", "has_availability", *NB)
    w = M.listing_weights(star.dim_listing, NB)
    j = star.fact.where(M.avail()).select("listing_id", "price").join(w, "listing_id", "inner")
    price, wt = F.col("price"), F.col("w")
    agg = j.groupBy(*NB).agg(
        F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        F.sum(price.cast(M.DEC0) * wt).cast(M.DEC0).alias("psum"),
        F.sum(F.when(price.isNotNull(), wt)).alias("pcnt"))
    med = M.weighted_median(j, NB, "price", "w")
    return join_null_safe(agg, med, NB, "left").select(
        *NB, "min_price", "max_price", F.col("median_price").alias("med_price"),
        as_double(ratio6("psum", F.nullif(F.col("pcnt"), F.lit(0)))).alias("avg_price"))


def _counts_with_lags(star):
    return M.listing_lags(M.listing_counts(star, NB), NB)


def q_avail_unavail_counts(spark, sf):
    c = M.listing_counts(star_with(spark, sf, *COUNTED, *NB), NB)
    return c.select(*NB, "year_month", "total_count", "avail_count", "unavail_count")


def q_distinct_hosts(spark, sf):
    return M.listing_hosts(star_with(spark, sf, *HOSTED, *NB), NB)


def q_lag_counts(spark, sf):
    c = _counts_with_lags(star_with(spark, sf, *COUNTED, *NB))
    pos = lambda x: F.when(F.col(x) > 0, F.col(x))  # noqa: E731 - group absent -> NULL
    return c.select(*NB, "year_month", "total_count", "lag_total_count",
                    pos("avail_count").alias("avail_count"), "lag_avail_count",
                    pos("unavail_count").alias("unavail_count"), "lag_unavail_count")


def q_pct_change_nullif(spark, sf):
    c = _counts_with_lags(star_with(spark, sf, *COUNTED, *NB))
    return c.select(*NB, "year_month",
                    as_double(F.when(F.col("avail_count") > 0,
                                     pct_change("avail_count", "lag_avail_count"))).alias("active_pct_change"),
                    as_double(F.when(F.col("unavail_count") > 0,
                                     pct_change("unavail_count", "lag_unavail_count"))).alias("inactive_pct_change"))


def q_estimated_revenue(spark, sf):
    c = M.listing_counts(star_with(spark, sf, *COUNTED, *NB), NB).where(F.col("avail_count") > 0)
    return c.select(*NB, "year_month", "total_num_stay", "total_rev").withColumns(
        _bigint("total_num_stay", "total_rev"))


def q_multi_key_sort(spark, sf):
    keys = M.PROPERTY_KEYS
    c = M.listing_counts(star_with(spark, sf, *COUNTED, *keys), keys)
    return (c.select(*keys, "year_month", "total_count")
             .orderBy(*[F.col(k).asc_nulls_last() for k in keys], "year_month"))


# --- scalar functions ----------------------------------------------------

def q_string_functions(spark, sf):
    s = read_table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    raw_code = F.concat(F.lit("LGA"), F.col("s_nationkey").cast("string"))
    return s.select(
        "s_suppkey",
        F.upper("s_name").alias("name_upper"),
        F.substring("s_name", 1, 8).alias("name_head"),
        F.split_part(F.col("s_name"), F.lit("#"), F.lit(-1)).alias("name_tail"),
        F.length("s_name").alias("name_len"),
        F.right(raw_code, F.length(raw_code) - F.lit(3)).alias("code_digits"),
        strip_code_prefix(raw_code).alias("code_text"))


def q_month_from_filename(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    path = F.concat(F.lit("raw/listings/"), F.date_format("o_orderdate", "MM_yyyy"), F.lit(".csv"))
    return o.select("o_orderkey", file_name(path).alias("file_name"),
                    month_from_file_name(path).alias("year_month"))


def q_rounding_casts(spark, sf):
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    qty_text = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("."),
                        F.col("l_linenumber").cast("string"))
    flag_text = F.when(F.col("l_returnflag") == "N", F.lit("f")).otherwise(F.lit("t"))
    ship_text = F.date_format("l_shipdate", "dd/MM/yyyy")
    return li.select(
        "l_orderkey", "l_linenumber",
        qty_text.alias("qty_text"), rounding_int(qty_text).alias("qty_int"),
        flag_text.cast("boolean").alias("flag"),
        ship_text.alias("ship_text"), F.try_to_date(ship_text, "dd/MM/yyyy").alias("ship_date"),
        F.col("l_linenumber").cast("string").alias("line_text"))


# --- analysis ------------------------------------------------------------

def q1_best_neighbourhood(spark, sf):
    return A.best_neighbourhood(star_with(spark, sf, *EARNED, *NB)).withColumns(_bigint("total_rev"))


def q1_worst_neighbourhood(spark, sf):
    return A.worst_neighbourhood(star_with(spark, sf, *EARNED, *NB)).withColumns(_bigint("total_rev"))


def q1_best_lga_population(spark, sf):
    star = star_with(spark, sf, *EARNED, "listing_lga", *NB)
    return A.lga_population(star, A.best_neighbourhood(star).select("listing_neighbourhood"))


def q1_worst_lga_population(spark, sf):
    star = star_with(spark, sf, *EARNED, "listing_lga", *NB)
    return A.lga_population(star, A.worst_neighbourhood(star).select("listing_neighbourhood"))


#: The area that the literal-filter query asks for.
ASKED_LGA = "NATION_3"


def q1_scalar_subquery_lga(spark, sf, name: str = ASKED_LGA):
    """Population of the area of a given name, by literal filter and scalar subquery."""
    return A.lga_population(analogue_star(spark, sf), F.lit(name))


def q2_top5_neighbourhoods(spark, sf):
    return A.top5_neighbourhoods(star_with(spark, sf, *EARNED, *NB)).withColumn(
        "avg_est_price", as_double("avg_est_price"))


def q2_listing_types_semi(spark, sf):
    return A.listing_types_in_top5(star_with(spark, sf, *EARNED, *NB, *M.PROPERTY_KEYS))


def q2_modal_types(spark, sf):
    return A.modal_listing_types(star_with(spark, sf, *EARNED, *NB, *M.PROPERTY_KEYS))


def q3_same_lga(spark, sf):
    return A.multi_lga_hosts(analogue_star(spark, sf), same=True)


def q3_diff_lga(spark, sf):
    return A.multi_lga_hosts(analogue_star(spark, sf), same=False)


def q4_revenue_vs_mortgage(spark, sf):
    return A.revenue_vs_mortgage(star_with(spark, sf, *EARNED, "host_id", "listing_lga")).withColumns(_bigint("total_rev"))


def q4_can_afford(spark, sf):
    return A.afford_counts(star_with(spark, sf, *EARNED, "host_id", "listing_lga"), can=True)


def q4_cannot_afford(spark, sf):
    return A.afford_counts(star_with(spark, sf, *EARNED, "host_id", "listing_lga"), can=False)


# --- Spark SQL over temporary views --------------------------------------

def q_sql_cte_in_derived_table(spark, sf):
    return V.over_views(spark, sf, V.BUSY_MONTHS)


def q_sql_lateral_alias(spark, sf):
    return V.over_views(spark, sf, V.WORTH)


def q_sql_group_by_alias(spark, sf):
    return V.over_views(spark, sf, V.YEARLY).withColumns(_bigint("price_total"))


QUERIES: dict[str, Query] = {
    "staging_listing": q_staging_listing,
    "staging_census_g01": q_staging_census_g01,
    "staging_census_g02": q_staging_census_g02,
    "staging_lga_code": q_staging_lga_code,
    "staging_lga_suburb": q_staging_lga_suburb,
    "fact_listing": q_fact_listing,
    "dim_host_latest": q_dim_host_latest,
    "dim_listing_latest": q_dim_listing_latest,
    "lga_joined": q_lga_joined,
    "dim_lga_copy": q_dim_lga_copy,
    "dim_lga_suburb": q_dim_lga_suburb,
    "enrich_left_listing": q_enrich_left_listing,
    "enrich_left_host": q_enrich_left_host,
    "enrich_host_by_suburb": q_enrich_host_by_suburb,
    "natural_join_one_key": q_natural_join_one_key,
    "natural_join_two_keys_null": q_natural_join_two_keys_null,
    "mixed_type_join": q_mixed_type_join,
    "fanout_join": q_fanout_join,
    "listing_mart_neighbourhood": q_listing_mart_neighbourhood,
    "listing_mart_property": q_listing_mart_property,
    "host_mart": q_host_mart,
    "price_stats": q_price_stats,
    "avail_unavail_counts": q_avail_unavail_counts,
    "distinct_hosts": q_distinct_hosts,
    "lag_counts": q_lag_counts,
    "pct_change_nullif": q_pct_change_nullif,
    "estimated_revenue": q_estimated_revenue,
    "multi_key_sort": q_multi_key_sort,
    "string_functions": q_string_functions,
    "month_from_filename": q_month_from_filename,
    "rounding_casts": q_rounding_casts,
    "q1_best_neighbourhood": q1_best_neighbourhood,
    "q1_worst_neighbourhood": q1_worst_neighbourhood,
    "q1_best_lga_population": q1_best_lga_population,
    "q1_worst_lga_population": q1_worst_lga_population,
    "q1_scalar_subquery_lga": q1_scalar_subquery_lga,
    "q2_top5_neighbourhoods": q2_top5_neighbourhoods,
    "q2_listing_types_semi": q2_listing_types_semi,
    "q2_modal_types": q2_modal_types,
    "q3_same_lga": q3_same_lga,
    "q3_diff_lga": q3_diff_lga,
    "q4_revenue_vs_mortgage": q4_revenue_vs_mortgage,
    "q4_can_afford": q4_can_afford,
    "q4_cannot_afford": q4_cannot_afford,
    "sql_cte_in_derived_table": q_sql_cte_in_derived_table,
    "sql_lateral_alias": q_sql_lateral_alias,
    "sql_group_by_alias": q_sql_group_by_alias,
}
