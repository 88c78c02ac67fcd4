"""Business questions (N-01..N-12).

Every fact NATURAL JOIN dim_listing is evaluated with the dimension's tie
weights (see marts.py): revenue sums are weighted instead of emitting the
fact x ties pairs.  ORDER BY .. LIMIT keeps the warehouse's NULL order
(NULL is the largest value) and adds a key tiebreak (Q-15, Q-16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio6
from ..operators.windows import modes_per_group
from .marts import DEC0, avail, est_price, listing_weights
from .warehouse import Star


def revenue_by_neighbourhood(star: Star) -> DataFrame:
    """SUM((30 - availability_30) * price) over available rows of fact
    NATURAL JOIN dim_listing, per listing_neighbourhood, plus the joined
    available row count (the fact meets the tie weights, no pair rows)."""
    f = star.fact.where(avail()).select("listing_id", est_price().alias("est"))
    w = listing_weights(star.dim_listing, ["listing_neighbourhood"])
    return (f.join(w, "listing_id", "inner")
              .groupBy("listing_neighbourhood")
              .agg(F.sum((F.col("est") * F.col("w")).cast(DEC0)).alias("total_rev"),
                   F.sum("w").alias("avail_count")))


def best_neighbourhood(star: Star) -> DataFrame:
    """N-01: ORDER BY total_rev DESC LIMIT 1."""
    return (revenue_by_neighbourhood(star)
            .orderBy(F.col("total_rev").desc_nulls_first(),
                     F.col("listing_neighbourhood").asc_nulls_last())
            .limit(1).select("listing_neighbourhood", "total_rev"))


def worst_neighbourhood(star: Star) -> DataFrame:
    """N-02: ORDER BY total_rev ASC LIMIT 1."""
    return (revenue_by_neighbourhood(star)
            .orderBy(F.col("total_rev").asc_nulls_last(),
                     F.col("listing_neighbourhood").asc_nulls_last())
            .limit(1).select("listing_neighbourhood", "total_rev"))


def lga_population(star: Star, lga_name: Column | DataFrame) -> DataFrame:
    """N-03 / N-04: lga_name and Age_20_24_yr_P of the LGA rows whose code is
    ``(SELECT DISTINCT lga_code FROM dim_lga_code WHERE lga_name = X)`` and
    that some fact row lists in; LIMIT 1.

    ``lga_name`` is X: a literal, or a one-row frame as scalar subquery.  The code is a scalar subquery,
    so a name with two codes is an error.  The fact is only filtered by that code and
    reduced to it map-side, never joined row by row."""
    if isinstance(lga_name, DataFrame):
        lga_name = lga_name.scalar()
    d = star.dim_lga_code.withColumn("__code", F.col("lga_code").cast("bigint"))
    code = d.where(F.col("lga_name") == lga_name).select("__code").distinct().scalar()
    present = (star.fact.select(F.col("listing_lga").cast("bigint").alias("__code"))
               .where(F.col("__code") == code).distinct())
    return d.join(present, "__code", "left_semi").select("lga_name", "Age_20_24_yr_P").limit(1)


def top5_neighbourhoods(star: Star) -> DataFrame:
    """N-05 (view ``temp``): revenue per available joined row, top 5.  The
    view natural-joins two per-neighbourhood results, so a NULL
    neighbourhood never qualifies."""
    r = revenue_by_neighbourhood(star).where((F.col("avail_count") > 0)
                                             & F.col("listing_neighbourhood").isNotNull())
    return (r.select("listing_neighbourhood",
                     ratio6("total_rev", "avail_count").alias("avg_est_price"))
             .orderBy(F.col("avg_est_price").desc_nulls_first(),
                      F.col("listing_neighbourhood").asc_nulls_last())
             .limit(5))


def listing_types_in_top5(star: Star) -> DataFrame:
    """N-06 (view ``temp1``): DISTINCT (neighbourhood, property_type,
    room_type, accomodates) of fact NATURAL JOIN dim_listing, neighbourhood
    IN the top 5.  Only distinct types leave the join, so it is a semi-join with
    the fact on listing_id: no pair rows are made."""
    top = top5_neighbourhoods(star).select("listing_neighbourhood")
    dl = star.dim_listing.join(top, "listing_neighbourhood", "left_semi")
    return (dl.join(star.fact.select("listing_id"), "listing_id", "left_semi")
              .select("listing_neighbourhood", "property_type", "room_type", "accomodates")
              .distinct())


def modal_listing_types(star: Star) -> DataFrame:
    """N-07: per top-5 neighbourhood the property type, room type and
    capacity occurring in most distinct combinations (the three per-column
    modes of the reference, computed in one pass over ``temp1``)."""
    t = listing_types_in_top5(star)
    return modes_per_group(t, "listing_neighbourhood", ["property_type", "room_type", "accomodates"])


def multi_lga_hosts(star: Star, same: bool) -> DataFrame:
    """N-08 / N-09: hosts with more than one distinct listing LGA among rows
    whose listing LGA equals (differs from) the host LGA; counted."""
    listing_lga = F.col("listing_lga").cast("bigint")
    host_lga = F.col("host_lga").cast("bigint")
    cond = (listing_lga == host_lga) if same else (listing_lga != host_lga)
    hosts = (star.fact.where(cond)
             .groupBy("host_id").agg(F.count_distinct("listing_lga").alias("__n"))
             .where(F.col("__n") > 1))
    name = "count_same_lga" if same else "count_diff_lga"
    return hosts.agg(F.count("*").alias(name))


def revenue_vs_mortgage(star: Star) -> DataFrame:
    """N-10 (view ``temp2``): DISTINCT host_id, total_rev, yearly_mortgage
    for hosts with more than one fact row.

    The reference joins three per-host CTEs; two of them fold into one
    aggregate over a single fact scan: the fact LEFT JOINs the per-listing
    tie weights (exactly one row per listing, so nothing multiplies), and
    per host we count fact rows with a listing (cte1) and sum the weighted
    revenue of available rows that met dim_listing (cte3, which exists only
    if at least one such row exists)."""
    f = star.fact
    w = listing_weights(star.dim_listing, [])
    joined = avail() & F.col("w").isNotNull()
    per_host = (f.select("host_id", "listing_id", "has_availability", est_price().alias("__est"))
                 .join(w, "listing_id", "left")
                 .groupBy("host_id").agg(
                     F.count("listing_id").alias("__n"),
                     F.count_if(joined).alias("__m"),
                     F.sum(F.when(joined, (F.col("__est") * F.col("w")).cast(DEC0))).alias("total_rev"))
                 .where((F.col("__n") > 1) & (F.col("__m") > 0)))
    mortgage = (star.dim_lga_code
                .select(F.col("lga_code").cast("bigint").alias("__code"),
                        "median_mortage_repay_monthly").distinct())
    # Only (host, mortgage) reaches the output, so the DISTINCT over
    # (host, host_lga, mortgage) and the final DISTINCT collapse into one.
    lgas = (f.select("host_id", F.col("listing_lga").cast("bigint").alias("__code")).distinct()
              .join(mortgage, "__code", "inner")
              .select("host_id", "median_mortage_repay_monthly").distinct())
    return (per_host.join(lgas, "host_id", "inner")
            .select("host_id", "total_rev",
                    (F.col("median_mortage_repay_monthly") * 12).alias("yearly_mortgage")))


def afford_counts(star: Star, can: bool) -> DataFrame:
    """N-11 / N-12."""
    t = revenue_vs_mortgage(star)
    cond = (F.col("total_rev") >= F.col("yearly_mortgage")) if can else \
        (F.col("total_rev") < F.col("yearly_mortgage"))
    return t.where(cond).agg(F.count("host_id").alias("can_afford" if can else "cannot_afford"))

