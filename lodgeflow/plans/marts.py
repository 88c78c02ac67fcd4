"""Data marts (M-01..M-23).

Listing marts
-------------
The reference builds each listing mart from twelve CTEs that each re-join
the fact to the latest-snapshot dimensions, then natural-joins them.  Here
it is one pass per concern, with the same result:

* ``dim_listing`` keeps ties (several rows per listing in its latest
  month), so fact x dim multiplies each fact row by the listing's tie
  count.  Emitting those pairs is quadratic in a hot listing; instead ties
  are collapsed to ``(listing_id, grain keys, rating) -> w`` and every
  aggregate is weighted (counts and sums by ``w``, MIN/MAX unchanged, the
  median through ``percentile(.., frequency)`` over a (value -> weight)
  pre-aggregate).
* The fact joins the small weight table directly (broadcast when AQE
  measures it small).  A hash aggregate, combined map-side, reduces the
  joined rows to (grain, month, price) partial sums -- every metric is
  additive except MIN/MAX/median -- and a second aggregate rolls them up
  and takes the median over distinct prices: one fact scan for all counts,
  sums and the median; a second scan only for the distinct hosts.
* Lags run over the (grain, month) aggregate, whose window partitions hold
  one row per month.
* Group survival of the twelve-way inner join (Q-03) becomes a filter:
  >=1 available row, >=1 unavailable row, >=1 resolvable host, >=1
  superhost, no NULL key.

Host mart
---------
``dim_lga_code`` is at suburb grain, so the reference multiplies fact rows by
the k suburbs of an LGA and then self-joins on (listing_id, lga_name,
year_month): k^2 pairs.  Per such group with n = sum(k) and s = sum(k * est)
the pairs contribute exactly n * s, computed without materialising pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import (MEDIAN_TYPE, as_double, pct6, pct_change, ratio6)
from ..operators.windows import lag_of_existing
from .warehouse import Star

NEIGHBOURHOOD_KEYS = ["listing_neighbourhood"]
PROPERTY_KEYS = ["property_type", "room_type", "accomodates"]
DEC0 = "decimal(38,0)"


def avail() -> F.Column:
    return F.col("has_availability")


def est_price() -> F.Column:
    """Row-level estimate as DECIMAL(38,0): wide before it is multiplied or summed."""
    return (F.lit(30) - F.col("availability_30")).cast(DEC0) * F.col("price")


def listing_weights(dim_listing: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    """Tie weights of the latest-snapshot listing dimension: how many dim rows
    carry each (listing_id, keys, extra) combination."""
    return (dim_listing.where(F.col("listing_id").isNotNull())
            .groupBy("listing_id", *keys, *extra).agg(F.count("*").alias("w")))


def listing_counts(star: Star, keys: list[str]) -> DataFrame:
    """Weighted aggregates of fact NATURAL JOIN dim_listing per (keys, month),
    with the exact median of available prices, from one fact scan.

    The fact joins the tie-weight table (one row per distinct
    (listing, keys, rating)); AQE broadcasts it when it measures small, else
    shuffles on listing_id with skew splitting.  Every metric is additive
    except MIN/MAX/median, so a first hash aggregate (combined map-side)
    reduces the joined rows to (keys, month, price) partial sums; the second
    aggregate rolls those up and runs ``percentile`` over distinct prices
    only.  Sums of counts, nights and ratings within one price are BIGINT; whatever
    is multiplied by a price is DECIMAL(38,0) before it is summed."""
    f = star.fact.select("listing_id", "year_month", "has_availability", "price", "availability_30")
    w = listing_weights(star.dim_listing, keys, ["review_scores_rating"])
    j = f.join(w, "listing_id", "inner")
    wt, av, price = F.col("w"), avail(), F.col("price")
    rating = F.col("review_scores_rating")
    stay = F.lit(30) - F.col("availability_30")
    zero = F.lit(0)
    by_price = j.groupBy(*keys, "year_month", "price").agg(
        F.sum(wt).alias("n"),
        F.sum(F.when(av, wt).otherwise(zero)).alias("n_av"),
        F.sum(F.when(~av, wt).otherwise(zero)).alias("n_un"),
        F.sum(F.when(av, stay * wt)).alias("stays"),
        F.sum(F.when(av, rating * wt)).alias("r_sum"),
        F.sum(F.when(av & rating.isNotNull(), wt)).alias("r_cnt"))
    p_av = F.when(F.col("n_av") > 0, F.col("price"))
    agg = by_price.groupBy(*keys, "year_month").agg(
        F.sum("n").alias("total_count"),
        F.sum("n_av").alias("avail_count"),
        F.sum("n_un").alias("unavail_count"),
        F.min(p_av).alias("min_price"),
        F.max(p_av).alias("max_price"),
        F.percentile(p_av, F.lit(0.5), F.greatest(F.col("n_av"), F.lit(1))).alias("median_price"),
        F.sum(p_av.cast(DEC0) * F.col("n_av")).alias("price_sum"),
        F.sum(F.when(p_av.isNotNull(), F.col("n_av"))).alias("price_cnt"),
        F.sum("stays").alias("total_num_stay"),
        F.sum(F.col("price").cast(DEC0) * F.col("stays")).alias("total_rev"),
        F.sum("r_sum").alias("rating_sum"),
        F.sum("r_cnt").alias("rating_cnt"))
    return agg.withColumns({c: F.col(c).cast(DEC0) for c in
                            ("price_sum", "total_num_stay", "total_rev", "rating_sum")})


def weighted_median(df: DataFrame, groups: list[str], value: str, weight: str) -> DataFrame:
    """Exact interpolated median of ``value`` per group, each row counted
    ``weight`` times.

    A plain hash aggregate first reduces rows to (groups, value) -> total
    weight (combined map-side); ``percentile`` then runs over distinct values
    only, so its per-group buffers never see raw rows and the big aggregate
    stays a Tungsten hash aggregate."""
    reduced = (df.where(F.col(value).isNotNull())
                 .groupBy(*groups, value).agg(F.sum(weight).alias("__c")))
    return reduced.groupBy(*groups).agg(
        F.percentile(value, F.lit(0.5), F.col("__c")).alias("median_" + value))


def listing_hosts(star: Star, keys: list[str], by_month: bool = True) -> DataFrame:
    """COUNT(DISTINCT host_id) and distinct superhosts per (keys, month) over
    fact NATURAL JOIN dim_host (host_id, host_lga) NATURAL JOIN dim_listing.

    Only distinctness is read from that join, so the dimensions are reduced
    first (dim_host ties -> one row per (host, lga) with ``bool_or`` of the
    superhost flag; dim_listing -> distinct (listing, keys)) and the
    (keys, month, host, area) de-duplication is combined map-side.  NULL host_lga
    never matches (Q-05)."""
    g = keys + (["year_month"] if by_month else [])
    fh = (star.fact.where(F.col("host_id").isNotNull() & F.col("host_lga").isNotNull())
          .select("listing_id", "host_id", "host_lga", *(["year_month"] if by_month else [])))
    dh = (star.dim_host.where(F.col("host_id").isNotNull() & F.col("host_lga").isNotNull())
          .groupBy("host_id", "host_lga").agg(F.bool_or("host_is_superhost").alias("superhost")))
    dl = star.dim_listing.where(F.col("listing_id").isNotNull()).select("listing_id", *keys).distinct()
    # The fact is shuffled once, on listing_id; what meets the hosts is already distinct.
    per_area = fh.join(dl, "listing_id", "inner").select(*g, "host_id", "host_lga").distinct()
    per_host = (per_area.join(dh, ["host_id", "host_lga"], "inner")
                  .groupBy(*g, "host_id")
                  .agg(F.bool_or("superhost").alias("superhost")))
    return per_host.groupBy(*g).agg(
        F.count("*").alias("distinct_host_id"),
        F.count_if(F.col("superhost")).alias("distinct_superhost"))


def listing_lags(counts: DataFrame, keys: list[str]) -> DataFrame:
    """W-01..W-03 over existing groups (Q-01, Q-02, Q-19)."""
    out = lag_of_existing(counts, keys, "year_month", F.col("avail_count"),
                          F.col("avail_count") > 0, "lag_avail_count")
    out = lag_of_existing(out, keys, "year_month", F.col("unavail_count"),
                          F.col("unavail_count") > 0, "lag_unavail_count")
    return lag_of_existing(out, keys, "year_month", F.col("total_count"),
                           F.lit(True), "lag_total_count")


def listing_mart(star: Star, keys: list[str]) -> DataFrame:
    """M-18 / M-19 with the reference's DECIMAL scales."""
    counts = listing_lags(listing_counts(star, keys), keys)
    hosts = listing_hosts(star, keys)
    g = keys + ["year_month"]
    j = (counts.where((F.col("avail_count") > 0) & (F.col("unavail_count") > 0))
               .join(hosts.where(F.col("distinct_superhost") > 0), g, "inner"))
    return j.select(
        *g,
        pct6("avail_count", "total_count").alias("active_listing_rate"),
        F.col("min_price"), F.col("max_price"),
        F.col("median_price").cast(MEDIAN_TYPE).alias("med_price"),
        ratio6("price_sum", F.nullif(F.col("price_cnt"), F.lit(0))).alias("avg_price"),
        F.col("distinct_host_id"),
        pct6("distinct_superhost", "distinct_host_id").alias("superhost_rate"),
        ratio6("rating_sum", F.nullif(F.col("rating_cnt"), F.lit(0))).alias("avg_review_score"),
        pct_change("avail_count", "lag_avail_count").alias("active_pct_change"),
        pct_change("unavail_count", "lag_unavail_count").alias("inactive_pct_change"),
        F.col("total_num_stay"),
        ratio6("total_rev", "avail_count").alias("avg_est_price"))


DECIMAL_MART_COLUMNS = ["active_listing_rate", "med_price", "avg_price", "superhost_rate",
                        "avg_review_score", "active_pct_change", "inactive_pct_change",
                        "avg_est_price"]


def with_doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Expose decimal metrics as DOUBLE (engine-neutral comparison)."""
    return df.withColumns({c: as_double(c) for c in columns})


def neighbourhood_mart(star: Star) -> DataFrame:
    return listing_mart(star, NEIGHBOURHOOD_KEYS)


def property_mart(star: Star) -> DataFrame:
    return listing_mart(star, PROPERTY_KEYS)


# --- host mart -----------------------------------------------------------

def lga_suburb_counts(dim_lga_code: DataFrame) -> DataFrame:
    """k = number of suburb rows per (lga_code, lga_name) of the suburb-grain dim."""
    return (dim_lga_code.where(F.col("lga_code").isNotNull() & F.col("lga_name").isNotNull())
            .groupBy("lga_code", "lga_name").agg(F.count("*").alias("k")))


def fact_with_host_lga_name(star: Star) -> DataFrame:
    """fact INNER JOIN dim_lga_code ON host_lga = lga_code, one row per fact
    row and LGA name, carrying the suburb multiplicity k instead of k rows."""
    kt = lga_suburb_counts(star.dim_lga_code)
    f = star.fact.where(F.col("host_lga").isNotNull())
    return f.join(kt, f["host_lga"] == kt["lga_code"], "inner").drop(kt["lga_code"])


def host_cells(star: Star) -> DataFrame:
    """lga_name, year_month, listing, n, s: one row per listing (n = sum(k),
    s = sum(k * est)) and, with NULL listing, one per distinct host.

    Each fact row gives two cells, one under its listing and one under its host,
    so that one scan, one join and one aggregate (combined map-side) serve both."""
    fk = fact_with_host_lga_name(star).where(F.col("listing_id").isNotNull()
                                             & F.col("year_month").isNotNull())
    nothing = F.lit(0).cast(DEC0)
    cells = F.array(
        F.struct(F.col("listing_id").cast("bigint").alias("listing"), F.lit(None).cast("bigint").alias("host"),
                 F.col("k").alias("n"), (F.col("k") * est_price()).cast(DEC0).alias("s")),
        F.struct(F.lit(None).cast("bigint").alias("listing"), F.col("host_id").cast("bigint").alias("host"),
                 F.lit(0).cast("bigint").alias("n"), nothing.alias("s")))
    return (fk.select("lga_name", "year_month", F.explode(cells).alias("c"))
              .groupBy("lga_name", "year_month", F.col("c.listing").alias("listing"), F.col("c.host").alias("host"))
              .agg(F.sum("c.n").alias("n"), F.sum("c.s").alias("s")))


def host_mart(star: Star) -> DataFrame:
    """M-20..M-23 (no availability filter, Q-20)."""
    j = host_cells(star).groupBy("lga_name", "year_month").agg(
        F.count("host").alias("num_distinct_host"),
        F.sum(F.when(F.col("listing").isNotNull(), (F.col("n") * F.col("s")).cast(DEC0))).alias("total_rev"))
    return j.select(
        F.col("lga_name").alias("host_neighbourhood_lga"), "year_month", "num_distinct_host", "total_rev",
        ratio6("total_rev", F.nullif(F.col("num_distinct_host"), F.lit(0))).alias("avg_rev_per_host"))


def host_mart_parts(star: Star) -> tuple[DataFrame, DataFrame]:
    """Revenue and pair rows, and distinct hosts, per LGA name and month."""
    cells = host_cells(star)
    g = ["lga_name", "year_month"]
    rev = (cells.where(F.col("listing").isNotNull()).groupBy(*g)
           .agg(F.sum((F.col("n") * F.col("s")).cast(DEC0)).alias("total_rev"),
                F.sum(F.col("n") * F.col("n")).alias("pair_rows")))
    hosts = cells.groupBy(*g).agg(F.count("host").alias("num_distinct_host"))
    return rev, hosts


def host_pair_rows(star: Star) -> DataFrame:
    """Rows of the k-squared self-join per LGA name, counted without making them."""
    return host_mart_parts(star)[0].groupBy("lga_name").agg(F.sum("pair_rows").alias("pair_rows"))
