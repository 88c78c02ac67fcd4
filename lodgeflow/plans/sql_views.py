"""Ad hoc Spark SQL over temporary views of the warehouse (K-02, P-18..P-20).

A view's plan is taken when a statement is analysed, so registering other tables under the same
names later leaves frames that were made before as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .driver_star import analogue_star
from .pipeline import register_views

#: A CTE inside a derived table (P-18): months of each area in which much was open.
BUSY_MONTHS = """
SELECT t.listing_lga, count(*) AS busy_months, max(t.open_rows) AS most_open
FROM (WITH open_rows_of AS (SELECT listing_lga, year_month FROM fact_listing WHERE has_availability = TRUE)
      SELECT listing_lga, year_month, count(*) AS open_rows FROM open_rows_of GROUP BY listing_lga, year_month) t
WHERE t.open_rows >= 2
GROUP BY t.listing_lga
"""

#: Columns that use the aliases of earlier ones in the same list (P-19).
WORTH = """
SELECT listing_id, host_id, year_month, price,
       30 - availability_30 AS nights, nights * price AS worth, worth >= 1000000 AS is_large
FROM fact_listing
"""

#: Grouping by the aliases of computed columns (P-20).
YEARLY = """
SELECT year(year_month) AS yr, listing_lga = CAST(host_lga AS INT) AS at_home, count(*) AS row_count,
       sum(CAST(price AS DECIMAL(38,0))) AS price_total
FROM fact_listing
GROUP BY yr, at_home
"""


def over_views(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """The warehouse tables as temporary views, and a statement over them."""
    star = analogue_star(spark, sf_dir)
    register_views({"fact_listing": star.fact, "dim_host": star.dim_host, "dim_listing": star.dim_listing,
                    "dim_lga_code": star.dim_lga_code, "dim_lga_suburb": star.dim_lga_suburb})
    return spark.sql(statement)
