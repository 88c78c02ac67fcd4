"""The star schema over the driver's parquet tables, as lazy plans (see
``sources/analogue.py`` for the mapping).

Each query plans its tables from the raw scans, so a changed input is always seen, whatever
store it is in.  ``analogue_star`` is lazy, for queries that read the enriched listings once.
``shared_star`` is for queries whose branches read them several times: the listings are joined once and
written, with the columns that the query needs, to the session's shared folder, and
every branch reads that table.  Written layers are ``plans/pipeline.run_pipeline``'s work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import analogue
from ..sources.storage import written_once
from .warehouse import Star, build_star, lga_joined, listing_final, merge1


def analogue_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Staging and enrichment tables by name."""
    listing = analogue.staging_listing(spark, sf_dir)
    code = analogue.staging_lga_code(spark, sf_dir)
    suburb = analogue.staging_lga_suburb(spark, sf_dir)
    joined = lga_joined(suburb, code, analogue.staging_census_g01(spark, sf_dir),
                        analogue.staging_census_g02(spark, sf_dir))
    m1 = merge1(listing, code)
    # The analogue resolves a host's area by LGA name (see README).
    final = listing_final(m1, code, lookup_key="lga_name")
    return {"lga_suburb": suburb, "lga_joined": joined, "merge1": m1, "listing_final": final}


def analogue_star(spark: SparkSession, sf_dir: str) -> Star:
    layers = analogue_layers(spark, sf_dir)
    return build_star(layers["listing_final"], layers["lga_joined"], layers["lga_suburb"])


def shared_star(spark: SparkSession, sf_dir: str, columns: list[str]) -> Star:
    """The star over one written build of the enriched listings: the month and ``columns`` of them."""
    layers = analogue_layers(spark, sf_dir)
    final = layers["listing_final"].select("year_month", *columns)
    return build_star(written_once(final, "listing_final"), layers["lga_joined"], layers["lga_suburb"])
