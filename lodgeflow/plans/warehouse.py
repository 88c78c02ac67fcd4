"""Warehouse layer (B-06..B-13): geography join, listing enrichment, the
monthly fact and latest-snapshot dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..operators.latest import latest_with_ties

FACT_COLUMNS = ["listing_id", "host_id", "listing_lga", "host_lga", "price",
                "has_availability", "availability_30", "year_month"]
DIM_HOST_COLUMNS = ["host_id", "host_name", "host_since", "host_is_superhost",
                    "host_neighbourhood", "host_lga"]
DIM_LISTING_BASE = ["listing_id", "listing_neighbourhood", "property_type", "room_type",
                    "accomodates", "number_of_reviews"]
REVIEW_COLUMNS = ["review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
                  "review_scores_checkin", "review_scores_communication", "review_scores_value"]


def lga_joined(suburb: DataFrame, code: DataFrame, g01: DataFrame, g02: DataFrame,
               g02_columns: list[str] | None = None) -> DataFrame:
    """B-06: suburb LEFT JOIN code, INNER JOIN g01, INNER JOIN g02.

    The inner joins on the nullable side reject the outer rows (Q-09), so
    suburbs whose LGA has no code are dropped; Catalyst turns the outer join
    into an inner one.  Codes are compared as numbers (int vs text, Q-10).
    Suburb grain: one row per suburb."""
    g02_columns = g02_columns or [c for c in g02.columns if c != "lga_code"]
    c = code.select(F.col("lga_name").alias("__c_name"),
                    F.col("lga_code").cast("bigint").alias("__c_code"))
    g1 = g01.withColumn("__g1_code", F.col("lga_code").cast("bigint"))
    g2 = g02.select(F.col("lga_code").cast("bigint").alias("__g2_code"), *g02_columns)
    out = (suburb.join(c, suburb["lga_name"] == c["__c_name"], "left")
                 .join(g1, F.col("__c_code") == F.col("__g1_code"), "inner")
                 .join(g2, F.col("__c_code") == F.col("__g2_code"), "inner"))
    return out.select(*[suburb[x] for x in suburb.columns], *[g1[x] for x in g01.columns],
                      *[F.col(x) for x in g02_columns])


def merge1(listing: DataFrame, code: DataFrame) -> DataFrame:
    """B-07: listing LEFT JOIN lga_code ON listing_neighbourhood = lga_name."""
    return lookup_join(listing, code, "listing_neighbourhood", "lga_name",
                       {"lga_code": "listing_lga"})


def listing_final(m1: DataFrame, host_lookup: DataFrame, lookup_key: str = "suburb_name") -> DataFrame:
    """B-08: merge1 LEFT JOIN lookup ON host_neighbourhood = ``lookup_key``;
    host_lga keeps the lookup's text type.  Duplicate names fan out (Q-14)."""
    lk = host_lookup.select(F.col(lookup_key), F.col("lga_code").cast("string").alias("lga_code"))
    return lookup_join(m1, lk, "host_neighbourhood", lookup_key, {"lga_code": "host_lga"})


def _there(final: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in final.columns]


def fact_listing(final: DataFrame) -> DataFrame:
    """B-09.  This and the dimensions have those of their columns that ``final`` has."""
    return final.select(*_there(final, FACT_COLUMNS))


def dim_host(final: DataFrame) -> DataFrame:
    """B-10: host attributes of the host's latest month, ties kept."""
    return latest_with_ties(final, "host_id", "year_month", _there(final, DIM_HOST_COLUMNS))


def dim_listing(final: DataFrame) -> DataFrame:
    """B-11: listing attributes of the listing's latest month, ties kept."""
    return latest_with_ties(final, "listing_id", "year_month", _there(final, DIM_LISTING_BASE + REVIEW_COLUMNS))


def dim_lga_suburb(suburb: DataFrame) -> DataFrame:
    """B-13."""
    return suburb.select("lga_name", "suburb_name")


@dataclass
class Star:
    fact: DataFrame
    dim_host: DataFrame | None
    dim_listing: DataFrame | None
    dim_lga_code: DataFrame
    dim_lga_suburb: DataFrame
    listing_final: DataFrame | None = None   # the enriched table the star derives from


def build_star(final: DataFrame, joined: DataFrame, suburb: DataFrame) -> Star:
    """A dimension whose key ``final`` lacks is None."""
    return Star(fact=fact_listing(final),
                dim_host=dim_host(final) if "host_id" in final.columns else None,
                dim_listing=dim_listing(final) if "listing_id" in final.columns else None, dim_lga_code=joined,
                dim_lga_suburb=dim_lga_suburb(suburb), listing_final=final)
