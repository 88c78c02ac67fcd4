"""Staging layer from raw CSV files (B-01..B-05, K-04..K-07).

The reference types by position, then rewrites whole tables in place
(ALTER/UPDATE).  On immutable DataFrames the rewrites are column
expressions in the same select, so each staging table is one scan.
Casts follow the warehouse rules: numeric text to integer rounds, and a value
that cannot be cast fails the job, naming its column and file.  ``lenient``
makes it NULL instead; ``staging_rejects`` counts such values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rounding_int
from ..functions.text import month_from_file_name, strip_code_prefix
from ..sources import csv_files as C

LISTING_TEXT = {"host_name", "host_since", "host_neighbourhood", "listing_neighbourhood",
                "property_type", "room_type"}
LISTING_BOOL = {"host_is_superhost", "has_availability"}


def _bool(c: str):
    """Text -> boolean as the warehouse casts it: t/true/y/yes/1/on and
    f/false/n/no/0/off in any case; anything else becomes NULL."""
    v = F.lower(F.trim(F.col(c)))
    return (F.when(v == "on", F.lit(True)).when(v == "off", F.lit(False))
             .otherwise(v.try_cast("boolean")))


def _read(c: str, typed: Column, lenient: bool) -> Column:
    """``typed``, or an error where there is text that it could not read."""
    if lenient:
        return typed
    said = F.concat(F.lit(f"column {c}: cannot read '"), F.col(c), F.lit("' in "), F.col("file_path"))
    return F.when(F.col(c).isNotNull() & typed.isNull(), F.raise_error(said)).otherwise(typed)


def _listing_types() -> dict[str, Column]:
    """The typed form of each listing column that is not text."""
    out = {}
    for c in C.LISTING_COLUMNS:
        if c == "scraped_date":
            out[c] = F.try_to_date(F.col(c), C.DATE_FORMAT)
        elif c in LISTING_BOOL:
            out[c] = _bool(c)
        elif c not in LISTING_TEXT:
            out[c] = rounding_int(c)
    return out


def staging_listing_from_raw(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """B-01: typed listing snapshot rows with the month of the file name.

    mth / yr are substrings of the file name; year_month is built from them
    (K-04/K-05); neighbourhood names are upper-cased (F-01)."""
    name = F.split_part(F.col("file_path"), F.lit("/"), F.lit(-1))
    types = _listing_types()
    cols = []
    for c in C.LISTING_COLUMNS:
        if c in types:
            cols.append(_read(c, types[c], lenient).alias(c))
        elif c in ("listing_neighbourhood", "host_neighbourhood"):
            cols.append(F.upper(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    month = month_from_file_name("file_path")
    if not lenient:
        month = F.coalesce(month, F.raise_error(F.concat(F.lit("no month in file name "), F.col("file_path"))))
    cols += [F.substring(name, 1, 2).alias("mth"), F.substring(name, 4, 4).alias("yr"),
             month.alias("year_month")]
    return raw.select(*cols)


def staging_census_g01_from_raw(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """B-02: code prefix stripped (K-06), counts rounded to integers."""
    return raw.select(_read("lga_code", strip_code_prefix("lga_code"), lenient).alias("lga_code"),
                      *[_read(c, rounding_int(c), lenient).alias(c) for c in C.G01_COLUMNS[1:]])


def staging_census_g02_from_raw(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """B-03: fractional averages lose their fraction by rounding (Q-11)."""
    return raw.select(_read("lga_code", strip_code_prefix("lga_code"), lenient).alias("lga_code"),
                      *[_read(c, rounding_int(c), lenient).alias(c) for c in C.G02_COLUMNS[1:]])


def staging_lga_code_from_raw(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """B-04: integer code, upper-case name (K-07)."""
    return raw.select(_read("lga_code", rounding_int("lga_code").cast("int"), lenient).alias("lga_code"),
                      F.upper("lga_name").alias("lga_name"))


def staging_lga_suburb_from_raw(raw: DataFrame) -> DataFrame:
    """B-05: upper-case LGA name only; suburb names keep their case (Q-13)."""
    return raw.select(F.upper("lga_name").alias("lga_name"), F.col("suburb_name"))


def staging_tables(spark: SparkSession, src: dict[str, str], multiline: bool = True,
                   lenient: bool = False) -> dict:
    """All five staging tables from raw folders keyed listing/g01/g02/code/suburb."""
    raw = _raw_tables(spark, src, multiline)
    return {
        "staging_listing": staging_listing_from_raw(raw["staging_listing"], lenient),
        "staging_census_g01": staging_census_g01_from_raw(raw["staging_census_g01"], lenient),
        "staging_census_g02": staging_census_g02_from_raw(raw["staging_census_g02"], lenient),
        "staging_lga_code": staging_lga_code_from_raw(raw["staging_lga_code"], lenient),
        "staging_lga_suburb": staging_lga_suburb_from_raw(raw["staging_lga_suburb"]),
    }


def _raw_tables(spark: SparkSession, src: dict[str, str], multiline: bool) -> dict[str, DataFrame]:
    return {
        "staging_listing": C.raw_listing(spark, src["listing"], multiline),
        "staging_census_g01": C.raw_census_g01(spark, src["g01"], multiline),
        "staging_census_g02": C.raw_census_g02(spark, src["g02"], multiline),
        "staging_lga_code": C.raw_lga_code(spark, src["code"], multiline),
        "staging_lga_suburb": C.raw_lga_suburb(spark, src["suburb"], multiline),
    }


def staging_rejects(spark: SparkSession, src: dict[str, str], multiline: bool = True) -> DataFrame:
    """How many values of each staging column could not be read, by file: rows
    (table, column, file_path, rejected), none where all values could."""
    types = {
        "staging_listing": _listing_types() | {"year_month": month_from_file_name("file_path")},
        "staging_census_g01": {"lga_code": strip_code_prefix("lga_code")}
        | {c: rounding_int(c) for c in C.G01_COLUMNS[1:]},
        "staging_census_g02": {"lga_code": strip_code_prefix("lga_code")}
        | {c: rounding_int(c) for c in C.G02_COLUMNS[1:]},
        "staging_lga_code": {"lga_code": rounding_int("lga_code").cast("int")},
    }
    parts = []
    for table, raw in _raw_tables(spark, src, multiline).items():
        if table not in types:
            continue
        counts = raw.groupBy("file_path").agg(*[
            F.count_if((F.lit(True) if c == "year_month" else F.col(c).isNotNull()) & t.isNull()).alias(c)
            for c, t in types[table].items()])
        parts.append(counts.unpivot("file_path", list(types[table]), "column", "rejected")
                     .where(F.col("rejected") > 0)
                     .select(F.lit(table).alias("table"), "column", "file_path", "rejected"))
    return reduce(DataFrame.unionByName, parts)
