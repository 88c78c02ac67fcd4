"""Raw-layer CSV sources (S-01..S-11).

The raw files are read positionally: one header line is skipped and columns
get their names by position from a fixed all-text schema, so no schema is
inferred and a renamed header cannot shift columns.  Typing happens in the
staging layer.  Format (fixed values of the raw layer): comma separated,
optional double-quote enclosure, day-first dates, four null tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import null_tokens_to_null
from .storage import hadoop

# Positional column names of each raw file.
LISTING_COLUMNS = [
    "listing_id", "scrape_id", "scraped_date", "host_id", "host_name", "host_since",
    "host_is_superhost", "host_neighbourhood", "listing_neighbourhood", "property_type",
    "room_type", "accomodates", "price", "has_availability", "availability_30",
    "number_of_reviews", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_value",
]
AGE_BANDS = ["0_4", "5_14", "15_19", "20_24", "25_34", "35_44", "45_54", "55_64", "65_74", "75_84"]
G01_COLUMNS = (["lga_code", "tot_p_m", "tot_p_f"]
               + [f"Age_{b}_yr_{s}" for b in AGE_BANDS for s in ("M", "F", "P")]
               + ["Age_85ov_M", "Age_85ov_F", "Age_85ov_P"])
G02_COLUMNS = [
    "lga_code", "median_age_persons", "median_mortage_repay_monthly",
    "median_tot_prsnl_inc_weekly", "median_rent_weekly", "median_tot_fam_inc_weekly",
    "average_num_psns_per_bedroom", "median_tot_hhd_inc_weekly", "average_household_size",
]
LGA_CODE_COLUMNS = ["lga_code", "lga_name"]
LGA_SUBURB_COLUMNS = ["lga_name", "suburb_name"]

# Patterns of each raw dataset, which must match a file's whole path below the raw folder.
LISTING_PATTERN = ".*_20.*[.]csv"
G01_PATTERN = ".*G01.*[.]csv"
G02_PATTERN = ".*G02.*[.]csv"
LGA_CODE_PATTERN = ".*LGA_CODE[.]csv"
LGA_SUBURB_PATTERN = ".*LGA_SUBURB[.]csv"

DATE_FORMAT = "dd/MM/yyyy"


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def csv_reader(spark: SparkSession, names: list[str], multiline: bool = True, streaming: bool = False):
    """A configured (batch or streaming) CSV reader for positional text columns.

    ``multiline`` reads newlines inside quoted fields, as the raw format allows
    them; each file is then one split.  Turn it off for files without such fields."""
    r = spark.readStream if streaming else spark.read
    return (r.schema(text_schema(names))
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("multiLine", multiline)
            .option("recursiveFileLookup", True))


def raw_folder(spark: SparkSession, path: str) -> str:
    """The folder below which paths are matched, as file paths spell it: a file's own folder,
    and of a glob what stands before it."""
    fs, p = hadoop(spark, path)
    while any(c in p.getName() for c in "*?[{") or (fs.exists(p) and fs.getFileStatus(p).isFile()):
        p = p.getParent()
    return fs.makeQualified(p).toUri().getRawPath().rstrip("/")


def in_dataset(spark: SparkSession, path: str, pattern: str, file_path: str = "_metadata.file_path",
               gzipped: bool = False) -> Column:
    """S-04..S-08: files whose path below ``path`` matches ``pattern`` whole; if ``gzipped``, followed
    by ``.gz``.  All raw datasets share one folder tree; a batch scan tests the path when it lists
    files and opens no other."""
    end = "[.]gz" if gzipped else ""
    return F.col(file_path).rlike(f"^[^:/]+:(//[^/]*)?\\Q{raw_folder(spark, path)}\\E/(?:{pattern}){end}$")


def clean_tokens(df: DataFrame, names: list[str]) -> DataFrame:
    """S-02: every null token becomes NULL, keeping the file path column."""
    return df.select(*[null_tokens_to_null(c).alias(c) for c in names],
                     F.col("_metadata.file_path").alias("file_path"))


def read_raw(spark: SparkSession, path: str, names: list[str], pattern: str,
             multiline: bool = True, gzipped: bool = False) -> DataFrame:
    """S-01/S-09/S-10: batch scan; listing the folder again on every call is
    the refresh of S-11.  ``gzipped`` reads the dataset's compressed files, and no others."""
    df = csv_reader(spark, names, multiline).load(path, format="csv")
    return clean_tokens(df.where(in_dataset(spark, path, pattern, gzipped=gzipped)), names)


def raw_listing(spark, path, multiline=True, gzipped=False):
    return read_raw(spark, path, LISTING_COLUMNS, LISTING_PATTERN, multiline, gzipped)


def raw_census_g01(spark, path, multiline=True):
    return read_raw(spark, path, G01_COLUMNS, G01_PATTERN, multiline)


def raw_census_g02(spark, path, multiline=True):
    return read_raw(spark, path, G02_COLUMNS, G02_PATTERN, multiline)


def raw_lga_code(spark, path, multiline=True):
    return read_raw(spark, path, LGA_CODE_COLUMNS, LGA_CODE_PATTERN, multiline)


def raw_lga_suburb(spark, path, multiline=True):
    return read_raw(spark, path, LGA_SUBURB_COLUMNS, LGA_SUBURB_PATTERN, multiline)
