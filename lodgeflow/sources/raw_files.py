"""The driver tables as raw CSV files, laid out as a landing folder: dated listing files and the
census and area files beside them.

Rows are written by Spark in as many files as the data needs; then each file gets its raw name, by a
rename.  What the raw format allows is in them: quoted newlines and quotes, each null token,
fractions in whole-number columns, code prefixes, mixed case.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS
from ..session import checkpoint_root
from . import analogue
from . import csv_files as C
from .storage import exists, hadoop, remove, rename
from .tables import read_table

#: The snapshot months of the driver's ship dates, moved into the years of the raw file names.
YEARS_LATER = 10


def token(pick: Column) -> Column:
    """One of the null tokens, by a whole number."""
    return F.get(F.array(*[F.lit(t) for t in NULL_TOKENS]), F.pmod(pick.cast("int"), F.lit(len(NULL_TOKENS))))


def listing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows, all text, and the name (``file``) under which each is filed.  They come dealt by
    month, which is one file name, and sorted by it, as the writer needs them: rows are shuffled and
    sorted before they get their text, not after."""
    later = F.add_months("scraped_date", 12 * YEARS_LATER)
    rows = (analogue.listings_by_month(spark, sf_dir)
            .withColumn("file", F.coalesce(F.date_format(later, "MM_yyyy"), F.lit("")))   # no NULL: the writer knows the order
            .sortWithinPartitions("file"))
    nothing = token(F.col("number_of_reviews"))
    flag = lambda c: F.when(F.col(c), F.lit("t")).otherwise(F.lit("f"))
    made = {
        "scraped_date": F.date_format(later, C.DATE_FORMAT),
        "host_name": F.concat("host_name", F.lit('\n"'), "room_type", F.lit('", said so')),
        "host_is_superhost": flag("host_is_superhost"),
        "host_neighbourhood": F.coalesce(F.lower("host_neighbourhood"), nothing),
        "listing_neighbourhood": F.initcap("listing_neighbourhood"),
        "accomodates": F.concat(F.col("accomodates").cast("string"), F.lit(".4")),
        "price": F.concat(F.col("price").cast("string"), F.lit(".5")),
        "has_availability": flag("has_availability"),
        "review_scores_rating": F.when(F.col("number_of_reviews") > 3, F.col("review_scores_rating").cast("string")).otherwise(nothing),
    }
    cols = [made.get(c, F.col(c).cast("string") if c in rows.columns else nothing).alias(c) for c in C.LISTING_COLUMNS]
    return rows.select(*cols, "file")


def _census(spark: SparkSession, sf_dir: str, columns: list[str], fraction: str, every: int) -> DataFrame:
    """One row for each nation: column i holds its customers plus i, each ``every``-th one a null token."""
    people = read_table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    cells = [(token(F.col("c_nationkey")) if i % every == 0
              else F.concat((F.col("n") + i).cast("string"), F.lit(fraction))).alias(c)
             for i, c in enumerate(columns) if i]
    return people.select(F.concat(F.lit("LGA"), F.lpad(F.col("c_nationkey").cast("string"), 5, "0")).alias("lga_code"), *cells)


def census_g01_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _census(spark, sf_dir, C.G01_COLUMNS, ".4", 5).withColumn("file", F.lit("census_G01"))


def census_g02_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _census(spark, sf_dir, C.G02_COLUMNS, ".5", 4).withColumn("file", F.lit("census_G02"))


def lga_code_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (analogue.raw_lga_code(spark, sf_dir)
            .select(F.col("lga_code").cast("string"), F.initcap("lga_name").alias("lga_name"), F.lit("LGA_CODE").alias("file")))


def lga_suburb_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (analogue.raw_lga_suburb(spark, sf_dir)
            .select(F.lower("lga_name").alias("lga_name"), "suburb_name", F.lit("LGA_SUBURB").alias("file")))


def landing_folder(spark: SparkSession) -> str:
    """A new folder in the session's shared folder, which goes when the application ends."""
    path = f"{checkpoint_root(spark)}/raw-{uuid.uuid4().hex}"
    fs, p = hadoop(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def land(rows: DataFrame, folder: str, name: str, dealt: bool = False) -> None:
    """Writes ``rows`` as CSV files below ``folder``: ``name`` is a template of the row's ``file`` and a
    number, and files whose names end in ``.gz`` are compressed.  A file value with many rows is dealt
    to several files; ``dealt`` rows are so already."""
    spark = rows.sparkSession
    work = f"{folder}/_work-{uuid.uuid4().hex}"
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"} if name.endswith(".gz") else {}
    ((rows if dealt else rows.hint("rebalance", "file")).write.partitionBy("file")
     .options(header=True, quote='"', escape='"', **packed).csv(work))
    fs, p = hadoop(spark, work)
    for value in [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]:
        label = value.getName().split("=", 1)[1]
        for k, part in enumerate(sorted(s.getPath().toString() for s in fs.listStatus(value))):
            target = f"{folder}/{name.format(file=label, number=k)}"
            parent = target.rsplit("/", 1)[0]
            if not exists(spark, parent):
                fs.mkdirs(hadoop(spark, parent)[1])
            rename(spark, part, target)
    remove(spark, work)


def land_all(spark: SparkSession, sf_dir: str, *datasets: str) -> str:
    """A landing folder with the named raw datasets (listing, g01, g02, code, suburb)."""
    folder = landing_folder(spark)
    for d in datasets:
        make, name = DATASETS[d]
        land(make(spark, sf_dir), folder, name, dealt=d == "listing")
    return folder


DATASETS = {
    "listing": (listing_text, "listings/{file}_{number}.csv.gz"),
    "g01": (census_g01_text, "census/{file}_{number}.csv"),
    "g02": (census_g02_text, "census/{file}_{number}.csv"),
    "code": (lga_code_text, "areas/{number}_{file}.csv"),
    "suburb": (lga_suburb_text, "areas/{number}_{file}.csv"),
}
