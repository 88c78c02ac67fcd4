"""How often line items are shuffled on their way to the listings."""

import contextlib
import glob
import gzip
import os

from lodgeflow.sources import analogue, raw_files
from lodgeflow.sources import csv_files as C

from .conftest import SMALL_SF


@contextlib.contextmanager
def setting(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_listings_are_not_shuffled_by_supplier(spark):
    """One shuffle by part and one by order, where neither side is broadcast; suppliers and nations
    go to the tasks after a count."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        lines = plan(analogue.staging_listing(spark, SMALL_SF))
    dealt = [x for x in lines if "Exchange hashpartitioning(l_" in x]
    assert sorted(x.split("hashpartitioning(")[1].split("#")[0] for x in dealt) == ["l_orderkey", "l_partkey"]
    assert not any("nationkey" in x for x in lines if "hashpartitioning" in x)


def test_raw_listings_are_dealt_before_they_are_text(spark):
    lines = plan(raw_files.listing_text(spark, SMALL_SF))
    dealt = [x for x in lines if "REBALANCE" in x]
    assert len(dealt) == 1 and "year_month" in dealt[0]


def test_raw_listings_are_sorted_before_they_are_text(spark):
    """The writer sorts rows by file unless it knows that they are: then the sorter holds no text."""
    df = raw_files.listing_text(spark, SMALL_SF)
    order = df._jdf.queryExecution().optimizedPlan().outputOrdering().toString()
    assert "file#" in order and not df.schema["file"].nullable
    ranks = [x for x in plan(df) if "Sort [file" in x]
    assert len(ranks) == 1 and "false" in ranks[0]


def test_landed_listings_are_compressed_and_whole(spark):
    """Landed text takes less than 0.4 of its bytes on disk, and every row is read back."""
    folder = raw_files.land_all(spark, SMALL_SF, "listing", "code")
    files = glob.glob(f"{folder.removeprefix('file://')}/listings/*")
    assert files and all(f.endswith(".csv.gz") for f in files)
    text = sum(len(gzip.open(f).read()) for f in files)
    assert sum(os.path.getsize(f) for f in files) < 0.4 * text
    rows = C.raw_listing(spark, folder, gzipped=True)
    assert rows.count() == spark.read.parquet(f"{SMALL_SF}/lineitem.parquet").count()
    assert rows.where("host_name not like '%\n\"ROOM_%'").count() == 0


def test_a_compressed_file_is_read_only_where_it_is_asked_for(spark, tmp_path):
    line = ",".join(["1"] * len(C.LISTING_COLUMNS)) + "\n"
    for name, n in (("01_2020.csv", 1), ("02_2020.csv.gz", 2), ("02_2020.csv.gz.gz", 4), ("03.csv.gz", 8)):
        with (gzip.open if name.endswith(".gz") else open)(tmp_path / name, "wt") as f:
            f.write("head" + line + n * line)
    assert C.raw_listing(spark, str(tmp_path)).count() == 1
    assert C.raw_listing(spark, str(tmp_path), gzipped=True).count() == 2


def test_numbers_that_no_part_or_order_takes_raise_nothing(spark, tmp_path):
    """A quantity beyond an int is cast after the joins, which drop its row."""
    for name in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        rows = spark.read.parquet(f"{SMALL_SF}/{name}.parquet").limit(200)
        if name == "lineitem":
            odd = rows.limit(1).selectExpr(*[
                "-1L as l_orderkey" if c == "l_orderkey" else "1e12 as l_quantity" if c == "l_quantity" else c for c in rows.columns])
            rows = rows.unionByName(odd)
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    out = analogue.staging_listing(spark, str(tmp_path)).collect()
    assert all(r.scrape_id >= 0 for r in out)
