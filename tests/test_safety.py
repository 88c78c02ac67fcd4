"""Inputs and settings that must not lose, repeat or bend data without an error."""

import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.errors import PySparkException

from lodgeflow.plans import analysis as A
from lodgeflow.plans import marts as M
from lodgeflow.plans.catalog import QUERIES
from lodgeflow.plans.pipeline import register_catalog, run_pipeline, write_table
from lodgeflow.plans.staging import staging_listing_from_raw, staging_rejects
from lodgeflow.plans.warehouse import Star
from lodgeflow.session import checkpoint_root
from lodgeflow.sources.csv_files import raw_listing
from lodgeflow.streaming.refresh import refresh_listing_staging

from .conftest import ROOT, SMALL_SF
from .fixtures import HEADER_LISTING, listing_rows, write_csv, write_fixture, write_listing_month


def cli(*args):
    subprocess.run([sys.executable, "-m", "lodgeflow", *args, "--master", "local[2]"], cwd=ROOT, check=True,
                   capture_output=True, timeout=600)


def test_refresh_command_finds_its_checkpoint_again():
    """Two processes, no --checkpoint: a new file is added, nothing twice."""
    root = tempfile.mkdtemp(prefix="lodgeflow-cli-")
    src, dst = os.path.join(root, "listings"), os.path.join(root, "stg")
    write_listing_month(root, 1)
    write_listing_month(root, 2)
    cli("refresh", "--src", src, "--dst", dst)
    write_listing_month(root, 3)
    cli("refresh", "--src", src, "--dst", dst, "--max-files", "1")
    import pyarrow.dataset as ds
    files = [f for f in ds.dataset(dst, format="parquet", exclude_invalid_files=True).files if f.endswith(".parquet")]
    assert sum(ds.dataset(f).count_rows() for f in files) == 12 + 12 + 12


def test_refresh_sees_changes(spark):
    root = tempfile.mkdtemp(prefix="lodgeflow-re-")
    src, dst = os.path.join(root, "listings"), os.path.join(root, "stg")
    write_listing_month(root, 1)
    write_listing_month(root, 2)
    n = spark.read.format("csv").option("header", True).load(src).count()
    assert refresh_listing_staging(spark, src, dst) == 1
    assert refresh_listing_staging(spark, src, dst) == 0
    assert spark.read.parquet(dst).count() == n
    name = next(f for f in sorted(os.listdir(src)) if f.endswith(".csv"))
    write_csv(os.path.join(src, name), HEADER_LISTING, listing_rows(1)[:5])
    now = spark.read.format("csv").option("header", True).load(src).count()
    assert now < n
    refresh_listing_staging(spark, src, dst)
    assert spark.read.parquet(dst).count() == now
    with pytest.raises(ValueError, match="another folder"):
        refresh_listing_staging(spark, root, dst)
    with pytest.raises(ValueError, match="full refresh"):
        refresh_listing_staging(spark, src, dst, checkpoint=os.path.join(root, "elsewhere"))


def test_every_catalogued_table_has_its_rows(spark):
    root, dst = (tempfile.mkdtemp(prefix=f"lodgeflow-{k}-") for k in "cd")
    write_fixture(root, months=(1, 2))
    out = run_pipeline(spark, root, dst, catalog=True)
    paths = {f"{layer}.{t}": os.path.join(dst, layer, t) for layer in ("staging", "datawarehouse", "datamart")
             for t in os.listdir(os.path.join(dst, layer))}
    register_catalog(spark, paths)
    for name in paths:
        assert spark.table(name).count() == out[name.split(".")[1]].count(), name


def test_overwrite_drops_old_partitions_in_dynamic_mode(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="lodgeflow-o-"), "t")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), path, ["p"])
        assert write_table(spark.createDataFrame([(3, 3)], "v int, p int"), path, ["p"]).count() == 1
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_beyond_bigint(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        price = 10 ** 17
        fact = spark.createDataFrame(
            [(k, 1, 1, "1", price, True, 0, None) for k in range(4)],
            "listing_id long, host_id long, listing_lga long, host_lga string, price long, "
            "has_availability boolean, availability_30 int, year_month date")
        dim = spark.createDataFrame([(k, "X", 90) for k in range(4)],
                                    "listing_id long, listing_neighbourhood string, review_scores_rating int")
        star = Star(fact=fact, dim_host=None, dim_listing=dim, dim_lga_code=None, dim_lga_suburb=None, listing_final=None)
        assert A.best_neighbourhood(star).first().total_rev == 4 * 30 * price
        assert M.listing_counts(star, ["listing_neighbourhood"]).first().total_rev == 4 * 30 * price
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def bad_listing(change, name="01_2021.csv"):
    root = tempfile.mkdtemp(prefix="lodgeflow-bad-")
    rows = listing_rows(1)
    change(rows)
    write_csv(os.path.join(root, name), HEADER_LISTING, rows)
    return root


def test_unreadable_values_fail_or_are_counted(spark):
    def price(rows):
        rows[0][12] = "$1200"
    root = bad_listing(price)
    raw = raw_listing(spark, root)
    with pytest.raises(PySparkException, match="column price: cannot read"):
        staging_listing_from_raw(raw).collect()
    assert staging_listing_from_raw(raw, lenient=True).where("price is null").count() >= 1
    src = {k: root for k in ("listing", "g01", "g02", "code", "suburb")}
    empty = tempfile.mkdtemp(prefix="lodgeflow-ok-")
    write_fixture(empty, months=(1,))
    src = {"listing": root} | {k: empty for k in ("g01", "g02", "code", "suburb")}
    found = {(r.table, r.column): r.rejected for r in staging_rejects(spark, src).collect()}
    assert found[("staging_listing", "price")] == 1


def test_file_name_without_month_fails(spark):
    root = bad_listing(lambda rows: None, "listings_2020_05.csv")
    with pytest.raises(PySparkException, match="no month in file name"):
        staging_listing_from_raw(raw_listing(spark, root)).collect()


def test_quoted_newline_is_read_by_default(spark):
    def name(rows):
        rows[0][4] = '"Smith,\nJ"'
    assert raw_listing(spark, bad_listing(name)).count() == 12


def test_checkpoint_root_is_stable(spark):
    assert checkpoint_root(spark) == checkpoint_root(spark)


def test_changed_inputs_are_seen_and_nothing_is_written(spark):
    """Folder-shaped tables under a URI; the second read sees the new part."""
    root = tempfile.mkdtemp(prefix="lodgeflow-in-")
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        spark.read.parquet(f"{SMALL_SF}/{t}.parquet").coalesce(1).write.parquet(f"{root}/{t}.parquet")
    n = QUERIES["fact_listing"](spark, f"file://{root}").count()
    few = spark.read.parquet(f"{SMALL_SF}/lineitem.parquet").limit(1000)
    few.write.mode("overwrite").parquet(f"{root}/lineitem.parquet")
    assert QUERIES["fact_listing"](spark, f"file://{root}").count() == 1000 < n


def test_suburb_list_reads_its_own_tables_only(spark):
    scans = QUERIES["dim_lga_suburb"](spark, SMALL_SF).inputFiles()
    assert {os.path.basename(f) for f in scans} == {"supplier.parquet", "nation.parquet"}


def test_two_codes_for_one_name_are_an_error(spark):
    from pyspark.sql import functions as F
    lga = spark.createDataFrame([("A", "1", 5), ("A", "2", 6), ("B", "3", 7)], "lga_name string, lga_code string, Age_20_24_yr_P int")
    fact = spark.createDataFrame([(1,), (2,), (3,)], "listing_lga int")
    star = Star(fact=fact, dim_host=None, dim_listing=None, dim_lga_code=lga, dim_lga_suburb=None, listing_final=None)
    assert A.lga_population(star, F.lit("B")).first() == ("B", 7)
    assert A.lga_population(star, F.lit("C")).collect() == []
    with pytest.raises(Exception, match="(?i)scalar.subquery|more than one row"):
        A.lga_population(star, F.lit("A")).collect()
