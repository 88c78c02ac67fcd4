"""Tables that survive a failed rebuild, raw files chosen by their whole path, and plans that read the
line items once."""

import os
import re
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from lodgeflow.operators.latest import latest_counts, latest_with_ties
from lodgeflow.plans.catalog import QUERIES
from lodgeflow.plans.pipeline import write_table
from lodgeflow.sources import csv_files as C
from lodgeflow.sources import storage

from .conftest import ROOT, SMALL_SF

SLOW_WRITER = """
import sys, time
sys.path.insert(0, sys.argv[1])
from lodgeflow.plans.pipeline import write_table
from lodgeflow.session import build_session
spark = build_session("local[2]", 2)

mark = sys.argv[3]

def slow(batches):
    for b in batches:
        open(mark, "w").close()
        time.sleep(600)
        yield b

write_table(spark.range(10).mapInArrow(slow, "id long"), sys.argv[2])
"""


def folders(tmp_path):
    return sorted(os.listdir(tmp_path))


def test_a_killed_rebuild_leaves_the_old_rows(spark, tmp_path):
    (tmp_path / "tables").mkdir()
    mark, tmp_path = tmp_path / "mark", tmp_path / "tables"
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    writer = subprocess.Popen([sys.executable, "-c", SLOW_WRITER, ROOT, path, str(mark)], start_new_session=True)
    try:
        for _ in range(240):
            if mark.exists():
                break
            time.sleep(0.5)
        assert mark.exists() and writer.poll() is None
    finally:
        os.killpg(writer.pid, signal.SIGKILL)
        writer.wait()
    assert spark.read.parquet(path).count() == 5
    assert len(folders(tmp_path)) == 2              # the unfinished table lies beside it
    assert write_table(spark.range(7), path).count() == 7
    assert folders(tmp_path) == ["t"]


def test_a_failed_rebuild_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="no such luck"):
        write_table(spark.range(9).select(F.raise_error(F.lit("no such luck")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5


def test_a_swap_that_stopped_between_its_renames_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    os.rename(path, path + storage.OLD + "1")
    spark.range(3).write.parquet(path + storage.NEW + "1")
    storage.restore(spark, path)
    assert folders(tmp_path) == ["t"] and spark.read.parquet(path).count() == 5


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    old = write_table(spark.range(5), path)
    assert write_table(old.where("id > 1"), path).count() == 3


@pytest.mark.parametrize("name,pattern", [
    ("listings_2020/january.csv", C.LISTING_PATTERN), ("G01/people.csv", C.G01_PATTERN), ("G02/money.csv", C.G02_PATTERN),
    ("deep/er/LGA_CODE.csv", C.LGA_CODE_PATTERN), ("LGA_SUBURB.csv", C.LGA_SUBURB_PATTERN)])
def test_files_are_told_apart_by_their_whole_path(spark, tmp_path, name, pattern):
    """Folder names count as file names do; what lies above the raw folder does not."""
    root = tmp_path / "x_2020 G01 G02" / "raw"
    for f in ("listings_2020/january.csv", "G01/people.csv", "G02/money.csv", "deep/er/LGA_CODE.csv", "LGA_SUBURB.csv",
              "LGA_CODE_old.csv", "G01/notes.txt", "other.csv"):
        (root / f).parent.mkdir(parents=True, exist_ok=True)
        (root / f).write_text(f"a,b\n{f},1\n")
    got = C.read_raw(spark, str(root), ["a", "b"], pattern)
    # a folder name makes the G01 pattern match its csv files only
    assert [r.a for r in got.collect()] == [name]
    one = C.read_raw(spark, str(root / name), ["a", "b"], ".*[.]csv")
    assert [r.a for r in one.collect()] == [name]


def test_unmatched_files_are_not_opened(spark, tmp_path):
    for f in ("a_2020.csv", "b.csv", "c.csv"):
        (tmp_path / f).write_text("a,b\n1,2\n")
    df = C.read_raw(spark, str(tmp_path), ["a", "b"], C.LISTING_PATTERN)
    df.collect()
    assert df.inputFiles() and re.search("file_path", df._jdf.queryExecution().toString())
    assert df.count() == 1


def lineitem_scans(df):
    """File scans of lineitem in the plan that ran, reused exchanges not counted again."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text
    final = text.split("== Initial Plan ==")[0]
    return len(re.findall(r"(?:FileScan|BatchScan) parquet [^\n]*lineitem\.parquet", final))


@pytest.mark.parametrize("name", ["dim_host_latest", "dim_listing_latest"])
def test_latest_dimensions_read_the_line_items_once(spark, name):
    assert lineitem_scans(QUERIES[name](spark, SMALL_SF)) == 1


@pytest.mark.parametrize("name", ["listing_mart_neighbourhood", "listing_mart_property", "q4_revenue_vs_mortgage", "q2_modal_types"])
def test_marts_read_the_line_items_once(spark, name):
    """The build is written when the query is made; its plan reads that table, and no line items."""
    assert lineitem_scans(QUERIES[name](spark, SMALL_SF)) == 0


def test_latest_of_a_hot_key_keeps_distinct_attributes(spark):
    """A key with most rows: its ties are counted, not listed, until the end."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"),
                                   (F.col("id") % 7).alias("ts"), (F.col("id") % 2).alias("v"))
    counts = latest_counts(df, "k", "ts", ["k", "v"], "n")
    hot = sorted((r.v, r.n) for r in counts.where("k = 1").collect())
    want = {}
    for i in range(30000):
        if i % 3 and i % 7 == 6:
            want[i % 2] = want.get(i % 2, 0) + 1
    assert hot == sorted(want.items())
    assert latest_with_ties(df, "k", "ts", ["k", "v"]).where("k = 1").count() == sum(want.values())
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan
