"""Incremental refresh of the listing staging table (S-11 as a stream).

The reference re-lists its external table before each rebuild.  With
Structured Streaming the file source remembers, in its checkpoint, which
monthly files were already staged; a run with ``availableNow`` stages only
the files that arrived since, then stops.

The checkpoint lies beside the table (``<dst>_checkpoint``), so every
application finds it again.  It also keeps the list of staged files with
their length and modification time: when a known file has changed or gone, the
table is staged anew from all files, as a batch rebuild would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import staging_listing_from_raw
from ..sources import csv_files as C
from ..sources.storage import exists, hadoop, remove


def _batches(spark: SparkSession, checkpoint: str) -> int:
    """Committed micro-batches, by the checkpoint's own log."""
    fs, p = hadoop(spark, f"{checkpoint}/commits")
    if not fs.exists(p):
        return 0
    return sum(1 for s in fs.listStatus(p) if s.getPath().getName().isdigit())


#: One row per monthly file: the list that any file source holds on the driver.
FILES = "path string, length long, modificationTime timestamp"


def _files(spark: SparkSession, src: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(src)
            .where(C.in_dataset(spark, src, C.LISTING_PATTERN))
            .select("path", "length", "modificationTime"))


def refresh_listing_staging(spark: SparkSession, src: str, dst: str,
                            checkpoint: str | None = None,
                            max_files_per_trigger: int | None = None,
                            full: bool = False, multiline: bool = True) -> int:
    """Bring the parquet table at ``dst`` up to date with the listing files
    under ``src``; returns the number of micro-batches that staged files.

    ``max_files_per_trigger`` bounds each micro-batch (a large backfill is
    then staged in several bounded batches; ``availableNow`` honours it).
    ``full`` stages all files anew.  A table without its checkpoint, or one
    that was staged from another folder, is refused unless ``full`` is given."""
    checkpoint = checkpoint or dst.rstrip("/") + "_checkpoint"
    manifest = f"{checkpoint}/staged_files"
    known = spark.read.parquet(manifest) if exists(spark, manifest) else None
    if not full and known is None and exists(spark, dst):
        raise ValueError(f"{dst} exists but {checkpoint} does not describe it; use a full refresh")
    # Listed before the stream starts: what arrives meanwhile counts as new or changed next time.
    now = spark.createDataFrame(_files(spark, src).collect(), FILES)
    if known is not None and not full:
        if known.where(known.src != src).limit(1).count():
            raise ValueError(f"{dst} was staged from another folder than {src}; use a full refresh")
        # A known file that changed or went: the whole table is staged anew.
        full = known.drop("src").exceptAll(now).limit(1).count() > 0
    if full:
        remove(spark, dst)
        remove(spark, checkpoint)
    before = _batches(spark, checkpoint)
    reader = C.csv_reader(spark, C.LISTING_COLUMNS, multiline=multiline, streaming=True).option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(src, format="csv").where(C.in_dataset(spark, src, C.LISTING_PATTERN))
    staged = staging_listing_from_raw(C.clean_tokens(raw, C.LISTING_COLUMNS))
    q = (staged.writeStream.format("parquet")
         .option("path", dst)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    now.withColumn("src", F.lit(src)).coalesce(1).write.mode("overwrite").parquet(manifest)
    return _batches(spark, checkpoint) - before
