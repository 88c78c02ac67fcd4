"""Written tables: replaced whole without a moment that loses the old rows (K-01), and
intermediate tables that one query writes once and reads often.

A table is a folder.  Its replacement is written beside it, and the folders are swapped by
renames when it is complete.  A writer that dies leaves the old folder in place, or, between the two
renames, set aside: ``restore`` puts it back.  On a store whose renames copy (an object
store), the swap takes as long as the copy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root

NEW, OLD = "__new-", "__old-"


def hadoop(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as that system's object."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = hadoop(spark, source)
    if not fs.rename(p, hadoop(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def _beside(spark: SparkSession, path: str, mark: str) -> list[str]:
    """Folders next to the table that bear its name and ``mark``."""
    fs, p = hadoop(spark, path)
    if not fs.exists(p.getParent()):
        return []
    names = [s.getPath() for s in fs.listStatus(p.getParent())]
    return sorted(n.toString() for n in names if n.getName().startswith(p.getName() + mark))


def restore(spark: SparkSession, path: str) -> None:
    """Ends what a writer that died has begun: a complete old table comes back into its place, and
    folders that no table uses go."""
    path = path.rstrip("/")
    old = _beside(spark, path, OLD)
    if old and not exists(spark, path):
        rename(spark, old.pop(), path)
    for left in old + _beside(spark, path, NEW):
        remove(spark, left)


def replace_table(spark: SparkSession, path: str, write) -> None:
    """``write(folder)`` makes the new table; it takes the place of ``path`` when it is complete.
    One writer at a time."""
    path = path.rstrip("/")
    restore(spark, path)
    mark = uuid.uuid4().hex
    new, old = path + NEW + mark, path + OLD + mark
    write(new)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, new, path)
    remove(spark, old)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder that all branches of a query read.  It
    goes when the application ends."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, p = hadoop(spark, path)
    fs.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)
