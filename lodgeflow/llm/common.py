"""Helpers shared by the operators: reading, scratch tables, Arrow maps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import hadoop

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN_ROOT: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names; one of our own only on a local master that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _OWN_ROOT.setdefault(app, "file://" + tempfile.mkdtemp(prefix="llm-"))
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for one table in a new folder of its own, which goes when the application ends."""
    folder = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    fs, path = hadoop(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/rows"


def save(df: DataFrame, path: str) -> None:
    """Writes ``df``; the write's shuffle files go as soon as it ends, so that one
    step's disk is free for the next."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.select("*").write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: lineage is cut with files that
    outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    save(df, path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._scratch_path = path
    return made


def let_go(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made and that nothing will read any more."""
    for made in tables:
        fs, path = hadoop(made.sparkSession, made._scratch_path)
        fs.delete(path.getParent(), True)


def table_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where no file matches."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def text_of(column: str = "text"):
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def arrow_schema(spark_ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(spark_ddl))


def slices(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes, whole rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)



def without(documents: DataFrame, gone: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that ``gone`` does not name by (doc_id, text_key), all columns
    as they are.  Null doc_ids match each other; ``gone`` is hashed, texts are not sorted."""
    rows = documents.select(F.struct("*").alias("row"))
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct().hint("shuffle_hash")
    own = F.xxhash64(F.coalesce(F.col(f"row.{text}"), F.lit("")))
    left = rows.join(gone, F.col("row.doc_id").cast("long").eqNullSafe(F.col("_doc")) & (own == F.col("_key")), "left_anti")
    return left.select("row.*")
