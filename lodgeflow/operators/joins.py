"""Join helpers (J-01..J-13).

The library's own joins carry no hint and are left to Catalyst + AQE (which converts a
sort-merge join to a broadcast one at runtime when the measured side is
under ``spark.sql.autoBroadcastJoinThreshold``).  ``bounded_broadcast`` is for
callers that know better; it checks the size first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A hinted side may hold at most this many rows and (estimated) bytes;
# beyond either bound it is joined by shuffle instead.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# Conservative per-value widths used to turn a row bound into a byte bound.
_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
          "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
_DEFAULT_WIDTH = 64   # strings, decimals, nested values


def row_width(df: DataFrame) -> int:
    """Upper-bound-ish bytes per row from the schema (8 bytes row overhead)."""
    return 8 + sum(_WIDTH.get(t, _DEFAULT_WIDTH) for _, t in df.dtypes)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when the side is proven small: at most
    ``max_rows`` rows and ``max_bytes`` estimated bytes.

    The check is a bounded job (``limit(cap + 1).count()``), so it costs at
    most ``cap`` rows of work however large the input is."""
    cap = max(1, min(max_rows, max_bytes // row_width(df)))
    n = df.limit(cap + 1).count()
    return F.broadcast(df) if n <= cap else df


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    rcols = set(right.columns)
    return [c for c in left.columns if c in rcols]


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """SQL NATURAL JOIN: equi-join on every shared column name (NULL never
    matches), shared columns once in the output."""
    keys = common_columns(left, right)
    if not keys:
        raise ValueError("natural join without shared columns would be a cross join")
    return left.join(right, keys, how)


def lookup_join(df: DataFrame, lookup: DataFrame, left_on: str, right_on: str,
                take: dict[str, str], how: str = "left") -> DataFrame:
    """Enrich ``df`` with columns of a lookup table matched by name (J-13).

    ``take`` maps lookup column -> output name.  Duplicate lookup keys fan
    out, as in the SQL (Q-14).  AQE broadcasts the lookup when it measures it
    small.  Where it shuffles, rows with a NULL key, which match nothing, are
    dealt over all tasks by a hash of the row instead of meeting in one."""
    # A literal zero would be folded into a filter and not be a key of the join.
    lk = lookup.select(
        F.col(right_on).alias("__lk"), F.xxhash64(right_on).bitwiseAND(F.lit(0)).alias("__ls"),
        *[F.col(src).alias(dst) for src, dst in take.items()])
    hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    salted = df.withColumn("__ks", F.when(df[left_on].isNull(), F.xxhash64(*hashed)).otherwise(F.lit(0)))
    return salted.join(lk, (salted[left_on] == lk["__lk"]) & (salted["__ks"] == lk["__ls"]), how).drop(
        "__lk", "__ls", "__ks")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join two results of the same GROUP BY on their keys, NULL group keys
    included (``<=>``), keeping one copy of each key column."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
