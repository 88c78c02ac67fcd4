"""Window operators (W-01..W-05, P-21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_of_existing(df: DataFrame, partition_by: list[str], order_by: str,
                    value: Column, present: Column, out: str) -> DataFrame:
    """``lag(COUNT(*)) OVER (PARTITION BY .. ORDER BY ..) - 1`` computed over
    the groups that exist under a filter (Q-01, Q-02).

    Rows where ``present`` is false are skipped, so the lag steps over
    existing groups, not calendar months; "minus one" is literal."""
    w = (Window.partitionBy(*partition_by).orderBy(order_by)
         .rowsBetween(Window.unboundedPreceding, -1))
    prev = F.last(F.when(present, value), ignorenulls=True).over(w)
    return df.withColumn(out, F.when(present, prev - F.lit(1)))


def mode_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent ``value`` per ``group`` (ROW_NUMBER over COUNT DESC, rn=1).

    The SQL has no tiebreak; ties go to the smallest value (NULLs last) so
    the answer is deterministic (Q-15).  Partitions are (group, value)
    counts, so a window partition holds one row per distinct value only."""
    counts = df.groupBy(group, value).agg(F.count(value).alias("__n"))
    w = Window.partitionBy(group).orderBy(F.col("__n").desc(), F.col(value).asc_nulls_last())
    return (counts.withColumn("__rn", F.row_number().over(w))
                  .where(F.col("__rn") == 1)
                  .select(group, value))


def modes_per_group(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """``mode_per_group`` for several columns in one pass: one row per group
    with the modal value of each column (same counts and tiebreak).

    The rows are unpivoted to (group, column, value) -- values as text plus
    a numeric sort key so numeric columns keep numeric tie order -- counted
    once, ranked by one window, and pivoted back.  Groups with a NULL key
    are dropped, as a natural join of per-column results would."""
    types = dict(df.dtypes)
    numeric = {c for c in columns if types[c] in ("int", "bigint", "smallint", "tinyint")}
    cells = [F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value"),
                      (F.col(c).cast("bigint") if c in numeric else F.lit(None).cast("bigint")).alias("num"))
             for c in columns]
    long = (df.where(F.col(group).isNotNull())
              .select(group, F.explode(F.array(*cells)).alias("__c"))
              .select(group, "__c.*"))
    counts = long.groupBy(group, "col", "value", "num").agg(F.count("value").alias("__n"))
    w = Window.partitionBy(group, "col").orderBy(
        F.col("__n").desc(), F.col("num").asc_nulls_last(), F.col("value").asc_nulls_last())
    top = counts.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1)
    picks = [F.max(F.when(F.col("col") == c, F.col("value"))).cast(types[c]).alias(c) for c in columns]
    return top.groupBy(group).agg(*picks)
