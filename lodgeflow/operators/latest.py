"""Latest snapshot per key with ties kept (J-08, Q-06).

``t1 JOIN (SELECT key, max(ts) latest FROM t GROUP BY key) t2
      ON t1.key = t2.key AND t1.ts = t2.latest``

in one pass over the table, without the join.  Equal rows are counted first (combined
map-side), so a key's state holds its distinct (ts, attributes) only.  ``rank() = 1`` by falling
``ts`` is then planned as a group limit: each map task drops all but its latest rows of a key
before the shuffle, so a key that holds a third of all rows sends its ties alone.
A row whose key or timestamp is NULL never matches, as in the SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_counts(df: DataFrame, key: str, ts: str, columns: list[str], count: str) -> DataFrame:
    """Distinct ``columns`` of each key's latest rows, with the number of such rows."""
    counted = (df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
               .groupBy(F.col(key).alias("__key"), F.col(ts).alias("__ts"),
                        *[F.col(c).alias(f"__v{i}") for i, c in enumerate(columns)])
               .agg(F.count("*").alias("__n")))
    newest = Window.partitionBy("__key").orderBy(F.col("__ts").desc())
    return (counted.withColumn("__r", F.rank().over(newest)).where(F.col("__r") == 1)
            .select(*[F.col(f"__v{i}").alias(c) for i, c in enumerate(columns)], F.col("__n").alias(count)))


def latest_with_ties(df: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """``columns`` of each key's latest rows, one row for each of them."""
    found = latest_counts(df, key, ts, columns, "__copies")
    return found.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "__copies")).alias("__copy")).drop("__copy")
