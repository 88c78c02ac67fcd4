"""Exact top-k search by inner product, by a three-phase uniform threshold.

The dimensions are cut into ``LISTS`` groups.  For a query, each group is a score list: the
candidates with their share of the inner product.  Query and candidate blocks meet in tiles
of bounded size, one for each list.

1. Each list's highest candidates are gathered and scored in full; the k-th best score so
   far is tau, and no result can score less.
2. The safe cutoff tau / LISTS goes out with the queries: who reaches tau somewhere has a
   share of at least that.  Every list gives all entries that reach it.  Candidates
   that all lists gave are scored; for the others, a missing share lies below the cutoff,
   which bounds the score from above.
3. Candidates whose bound reaches the k-th best known score are scored in full.

Equal vectors are searched as one, with their smallest vec_ids, so that a vector held by many
rows adds one entry to each list.

Defined results: rows with a null vec_id, and vectors that are null or hold null or
non-finite entries take no part; the shorter of two vectors counts as zero beyond its end,
an empty one is all zeros; each candidate row ranks by itself, repeated ones too; rows
with the query's vec_id are its own; a query is a distinct pair of vec_id and vector; ties go to
the smaller vec_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, written
from .vectors import matrix, padded, products, whole_vectors, width

#: Groups of dimensions, and how many entries of each list the first phase gathers.
LISTS = 2
HEADS = 24
#: Rows and queries of a tile.
BLOCK_ROWS = 2048
BLOCK_QUERIES = 512
#: Below every share; inner products must lie within 2**58 of zero.
NEVER = -(1 << 58)

ENTRY = "query long, cand long, list int, share long"
ENTRIES = pa.schema([("query", pa.int64()), ("cand", pa.int64()), ("list", pa.int32()), ("share", pa.int64())])
KEYS = ["row_block", "query_block", "list"]


def few_smallest(most: int):
    """Per task: one row for each vector, with its ``most`` smallest vec_ids and their counts."""
    schema = arrow_schema("x array<long>, members array<struct<vec_id: long, n: long>>")

    def run(batches):
        found: dict[bytes, dict[int, int]] = {}
        for batch in batches:
            rows = np.ascontiguousarray(matrix(batch.column("x")))
            for row, vec_id in zip(rows, batch.column("vec_id").to_pylist()):
                ids = found.setdefault(row.tobytes(), {})
                if vec_id in ids:
                    ids[vec_id] += 1
                elif len(ids) < most:
                    ids[vec_id] = 1
                elif vec_id < (last := max(ids)):
                    del ids[last]
                    ids[vec_id] = 1
        keys = list(found)
        for at in range(0, len(keys), 4096):
            part = keys[at:at + 4096]
            yield pa.RecordBatch.from_pylist(
                [{"x": np.frombuffer(k, np.int64), "members": [{"vec_id": i, "n": n} for i, n in sorted(found[k].items())]}
                 for k in part], schema)
    return run


def candidates(vectors: DataFrame, k: int) -> DataFrame:
    """(cand, x, members, only): each distinct vector once, with its k + 1 smallest vec_ids and
    their numbers of rows; ``only`` is the vec_id of a vector that has a single one."""
    local = vectors.mapInArrow(few_smallest(k + 1), "x array<long>, members array<struct<vec_id: long, n: long>>")
    met = local.groupBy("x").agg(F.flatten(F.collect_list("members")).alias("met"))
    ids = F.slice(F.array_sort(F.array_distinct(F.transform("met", lambda m: m["vec_id"]))), 1, k + 1)
    members = F.transform("ids", lambda i: F.struct(i.alias("vec_id"), F.aggregate(
        F.filter("met", lambda m: m["vec_id"] == i), F.lit(0).cast("long"), lambda s, m: s + m["n"]).alias("n")))
    return (met.withColumn("ids", ids).withColumn("members", members)
            .select(F.monotonically_increasing_id().alias("cand"), "x", "members",
                    F.when(F.size("members") == 1, F.get("members", F.lit(0))["vec_id"]).alias("only")))


def by_list(df: DataFrame, dims: int, lists: int) -> DataFrame:
    """One row for each list, with its share of ``x``."""
    step = max(1, -(-dims // lists))
    cuts = [F.slice("x", 1 + j * step, step) for j in range(lists)]
    return df.select("*", F.posexplode(F.array(*cuts)).alias("list", "part")).drop("x")


def tiles(cands: DataFrame, queries: DataFrame, dims: int, lists: int, blocks: tuple[int, int], tile) -> DataFrame:
    """``tile`` of every block of candidates with every block of queries, for each list."""
    rows, asked = blocks
    left = (by_list(cands.select("cand", "only", "x"), dims, lists)
            .withColumn("row_block", F.pmod(F.xxhash64("cand"), F.lit(rows)).cast("int"))
            .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(asked - 1)))))
    right = (by_list(queries, dims, lists)
             .withColumn("query_block", F.pmod(F.xxhash64("query"), F.lit(asked)).cast("int"))
             .withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))))
    return left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS)).applyInArrow(tile, ENTRY)


def tile_scores(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Shares (queries x candidates), and which candidates have a row that is not the query's own."""
    shares = products(matrix(right["part"]), matrix(left["part"]))
    only = left["only"].combine_chunks()
    single = only.is_valid().to_numpy(zero_copy_only=False)
    own = right["query_id"].to_numpy()[:, None] == only.fill_null(0).to_numpy(zero_copy_only=False)[None, :]
    return shares, ~(own & single[None, :])


def entries(left: pa.Table, right: pa.Table, q: np.ndarray, c: np.ndarray, shares: np.ndarray) -> pa.Table:
    lists = np.full(len(q), left["list"][0].as_py() if left.num_rows else 0, np.int32)
    return pa.Table.from_arrays(
        [pa.array(right["query"].to_numpy()[q]), pa.array(left["cand"].to_numpy()[c]), pa.array(lists),
         pa.array(shares)], schema=ENTRIES)


def highest(depth: int):
    """Tile of the first phase: the ``depth`` best candidates of each query."""
    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return ENTRIES.empty_table()
        shares, valid = tile_scores(left, right)
        shares = np.where(valid, shares, NEVER)
        take = min(depth, shares.shape[1])
        best = np.argpartition(-shares, take - 1, axis=1)[:, :take]
        q = np.repeat(np.arange(len(shares)), take)
        c = best.ravel()
        found = shares[q, c]
        there = found > NEVER
        return entries(left, right, q[there], c[there], found[there])
    return tile


def reaching(left: pa.Table, right: pa.Table) -> pa.Table:
    """Tile of the second phase: every entry that reaches the query's cutoff."""
    if not left.num_rows or not right.num_rows:
        return ENTRIES.empty_table()
    shares, valid = tile_scores(left, right)
    q, c = np.nonzero(valid & (shares >= right["cutoff"].to_numpy()[:, None]))
    return entries(left, right, q, c, shares[q, c])


def scored(pairs: DataFrame, cands: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, cand, score) with the whole inner product of each pair."""
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, p: s + p)
    return (pairs.select("query", "cand").join(cands.select("cand", "x"), "cand")
            .join(queries.select("query", F.col("x").alias("y")), "query").select("query", "cand", dot.alias("score")))


def kth_best(scores: DataFrame, k: int, name: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "cand"))
    return scores.withColumn("_rank", rank).where(F.col("_rank") == k).select("query", F.col("score").alias(name))


def cutoff_of(lists: int) -> Column:
    """tau / lists, rounded up; without a tau, below every share."""
    up = f"case when pmod(tau, {lists}) > 0 then tau - pmod(tau, {lists}) + {lists} else tau end"
    return F.coalesce(F.expr(f"cast(({up}) div {lists} as long)"), F.lit(NEVER))


def top_k(embeddings: DataFrame, every: int = 50, k: int = 5, lists: int = LISTS, heads: int = HEADS,
          block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose vec_id is
    divisible by ``every``, exactly."""
    vectors = whole_vectors(embeddings).where(F.col("vec_id").isNotNull())
    dims = max(1, width(vectors))
    vectors = padded(vectors, dims)
    cands = written(candidates(vectors, k), "topk-candidates")
    queries = written(vectors.where(F.col("vec_id") % every == 0).distinct()
                      .select(F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"), "x"),
                      "topk-queries")
    lists = min(lists, dims)
    blocks = (max(1, -(-cands.count() // block_rows)), max(1, -(-queries.count() // block_queries)))

    # Phase 1: the highest entries of each list; the k-th best of their scores is safe.
    heads_of = tiles(cands, queries, dims, lists, blocks, highest(max(k, heads)))
    order = Window.partitionBy("query", "list").orderBy(F.col("share").desc(), "cand")
    heads_of = heads_of.withColumn("_in", F.row_number().over(order)).where(F.col("_in") <= max(k, heads))
    tau = kth_best(scored(heads_of.select("query", "cand").distinct(), cands, queries), k, "tau")
    asked = written(queries.join(tau, "query", "left")
                    .withColumn("cutoff", cutoff_of(lists)), "topk-cutoffs")

    # Phase 2: all entries that reach the cutoff.
    given = tiles(cands, asked, dims, lists, blocks, reaching)
    seen = written(given.groupBy("query", "cand").agg(F.count("*").alias("seen"), F.sum("share").alias("share")),
                   "topk-entries")
    known = seen.where(F.col("seen") == lists).select("query", "cand", F.col("share").alias("score"))
    least = (asked.select("query", "tau", "cutoff").join(kth_best(known, k, "known"), "query", "left")
             .select("query", "cutoff", F.coalesce(F.greatest("tau", "known"), F.lit(NEVER)).alias("least")))

    # Phase 3: who could still reach the k-th best is scored in full.
    above = F.col("share") + (F.lit(lists) - F.col("seen")) * (F.col("cutoff") - 1)
    open_pairs = seen.where(F.col("seen") < lists).join(least, "query").where(above >= F.col("least"))
    scores = known.unionByName(scored(open_pairs, cands, queries))
    return ranked(scores, cands, queries, k)


def ranked(scores: DataFrame, cands: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query among the scored vectors."""
    top = Window.partitionBy("query").orderBy(F.col("score").desc())
    close = scores.withColumn("_rank", F.rank().over(top)).where(F.col("_rank") <= k)
    rows = (close.join(cands.select("cand", "members"), "cand").join(queries.select("query", "query_id"), "query")
            .select("query", "query_id", "score", F.explode("members").alias("m"))
            .where(F.col("m.vec_id") != F.col("query_id"))
            .select("query", "query_id", "score", F.col("m.vec_id").alias("vec_id"),
                    F.explode(F.sequence(F.lit(1).cast("long"), F.least("m.n", F.lit(k).cast("long")))).alias("copy")))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "copy")
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
