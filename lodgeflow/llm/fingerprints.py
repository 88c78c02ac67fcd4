"""Document fingerprints by randomised edit embedding.

A walk over the characters reads one of them at each time step and moves on if a
random bit, shared by all documents and drawn for (time, character class), is one.
Texts at a small edit distance are thereby mapped to strings at a small Hamming
distance: after an edit the two walks soon meet again.  The fingerprint keeps the
walk's length and its symbols at sampled times.  The samples lie equally dense in each
doubling of time, so short and long texts share one layout, and each sample counts by
the stretch of time that it stands for.  Near-duplicate search hashes bands of sampled
symbols and verifies candidates by the fingerprints' likeness.

Defined results: null and empty texts have an empty walk, like to each other (1) and
unlike all else (0); rows with equal doc_id are ordered by text; a table of one row is
its own next row; an empty table gives an empty result; other columns are ignored.
Every character of a long text is walked.
"""

from __future__ import annotations

import hashlib
import random
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, slices, text_of, written
from .jaccard_join import tiles

CLASS_BITS = 6
PERIOD = 1024
FIRST = 64
SAMPLES = 32
OCTAVES = 40
SEED = 7
BAND = 8
LIKE = 0.8
#: Different fingerprints in one block of a band's bucket.
BLOCK = 2048
PRINTS = "doc_id long, fingerprint string, bands array<string>"
PAIRS = "doc_id long, representative long, likeness double"


class Print(NamedTuple):
    length: int
    symbols: np.ndarray

    def text(self) -> str:
        return f"{self.length:x}." + "".join("0123456789abcdef"[s] for s in self.symbols.tolist())


def parse(text: str) -> Print:
    length, _, symbols = text.partition(".")
    return Print(int(length, 16), np.array([int(c, 16) for c in symbols], np.uint8))


class Walker:
    """The shared random walk: moves by (character class, time modulo PERIOD)."""

    def __init__(self, seed: int = SEED):
        draw = random.Random(seed)
        self.moves: list[list[int]] = []
        for _ in range(1 << CLASS_BITS):
            bits = [draw.random() < 0.5 for _ in range(PERIOD)]
            bits[draw.randrange(PERIOD)] = True
            ahead, nxt = [0] * PERIOD, 0
            for t in range(2 * PERIOD - 1, -1, -1):
                if bits[t % PERIOD]:
                    nxt = t
                if t < PERIOD:
                    ahead[t] = (nxt + 1) % PERIOD
            self.moves.append(ahead)
        times, weights = [], []
        for o in range(OCTAVES):
            low, high = (0, FIRST) if o == 0 else (FIRST << (o - 1), FIRST << o)
            times += sorted(draw.sample(range(low, high), SAMPLES))
            weights += [(high - low) / SAMPLES] * SAMPLES
        self.times, self.weights = np.array(times, np.int64), np.array(weights)

    def walk(self, points: np.ndarray, t: int = 0) -> np.ndarray:
        """The time at which each character is first read, and the time after the last."""
        moves, state = self.moves, t % PERIOD
        classes = ((points * np.uint32(2654435761)) >> np.uint32(32 - CLASS_BITS)).astype(np.uint8).tobytes()
        states = array("H", [state])
        states.extend([state := moves[c][state] for c in classes])
        at = np.frombuffer(states, np.uint16).astype(np.int64)
        steps = (np.diff(at) - 1) % PERIOD + 1
        return t + np.concatenate([[0], np.cumsum(steps)])

    def sample(self, points: np.ndarray, times: np.ndarray) -> Print:
        length = int(times[-1])
        wanted = self.times[:np.searchsorted(self.times, length)]
        wanted = wanted[wanted >= times[0]]
        read = points[np.searchsorted(times, wanted, "right") - 1]
        return Print(length, ((read * np.uint32(2246822519)) >> np.uint32(28)).astype(np.uint8))

    def likeness(self, a: Print, b: Print) -> float:
        """The estimated share of time steps at which both walks read the same symbol."""
        most, both = max(a.length, b.length), min(len(a.symbols), len(b.symbols))
        total = self.weights[:np.searchsorted(self.times, most)].sum()
        if not total:
            return 1.0 if a.length == b.length else 0.0
        return float(self.weights[:both][a.symbols[:both] == b.symbols[:both]].sum() / total)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Walked(NamedTuple):
    doc_id: int | None
    points: np.ndarray
    times: np.ndarray
    print: Print


def walked(walker: Walker, doc_id: int | None, text: str) -> Walked:
    points = code_points(text)
    times = walker.walk(points)
    return Walked(doc_id, points, times, walker.sample(points, times))


def compared(walker: Walker, a: Walked, b: Walked) -> tuple:
    """The result row of ``a``, whose next document is ``b``."""
    n = len(a.points)
    kept = n - n // 2
    tail = b.points[:n // 2]
    edited = np.concatenate([a.points[:kept], tail])
    if kept:
        times = walker.walk(tail, int(a.times[kept]))
        shared = int(np.searchsorted(walker.times, times[0]))
        rest = walker.sample(tail, times) if len(tail) else Print(int(times[-1]), np.empty(0, np.uint8))
        new = Print(rest.length, np.concatenate([a.print.symbols[:shared], rest.symbols]))
    else:
        new = a.print
    sha = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"))
    return (a.doc_id, n, sha.hexdigest(), a.print.text(), new.text(),
            walker.likeness(a.print, new), walker.likeness(a.print, b.print))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
EDGES = RESULT + ", part int, edge string, text string"


def batch_of(rows: list[tuple], out: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(out)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out.types)], schema=out)


def walk_in_order(seed: int):
    """Rows of one partition in order: each is compared with the next; the first and the
    last row also come out as edges, with their texts."""
    out = arrow_schema(EDGES)
    blank = (None,) * (len(out) - 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker, part, last, last_text = Walker(seed), TaskContext.get().partitionId(), None, ""
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                here = walked(walker, doc_id, text)
                if last is None:
                    rows.append((doc_id, *blank, part, "first", text))
                else:
                    rows.append((*compared(walker, last, here), part, None, None))
                last, last_text = here, text
            yield batch_of(rows, out)
        if last is not None:
            yield batch_of([(last.doc_id, *blank, part, "last", last_text)], out)

    return run


def walk_pairs(seed: int):
    out = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(seed)
        for batch in slices(batches):
            yield batch_of([compared(walker, walked(walker, i, a), walked(walker, None, b))
                            for i, a, b in zip(*[c.to_pylist() for c in batch.columns])], out)

    return run


def edit_fingerprints(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """Fingerprints of each text and of its edited text, by falling doc_id.

    Texts are dealt out once, by ranges of doc_id.  Only the first and the last text of
    each range are joined again, to carry the order across ranges.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ordered = (docs.repartitionByRange(F.col("doc_id").desc_nulls_last())
               .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "text"))
    rows = written(ordered.mapInArrow(walk_in_order(seed), EDGES), "walked")
    # One row for each range: their numbers alone are put in order.
    firsts = rows.where(F.col("edge") == "first").select("part", F.col("text").alias("next_text"))
    order = firsts.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"),
                          F.min("part").over(Window.partitionBy(F.lit(0))).alias("first"))
    ends = (rows.where(F.col("edge") == "last").select("doc_id", "part", "text")
            .join(order.select("part", F.coalesce("next", "first").alias("to")), "part")
            .join(firsts.withColumnRenamed("part", "to"), "to")
            .select("doc_id", "text", "next_text").mapInArrow(walk_pairs(seed), RESULT))
    return rows.where(F.col("edge").isNull()).drop("part", "edge", "text").unionByName(ends)


def print_and_bands(seed: int, band: int):
    out = arrow_schema(PRINTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(seed)
        for batch in slices(batches):
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made = walked(walker, i, text).print
                full = len(made.symbols) // SAMPLES
                keys = [f"{k // SAMPLES}.{k % SAMPLES}." + bytes(made.symbols[k:k + band]).hex()
                        for o in range(max(0, full - 2), full + 1)
                        for k in range(o * SAMPLES, min((o + 1) * SAMPLES, len(made.symbols)), band)]
                rows.append((i, made.text(), keys))
            yield batch_of(rows, out)

    return run


def like_tile(seed: int, likeness: float):
    """Rows (band, i, j, block, doc_id, fingerprint) of one tile -> the pairs that join, as a
    forest, what is alike.  A tile of two blocks compares across them only."""
    walker = Walker(seed)
    times, weights = walker.times, walker.weights

    def solve(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        rows.sort(key=lambda r: r[4:])
        prints = [parse(r[5]) for r in rows]
        doc, block = (np.array([r[k] for r in rows]) for k in (4, 3))
        across = rows[0][1] != rows[0][2]
        width = max(len(p.symbols) for p in prints)
        symbols = np.full((len(rows), width), 255, np.uint8)
        for k, p in enumerate(prints):
            symbols[k, :len(p.symbols)] = p.symbols
        reach = np.searchsorted(times, [p.length for p in prints])
        total = np.concatenate([[0], np.cumsum(weights)])
        root, pairs = np.arange(len(rows)), []
        for k in range(1, len(rows)):
            n = len(prints[k].symbols)
            own = (symbols[:k, :n] == prints[k].symbols) @ weights[:n] / total[np.maximum(reach[:k], reach[k])]
            fit = own >= likeness
            if across:
                fit &= block[:k] != block[k]
            for j in np.flatnonzero(fit).tolist():
                if root[j] != root[k]:
                    if doc[j] != doc[k]:
                        pairs.append((int(doc[k]), int(doc[j]), float(own[j])))
                    root[root == root[k]] = root[j]
        return pairs

    return solve


def near_duplicates(documents: DataFrame, likeness: float = LIKE, band: int = BAND,
                    seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Verified pairs (doc_id, representative, likeness) of documents that share a band.

    Equal fingerprints are merged first, under their smallest doc_id.  All different
    fingerprints of a band's bucket are compared, in tiles of two blocks at most; of the
    pairs that are alike, a tile gives a forest, with the smallest doc_ids as representatives.
    So documents that are alike are always linked, by their own pair or by others.
    Documents are met in every band of their two longest full octaves and of the
    unfinished one behind them.  Like any banding this can miss pairs.
    """
    docs = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
            .where(F.col("doc_id").isNotNull()))
    prints = written(docs.mapInArrow(print_and_bands(seed, band), PRINTS), "prints")
    firsts = written(prints.groupBy("fingerprint").agg(
        F.min("doc_id").alias("representative"), F.first("bands").alias("bands")), "first-prints")
    copies = (prints.select("doc_id", "fingerprint").join(firsts.select("fingerprint", "representative"), "fingerprint")
              .where(F.col("doc_id") > F.col("representative"))
              .select("doc_id", "representative", F.lit(1.0).alias("likeness")))
    rows = firsts.select(F.explode("bands").alias("band"), F.col("representative").alias("doc_id"), "fingerprint")
    stats = (rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
             .select("band", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    rows = (rows.join(stats, "band")
            .withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "doc_id", "fingerprint"))
    near = (rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
            .mapInArrow(tiles(like_tile(seed, likeness), 3, PAIRS), PAIRS))
    return (near.unionByName(copies.where(F.col("likeness") >= likeness))
            .groupBy("doc_id", "representative").agg(F.max("likeness").alias("likeness")))
