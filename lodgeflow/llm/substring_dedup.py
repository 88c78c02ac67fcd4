"""Removal of word windows that repeat across documents, by level-wise doubling.

Level one files every window of ``length`` words under one of its stretches of half that
length.  Only half-length stretches that occur in several texts survive; their
windows alone are extended to the full length and compared as 128-bit hashes.  The
document with the smallest doc_id owns a window; each other document loses the words that
the window covers.

Defined results: null and empty texts have no words; rows without doc_id keep all words and
take none from others; documents with equal doc_id take no words from each other; equal
texts lose all words but in the smallest doc_id; texts shorter than a window stay whole;
an empty table gives an empty result; other columns are ignored.  Long texts are
searched whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, slices, written
from .hashing import Anchors, Hasher
from .repeats import SLICE, filed, first_copies, keyed, repeated_anchors, texts_with, units

LENGTH = 50


def extended(length: int):
    """(doc_id, k1, text, hs) -> (doc_id, k1, anchor, whole, start): full windows of the anchors."""
    out = arrow_schema("doc_id long, k1 long, anchor long, whole long, start int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, SLICE):
            doc_id, k1, texts, lists = batch.columns
            values, bounds, _ = units(hasher, texts, True)
            if len(values) < length:
                continue
            sums = hasher.sums(values)
            anchors = Anchors(hasher, sums, bounds, length, length // 2)
            at = filed(anchors, bounds, lists)
            doc = np.searchsorted(bounds, at, "right") - 1
            yield pa.RecordBatch.from_arrays([
                doc_id.take(pa.array(doc)), k1.take(pa.array(doc)),
                pa.array(anchors.least[at].view(np.int64)),
                pa.array(hasher.stretch(sums, at, at + length).view(np.int64)),
                pa.array((at - bounds[doc]).astype(np.int32))], schema=out)

    return run


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def cut(length: int, with_text: bool):
    out = arrow_schema(RESULT if with_text else RESULT.removesuffix(", kept string"))

    def row(doc_id, text: bytes, copy: bool | None, starts: list[int] | None) -> tuple:
        words = text.split()
        kept = words
        if copy and len(words) >= length:
            kept = []
        elif starts:
            edge = np.zeros(len(words) + 1, np.int32)
            np.add.at(edge, starts, 1)
            np.add.at(edge, np.asarray(starts) + length, -1)
            kept = [w for w, c in zip(words, np.cumsum(edge).tolist()) if not c]
        joined = b" ".join(kept)
        made = (doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest())
        return (*made, joined.decode()) if with_text else made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            i, t, c, s = batch.columns
            rows = [row(*x) for x in zip(i.to_pylist(), t.cast(pa.large_binary()).to_pylist(),
                                         c.to_pylist(), s.to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return run


def candidate_windows(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, k1, anchor, whole, start of the full windows whose half-length stretch
    survived level one, of each different text."""
    if length < 2:
        raise ValueError("a window has two words or more")
    halves = repeated_anchors(docs, length, length // 2, words=True, within=False, hot=0).drop("hots")
    texts = texts_with(docs, halves).select("doc_id", "k1", "text", "hs")
    return written(texts.mapInArrow(
        extended(length), "doc_id long, k1 long, anchor long, whole long, start int"), "windows")


def longest_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, longest: the longest of length, 2 length, 4 length ... words that some window of
    the document shares with another, different text.  Each level joins the windows that
    survived the last one with those that follow them, until none survives."""
    windows = candidate_windows(keyed(documents), length).select(
        "doc_id", "k1", "start", "whole", F.col("anchor").alias("other"))
    found, reached = None, length
    while True:
        lists = (windows.groupBy("whole", "other").agg(F.min("k1").alias("low"), F.max("k1").alias("high"))
                 .where(F.col("low") != F.col("high")).select("whole", "other"))
        windows = written(windows.join(lists, ["whole", "other"], "left_semi"), f"level-{reached}")
        if windows.isEmpty():
            break
        level = windows.select("doc_id", "k1").distinct().withColumn("longest", F.lit(reached))
        found = level if found is None else found.unionByName(level)
        after = windows.select("doc_id", "k1", (F.col("start") - reached).alias("start"),
                               F.col("whole").alias("w2"), F.col("other").alias("o2"))
        windows = (windows.join(after, ["doc_id", "k1", "start"])
                   .select("doc_id", "k1", "start", F.xxhash64("whole", "w2").alias("whole"),
                           F.xxhash64("other", "o2", "whole").alias("other")))
        reached *= 2
    if found is None:
        return windows.select("doc_id", F.lit(0).alias("longest")).limit(0)
    return found.groupBy("doc_id").agg(F.max("longest").alias("longest"))


def substring_dedup(documents: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept words."""
    docs = keyed(documents)
    windows = candidate_windows(docs, length)
    owners = (windows.groupBy("anchor", "whole").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
              .where(F.col("owner") < F.col("last")).select("anchor", "whole", "owner"))
    # The starts of one document go to one row: as many as it has words at most.
    starts = (windows.join(owners, ["anchor", "whole"]).where(F.col("doc_id") > F.col("owner"))
              .groupBy("doc_id", "k1").agg(F.collect_set("start").alias("starts")))
    copies = (docs.select("doc_id", "k1", "k2").join(first_copies(docs), ["k1", "k2"])
              .where(F.col("doc_id") > F.col("first")).select("doc_id", "k1").distinct()
              .withColumn("copy", F.lit(True)))
    info = written(copies.join(starts, ["doc_id", "k1"], "full"), "removals")
    return (texts_with(docs, info, "left").select("doc_id", "text", "copy", "starts")
            .mapInArrow(cut(length, with_text), RESULT if with_text else RESULT.removesuffix(", kept string")))
