"""What the searches for repeated stretches share.

Texts are known by two 64-bit hashes; equal texts are searched once, under their smallest
doc_id.  Each window of the searched length is filed under the least hash of the grams
inside it, so equal windows are filed alike wherever they lie, while only a few per cent
of all places are anchors.  Anchors that occur in one text only file nothing that repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, slices, text_of, written
from .hashing import Anchors, Hasher, buffer_of, word_hashes, word_places

#: Bytes of text that are hashed at a time.
SLICE = 256 << 10


def keyed(documents: DataFrame, *more: Column) -> DataFrame:
    """doc_id, text (null: empty) and the text's two hashes."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *more)
    return docs.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})


def first_copies(docs: DataFrame) -> DataFrame:
    """k1, k2 and the smallest doc_id of each text; rows without doc_id take no part."""
    return (docs.where(F.col("doc_id").isNotNull()).groupBy("k1", "k2")
            .agg(F.min("doc_id").alias("first")))


def units(hasher: Hasher, texts: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash values of the texts' words or bytes, their bounds by text, and the bytes."""
    data, bounds = buffer_of(texts)
    if not words:
        return hasher.values[data], bounds, data
    starts, ends, bounds = word_places(data, bounds)
    return word_hashes(hasher, data, starts, ends), bounds, data


def anchor_rows(window: int, gram: int, words: bool):
    """(k1, text) -> (k1, h, twice): the distinct anchors of each text, and whether one
    stands at several places in it."""
    out = arrow_schema("k1 long, h long, twice boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, SLICE):
            values, bounds, _ = units(hasher, batch.column(1), words)
            if len(values) < window:
                continue
            anchors = Anchors(hasher, hasher.sums(values), bounds, window, gram)
            at = anchors.chosen()
            doc, h = np.searchsorted(bounds, at, "right") - 1, anchors.grams[at]
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
            firsts = np.flatnonzero(new)
            times = np.diff(np.append(firsts, len(h)))
            k1 = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[doc[firsts]]), pa.array(h[firsts].view(np.int64)), pa.array(times > 1)], schema=out)

    return run


def repeated_anchors(docs: DataFrame, window: int, gram: int, words: bool, within: bool,
                     hot: int) -> DataFrame:
    """doc_id, k1, hs, hots: of each text's first copy, the anchors that also stand in another
    text (or, with ``within``, at another place of the same); ``hots`` are those of
    them that more than ``hot`` texts hold."""
    rows = docs.where(F.col("doc_id").isNotNull()).select("k1", "text")
    anchors = written(rows.mapInArrow(anchor_rows(window, gram, words), "k1 long, h long, twice boolean"), "anchors")
    lists = anchors.groupBy("h").agg(F.min("k1").alias("low"), F.max("k1").alias("high"),
                                     F.max("twice").alias("twice"), F.count(F.lit(1)).alias("n"))
    repeated = (F.col("low") != F.col("high")) | (F.col("twice") if within else F.lit(False))
    lists = lists.where(repeated).select("h", (F.col("n") > hot).alias("hot"))
    by_text = (anchors.select("k1", "h").join(lists, "h").groupBy("k1")
               .agg(F.collect_set("h").alias("hs"), F.collect_set(F.when(F.col("hot"), F.col("h"))).alias("hots")))
    firsts = first_copies(docs).select(F.col("first").alias("doc_id"), "k1")
    return written(firsts.join(by_text, "k1").select("doc_id", "k1", "hs", "hots"), "repeated-anchors")


def texts_with(docs: DataFrame, info: DataFrame, how: str = "inner") -> DataFrame:
    """The texts joined with a small row for some of them, by (doc_id, k1): the small
    side is hashed, so texts are dealt out but never sorted."""
    return docs.join(info.hint("shuffle_hash"), ["doc_id", "k1"], how)


def filed(anchors: Anchors, bounds: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Places of the valid windows whose anchor is in their own text's list."""
    keep = []
    offsets = lists.offsets.to_numpy()
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    base = offsets[0]
    for k in range(len(lists)):
        a, b = int(bounds[k]), int(bounds[k + 1])
        own = np.sort(flat[offsets[k] - base:offsets[k + 1] - base])
        if not len(own) or b <= a:
            continue
        at = np.flatnonzero(anchors.valid[a:b]) + a
        least = anchors.least[at]
        found = own[np.minimum(np.searchsorted(own, least), len(own) - 1)] == least
        keep.append(at[found])
    return np.concatenate(keep) if keep else np.empty(0, np.int64)
