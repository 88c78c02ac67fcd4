"""Removal of byte strings that repeat, by threshold-bounded expansion on a BWT.

Windows of ``length`` bytes are filed under anchors; only anchors that repeat are
followed.  A segment is a run of windows of one anchor, and equal segments are merged
before they meet.  Where an anchor has several different segments, a task joins
them to one text, forms its Burrows-Wheeler transform, and expands intervals breadth first
by backward extension: level l marks the places of the suffix array whose common prefix
is l bytes long, and the search stops at the minimum length.  What is unmarked then
separates nothing: suffixes between two marks share the window.  The earliest place
(doc_id, then start) owns a window; every other place loses its bytes.

Anchors that very many texts hold are split by a second anchor of the same windows.  What
is still larger than a block goes to several transforms, each with its share of the different
segments; a block's own windows, one of each kind, then meet those of the bucket's other
blocks by 128-bit hashes.

Defined results: null and empty texts have no bytes; rows without doc_id keep all bytes and
take none from others; equal texts lose all bytes but in the smallest doc_id; texts
shorter than a window stay whole; an empty table gives an empty result; other columns are
ignored.  Long texts are searched whole.  Cuts are judged on bytes, so what is
kept of a text can end inside a character: ``kept`` is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.joins import bounded_broadcast
from .common import arrow_schema, slices, written
from .hashing import Anchors, Hasher, buffer_of, mix
from .repeats import SLICE, filed, first_copies, keyed, repeated_anchors, texts_with

LENGTH = 100
GRAM = 40
#: Texts with an anchor beyond which its windows are split by a second anchor.
HOT = 2000
#: Bytes of different segments in one transform; a larger bucket is dealt to several.
BLOCK = 1 << 20
#: Bytes of small buckets that are transformed together, so that a worker holds the numbers of few.
GATHERED = 1 << 18
#: Bytes of rows that a worker has as Python objects, or gives back, at a time.
HELD = 1 << 20
#: Separates segments; no byte of UTF-8.
END = 255


def least_rotations(text: np.ndarray, length: int) -> np.ndarray:
    """Starts of all rotations of ``text``, sorted by their first ``length`` bytes at least."""
    n = len(text)
    wide = np.concatenate([text, np.resize(text, 8)]).astype(np.uint64)
    rank = np.zeros(n, np.uint64)
    for k in range(8):
        rank = (rank << np.uint64(8)) | wide[k:k + n]
    span = 8
    while True:
        order = np.argsort(rank, kind="stable")
        ranked = rank[order]
        if span >= length:
            return order
        dense = np.empty(n, np.uint64)
        dense[order] = np.cumsum(np.concatenate([[0], (ranked[1:] != ranked[:-1]).astype(np.uint64)]), dtype=np.uint64)
        if dense[order[-1]] == n - 1:
            return order
        rank = dense * np.uint64(n) + np.roll(dense, -span)
        span *= 2


def marks(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at k where the rotations k - 1 and k of ``order`` share less than ``length`` bytes.

    Intervals are rows [low, high) of the transform that share a prefix.  A level
    extends each by every byte that precedes it; an extension whose end is unmarked gets the
    mark and goes on to the next level.
    """
    n = len(text)
    # Numbers of 32 bits, where intervals times bytes fit them: a block has several of each byte.
    small = np.int32 if n < 1 << 22 else np.int64
    last = text[order - 1]
    steps = np.empty(n, small)
    steps[np.argsort(last, kind="stable")] = np.arange(n, dtype=small)
    marked = np.zeros(n + 1, bool)
    marked[[0, n]] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        if not len(low):
            break
        sizes = high - low
        begins = np.cumsum(sizes) - sizes
        rows = np.arange(int(sizes.sum()), dtype=small) + np.repeat((low - begins).astype(small), sizes)
        # Rows of one interval with one preceding byte move to adjacent rows, in order.
        key = np.repeat(np.arange(len(low), dtype=small) * small(256), sizes)
        key += last[rows]
        group = np.argsort(key, kind="stable")
        to, key = steps[rows[group]], key[group]
        firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        low = to[firsts]
        high = to[np.append(firsts[1:], len(to)) - 1] + 1
        fresh = ~marked[high]
        marked[high[fresh]] = True
        low, high = low[fresh], high[fresh]
    return marked[:n]


def owners(segments: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, offset, owner's doc, owner's start) of each window of the segments.

    ``docs`` and ``starts`` give the earliest place of each segment.
    """
    sizes = np.array([len(s) for s in segments])
    text = np.frombuffer(b"".join([s + bytes([END]) for s in segments]), np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    order = least_rotations(text, length)
    group = np.cumsum(marks(text, order, length))
    segment = np.repeat(np.arange(len(segments)), sizes + 1)
    offset = np.arange(len(text)) - begins[segment]
    whole = (offset + length <= sizes[segment])[order]
    at, group = order[whole], group[whole]
    seg, off = segment[at], offset[at]
    doc, start = docs[seg], starts[seg] + off
    rank = np.lexsort((start, doc, group))
    sorted_group = group[rank]
    firsts = np.flatnonzero(np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]]))
    first = np.repeat(rank[firsts], np.diff(np.append(firsts, len(rank))))
    return seg[rank], off[rank], doc[first], start[first]


SEGMENT = "bucket long, segment long, doc_id long, k1 long, start int, bytes binary"


def cut_segments(length: int, gram: int, most: int):
    """(doc_id, k1, text, hs, hots) -> the runs of windows of repeated anchors, a longer run in
    pieces of ``most`` windows (pieces share length - 1 bytes, so no window is lost)."""
    out = arrow_schema(SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, second = Hasher(), Hasher(2)
        for batch in slices(batches, SLICE):
            doc_id, k1, texts, lists, hots = batch.columns
            data, bounds = buffer_of(texts)
            if len(data) < length:
                continue
            values = hasher.values[data]
            sums = hasher.sums(values)
            anchors = Anchors(hasher, sums, bounds, length, gram)
            at = filed(anchors, bounds, lists)
            if not len(at):
                continue
            bucket = anchors.least[at]
            hot = np.isin(at, filed(anchors, bounds, hots))
            if hot.any():
                other = Anchors(second, second.sums(second.values[data]), bounds, length, gram)
                bucket = np.where(hot, mix(bucket + other.least[at]), bucket)
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) != 1) | (bucket[1:] != bucket[:-1])
            firsts = np.flatnonzero(new)
            new |= (np.arange(len(at)) - firsts[np.cumsum(new) - 1]) % most == 0
            firsts = np.flatnonzero(new)
            a = at[firsts]
            b = at[np.append(firsts[1:], len(at)) - 1] + length
            doc = np.searchsorted(bounds, a, "right") - 1
            raw = data.tobytes()
            which = pa.array(doc)
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[firsts].view(np.int64)), pa.array(hasher.stretch(sums, a, b).view(np.int64)),
                doc_id.take(which), k1.take(which), pa.array((a - bounds[doc]).astype(np.int32)),
                pa.array([raw[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary())], schema=out)

    return run


OWNED = "bucket long, segment long, low int, high int, owner long, owner_start int, own binary"


def expand(length: int, block: int):
    """Different segments, sorted by bucket and part -> stretches of windows and the earliest place,
    in the part, of a stretch's first window.  The windows of a stretch are all owners, or all have
    an earlier place; ``own`` has the bytes of a stretch of owners whose part is one of several."""
    out = arrow_schema(OWNED)

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        rows.sort(key=lambda r: r[:3])
        bucket, parts, segment, docs, starts, texts = zip(*rows)
        docs, starts = np.array(docs), np.array(starts)
        seg, off, doc, start = owners(list(texts), docs, starts, length)
        order = np.lexsort((off, seg))
        seg, off, doc, start = seg[order], off[order], doc[order], start[order]
        owner = (doc == docs[seg]) & (start == starts[seg] + off)
        new = np.ones(len(seg), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (owner[1:] != owner[:-1])
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(seg)) - 1
        seg, low, high, doc, start = seg[firsts], off[firsts], off[lasts], doc[firsts], start[firsts]
        bucket, segment = np.array(bucket)[seg], np.array(segment)[seg]
        own = (np.array(parts)[seg] > 0) & owner[firsts]
        return pa.RecordBatch.from_arrays([
            pa.array(bucket), pa.array(segment), pa.array(low.astype(np.int32)),
            pa.array(high.astype(np.int32)), pa.array(doc), pa.array(start.astype(np.int32)),
            pa.array([texts[k][a:b + length] if x else None for k, a, b, x in zip(
                seg.tolist(), low.tolist(), high.tolist(), own.tolist())], pa.binary())], schema=out)

    def alone(rows: list[tuple]) -> bool:
        """Whether no window repeats: the middle, which all windows hold, stands there once."""
        text = rows[0][5]
        middle = len(text) - length
        return len(rows) == 1 and length - middle >= 16 and text.find(text[middle:length], middle + 1) < 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, singles, group = 0, [], []

        def close() -> None:
            nonlocal size
            if group and alone(group):
                singles.extend(group)
            else:
                held.extend(group)
                size += sum(len(r[5]) + 1 for r in group)
            group.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if held:
                yield solve(held)
            if singles:
                b, p, s, d, a, t = zip(*singles)
                zero = np.zeros(len(b), np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(b), pa.array(s), pa.array(zero),
                    pa.array(np.array([len(x) - length for x in t], np.int32)),
                    pa.array(d), pa.array(a, pa.int32()),
                    pa.array([x if k else None for k, x in zip(p, t)], pa.binary())], schema=out)
            held.clear()
            singles.clear()
            size = 0

        for batch in slices(batches, HELD):
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if group and group[0][:2] != row[:2]:
                    close()
                    if size >= min(block, GATHERED) or len(singles) >= 50_000:
                        yield from flush()
                group.append(row)
        close()
        yield from flush()

    return run


WINDOW = "bucket long, segment long, at int, doc_id long, start int, w1 long, w2 long"


def own_windows(length: int):
    """Own stretches -> their windows: offset in the segment, place, and two hashes."""
    out = arrow_schema(WINDOW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = Hasher(), Hasher(2)
        for batch in slices(batches, SLICE):
            bucket, segment, low, doc_id, start, texts = batch.columns
            data, bounds = buffer_of(texts)
            n = np.diff(bounds) - length + 1
            row = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            at = bounds[row] + step
            hashes = [h.stretch(h.sums(h.values[data]), at, at + length) for h in hashers]
            low, start = (c.to_numpy()[row] + step.astype(np.int32) for c in (low, start))
            which = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                bucket.take(which), segment.take(which), pa.array(low, pa.int32()), doc_id.take(which),
                pa.array(start, pa.int32()), *[pa.array(h.view(np.int64)) for h in hashes]], schema=out)

    return run


def dealt(segments: DataFrame, block: int) -> DataFrame:
    """bucket, part, segment, doc_id, start, bytes of the different segments: part 0 of a bucket
    of at most ``block`` bytes, parts 1, 2, ... of about that size of a larger one."""
    large = (segments.groupBy("bucket", "segment").agg(F.first(F.length("bytes")).alias("n"))
             .groupBy("bucket").agg(F.sum(F.col("n") + 1).alias("n")).where(F.col("n") > block)
             .select("bucket", F.ceil(F.col("n") / block).alias("parts")))
    large = bounded_broadcast(written(large, "large-buckets"))
    # The hash-equal segments of a bucket are one; min_by and min take the same row's place.
    place = F.struct("doc_id", "start")
    different = segments.groupBy("bucket", "segment").agg(
        F.min(place).alias("p"), F.first("bytes").alias("bytes"))
    part = F.coalesce(F.pmod(F.xxhash64("segment"), F.col("parts")) + 1, F.lit(0)).cast("int")
    return different.join(large, "bucket", "left").select(
        "bucket", part.alias("part"), "segment", F.col("p.doc_id").alias("doc_id"),
        F.col("p.start").alias("start"), "bytes")


def owned(segments: DataFrame, length: int, block: int) -> DataFrame:
    """bucket, segment, low, high, owner, owner_start: stretches of windows of the different segments,
    with an earlier place of the first one if all have one, else its own place."""
    solved = written(dealt(segments, block).repartition("bucket", "part").sortWithinPartitions("bucket", "part")
                     .mapInArrow(expand(length, block), OWNED), "solved")
    windows = (solved.where(F.col("own").isNotNull())
               .select("bucket", "segment", "low", "owner", "owner_start", "own")
               .mapInArrow(own_windows(length), WINDOW))
    place = F.struct("doc_id", "start")
    first = (windows.groupBy("bucket", "w1", "w2").agg(F.min(place).alias("p"), F.max(place).alias("q"))
             .where(F.col("p") != F.col("q")).select("bucket", "w1", "w2", "p"))
    across = (windows.join(first, ["bucket", "w1", "w2"]).where(F.col("p") < place)
              .select("bucket", "segment", F.col("at").alias("low"), F.col("at").alias("high"),
                      F.col("p.doc_id").alias("owner"), F.col("p.start").alias("owner_start")))
    return solved.drop("own").unionByName(across)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return joined


def kept_bytes(text: bytes, copy: bool | None, spans: list[dict] | None, length: int) -> tuple[bytes, int]:
    """What is left of a text, and the number of stretches that were cut out."""
    gone = [(0, len(text))] if copy and len(text) >= length else merged(spans)
    kept, at = [], 0
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), len(gone)


def cut(length: int, with_bytes: bool):
    out = arrow_schema(RESULT if with_bytes else RESULT.removesuffix(", kept binary"))

    def row(doc_id, text: bytes, copy: bool | None, spans: list[dict] | None) -> tuple:
        kept, n_spans = kept_bytes(text, copy, spans, length)
        made = (doc_id, len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())
        return (*made, kept) if with_bytes else made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, HELD):
            i, t, c, s = batch.columns
            rows = [row(*x) for x in zip(i.to_pylist(), t.cast(pa.large_binary()).to_pylist(),
                                         c.to_pylist(), s.to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return run


def removed_spans(docs: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """doc_id, k1, copy, spans of the texts that lose bytes."""
    candidates = repeated_anchors(docs, length, gram, words=False, within=True, hot=hot)
    texts = texts_with(docs, candidates).select("doc_id", "k1", "text", "hs", "hots")
    segments = written(texts.mapInArrow(cut_segments(length, gram, max(length, BLOCK // 4)), SEGMENT), "segments")
    solved = owned(segments, length, BLOCK)
    found = (segments.select("bucket", "segment", "doc_id", "k1", "start").join(solved, ["bucket", "segment"])
             .where((F.col("owner") < F.col("doc_id")) | (
                 (F.col("owner") == F.col("doc_id")) & (F.col("owner_start") < F.col("start") + F.col("low"))))
             .select("doc_id", "k1", F.struct((F.col("start") + F.col("low")).alias("a"),
                                              (F.col("start") + F.col("high") + length).alias("b")).alias("span")))
    spans = found.groupBy("doc_id", "k1").agg(F.collect_set("span").alias("spans"))
    copies = (docs.select("doc_id", "k1", "k2").join(first_copies(docs), ["k1", "k2"])
              .where(F.col("doc_id") > F.col("first")).select("doc_id", "k1").distinct()
              .withColumn("copy", F.lit(True)))
    return written(copies.join(spans, ["doc_id", "k1"], "full"), "removals")


def suffix_dedup(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
                 with_bytes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked
    for, the kept bytes."""
    if not 8 <= gram <= length:
        raise ValueError("anchors have 8 bytes or more and fit into a window")
    docs = keyed(documents)
    info = removed_spans(docs, length, gram, hot)
    return (texts_with(docs, info, "left").select("doc_id", "text", "copy", "spans")
            .mapInArrow(cut(length, with_bytes), RESULT if with_bytes else RESULT.removesuffix(", kept binary")))


def trimmed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, HELD):
            row, text, copy, spans = batch.columns
            kept = []
            for t, c, s in zip(text.cast(pa.large_binary()).to_pylist(), copy.to_pylist(), spans.to_pylist()):
                made = kept_bytes(t, c, s, length)[0]
                kept.append(made.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([row, pa.array(kept, pa.string())], names=["row", "kept"])

    return run


def without_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """The documents with their repeated bytes removed from ``text``, all other columns as they
    are.  Bytes left of a character that a cut went through are dropped; null texts stay null."""
    info = removed_spans(keyed(documents), length, gram, hot)
    rest = [F.col(c) for c in documents.columns if c != "text"]
    null = "_null"
    while null in map(str.lower, documents.columns):
        null += "_"
    rows = keyed(documents, F.struct(F.col("text").isNull().alias(null), *rest).alias("row"))
    joined = texts_with(rows, info, "left").select("row", "text", "copy", "spans")
    schema = StructType([joined.schema["row"], StructField("kept", StringType())])
    made = joined.mapInArrow(trimmed(length), schema)
    return made.select(*[
        F.when(~F.col(f"row.{null}"), F.col("kept")).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
        for c in documents.columns])
