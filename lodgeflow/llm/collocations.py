"""Phrase collocation mining by a multikey three-way quicksort of suffix pointers.

A suffix is a place in a text with the words that follow it there, up to the longest phrase or the
end of its piece.  Sorted by three-way partitions, word by word, the suffixes that share
their first k words form the "equal" partition of depth k: its size is the number of places
of that phrase.  A partition smaller than ``least`` is abandoned, as nothing in it is frequent.

Spark routes each suffix by its leading words, so that all suffixes of a phrase meet in one bucket, and
the sort runs on buckets of bounded size:

* Words are counted first, by language.  A suffix ends before the first infrequent word, which no
  frequent phrase holds.
* A suffix is routed by its leading words up to the first one that is not hot (at least two words, at
  most all).  A hot word stands in more places than a bucket may hold; any other
  word bounds the group that it leads.  Phrases of hot words alone, shorter than the longest, are
  met in several buckets, and their counts are summed afterwards.
* Equal suffixes of a task are merged into one with a weight before they are shuffled.

Words are 64-bit codes of language and word.  The word counts show whether two share a code; if so,
the work starts again with other codes.  Up to ``RANKED`` frequent words are known to the tasks by
rank, and suffixes travel as ranks.  More than that are known as bit maps of a fixed size, for
frequent and for hot words, and suffixes travel as codes; a bit that is set by chance keeps a suffix
longer or routes it deeper, and counts do not change.

Defined results: null texts are empty, a null ``lang`` counts as ``und``; empty texts and
pieces have no words; repeated rows count each time; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, slices, text_of, written
from .hashing import Hasher, buffer_of, mix, to_lower, word_hashes, word_places

LONGEST = 5
LEAST = 100
KEEP = 2000
#: Suffixes of a bucket; a word in more places than half of that is hot.
BUCKET = 1_000_000
#: Suffixes that a task merges at once.
MERGED = 500_000
#: Frequent words that are sent to the tasks by rank (16 bytes each).
RANKED = 2_000_000
#: Bits of the maps of frequent and of hot words.
MAP_BITS = 1 << 25
WORD_BITS = 1 << 15

WORDS = "code long, lang string, word string, n long"
BLOCKS = "bucket int, places int, codes binary, lengths binary, weights binary"
PHRASES = "phrase array<long>, n long"


# --- texts to codes -------------------------------------------------------

def break_table() -> np.ndarray:
    """Bytes in lower case (A-Z), all that ends a piece as a line feed."""
    table = to_lower()
    table[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 0x0A
    return table


def lang_codes(langs: list[str], seed: int) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
                     for x in langs], np.uint64)


class Words:
    """The words of one batch: codes of language and word, places, piece and language of each."""

    def __init__(self, hasher: Hasher, batch: pa.RecordBatch, seed: int):
        data, bounds = buffer_of(batch.column("text"))
        self.data = break_table()[data]
        self.starts, self.ends, by_text = word_places(self.data, bounds)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(by_text))
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[text]
        breaks = np.cumsum(self.data == 0x0A)
        self.piece = breaks[self.starts] + text if len(self.starts) else text
        codes = word_hashes(hasher, self.data, self.starts, self.ends)
        self.codes = np.maximum(mix(codes ^ lang_codes(self.langs, seed)[self.lang]), np.uint64(1))


def texts_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of UTF-8 bytes as strings."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    taken = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(taken)])


def differing(w: Words, like: np.ndarray) -> np.ndarray:
    """Words that differ, in language or bytes, from the word at ``like``."""
    lengths = w.ends - w.starts
    out = (lengths != lengths[like]) | (w.lang != w.lang[like])
    same = np.flatnonzero(~out)
    if len(same):
        lengths = lengths[same]
        first = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(first, lengths)
        wrong = (w.data[np.repeat(w.starts[same], lengths) + place]
                 != w.data[np.repeat(w.starts[like[same]], lengths) + place])
        out[same] = np.add.reduceat(wrong, first) > 0
    return out


def count_words(seed: int):
    schema = arrow_schema(WORDS)

    def run(batches):
        hasher = Hasher(seed)
        for batch in slices(batches, 4 << 20):
            w = Words(hasher, batch, seed)
            codes, at, of, n = np.unique(w.codes, return_index=True, return_inverse=True, return_counts=True)
            # A second word with a code is told as well, so that it is seen.
            apart = np.flatnonzero(differing(w, at[of]))
            at, codes = np.append(at, apart), np.append(codes, w.codes[apart])
            n = np.append(n, np.ones(len(apart), n.dtype))
            langs = pa.array(w.langs, pa.string()).take(pa.array(w.lang[at]))
            words = texts_of(w.data, w.starts[at], w.ends[at]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), langs, words, pa.array(n)], schema=schema)
    return run


def word_counts(documents: DataFrame, seeds: int = 8) -> tuple[DataFrame, int]:
    """(code, lang, word, n) of all words, and the seed by which no two share a code."""
    for seed in range(1, seeds + 1):
        counts = documents.mapInArrow(count_words(seed), WORDS)
        words = written(counts.groupBy("code", "lang", "word").agg(F.sum("n").alias("n")), "collocation-words")
        if words.groupBy("code").count().where(F.col("count") > 1).isEmpty():
            return words, seed
    raise RuntimeError("no seed keeps the codes of all words apart")


def bit_map(words: DataFrame) -> bytes:
    """One bit for each code's place in a map of ``MAP_BITS``: its size does not depend on the table's."""
    place = F.pmod("code", F.lit(MAP_BITS))
    parts = (words.select(F.floor(place / WORD_BITS).cast("int").alias("part"), F.pmod(place, F.lit(WORD_BITS)).alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for r in parts.toLocalIterator():
        out[r.part * WORD_BITS // 8:(r.part + 1) * WORD_BITS // 8] = np.frombuffer(r.bits, np.uint8)[:WORD_BITS // 8]
    return out.tobytes()


def in_map(bits: bytes, codes: np.ndarray) -> np.ndarray:
    place = codes % np.uint64(MAP_BITS)
    found = np.frombuffer(bits, np.uint8)[(place >> np.uint64(3)).astype(np.int64)]
    return (found >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


class Ranked:
    """Frequent words by rank, from 1, the most frequent first; 0 is any other word."""

    def __init__(self, codes: np.ndarray, hot: int):
        self.hot_words, self.by_rank = hot, np.append(np.uint64(0), codes)
        self.ranks = np.argsort(codes).astype(np.uint32) + np.uint32(1)
        self.sorted = codes[self.ranks - 1]

    def kept(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.zeros(len(codes), np.uint32)
        at = np.minimum(np.searchsorted(self.sorted, codes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == codes, self.ranks[at], np.uint32(0))

    def hot(self, values: np.ndarray) -> np.ndarray:
        return (values > 0) & (values <= self.hot_words)

    def codes(self, values: np.ndarray) -> np.ndarray:
        return self.by_rank[values]


class Mapped:
    """Frequent and hot words by bit maps; frequent words are their codes, 0 is any other."""

    def __init__(self, frequent: bytes, hot: bytes):
        self.frequent_bits, self.hot_bits = frequent, hot

    def kept(self, codes: np.ndarray) -> np.ndarray:
        return np.where(in_map(self.frequent_bits, codes), codes, np.uint64(0))

    def hot(self, values: np.ndarray) -> np.ndarray:
        return (values > 0) & in_map(self.hot_bits, values)

    def codes(self, values: np.ndarray) -> np.ndarray:
        return values


def lexicon(words: DataFrame, least: int, bucket: int) -> Ranked | Mapped:
    frequent, hot = words.where(F.col("n") >= least), words.where(F.col("n") > bucket // 2)
    first = frequent.select("code").limit(RANKED + 1).count()
    if first > RANKED:
        return Mapped(bit_map(frequent), bit_map(hot))
    codes = frequent.orderBy(F.col("n").desc(), "code").select("code").toArrow()["code"].to_numpy().view(np.uint64)
    return Ranked(codes, hot.count())


# --- suffixes and their buckets -------------------------------------------

def suffix_columns(codes: np.ndarray, piece: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Words 0 to longest - 1 of each suffix (rows by depth), 0 behind its end; and its length."""
    n = len(codes)
    columns = np.zeros((longest, n), codes.dtype)
    there = codes > 0
    lengths = np.zeros(n, np.uint8)
    for k in range(min(longest, n)):
        if k:
            there = there[:n - k] & (codes[k:] > 0) & (piece[k:] == piece[:n - k])
        columns[k, :len(there)] = np.where(there, codes[k:], 0)
        lengths[:len(there)] += there
        there = np.append(there, np.zeros(n - len(there), bool))
    return columns, lengths


def routes(columns: np.ndarray, lengths: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the leading words by which a suffix is routed, and one of all its words."""
    key = np.zeros(columns.shape[1], np.uint64)
    whole = np.zeros(columns.shape[1], np.uint64)
    going = np.ones(columns.shape[1], bool)
    for k, column in enumerate(columns):
        there = k < lengths
        whole = np.where(there, mix(whole ^ column.astype(np.uint64)) * np.uint64(2 * k + 3), whole)
        key = np.where(there & (going | (k < 2)), whole, key)
        going &= hot[k]
    return mix(key), whole


def planes(values: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second bytes, and so on: high bytes shrink well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def of_planes(data: bytes, dtype: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def route_suffixes(seed: int, known: Ranked | Mapped, buckets: int, longest: int):
    schema = arrow_schema(BLOCKS)

    def blocks(kept: list[tuple[np.ndarray, np.ndarray]]):
        columns = np.concatenate([c for c, _ in kept], axis=1)
        lengths = np.concatenate([n for _, n in kept])
        key, whole = routes(columns, lengths, known.hot(columns))
        bucket = (key % np.uint64(buckets)).astype(np.int32)
        # Equal suffixes stand together by bucket and hash; where words differ, they stay apart.
        order = np.lexsort((whole, bucket))
        columns, lengths, bucket = columns[:, order], lengths[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (columns[:, 1:] != columns[:, :-1]).any(axis=0) | (bucket[1:] != bucket[:-1])
        at = np.flatnonzero(new)
        weights = np.diff(np.append(at, len(order))).astype(np.uint32)
        columns, lengths, bucket = columns[:, at], lengths[at], bucket[at]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
            yield pa.RecordBatch.from_pylist([{
                "bucket": int(bucket[a]), "places": int(b - a), "lengths": lengths[a:b].tobytes(), "weights": weights[a:b].tobytes(),
                "codes": planes(np.concatenate([c[a:b][lengths[a:b] > k] for k, c in enumerate(columns)]))}], schema)

    def run(batches):
        hasher, kept, n = Hasher(seed), [], 0
        for batch in slices(batches, 2 << 20):
            w = Words(hasher, batch, seed)
            columns, lengths = suffix_columns(known.kept(w.codes), w.piece, longest)
            take = lengths >= 2
            kept.append((columns[:, take], lengths[take]))
            n += int(take.sum())
            if n >= MERGED:
                yield from blocks(kept)
                kept, n = [], 0
        if n:
            yield from blocks(kept)
    return run


# --- the sort of a bucket -------------------------------------------------

def equal_partitions(columns: np.ndarray, lengths: np.ndarray, weights: np.ndarray, hot: np.ndarray, least: int):
    """Multikey three-way quicksort of the suffixes; yields (row, depth, size) for each equal partition
    of two words or more that is frequent, or made of hot words alone and so not whole here.

    ``row`` is a suffix of the partition.  Pointers to suffixes move, the words stay.
    """
    longest = len(columns)
    # (pointers, words that they share, whether those are all hot, whether the next one is too)
    todo = [(np.flatnonzero(~hot[0]), 0, True, False), (np.flatnonzero(hot[0]), 0, True, True)]
    while todo:
        rows, depth, all_hot, hot_next = todo.pop()
        partial = all_hot and hot_next and depth + 1 < longest
        if not len(rows) or not partial and weights[rows].sum() < least:
            continue
        words = columns[depth][rows]
        sample = np.sort(words[:: max(1, len(words) // 15)])
        pivot = sample[len(sample) // 2]
        for side in (words < pivot, words > pivot):
            if side.any():
                todo.append((rows[side], depth, all_hot, hot_next))
        rows = rows[words == pivot]
        size = int(weights[rows].sum())
        depth += 1
        if size < least and not partial:
            continue
        if depth > 1:
            yield int(rows[0]), depth, size
        rows = rows[lengths[rows] > depth]
        if depth < longest and len(rows):
            if partial:
                more = hot[depth][rows]
                todo += [(rows[more], depth, True, True), (rows[~more], depth, True, False)]
            else:
                todo.append((rows, depth, False, False))


def sort_bucket(known: Ranked | Mapped, least: int, longest: int):
    schema = arrow_schema(PHRASES)

    def run(table: pa.Table) -> pa.Table:
        dtype = known.kept(np.empty(0, np.uint64)).dtype
        parts = {name: [x.as_py() for x in table[name]] for name in ("codes", "lengths", "weights")}
        lengths = np.frombuffer(b"".join(parts["lengths"]), np.uint8)
        weights = np.frombuffer(b"".join(parts["weights"]), np.uint32).astype(np.int64)
        columns = np.zeros((longest, len(lengths)), dtype)
        at = 0
        for codes, own in zip(parts["codes"], parts["lengths"]):
            values, own = of_planes(codes, dtype), np.frombuffer(own, np.uint8)
            done = 0
            for k in range(longest):
                there = np.flatnonzero(own > k)
                columns[k, at + there] = values[done:done + len(there)]
                done += len(there)
            at += len(own)
        phrases, sizes = [], []
        for row, depth, size in equal_partitions(columns, lengths, weights, known.hot(columns), least):
            phrases.append(known.codes(columns[:depth, row]).view(np.int64).tolist())
            sizes.append(size)
        return pa.Table.from_arrays([pa.array(phrases, schema.field("phrase").type), pa.array(sizes, pa.int64())], schema=schema)
    return run


def frequent_phrases(documents: DataFrame, words: DataFrame, seed: int, total: int, least: int, longest: int,
                     bucket: int) -> DataFrame:
    """(phrase, n) of each phrase of 2 to ``longest`` words with at least ``least`` places."""
    known = lexicon(words, least, bucket)
    buckets = max(1, -(-total // bucket))
    routed = documents.mapInArrow(route_suffixes(seed, known, buckets, longest), BLOCKS)
    found = routed.groupBy("bucket").applyInArrow(sort_bucket(known, least, longest), PHRASES)
    return found.groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- scores ---------------------------------------------------------------

def wide(c: str):
    return F.col(c).cast("decimal(38,0)")


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame, longest: int) -> DataFrame:
    """(phrase, lang, a, l, r, n, score) of each phrase by its lowest-scoring cut, the first of equal ones."""
    counts = phrases.unionByName(words.select(F.array("code").alias("phrase"), "n"))
    langs = words.select(F.col("code").alias("first"), "lang")
    cuts = (phrases.select("phrase", F.col("n").alias("a"),
                           F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
            .withColumn("head", F.slice("phrase", F.lit(1), F.col("k")))
            .withColumn("tail", F.slice("phrase", F.col("k") + 1, F.lit(longest))))
    cuts = (cuts.join(counts.select(F.col("phrase").alias("head"), F.col("n").alias("l")), "head")
            .join(counts.select(F.col("phrase").alias("tail"), F.col("n").alias("r")), "tail")
            .withColumn("first", F.get("phrase", F.lit(0))).join(langs, "first").join(totals, "lang"))
    score = F.expr("cast((cast(1000 as decimal(38,0)) * cast(a as decimal(19,0)) * n) div (cast(l as decimal(19,0)) * r) as long)")
    cuts = cuts.withColumn("score", score)
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return (cuts.groupBy("phrase", "lang", "a", "n").agg(best)
            .select("phrase", "lang", "a", "best.l", "best.r", "n", "best.score"))


def within_longer(phrases: DataFrame) -> DataFrame:
    """(phrase, longer): the highest count among the candidates with one word more that hold it.  A phrase that
    any longer one holds as often is held as often by one of these, as counts fall with each word."""
    size = F.size("phrase")
    shorter = F.array(F.slice("phrase", F.lit(1), size - 1), F.slice("phrase", F.lit(2), size - 1))
    return (phrases.where(size > 2).select(F.explode(shorter).alias("phrase"), "n")
            .groupBy("phrase").agg(F.max("n").alias("longer")))


def collocations(documents: DataFrame, keep: int | None = KEEP, least: int = LEAST, longest: int = LONGEST,
                 bucket: int = BUCKET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``keep`` best phrases, all with None."""
    texts = documents.select(text_of().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    words, seed = word_counts(texts)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    kept_words = words.where(F.col("n") >= least)
    phrases = written(frequent_phrases(texts, words, seed, total, least, longest, bucket), "collocation-phrases")
    found = scored(phrases, kept_words, totals, longest)
    longer = within_longer(phrases)
    found = found.join(longer, "phrase", "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    named = (found.select("*", F.posexplode("phrase").alias("at", "code")).join(kept_words.select("code", "word"), "code")
             .groupBy("phrase", "lang", "a", "l", "r", "n", "score")
             .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt")))
    named = named.withColumn("phrase", F.array_join(F.transform("spelt", lambda s: s["word"]), " "))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order))
    if keep is not None:
        ranked = ranked.where(F.col("rank") <= keep)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
