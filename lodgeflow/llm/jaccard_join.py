"""Exact Jaccard join of documents' word shingles, by size-banded tiles and bitmaps.

Equal shingle sets are merged first.  Of each set, its rarest shingles are posted: two sets
at the threshold share one of them.  "Rare" is any order that all sets share; here the
most frequent shingles of the corpus, a list of bounded length, come last, and so long lists
of unrelated documents do not arise.  Only shingles posted by several sets are followed, and of
their sets only those that may link with another one there: the place of the first shingle
that two sets share bounds their overlap.

A posting list is cut into tiles by size band, since sets at the threshold are of like size,
and long lists further into blocks.  In a tile, bitmaps of hashed shingles are compared first:
the bits in which two differ bound the overlap from above.  Pairs that may reach the
threshold are settled by intersecting sorted arrays.  A first round joins sets inside small
tiles of a few lists by spanning trees of the likest pairs, so that groups of near copies
collapse; the second round compares across those groups in all tiles of all lists, so that no
link between groups is lost.  Its pairs are settled in passes, the likest of each set first:
what earlier links have joined need not be settled.  Tiles hold bitmaps alone; shingles are
only gathered for the pairs that a pass takes.

Defined results: null and empty texts have empty sets, linked with nothing; a text of
fewer words than a shingle is one shingle; rows without doc_id have no component; rows with
equal doc_id are one document, which links as any of its texts does (``one_of_each`` judges each
of its rows by its own text); an empty table gives an empty result; other columns are ignored.
Long texts count whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, let_go, slices, text_of, without, written
from .components import components
from .hashing import Hasher, buffer_of, mix, word_hashes, word_places

WORDS = 5
PERCENT = 80
#: Shingles that come last in the common order: the most frequent ones, so many at most.
FREQUENT = 1 << 16
#: Bytes of text in which repeated shingles are counted before they are summed up.
COUNTED = 4 << 20
#: Lists of each set that the first round uses, and sets in one of its tiles.
FIRST_LISTS = 3
FIRST_TILE = 256
#: Sets in one block of a tile of the second round.
BLOCK = 2048
#: So many of a set's first shingles in lists say in which tile of the second round it meets another.
FIRSTS = 8
#: In tiles of up to so many pairs each pair is looked at alone.
FEW_PAIRS = 8
#: Lists of up to so many sets are searched for the sets that may link there.
SHORT_LIST = 64
#: Pairs of each set that the first pass over the second round's pairs settles; each later pass
#: takes so many times more, until none is left.
PASS = 8
NO_SHINGLE = np.iinfo(np.int64).max
SLICE = 512 << 10


def shingles(hasher: Hasher, texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text, shingle hash) pairs, as two arrays."""
    data, bounds = buffer_of(texts)
    starts, ends, first = word_places(data, bounds)
    sums = hasher.sums(word_hashes(hasher, data, starts, ends, lower=True))
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc))
    full = at + words <= first[1:][doc]
    at, doc = at[full], doc[full]
    h = hasher.stretch(sums, at, at + words)
    few = np.flatnonzero((n > 0) & (n < words))
    h = np.concatenate([h, hasher.stretch(sums, first[:-1][few], first[1:][few])])
    doc = np.concatenate([doc, few])
    order = np.argsort(h)
    # Short numbers are sorted in one pass.
    order = order[np.argsort(doc[order].astype(np.uint16 if len(n) < 1 << 16 else np.int64), kind="stable")]
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def count_repeats(words: int):
    out = arrow_schema("h long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, COUNTED):
            seen = [shingles(hasher, b.column(0), words)[1] for b in slices([batch], SLICE)]
            h, n = np.unique(np.concatenate(seen), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[n > 1].view(np.int64)), pa.array(n[n > 1])], schema=out)

    return run


def frequent_shingles(docs: DataFrame, words: int, most: int) -> np.ndarray:
    """At most ``most`` shingle hashes, the most frequent last.  They only set the order in which
    shingles are posted; results do not depend on them."""
    rows = (docs.select("text").mapInArrow(count_repeats(words), "h long, n long")
            .groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(most).toArrow())
    return rows["h"].to_numpy().view(np.uint64)[::-1].copy()


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's n shingles are posted: all but ceil(percent n / 100), and one more."""
    return n + 1 + (-percent * n) // 100


SETS = "doc_id long, text_key long, n long, s1 long, s2 long, posted array<long>, bits binary"


def set_rows(words: int, percent: int, frequent: np.ndarray):
    """(doc_id, text, text_key) -> size, two hashes of the set, the posted shingles, rarest
    first, and the bitmap."""
    out = arrow_schema(SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        order = np.argsort(frequent)
        known = frequent[order]
        for batch in slices(batches, SLICE):
            doc, h = shingles(hasher, batch.column(1), words)
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            n = np.diff(bounds)
            total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(k)), dtype=np.uint64)])
                     for k in (0, 0x5851F42D4C957F2D)]
            s1, s2 = (t[bounds[1:]] - t[bounds[:-1]] for t in total)
            rank = np.zeros(len(h), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                rank = np.where(known[at] == h, order[at] + 1, 0)
            by = np.argsort(doc * (len(known) + 1) + rank, kind="stable")
            place = np.arange(len(h)) - bounds[:-1][doc]
            keep = by[place < prefix_size(n, percent)[doc]]
            sizes = np.where(n > 0, prefix_size(n, percent), 0)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(n.astype(np.int64)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[keep].view(np.int64)), type=out.types[5]),
                pa.array([bitmap(h[a:b]).tobytes() if b > a else None for a, b in zip(bounds, bounds[1:])], pa.binary())],
                schema=out)

    return run


def bitmap(h: np.ndarray) -> np.ndarray:
    """Two bits or more for each shingle, a power of two in all, by the hashes' top bits."""
    width = max(6, int(2 * len(h) - 1).bit_length())
    bits = np.zeros(1 << width, np.uint8)
    bits[h >> np.uint64(64 - width)] = 1
    return np.packbits(bits)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of the same set with fewer bits: neighbouring bits fall together."""
    bits = np.unpackbits(bits)
    return np.packbits(bits.reshape(size * 8, -1).max(1))


def band(n):
    """Sets at the threshold of 80 per cent lie in one band or in adjacent ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.25)) + 1e-9).cast("int")


POSTS = "h long, node long, n long, place int"


def most_size(n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """The largest set that a set of n shingles can link with, if the first shingle that both have stands at ``place``."""
    return (100 + percent) * (n - place) // percent - n


def may_link(h: np.ndarray, n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of lists, sorted by h, may link with another row of their list.  All rows of long lists may."""
    most = most_size(n, place, percent)
    fit = np.zeros(len(h), bool)
    for far in range(1, min(SHORT_LIST, len(h))):
        a = np.flatnonzero(h[far:] == h[:-far])
        if not len(a):
            return fit
        b = a + far
        good = ((n[b] <= most[a]) & (n[a] <= most[b])
                & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])))
        fit[a[good]] = fit[b[good]] = True
    far = SHORT_LIST
    if len(h) > far:
        for a in np.unique(h[far:][h[far:] == h[:-far]]):
            fit[np.searchsorted(h, a):np.searchsorted(h, a, "right")] = True
    return fit


def followed(percent: int):
    """Rows (h, node, n, place) sorted by h and node -> those that may link in the list of h, each once.

    The last list of a batch waits for the next one; a long list goes on as it comes."""
    out = arrow_schema(POSTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long, last = None, None, None

        def kept(columns: list[np.ndarray], at: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c[at], t) for c, t in zip(columns, out.types)], schema=out)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            h, node = columns[:2]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
            new[0] = last != (h[0], node[0])
            last = (h[-1], node[-1])
            columns = [c[new] for c in columns]
            if long is not None:
                # The rest of a list that is known to be long.
                end = np.searchsorted(columns[0], long, "right")
                if end:
                    yield kept(columns, np.arange(end))
                columns = [c[end:] for c in columns]
            if not len(columns[0]):
                continue
            long = None
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns)]
            h = columns[0]
            end = np.searchsorted(h, h[-1])
            if len(h) - end > SHORT_LIST:
                end, long, held = len(h), h[-1], None
            else:
                held = [c[end:] for c in columns]
            yield kept(columns, np.flatnonzero(may_link(*(columns[k][:end] for k in (0, 2, 3)), percent)))
        if held is not None:
            yield kept(held, np.flatnonzero(may_link(held[0], held[2], held[3], percent)))

    return run


NODE = "node long, shingles binary"


def node_rows(words: int):
    """(node, s1, text) -> sorted shingles, once for each node of the task."""
    out = arrow_schema(NODE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, met = Hasher(), set()
        for batch in slices(batches, SLICE):
            doc, h = shingles(hasher, batch.column(2), words)
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            rows = []
            for i, s1, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bounds, bounds[1:]):
                own = h[a:b]
                if i not in met and int(mix(own).sum(dtype=np.uint64).view(np.int64)) == s1:
                    met.add(i)
                    rows.append((i, own.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return run


def matrix(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps of one tile, folded to the smallest, as rows of 64-bit words."""
    size = min(map(len, bitmaps))
    rows = [b if len(b) == size else folded(np.frombuffer(b, np.uint8), size).tobytes() for b in bitmaps]
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1)


def likeness(bits: np.ndarray, n: np.ndarray, own: np.ndarray, size: int, percent: int) -> np.ndarray:
    """The highest similarity that rows can have with a set of the given bitmap and size, in
    millionths; -1 where that is below the threshold.

    Each differing bit stands for a shingle of one set alone, so the overlap is at most half
    of (both sizes - differing bits).
    """
    differ = np.bitwise_count(bits ^ own).sum(1, dtype=np.int64)
    most = np.minimum((n + size - differ) // 2, np.minimum(n, size))
    union = n + size - most
    return np.where(100 * most >= percent * union, 1_000_000 * most // union, -1)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def tiles(solve: Callable[[list[tuple]], list[tuple]], keys: int, ddl: str):
    """Runs ``solve`` on each run of rows with equal first ``keys`` columns."""
    out = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        made: list[tuple] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), out.types)], schema=out)
            made.clear()
            return batch

        for batch in slices(batches):
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and held[0][:keys] != row[:keys]:
                    made.extend(solve(held))
                    held = []
                    if len(made) >= 10_000:
                        yield flush()
                held.append(row)
        if held:
            made.extend(solve(held))
        if made:
            yield flush()

    return run


def join_tile(percent: int):
    """Rows (h, band, sub, node, n, bits) of one tile -> a spanning forest, by the likest pairs,
    of what the bitmaps cannot keep apart."""

    def solve(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        rows.sort(key=lambda r: r[3])
        n = np.array([r[4] for r in rows])
        node = np.array([r[3] for r in rows])
        bits = matrix([r[5] for r in rows])
        # Rows that are not in the forest yet, the likest row in its present tree, and how like.
        left = np.arange(1, len(rows))
        best, to = np.full(len(left), -1), np.zeros(len(left), np.int64)
        last, pairs = 0, []
        while len(left):
            like = likeness(bits[left], n[left], bits[last], int(n[last]), percent)
            nearer = like > best
            best[nearer], to[nearer] = like[nearer], last
            at = int(best.argmax())
            last = int(left[at])
            if best[at] >= 0:
                pairs.append((min(node[last], node[to[at]]), max(node[last], node[to[at]])))
            left, best, to = np.delete(left, at), np.delete(best, at), np.delete(to, at)
        return pairs

    return solve


def first_common(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """The first shingle of ``mine`` that stands in a row of ``theirs``, else ``NO_SHINGLE``."""
    shared = (theirs[:, :, None] == mine[None, None, :]).any(1)
    return np.where(shared.any(1), mine[shared.argmax(1)], NO_SHINGLE)


def cross_tile(percent: int):
    """Rows (h, band, i, j, node, group, n, home, guest, minor, bits, firsts) of one tile ->
    pairs of homes and others that may link, of different groups, with their likeness.

    A pair stands in many lists.  Where the sets share one of the first shingles that they
    have in lists, only the tile of the first such shingle in the common order gives the pair:
    the first one that the sets share at all, in whose list sets that link have stayed."""

    def few(h: int, homes: list[tuple], others: list[tuple]) -> Iterator[tuple]:
        for r in homes:
            for o in others:
                if o[5] == r[5] or (o[8] and r[8]) or (r[9] and o[4] <= r[4]):
                    continue
                if next((x for x in r[11] if x in o[11]), h) == h:
                    bits = matrix([r[10], o[10]])
                    like = likeness(bits[1:], np.array([o[6]]), bits[0], r[6], percent)[0]
                    if like >= 0:
                        yield min(r[4], o[4]), max(r[4], o[4]), int(like)

    def solve(rows: list[tuple]) -> list[tuple]:
        homes, others = [r for r in rows if r[7]], [r for r in rows if not r[7]]
        if not homes or not others:
            return []
        h = rows[0][0]
        if len(homes) * len(others) <= FEW_PAIRS:
            return list(set(few(h, homes, others)))
        bits = matrix([r[10] for r in homes + others])
        mine, theirs = bits[:len(homes)], bits[len(homes):]
        node, group, n, guest = (np.array([r[k] for r in others]) for k in (4, 5, 6, 8))
        firsts = np.full((len(others), FIRSTS), NO_SHINGLE)
        for k, r in enumerate(others):
            firsts[k, :len(r[11])] = r[11]
        pairs = []
        for k, r in enumerate(homes):
            # Two sets outside the main group meet twice, once as each one's home.
            fit = (group != r[5]) & ~(guest & r[8]) & ((node > r[4]) | (not r[9]))
            at = np.flatnonzero(fit)
            if len(at):
                like = likeness(theirs[at], n[at], mine[k], r[6], percent)
                at, like = at[like >= 0], like[like >= 0]
            if len(at):
                first = first_common(np.array(r[11]), firsts[at])
                here = (first == h) | (first == NO_SHINGLE)
                pairs += [(min(r[4], d), max(r[4], d), s) for d, s in zip(node[at[here]].tolist(), like[here].tolist())]
        return list(set(pairs))

    return solve


def verify(percent: int):
    out = arrow_schema("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            good = [k for k in range(len(a)) if linked(np.frombuffer(x[k], np.uint64), np.frombuffer(y[k], np.uint64), percent)]
            yield pa.RecordBatch.from_arrays([pa.array([c[k] for k in good], pa.int64()) for c in (a, b)], schema=out)

    return run


def verified(docs: DataFrame, leads: DataFrame, pairs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) that are links.  Only texts that stand in a pair are shingled again."""
    pairs = written(pairs.select("a", "b").distinct(), f"{name}-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = leads.join(wanted, "node").select("node", "s1", "doc_id", "text_key")
    sets = written(docs.join(wanted.hint("shuffle_hash"), ["doc_id", "text_key"]).select("node", "s1", "text")
                   .mapInArrow(node_rows(words), NODE).dropDuplicates(["node"]), f"{name}-sets")
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    links = written(both.select("a", "b", "x", "y").mapInArrow(verify(percent), "a long, b long"), f"{name}-links")
    let_go(pairs, sets)
    return links


def first_round(posts: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) inside small tiles of each set's first lists."""
    lists = posts.groupBy("h", "band").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    own = posts.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(F.struct("place", "h", "band"))),
                                            1, FIRST_LISTS).alias("p"))
    few = own.select("node", F.explode("p").alias("x")).select("node", "x.h", "x.band")
    few = few.join(lists, ["h", "band"]).select("h", "band", "node", F.pmod(
        F.xxhash64("node", "h"), F.ceil(F.col("m") / FIRST_TILE)).alias("sub"))
    rows = few.join(nodes, "node").select("h", "band", "sub", "node", "n", "bits")
    return (rows.repartition("h", "band", "sub").sortWithinPartitions("h", "band", "sub")
            .mapInArrow(tiles(join_tile(percent), 3, "a long, b long"), "a long, b long"))


PAIRS = "a long, b long, like long"


def second_round(posts: DataFrame, nodes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups that may link, from all tiles of all lists, and their likeness.

    The rows of all tiles are written before they get their bitmaps, so that the shuffles which
    deal lists and those which deal bitmaps do not lie on disk together."""
    own = posts.join(groups, "node", "left").select(
        "h", "node", "band", F.coalesce("group", "node").alias("group"))
    rows = own.withColumn("guest", F.lit(False)).unionByName(
        own.withColumn("band", F.col("band") - 1).withColumn("guest", F.lit(True)))
    # A tile's main group need not be compared with itself: only the rest meets all.
    by_group = rows.groupBy("h", "band", "group").agg(
        F.count(F.lit(1)).alias("m"), F.max((~F.col("guest")).cast("int")).alias("owned"))
    stats = by_group.groupBy("h", "band").agg(
        F.sum("m").alias("m"), F.max(F.struct("m", "group")).alias("main"), F.max("owned").alias("owned"),
        F.count(F.lit(1)).alias("k")).where((F.col("k") > 1) & (F.col("owned") == 1))
    stats = stats.select("h", "band", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"),
                         F.ceil((F.col("m") - F.col("main.m")) / BLOCK).cast("int").alias("rest"),
                         F.col("main.group").alias("main"))
    rows = rows.join(stats, ["h", "band"]).withColumns({
        "i": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"),
        "j": F.pmod(F.xxhash64("node"), F.col("rest")).cast("int")})
    homes = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rest") - 1))).withColumn("home", F.lit(True))
    others = (rows.where(F.col("group") != F.col("main"))
              .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("home", F.lit(False)))
    met = written(homes.unionByName(others).select(
        "h", "band", "i", "j", "node", "group", "home", "guest", (F.col("group") != F.col("main")).alias("minor")), "met")
    both = met.join(nodes, "node").select(
        "h", "band", "i", "j", "node", "group", "n", "home", "guest", "minor", "bits", "firsts")
    pairs = (both.repartition("h", "band", "i", "j").sortWithinPartitions("h", "band", "i", "j")
             .mapInArrow(tiles(cross_tile(percent), 4, PAIRS), PAIRS))
    pairs = written(pairs.groupBy("a", "b").agg(F.max("like").alias("like")), "far-pairs")
    let_go(met)
    return pairs


def grouped(links: DataFrame) -> DataFrame:
    """(node, group) of each node in ``links``."""
    found = components(links).withColumnRenamed("node", "_node").withColumnRenamed("component", "group")
    return written(found.withColumnRenamed("_node", "node"), "groups")


def foreign(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different groups."""
    for end in ("a", "b"):
        own = groups.select(F.col("node").alias(end), F.col("group").alias(f"g{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"g{end}", F.coalesce(f"g{end}", end))
    return pairs.where(F.col("ga") != F.col("gb")).drop("ga", "gb")


def settled(docs: DataFrame, leads: DataFrame, near: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links that join the same sets as ``near`` and all links among ``pairs`` (a, b, like), a written table.

    Each pass takes the likest pairs of each set, ``PASS`` times as many as the one before;
    those of one group go, until no pair is left."""
    links, take = near, PASS
    best = Window.partitionBy("a").orderBy(F.desc("like"), "b")
    while not pairs.isEmpty():
        ranked = written(pairs.withColumn("k", F.row_number().over(best)), "far-ranked")
        let_go(pairs)
        links = links.unionByName(verified(docs, leads, ranked.where(F.col("k") <= take), words, percent, "far"))
        rest = ranked.where(F.col("k") > take).drop("k")
        if rest.isEmpty():
            let_go(ranked)
            return links
        groups = grouped(links)
        pairs, take = written(foreign(rest, groups), "far-left"), take * PASS
        let_go(ranked, groups)
    let_go(pairs)
    return links


def jaccard_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT,
                       by_row: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and text_key, a hash of the text.
    ``by_row`` links each row by its own text only, where rows share a doc_id."""
    if not PERCENT <= percent <= 100:
        raise ValueError("bands are made for thresholds of 80 per cent or more")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                            F.xxhash64(text_of()).alias("text_key"))
    frequent = frequent_shingles(docs, words, FREQUENT)
    sets = written(docs.mapInArrow(set_rows(words, percent, frequent), SETS), "sets")
    some = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # Each different set is a node.  It has the smallest doc_id as its number, or, where that
    # stands with several sets, a hash of both.
    firsts = some.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.min_by("text_key", "doc_id").alias("text_key"))
    alone = firsts.groupBy("doc_id").agg((F.count(F.lit(1)) == 1).alias("alone"))
    firsts = written(firsts.join(alone, "doc_id").withColumn("node", F.when(
        F.col("alone"), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "s1", "s2"))).drop("alone"), "firsts")
    leads = some.join(firsts, ["doc_id", "text_key", "s1", "s2"])
    posts = (leads.select("node", "n", F.posexplode("posted").alias("place", "h")).select("h", "node", "n", "place")
             .repartition("h").sortWithinPartitions("h", "node").mapInArrow(followed(percent), POSTS))
    posts = written(posts.withColumn("band", band(F.col("n"))), "posts")
    # At most as many shingles of a set come together here as it has posted.
    least = posts.groupBy("node").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("place", "h"))), 1, FIRSTS),
                                                  lambda x: x["h"]).alias("firsts"))
    # Bitmaps are shuffled once: a set's own rows meet its number, equal rows of one text meet there too.
    nodes = written(some.join(firsts.join(least, "node"), ["doc_id", "text_key", "s1", "s2"])
                    .dropDuplicates(["doc_id", "text_key", "s1", "s2"]).select("node", "n", "bits", "firsts"), "nodes")
    places = written(sets.select("doc_id", "text_key", "n", "s1", "s2"), "places")
    let_go(sets)
    near = verified(docs, firsts, first_round(posts, nodes, percent), words, percent, "near")
    groups = grouped(near)
    pairs = second_round(posts, nodes, groups, percent)
    let_go(posts, nodes, groups)
    links = settled(docs, firsts, near, pairs, words, percent)
    rows = places.join(firsts.select("s1", "s2", "node", F.col("doc_id").alias("first")), ["s1", "s2"], "left").select(
        "doc_id", "text_key", "n", "node", "first")
    if not by_row:
        several = (rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("doc_id")
                   .agg(F.min("node").alias("a"), F.max("node").alias("b")).where(F.col("a") != F.col("b")).drop("b"))
        links = links.unionByName(rows.where(F.col("n") > 0).join(several, "doc_id")
                                  .select("a", F.col("node").alias("b")))
    found = written(components(links), "found")
    least_doc = (found.join(firsts.select("node", "doc_id"), "node").groupBy("component")
                 .agg(F.min("doc_id").alias("least")))
    found = found.join(least_doc, "component").select("node", "least")
    return (rows.join(found, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("least", "first"))
                    .otherwise(F.col("doc_id"))
                    .alias("component_id"), "text_key"))


def one_of_each(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with the smallest doc_id of their component, all columns as they are.
    Rows without doc_id stay; rows that share doc_id and text stay or go together."""
    return without(documents, jaccard_components(documents, words, percent, by_row=True)
                   .where(F.col("component_id") != F.col("doc_id")))
