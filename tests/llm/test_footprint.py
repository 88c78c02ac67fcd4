"""What the searches leave on disk, and how much a worker takes at a time."""

import os

import pyarrow as pa

from lodgeflow.llm import common, jaccard_join, suffix_dedup


def scratch(spark):
    folder = common.scratch_root(spark).removeprefix("file:") + "/llm"
    folder = "/" + folder.lstrip("/")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_jaccard_tables_go_when_nothing_reads_them(spark):
    """Sets with bitmaps, lists, tiles and pairs are gone when the lazy result is given back; the
    result can still be read, twice."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[k % 7:k % 7 + 120] + [f"x{k}"]) for k in range(40)] + ["", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = scratch(spark)
    out = jaccard_join.jaccard_components(docs)
    left = {x.rsplit("-", 1)[0] for x in scratch(spark) - before}
    assert not left & {"sets", "posts", "nodes", "met", "near-pairs", "near-sets", "far-pairs", "far-ranked", "far-sets"}
    rows = sorted(out.collect())
    assert rows == sorted(out.collect()) and len(rows) == 42


def test_small_buckets_are_transformed_a_few_at_a_time(spark, monkeypatch):
    sizes = []
    real = suffix_dedup.owners

    def counted(segments, *rest):
        sizes.append(sum(map(len, segments)))
        return real(segments, *rest)

    monkeypatch.setattr(suffix_dedup, "owners", counted)
    rows = [(b, 0, 2 * b + k, k, 0, (b"%06d" % b + b"abcdefg" * 30)[:150 + k]) for b in range(4000) for k in range(2)]
    types = common.arrow_schema("bucket long, part int, segment long, doc_id long, start int, bytes binary").types
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["bucket", "part", "segment", "doc_id", "start", "bytes"])
    made = list(suffix_dedup.expand(100, suffix_dedup.BLOCK)(iter([batch])))
    assert sum(sizes) > 1 << 20 and max(sizes) <= (1 << 18) + 1000
    assert {x for m in made for x in m.column(1).to_pylist()} == {r[2] for r in rows}


def test_trimmed_texts_come_back_in_small_batches(spark):
    n, text = 4000, "é" * 1000
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([text] * n), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
        names=["row", "text", "copy", "spans"])
    made = list(suffix_dedup.trimmed(100)(iter([rows])))
    assert max(m.nbytes for m in made) < 2 << 20 and sum(m.num_rows for m in made) == n
    assert all(t == text for m in made for t in m.column(1).to_pylist())
