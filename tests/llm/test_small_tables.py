"""Operators against brute force on tables with nulls, empty and long texts, ties, repeated
rows and clashing column names; and on empty tables."""

import hashlib
import random
import re
import time
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodgeflow.llm import (fingerprints, jaccard_join, license_scan, packing, quality_crf, quality_rules,
                           secret_scan, sentencepieces, substring_dedup, suffix_dedup)
from lodgeflow.sources.storage import hadoop

from . import cases

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark).cache()


def multiset(rows):
    return sorted(map(repr, rows))


def test_substring_dedup(docs):
    length, seen, want = 50, {}, []
    by_doc = cases.ordered(cases.texts())
    for doc_id, text in by_doc:
        w = cases.words(text)
        for k in range(len(w) - length + 1):
            if doc_id is not None:
                key = tuple(w[k:k + length])
                seen[key] = min(doc_id, seen.get(key, doc_id))
    for doc_id, text in by_doc:
        w, gone = cases.words(text), set()
        for k in range(len(w) - length + 1):
            if doc_id is not None and seen[tuple(w[k:k + length])] < doc_id:
                gone.update(range(k, k + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in substring_dedup.substring_dedup(docs, length).collect()]
    assert multiset(got) == multiset(want)


def test_longest_repeats(docs):
    """Levels of 45, 90, 180 ... words, until none is shared by two different texts."""
    words = {}
    for doc_id, text in cases.texts():
        if doc_id is not None:
            words.setdefault(text or "", (doc_id, cases.words(text)))
    want = {}
    for text, (doc_id, w) in words.items():
        level = 45
        while True:
            others = {tuple(v[k:k + level]) for t, (_, v) in words.items() if t != text for k in range(len(v) - level + 1)}
            if not any(tuple(w[k:k + level]) in others for k in range(len(w) - level + 1)):
                break
            want[doc_id] = level
            level *= 2
    got = {r.doc_id: r.longest for r in substring_dedup.longest_repeats(docs, 45).collect()}
    assert got == want and len(set(want.values())) > 1


@pytest.mark.parametrize("length,gram,hot", [(100, 40, 2000), (100, 40, 1), (30, 12, 2000)])
def test_suffix_dedup(docs, length, gram, hot):
    first, want = {}, []
    by_doc = cases.ordered(cases.texts())
    for doc_id, text in by_doc:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            if doc_id is not None:
                first[data[k:k + length]] = min((doc_id, k), first.get(data[k:k + length], (doc_id, k)))
    for doc_id, text in by_doc:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - length + 1):
            if doc_id is not None and first[data[k:k + length]] < (doc_id, k):
                gone[k:k + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(data) else 0
        want.append((doc_id, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.suffix_dedup(docs, length, gram, hot).collect()]
    assert multiset(got) == multiset(want)


@pytest.mark.parametrize("hot", [2000, 20])
def test_suffix_buckets_beyond_a_block_are_dealt(spark, monkeypatch, hot):
    """A passage shorter than a window, in other surroundings in every text: its anchors have a
    different segment for each.  Some surroundings stand in several texts."""
    passage, length, block = cases.prose(50, 40)[:70], 100, 4000
    around = [(cases.prose(51 + k, 30)[:90], cases.prose(300 + k, 30)[:90]) for k in range(60)]
    rows = [(k, f"{k:03d}" * (k % 7) + a + passage + b) for k, (a, b) in enumerate(around)]
    rows += [(100 + k, f"{k:02d}{around[k][0]}{passage}{around[59 - k][1]}") for k in range(0, 60, 3)]
    real = suffix_dedup.expand

    def counted(length, block):
        inner = real(length, block)

        def run(batches):
            batches, sizes = list(batches), Counter()
            for batch in batches:
                for row in batch.to_pylist():
                    sizes[row["bucket"], row.get("part")] += len(row["bytes"]) + 1
            assert max(sizes.values(), default=0) <= 2 * block, max(sizes.values())
            yield from inner(iter(batches))

        return run

    monkeypatch.setattr(suffix_dedup, "expand", counted)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    first, want = {}, []
    for doc_id, text in rows:
        for k in range(len(text) - length + 1):
            first.setdefault(text[k:k + length], (doc_id, k))
    for doc_id, text in rows:
        gone = {x for k in range(len(text) - length + 1) if first[text[k:k + length]] < (doc_id, k)
                for x in range(k, k + length)}
        kept = "".join(c for k, c in enumerate(text) if k not in gone)
        want.append((doc_id, len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sum(w[1] > 0 for w in want) >= 15
    got = suffix_dedup.suffix_dedup(cases.documents(spark, rows), length, hot=hot).collect()
    assert multiset((r.doc_id, r.n_removed, r.kept_sha256) for r in got) == multiset(want)


def test_windows_meet_across_the_blocks_of_a_bucket(spark):
    length, shared = 100, cases.prose(60, 60)[:130]
    rows = [(7, 1000 + k, k, k, 5 * k, (cases.prose(61 + k, 20)[:60] + shared[k % 9:] + cases.prose(161 + k, 20)[:60]).encode())
            for k in range(40)]
    segments = spark.createDataFrame(rows, suffix_dedup.SEGMENT)
    assert suffix_dedup.dealt(segments, 2000).select("part").distinct().count() > 2
    first = {}
    for _, _, doc, _, start, text in rows:
        for k in range(len(text) - length + 1):
            first.setdefault(text[k:k + length], (doc, start + k))
    want = {(segment, k) for _, segment, doc, _, start, text in rows for k in range(len(text) - length + 1)
            if first[text[k:k + length]] < (doc, start + k)}
    doc = {r[1]: r[2] for r in rows}
    got = {(r.segment, k) for r in suffix_dedup.owned(segments, length, 2000).collect()
           for k in range(r.low, r.high + 1) if r.owner < doc[r.segment]}
    assert want and got == want


@pytest.mark.parametrize("unit", ["a", "ab", "abc" * 7 + "d"])
def test_long_runs_are_cut_into_segments(spark, monkeypatch, unit):
    """A run that repeats throughout: no segment is longer than a quarter of a block and a window."""
    block, length = 2000, 100
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    run = (unit * 9000)[:9000]
    rows = [(3, "x" + run), (5, run[:4000] + cases.prose(70, 40)), (8, cases.prose(71, 40) + run[1:2500])]
    keyed = suffix_dedup.keyed(cases.documents(spark, rows))
    anchors = suffix_dedup.repeated_anchors(keyed, length, 40, words=False, within=True, hot=2000)
    texts = suffix_dedup.texts_with(keyed, anchors).select("doc_id", "k1", "text", "hs", "hots")
    cut = texts.mapInArrow(suffix_dedup.cut_segments(length, 40, block // 4), suffix_dedup.SEGMENT)
    assert cut.selectExpr("max(length(bytes)) as n").first().n == block // 4 + length - 1
    first, want = {}, []
    for doc_id, text in rows:
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - length + 1):
            if first.setdefault(text[k:k + length], (doc_id, k)) != (doc_id, k):
                gone[k:k + length] = True
        kept = "".join(c for c, g in zip(text, gone) if not g)
        want.append((doc_id, len(text), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    made = suffix_dedup.suffix_dedup(cases.documents(spark, rows), length).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in made) == want


def test_four_megabytes_of_one_letter(spark):
    begun = time.monotonic()
    made = suffix_dedup.suffix_dedup(cases.documents(spark, [(1, "a" * (4 << 20)), (2, "b")])).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans) for r in made] == [(4 << 20, (4 << 20) - 1, 1), (1, 0, 0)]
    assert time.monotonic() - begun < 60


def test_without_repeats_keeps_columns(docs):
    out = suffix_dedup.without_repeats(docs)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    kept = {r.doc_id: r.text for r in out.where("doc_id in (3, 5, 7, 8)").collect()}
    assert kept[3] and kept[5] == "" and kept[7] is None and kept[8] == ""


def shingle_sets(rows, n=5):
    out = []
    for doc_id, text in rows:
        w = cases.words(cases.lower(text))
        out.append((doc_id, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n
                    else ({tuple(w)} if w else set())))
    return out


def brute_components(rows):
    sets = [(i, s) for i, s in shingle_sets(rows)]
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if None not in (sets[a][0], sets[b][0]) and x and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), least.get(find(k)) if i is not None else None) for k, (i, s) in enumerate(sets)]


def test_jaccard_components(docs):
    got = [tuple(r)[:3] for r in jaccard_join.jaccard_components(docs).collect()]
    assert multiset(got) == multiset(brute_components(cases.texts()))


def test_jaccard_chains_and_thresholds(spark):
    """Chains of near copies, pairs right at and right below the threshold, and a shared passage."""
    base = [f"w{k}" for k in range(104)]
    rows = [(0, " ".join(base))]
    for k in range(1, 25):
        words = rows[-1][1].split(" ")
        words[(k * 9) % 104] = f"n{k}"
        rows.append((k, " ".join(words)))
    for k in range(30, 90):
        rows.append((k, " ".join([f"p{j}" for j in range(20)] + [f"u{k}_{j}" for j in range(k)])))
    for cut in range(16, 26):
        rows.append((200 + cut, " ".join([f"q{j}" for j in range(cut, 104)])))
    rows.append((199, " ".join([f"q{j}" for j in range(104)])))
    got = [tuple(r)[:3] for r in jaccard_join.jaccard_components(cases.documents(spark, rows)).collect()]
    assert multiset(got) == multiset(brute_components(rows))


def test_jaccard_one_doc_id_with_several_texts(spark):
    """A document links as any of its texts does; ``one_of_each`` judges each row by its own text."""
    a, b, c = ([f"{x}{k}" for k in range(60)] for x in "abc")
    near = [" ".join(w[:59] + ["z"]) for w in (a, b)]
    rows = [(9, " ".join(a)), (9, " ".join(b)), (9, " ".join(c)), (7, near[0]), (8, near[1]), (12, " ".join(c)), (9, " ".join(a))]
    docs = cases.documents(spark, rows)
    got = [(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()]
    assert sorted(got) == [(7, 7), (8, 7), (9, 7), (9, 7), (9, 7), (9, 7), (12, 7)]
    left = sorted((r.doc_id, r.text) for r in jaccard_join.one_of_each(docs).select("doc_id", "text").collect())
    assert left == sorted([(7, near[0]), (8, near[1]), (9, " ".join(c))])


def near_group(n, seed=0):
    """n copies of one text with edits at random places: some pairs link, most do not."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        words = [f"w{j}" for j in range(180)]
        for j in rng.choice(180, 2, replace=False):
            words[j] = f"x{rng.integers(1 << 30)}"
        rows.append((k, " ".join(words)))
    return rows


def test_jaccard_group_of_near_copies_is_not_compared_in_pairs(spark, monkeypatch):
    taken = {}
    real = jaccard_join.verified

    def counted(docs, leads, pairs, *rest):
        taken[len(rows)] = taken.get(len(rows), 0) + pairs.select("a", "b").distinct().count()
        return real(docs, leads, pairs, *rest)

    monkeypatch.setattr(jaccard_join, "verified", counted)
    for n in (150, 600):
        rows = near_group(n)
        got = [tuple(r)[:3] for r in jaccard_join.jaccard_components(cases.documents(spark, rows)).collect()]
        assert multiset(got) == multiset(brute_components(rows))
    # Pairs that are settled grow with the group, not with its square.
    assert all(pairs <= 4 * n for n, pairs in taken.items())


def test_one_of_each_keeps_columns(docs):
    out = jaccard_join.one_of_each(docs)
    assert out.dtypes == docs.dtypes
    left = [r.doc_id for r in out.collect()]
    assert 3 in left and 5 not in left and 9 not in left and left.count(None) == 2


def test_packing(docs):
    t = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs, WORD_BPE).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 2048 for r in rows)
    want = []
    for doc_id, text in cases.texts():
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        start = 0
        for length in packing.binary_lengths(len(ids)):
            crc = zlib.crc32(array("I", ids[start:start + length]).tobytes())
            want.append((doc_id, start, length, crc, len(ids)))
            start += length
        assert start == len(ids)
    assert multiset((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == multiset(want)


def test_sentencepiece_parity_and_round_trip(docs):
    rows = sentencepieces.encode_documents(docs, PIECE_BPE).collect()
    assert len(rows) == len(cases.texts()) and all(r.parity and r.round_trip for r in rows)


def field(number: int, wire: int, data: bytes) -> bytes:
    return bytes([number << 3 | wire]) + (bytes([len(data)]) if wire == 2 else b"") + data


def test_unigram_models_are_rebuilt():
    """A hand-made unigram model file: scores, byte fallback and the space marker."""
    import struct

    import sentencepiece
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
    pieces += [(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    pieces += [("▁", -3, 1), ("▁a", -2, 1), ("b", -3, 1), ("ab", -2.5, 1), ("▁ab", -6, 1), ("a", -3.5, 1)]
    data = b"".join(field(1, 2, field(1, 2, t.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k])))
                    for t, s, k in pieces)
    data += field(2, 2, field(3, 0, b"\x01") + b"\x98\x02\x01")          # unigram, byte fallback
    data += field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00"))
    codec = sentencepieces.Codec(data)
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["ab ab", "a", "", "bab  ba", "aé b", "b\nab", "ab" * 50]
    for (ids, back), text in zip(codec.there_and_back(texts), texts):
        assert array("I", ids).tolist() == own.encode(text), text
        assert back == text


def test_secret_spans(docs):
    assign = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = []
    for doc_id, text in cases.texts():
        t = text or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[1]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        digest = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        n = Counter(k for _, _, k, _ in spans)
        want.append((doc_id, n["assign"], n["access"], n["hex"], hashlib.sha256(digest.encode()).hexdigest()))
    got = [tuple(r)[:5] for r in secret_scan.secret_digests(docs).collect()]
    assert multiset(got) == multiset(want)


def test_secret_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    first = cases.documents(spark, [(1, "token = abcdefgh"), (2, "token = abcdefgh"), (3, "clean")])
    assert [len(r.findings) for r in secret_scan.scan_history(first, "text", ledger).orderBy("doc_id").collect()] == [1, 1, 0]
    assert spark.read.parquet(f"{ledger}/*").count() == 2
    more = first.unionByName(cases.documents(spark, [(4, "AKIA" + "B" * 16)]))
    found = secret_scan.scan_history(more, "text", ledger).orderBy("doc_id").collect()
    assert [len(r.findings) for r in found] == [1, 1, 0, 1] and found[0].words == "w" and found[0].blob != "blob"
    assert spark.read.parquet(f"{ledger}/*").count() == 3
    newer = tuple(r._replace(version=2) if r.kind == "hex" else r for r in secret_scan.RULES)
    secret_scan.scan_history(more, "text", ledger, newer).collect()
    again = spark.read.parquet(f"{ledger}/*").where("size(rules) = 1").collect()
    assert {tuple(r.rules) for r in again} == {("hex@2",)} and len(again) == 3


def test_ledger_gives_the_wanted_versions_only(spark):
    ledger = f"{secret_scan.scratch_path(spark, 'ledger')}"
    rows = cases.documents(spark, [(1, "0af9" * 8 + " " + "0af9" * 12), (2, "AKIA" + "B" * 16)])
    base = secret_scan.RULES
    newer = tuple(r._replace(version=2, least=40) if r.kind == "hex" else r for r in base)

    def found(rules):
        made = secret_scan.scan_history(rows, "text", ledger, rules).orderBy("doc_id").collect()
        return [[(f.start, f.rank, f.end, f.kind) for f in r.findings] for r in made]

    old = [[(0, 2, 32, "hex"), (33, 2, 81, "hex")], [(0, 1, 20, "access")]]
    assert found(base) == old
    assert found(newer) == [[(33, 2, 81, "hex")], old[1]]
    assert found(base) == old
    assert found(newer[::-1]) == [[(33, 4, 81, "hex")], [(0, 5, 20, "access")]]
    ledger += "-of-kinds"
    (rows.selectExpr("sha2(text, 256) as blob", f"array({', '.join(repr(r.key) for r in base)}) as rules",
                     "array(named_struct('start', 0L, 'end', 9L, 'rank', 2, 'kind', 'hex')) as findings")
     .write.parquet(f"{ledger}/run-0"))
    assert found(base) == old


def test_redaction(docs):
    out = secret_scan.without_secrets(docs)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    text = out.where("doc_id = 19").first().text
    assert "hunter2" not in text and "[assign]" in text and "[access]" in text and "[hex]" in text
    same = {r.doc_id: r.text for r in out.collect()}
    assert same[18] == dict(cases.texts())[18] and same[7] is None


def redacted_by_hand(text: str, findings) -> str:
    at, out = 0, ""
    for f in findings:
        if f.start >= at:
            out += text[at:f.start] + f"[{f.kind}]"
        at = max(at, f.end)
    return out + text[at:]


@pytest.mark.parametrize("block", [1, 3, 64])
def test_spans_and_redaction_in_blocks(spark, monkeypatch, block):
    """Many findings, of which some overlap or hold each other, in blocks of any size."""
    monkeypatch.setattr(secret_scan, "LEAST_BLOCK", block)
    rng = random.Random(block)
    parts = ["token=abc", "é words 🎉 ", "0123456789abcdef" * 2, "password: " + "0af9" * 9, "AKIA" + "0" * 17 + "a" * 25, " ",
             "secret=token=abcdefgh", "\n", "x" * 40]
    rows = [(k, "".join(rng.choice(parts) for _ in range(n))) for k, n in enumerate([0, 1, 2, 3, 5, 8, 30, 200])]
    docs = cases.documents(spark, rows)
    found = {r.doc_id: r for r in secret_scan.scan_history(docs, "text", secret_scan.scratch_path(spark, "ledger")).collect()}
    hexes = {k: [m.span() for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24] for k, t in rows}
    assert {k: [(f.start, f.end) for f in r.findings if f.kind == "hex"] for k, r in found.items()} == hexes
    assert max(len(r.findings) for r in found.values()) > 50
    got = {r.doc_id: r.text for r in secret_scan.without_secrets(docs).collect()}
    assert got == {k: redacted_by_hand(t, found[k].findings) for k, t in rows}


def test_secrets_of_a_long_text(spark):
    """40,000 findings in one text, scanned and redacted; an accumulator over all of them took minutes."""
    docs = cases.documents(spark, [(1, ("0af9" * 8 + " ") * 40_000), (2, "clean")])
    begun = time.monotonic()
    assert [r.n_hex for r in secret_scan.secret_digests(docs).orderBy("doc_id").collect()] == [40_000, 0]
    assert secret_scan.without_secrets(docs).where("doc_id = 1").first().text == "[hex] " * 40_000
    assert time.monotonic() - begun < 60


def test_scratch_tables_lie_in_folders_that_go(spark):
    first, second = (secret_scan.scratch_path(spark, "kind") for _ in range(2))
    assert first != second
    fs, folder = hadoop(spark, first.removesuffix("/rows"))
    assert fs.exists(folder) and fs.cancelDeleteOnExit(folder)
    fs.delete(folder, True)


def test_licenses(docs):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    rows = license_scan.scan_licenses(docs).collect()
    want = []
    for doc_id, text in cases.texts():
        w, at, labels = word.findall(cases.lower(text)), [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            hits = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            at += hits
            labels |= {label} if hits else set()
        want.append((doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    assert multiset((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == multiset(want)
    found = next(r for r in rows if r.doc_id == 20)
    assert found.labels == "apache-2.0,cc-by,gpl,reserved" and "apache-2.0:0:8:1" in found.spans
    assert all(0 <= r.score <= 1 for r in rows) and all(r.labels == "" and r.score == 0 for r in rows if r.doc_id != 20)


def test_fuzzy_notices_are_found_up_to_the_bound():
    """Every way to put up to k random edits into a notice is found."""
    import random
    r = random.Random(5)
    for text, label in license_scan.NOTICES.items():
        n = license_scan.notice(text, label)
        for _ in range(40):
            made = bytearray(n.text)
            for _ in range(r.randint(0, n.edits)):
                k = r.randrange(1, len(made) - 1)
                kind = r.randrange(3)
                if kind == 0:
                    made[k] = ord("z")
                elif kind == 1:
                    made[k:k] = b"y"
                else:
                    del made[k]
            norm = b"foo bar " + bytes(made) + b" baz"
            assert license_scan.fuzzy_spans(norm, n), (text, made)


def test_fingerprints(docs):
    rows = cases.texts()
    falling = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    walker, want = fingerprints.Walker(), []
    for k, (doc_id, text) in enumerate(falling):
        a, b = text or "", falling[(k + 1) % len(falling)][1] or ""
        n = len(a)
        edited = a[:n - n // 2] + b[:n // 2]
        pa, pe, pb = (fingerprints.walked(walker, 0, t).print for t in (a, edited, b))
        want.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), pa.text(), pe.text(),
                     walker.likeness(pa, pe), walker.likeness(pa, pb)))
    got = [tuple(r) for r in fingerprints.edit_fingerprints(docs).collect()]
    assert multiset(got) == multiset(want)


def test_fingerprints_follow_edits():
    walker = fingerprints.Walker()
    text = cases.prose(11, 800)
    near = text[:500] + "x" + text[500:1200] + text[1205:]
    a, b, c = (fingerprints.walked(walker, 0, t).print for t in (text, near, cases.prose(12, 800)))
    assert walker.likeness(a, a) == 1 and walker.likeness(a, b) > 0.8 > 0.3 > walker.likeness(a, c)


def test_fingerprint_near_duplicates(docs):
    pairs = {(r.doc_id, r.representative) for r in fingerprints.near_duplicates(docs, likeness=0.7).collect()}
    assert (5, 3) in pairs and (9, 3) in pairs and not any(p[0] == 18 for p in pairs)


@pytest.mark.parametrize("block", [2048, 2])
def test_fingerprints_with_a_shared_head(spark, block):
    """A document that shares only its head with others stands in front of all of them."""
    head, tails = cases.prose(31, 400)[:1060], [cases.prose(32 + k, 400)[:840] for k in range(3)]
    near = tails[1][:500] + tails[2][500:600] + tails[1][600:]
    rows = [(1, head + " " + tails[0]), (2, head + " " + tails[1]), (3, head + " " + tails[1]),
            (4, head + " " + near), (5, head + " " + tails[2]), (6, head + " " + tails[2]), (None, head)]
    walker = fingerprints.Walker()
    made = [fingerprints.walked(walker, i, t).print for i, t in rows]
    # The head covers the full octaves.
    assert all(2048 < p.length < 4096 for p in made[:6]) and fingerprints.walked(walker, 0, head).print.length > 2048
    assert all(walker.likeness(made[0], p) < 0.8 for p in made[1:6]) and 0.8 <= walker.likeness(made[1], made[3]) < 1
    got = {tuple(r) for r in fingerprints.near_duplicates(cases.documents(spark, rows), block=block).collect()}
    assert got == {(3, 2, 1.0), (4, 2, walker.likeness(made[1], made[3])), (6, 5, 1.0)}


def test_the_unfinished_octave_has_bands(spark):
    text = cases.prose(41, 300)
    made = fingerprints.walked(fingerprints.Walker(), 1, text).print
    full, rest = divmod(len(made.symbols), fingerprints.SAMPLES)
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": text}])
    bands = next(fingerprints.print_and_bands(fingerprints.SEED, fingerprints.BAND)(iter([batch]))).column(2)
    octaves = Counter(int(b.split(".")[0]) for b in bands.to_pylist()[0])
    assert rest and octaves == {full - 2: 4, full - 1: 4, full: -(-rest // fingerprints.BAND)}


def test_quality_rules(docs):
    rows = quality_rules.quality_rules(docs).collect()
    want = []
    for _, text in cases.texts():
        w, t = cases.words(text), text or ""
        windows = list(zip(w, w[1:], w[2:]))
        n, covered = Counter(windows), set()
        for k, x in enumerate(windows):
            if n[x] > 1:
                covered |= {k, k + 1, k + 2}
        lines = [x for x in t.split("\n") if cases.words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed))
    got = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert multiset(got) == multiset(want)
    assert not any(r.kept and r.base_failed for r in rows)
    assert next(r for r in rows if r.doc_id == 25).kept and not next(r for r in rows if r.doc_id == 26).kept
    out = quality_rules.kept_documents(docs)
    assert out.dtypes == docs.dtypes
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)


def test_crf_marginals_are_exact():
    """Forward-backward against the sum over all labellings."""
    import itertools
    rng = np.random.default_rng(3)
    first = np.array([0, 1, 5, 9])
    own = rng.normal(size=9)
    model = quality_crf.Model(np.zeros(1), 0.7, -0.4)
    ahead, behind = quality_crf.forward_backward(own, first, model)
    for a, b in zip(first, first[1:]):
        total = np.zeros((b - a, 2))
        for labels in itertools.product((0, 1), repeat=int(b - a)):
            e = sum(own[a + k] for k, y in enumerate(labels) if y)
            e += sum({(0, 0): 0.7, (1, 1): -0.4}.get(p, 0) for p in zip(labels, labels[1:]))
            for k, y in enumerate(labels):
                total[k, y] += np.exp(e)
        np.testing.assert_allclose(quality_crf.sigmoid(ahead + behind)[a:b], total[:, 1] / total.sum(1))


def test_quality_classifier(spark, docs):
    r = cases.random.Random(1)
    good = [(k, cases.prose(100 + k, r.randint(60, 200))) for k in range(0, 60)]
    bad = [(k, " ".join(w + "###" for w in cases.prose(100 + k, 80).split())) for k in range(60, 120)]
    labelled = cases.documents(spark, good + bad + [(500, None), (500, None)])
    labels = spark.createDataFrame([(k, int(k < 60), 0) for k in range(120)] + [(None, 1, 0), (500, None, 1), (900, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_crf.classify(labelled, labels).collect()
    assert len(rows) == 122 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in rows)
    for x in rows:
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2)
        if x.doc_id < 120:
            assert x.predicted == int(x.doc_id < 60)
    model = quality_crf.train(labelled, labels)
    assert quality_crf.quality_scores(docs, model).count() == docs.count()
    none = quality_crf.classify(docs, labels.limit(0))
    assert {x.score for x in none.collect()} == {0.5}


def edited(rng, text, edits):
    for _ in range(edits):
        k, c = int(rng.integers(1, len(text) - 1)), "qxz"[int(rng.integers(3))]
        text = [text[:k] + c + text[k + 1:], text[:k] + text[k + 1:], text[:k] + c + text[k:]][int(rng.integers(3))]
    return text


def test_license_copies_next_to_each_other_are_all_found():
    """Every planted copy is met by a span of no more edits, and spans do not overlap."""
    rng = np.random.default_rng(1)
    known = [license_scan.notice(t, label) for t, label in license_scan.NOTICES.items()]
    for trial in range(300):
        n, parts, want, at = known[trial % len(known)], [], [], 0
        for _ in range(int(rng.integers(1, 6))):
            edits = int(rng.integers(0, n.edits + 1))
            parts.append(edited(rng, n.text.decode(), edits).encode())
            want.append((at, at + len(parts[-1]), edits))
            at += len(parts[-1]) + 1
            if rng.random() < 0.5:
                parts.append(b"other words")
                at += 12
        norm = b" ".join(parts)
        got = license_scan.fuzzy_spans(norm, n)
        assert all(x[1] < y[0] for x, y in zip(got, got[1:]))
        assert all(norm[a - 1:a] in (b"", b" ") and norm[b:b + 1] in (b"", b" ") for a, b, _ in got)
        assert all(any(x < b and a < y and e <= edits for x, y, e in got) for a, b, edits in want)
    n = license_scan.notice("released under the mit license", "mit")
    assert license_scan.fuzzy_spans(b"released under the mit lcense released under the mit license", n) == [
        (0, 29, 1), (30, 60, 0)]


def test_license_long_texts(spark):
    """Places are counted in one pass, however many there are."""
    rows = [(1, "cc by " * 200_000), (2, "released under the mit lcense " * 20_000)]
    begun = time.time()
    got = {r.doc_id: r for r in license_scan.scan_licenses(cases.documents(spark, rows)).collect()}
    assert time.time() - begun < 60
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (200_000, 0, 399_998)
    assert got[2].spans.count("mit:") == 20_000


def test_quality_features_know_one_text_only():
    hasher, name = quality_crf.Hasher(), list(quality_crf.KINDS).index

    def features(*texts):
        lines = quality_crf.lines_of(pa.array(texts), hasher)
        return lines.features[lines.first[-2]:]

    text = "alpha beta gamma delta\nalpha beta"
    for beside in ("alpha beta gamma", "delta", "", "x y z"):
        assert (features(beside, text) == features(text)).all()
    assert features("alpha alpha b alpha")[0][len(quality_crf.KINDS)] == 0.5
    # A line of 3 MiB has the shares that a short one has.
    assert (features("aB1" * (1 << 20))[0][:9] == features("aB1")[0][:9]).all()
    assert features("a" * (3 << 20))[0][name("lower")] == 1


def test_quality_scores_do_not_depend_on_neighbours_or_partitions(spark):
    rng = np.random.default_rng(4)
    rows = [(k, "\n".join(" ".join(f"w{j}" for j in rng.integers(0, 9, rng.integers(0, 12)))
                          for _ in range(int(rng.integers(1, 7))))) for k in range(200)]
    width = quality_crf.lines_of(pa.array(["a"]), quality_crf.Hasher()).features.shape[1]
    model = quality_crf.Model(rng.normal(size=width), 0.3, 0.2)
    docs = cases.documents(spark, rows)
    one, many = ({r.doc_id: r.score for r in quality_crf.quality_scores(d, model).collect()}
                 for d in (docs.coalesce(1), docs.repartition(7)))
    assert one == many


def test_repeats_go_beside_a_column_of_the_helper_name(spark):
    docs = cases.documents(spark, [(1, "a" * 30), (2, None)]).withColumn("_null", F.lit(5))
    assert sorted(r._null for r in suffix_dedup.without_repeats(docs).collect()) == [5, 5]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from lodgeflow.llm import common
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:1", applicationId="a"))
    with pytest.raises(RuntimeError):
        common.scratch_root(session)


@pytest.mark.parametrize("run", [
    lambda d: substring_dedup.substring_dedup(d), lambda d: suffix_dedup.suffix_dedup(d),
    lambda d: jaccard_join.jaccard_components(d), lambda d: packing.pack(d, WORD_BPE),
    lambda d: sentencepieces.encode_documents(d, PIECE_BPE), lambda d: secret_scan.secret_digests(d),
    lambda d: license_scan.scan_licenses(d), lambda d: fingerprints.edit_fingerprints(d),
    lambda d: quality_rules.quality_rules(d), lambda d: fingerprints.near_duplicates(d),
    lambda d: quality_crf.quality_scores(d, None), lambda d: suffix_dedup.without_repeats(d),
    lambda d: jaccard_join.one_of_each(d), lambda d: secret_scan.without_secrets(d),
    lambda d: quality_rules.kept_documents(d),
], ids=["op2", "op8", "op4", "op9", "op3", "op5", "op6", "op7", "op10", "bands", "op1", "trim", "one", "redact", "keep"])
def test_empty_tables(spark, run):
    assert run(cases.documents(spark, []).limit(0)).collect() == []


def test_interval_expansion_marks_common_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n, length = int(rng.integers(5, 300)), int(rng.integers(1, 20))
        text = rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8)
        text[rng.random(n) < 0.05] = suffix_dedup.END
        order = suffix_dedup.least_rotations(text, length)
        wide = text.tobytes() * (length // n + 3)
        want = [True] + [wide[a:a + length] != wide[b:b + length] for a, b in zip(order, order[1:])]
        assert suffix_dedup.marks(text, order, length).tolist() == want


def test_components(spark):
    from lodgeflow.llm.components import components
    links = [(k, k + 1) for k in range(40)] + [(100, 7), (200, 201), (202, 201), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 0, 200: 200, 201: 200, 202: 200}


def test_queries_are_registered(spark):
    import corpus_pipeline
    from lodgeflow.llm.oracle_sql import ORACLE
    from lodgeflow.llm.queries import QUERIES
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 11)) and set(ORACLE) <= set(QUERIES)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
