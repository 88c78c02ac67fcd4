"""The pipeline's stages, each against what its operator decides on its own input."""

import zlib
from array import array

from tokenizers import Tokenizer

import corpus_pipeline
from lodgeflow.llm import packing, quality_rules, queries, secret_scan
from lodgeflow.llm.common import table, written

from ..conftest import SMALL_SF
from .test_small_tables import brute_components


def test_stages(spark):
    docs = table(spark, SMALL_SF, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(written(stage(spark, kept[-1], SMALL_SF), "stage"))
        assert kept[-1].dtypes == docs.dtypes, name
    rows = [{r.doc_id: r for r in k.collect()} for k in kept]
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert set(rows[1]) == {i for i, k in verdict.items() if k} and all(rows[1][i] == rows[0][i] for i in rows[1])
    first = {i: c for i, _, c in brute_components([(i, r.text) for i, r in rows[1].items()])}
    assert set(rows[2]) == {i for i, c in first.items() if i == c} and all(rows[2][i] == rows[0][i] for i in rows[2])
    assert set(rows[3]) == set(rows[2]) == set(rows[4])
    seen = set()
    for i in sorted(rows[2]):
        data, gone = rows[2][i].text.encode(), set()
        for k in range(len(data) - 99):
            if data[k:k + 100] in seen:
                gone.update(range(k, k + 100))
            seen.add(data[k:k + 100])
        left = bytes(b for k, b in enumerate(data) if k not in gone).decode("utf-8", "ignore")
        assert rows[3][i].text == left and rows[3][i].n_chars == len(left)
    findings = {r.doc_id: r.spans for r in secret_scan.secret_digests(kept[3]).collect()}
    for i, r in rows[4].items():
        text, at, out = rows[3][i].text, 0, ""
        for kind, a, b in (s.split(":") for s in findings[i].split(",") if s):
            if int(a) >= at:
                out += text[at:int(a)] + f"[{kind}]"
            at = max(at, int(b))
        assert r.text == out + text[at:]
    t = Tokenizer.from_file(queries.WORD_BPE)
    pieces = {(p.doc_id, p.start): p for p in corpus_pipeline.run(spark, SMALL_SF).collect()}
    total = 0
    for i, r in rows[4].items():
        ids, start = t.encode(r.text, add_special_tokens=False).ids + [packing.END_ID], 0
        for n in packing.binary_lengths(len(ids)):
            p = pieces[(i, start)]
            assert (p.length, p.ids_crc32) == (n, zlib.crc32(array("I", ids[start:start + n]).tobytes()))
            start, total = start + n, total + 1
    assert total == len(pieces)
