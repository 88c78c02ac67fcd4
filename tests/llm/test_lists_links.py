"""Lists that the Jaccard join follows, and links that are joined up to components."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from lodgeflow.llm import common, components, jaccard_join

from . import cases
from .test_small_tables import brute_components, multiset


def union(links):
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("held", [components.HELD, 400])
def test_components(spark, held):
    """A long chain, rings and random links; few enough for one task, and too many for one."""
    rng = np.random.default_rng(0)
    chain = rng.permutation(2000).tolist()
    links = list(zip(chain, chain[1:])) + [(3000, 3001), (3001, 3002), (3002, 3000), (4000, 4000)]
    links += [(5000 + a, 5000 + b) for a, b in rng.integers(0, 900, (600, 2)).tolist()]
    got = components.components(spark.createDataFrame(links, "a long, b long"), held).collect()
    want = {x: c for x, c in union([x for x in links if x[0] != x[1]]).items()}
    assert len(got) == len(want) and {r.node: r.component for r in got} == want


def test_few_links_take_no_rounds(spark, monkeypatch):
    """Each round deals out all its links several times, however few they are."""
    tables = []
    real = components.written
    monkeypatch.setattr(components, "written", lambda df, name: tables.append(name) or real(df, name))
    links = spark.range(1, 1500).selectExpr("id as a", "id - 1 as b")
    assert {r.component for r in components.components(links).collect()} == {0}
    assert len(tables) <= 2


def fitting(rows, percent):
    """Rows of a list that may link with another one of it, pair by pair; all rows of long lists."""
    lists = defaultdict(set)
    for r in rows:
        lists[r[0]].add(r)
    return sorted(
        r for own in lists.values() for r in own if len(own) > jaccard_join.SHORT_LIST or any(
            q[1] != r[1] and 100 * min(q[2], r[2]) >= percent * max(q[2], r[2])
            and (100 + percent) * min(q[2] - q[3], r[2] - r[3]) >= percent * (q[2] + r[2]) for q in own))


@pytest.mark.parametrize("step", [1, 7, 64, 1000])
def test_followed_rows(spark, step):
    rng = np.random.default_rng(step)
    rows = []
    for h in range(60):
        for node in range(int(rng.choice([1, 2, 3, 5, 63, 64, 65, 66, 150]))):
            n = int(rng.integers(60, 110))
            rows += [(h, node, n, int(rng.integers(0, n // 5 + 1)))] * int(rng.choice([1, 1, 1, 2]))
    schema = common.arrow_schema(jaccard_join.POSTS)
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + step]), schema.types)], schema=schema)
               for k in range(0, len(rows), step)]
    got = [tuple(r.values()) for made in jaccard_join.followed(80)(iter(batches)) for r in made.to_pylist()]
    assert sorted(got) == fitting(rows, 80)


def test_passages_of_other_texts_are_not_followed(spark, monkeypatch):
    """Texts that share a passage do not link; few of the lists that they meet in are followed."""
    sizes = {}
    real = jaccard_join.written

    def counted(df, name):
        made = real(df, name)
        sizes[name] = made.count()
        return made

    monkeypatch.setattr(jaccard_join, "written", counted)
    # Words that repeat in the corpus are counted only within one task, so no shingle is known as frequent.
    monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda docs, words, most: np.empty(0, np.uint64))
    rows = [(2 * k + j, " ".join([f"p{k}_{i}" for i in range(30)] + [f"u{k}_{j}_{i}" for i in range(70 + 10 * j)]))
            for k in range(150) for j in (0, 1)]
    got = [tuple(r)[:3] for r in jaccard_join.jaccard_components(cases.documents(spark, rows)).collect()]
    assert got and all(i == c for i, _, c in got)
    # About one in five of the 26 shared shingles is posted by both texts: some 1,500 rows.
    assert sizes["posts"] <= 800
    near = [(1000 + k, text.replace("u3_1_5 ", "z ")) for k, (i, text) in enumerate(rows) if i == 7]
    got = [tuple(r)[:3] for r in jaccard_join.jaccard_components(cases.documents(spark, rows[:20] + near)).collect()]
    assert multiset(got) == multiset(brute_components(rows[:20] + near))
