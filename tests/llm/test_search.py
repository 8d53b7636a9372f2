"""Ranked lexical search against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
from test_operators import DOCS, sample, with_clashes

from tallyloom.llm import search
from tallyloom.llm.common import session

ITEMS = "item_id long, text string"


def terms_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(search.TERM, folded)


def brute(rows, queries, k):
    docs = [(d, collections.Counter(t)) for d, text in rows if (t := terms_of(text))]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    asked = collections.defaultdict(set)
    for item, text in queries:
        asked[item] |= set(terms_of(text))
    out = []
    for item, terms in asked.items():
        found = []
        for doc, counts in docs:
            m = 10 + 90 * sum(counts.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms & counts.keys()
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [
            (item, rank, None if none else doc, -score)
            for rank, (score, none, doc) in enumerate(sorted(found)[:k], 1)
        ]
    return sorted(out, key=repr)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 2000)
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(search, "STRETCH", 16)


def asked(spark):
    rows = [(i, f"River{i} bridge w{i * 5} the no{i} of stone1") for i in range(8)]
    return rows + [(8, None), (9, ""), (None, "here at all"), (3, "here again"), (10, "漢字 ünï")]


def test_search_equals_brute_force_with_odd_rows(spark, small, rows_of):
    session(spark)
    docs, queries = sample(), asked(spark)
    index = search.build_index(with_clashes(spark.createDataFrame(docs, DOCS).repartition(3)))
    got = search.search(index, with_clashes(spark.createDataFrame(queries, ITEMS)))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == brute([(d[0], d[1]) for d in docs], queries, 10)


def test_search_equals_brute_force_in_one_shard(spark, rows_of):
    session(spark)
    draw = random.Random(5)
    docs = [
        (i, " ".join(f"t{int(draw.paretovariate(0.7)) % 300}" for _ in range(draw.choice([5, 40, 200]))))
        for i in range(300)
    ]
    docs += [(400 + i, docs[7][1]) for i in range(30)]
    queries = [(i, " ".join(f"t{draw.randrange(60)}" for _ in range(12))) for i in range(10)]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    assert rows_of(search.search(index, spark.createDataFrame(queries, ITEMS), k=4)) == brute(docs, queries, 4)


def test_empty_tables(spark, rows_of):
    session(spark)
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert search.search(search.build_index(none), items).count() == 0
    index = search.build_index(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert search.search(index, items.limit(0)).count() == 0
    assert rows_of(search.search(index, items), "doc_id") == [(1,)]


def test_numbers_survive_packing():
    draw = np.random.default_rng(3)
    values = draw.integers(1, 1 << draw.integers(1, 40, 500), 500)
    packed, ends = search._varints(values)
    assert (search._unpacked(packed) == values).all()
    assert (search._unpacked(packed[ends[9] : ends[19]]) == values[10:20]).all()


def test_blocks_that_cannot_matter_stay_packed():
    """One rare and one common term: few blocks of the common list are ever opened."""
    n = 20000
    lengths = np.full(n, 100)
    lengths[500:] = 2000

    def listed(ordinals, tf, weight):
        values = np.empty(2 * len(ordinals), np.int64)
        values[0::2], values[1::2] = np.diff(np.concatenate([[-1], ordinals])), tf
        packed, ends = search._varints(values)
        last = np.append(np.arange(search.BLOCK, len(ordinals), search.BLOCK), len(ordinals)) - 1
        opens = np.concatenate([[0], last[:-1] + 1])
        heads = np.stack([ordinals[last], ends[1::2][last], np.arange(1, len(last) + 1)], 1)
        pairs = np.stack([np.maximum.reduceat(tf, opens), np.minimum.reduceat(lengths[ordinals], opens)], 1)
        return search._List(
            weight, heads.astype("<i4").tobytes(), pairs.astype("<i4").tobytes(),
            packed.tobytes(), len(ordinals), lambda length: 10 + length // 10,
        )

    everywhere, seldom = np.arange(n), np.arange(3, n, 250)
    tf = np.ones(n, np.int64)
    common, rare = listed(everywhere, tf, 3), listed(seldom, tf[seldom], 3000)
    m = 10 + lengths // 10
    tops, scores = search._best([common, rare], m, np.arange(n), 2)
    gains = 3 * (10**9 // (1000 + 8 * m))
    gains[seldom] += 3000 * (10**9 // (1000 + 8 * m[seldom]))
    want = np.lexsort((np.arange(n), -gains))[:2]
    assert tops.tolist() == want.tolist() and scores.tolist() == gains[want].tolist()
    assert common.open.sum() < len(common.open) / 4
