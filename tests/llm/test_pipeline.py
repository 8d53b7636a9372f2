"""The pipeline and its registration."""

import itertools
import os

import __spark_entry__ as contract
import corpus_pipeline
from test_operators import components

from tallyloom.llm import simhash
from tallyloom.llm.common import session

FOLDER = "/root/testdata/sf0.001"


def test_registered_queries():
    names = contract.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert names["pipeline"] is corpus_pipeline.run
    assert set(contract.oracle_sql()) <= set(names)


def test_stages_are_in_order_and_each_returns_documents(spark, tmp_path):
    session(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    given = docs.columns
    counts = [docs.count()]
    for name, step in corpus_pipeline.STAGES:
        out = os.path.join(tmp_path, name.replace(" ", "-"))
        step(spark, docs, FOLDER).write.parquet(out)
        docs = spark.read.parquet(out)
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == given
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "bpe"]
    assert counts[0] > counts[1] >= counts[2] > counts[3] and counts[4] == counts[5] > 0
    rows = docs.collect()
    assert all(r["n_tokens"] * 4 == len(r["token_ids"]) for r in rows)
    again = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_near_dedup_goes_by_fingerprints_too(spark):
    session(spark)
    # Texts that mostly say the same again: few bits apart, but not alike in distinct shingles.
    rows = [(i, f"line {i % 3} of a refrain " * 9 + " ".join(f"d{i}w{k}" for k in range(12))) for i in range(24)]
    rows += [(24 + i, f"line {i} of a refrain, sung once by voice {i}") for i in range(3)]
    prints = [simhash.majority_bits(simhash.shingle_hashes(t, 3)) for _, t in rows]
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t in rows]
    pairs = list(itertools.combinations(range(len(rows)), 2))
    assert not any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in pairs)
    apart = {(i, j): ((prints[i] ^ prints[j]) % (1 << 64)).bit_count() for i, j in pairs}
    links = [pair for pair, bits in apart.items() if bits <= 3]
    assert any(apart[pair] > 0 for pair in links) and any(apart[pair] == 0 for pair in links)
    want = sorted(set(components(links, range(len(rows))).values()))
    assert len(want) < 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r[0] for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == want
