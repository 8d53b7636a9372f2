"""op1's bags of leaf nodes: all pairs are found, and no vector is shuffled once per pair of nodes."""

import os

import numpy as np
import pytest

from tallyloom.llm import covertree
from tallyloom.llm.common import session


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def all_pairs(rows, min_cosine):
    """``key, links, component`` of rows ``key, vector, group`` by comparing everything."""
    key, vector, group = (np.array(x) for x in zip(*rows))
    units = unit(vector.astype(float))
    hits = (units @ units.T >= min_cosine) & (group[:, None] == group[None, :])
    np.fill_diagonal(hits, False)
    least = key.copy()
    while True:
        following = np.minimum(least, np.where(hits, least[None, :], key.max()).min(axis=1))
        if np.array_equal(following, least):
            return sorted(zip(key.tolist(), hits.sum(axis=1).tolist(), least.tolist()))
        least = following


def shuffle_files(spark):
    """Name and size of the shuffle files of this session."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    found = {}
    for top in manager.diskBlockManager().localDirsString():
        for folder, _, names in os.walk(top):
            for name in names:
                if name.startswith("shuffle_"):
                    found[name] = os.path.getsize(f"{folder}/{name}")
    return found


@pytest.mark.parametrize("kind", ["float", "double"])
def test_many_bags_and_jobs_against_all_pairs(spark, monkeypatch, kind):
    session(spark)
    monkeypatch.setattr(covertree, "BAG_BYTES", 4096)
    monkeypatch.setattr(covertree, "BAGS_A_JOB", 3)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 40))
    vectors = (centres[rng.integers(0, 20, 400)] + rng.normal(size=(400, 40)) * 0.3).astype(np.float32)
    vectors[350:] = vectors[:50]
    rows = [(i, [float(x) for x in v], int(i % 5 > 0) + (2 + i if i % 50 == 1 else 0)) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    got = sorted(tuple(r)[:3] for r in covertree.link_vectors(df, leaf=16).collect())
    assert got == all_pairs(rows, 0.93) and sum(n for _, n, _ in got) > 1000


def test_shuffle_does_not_grow_with_pairs_of_nodes(spark, monkeypatch):
    session(spark)
    monkeypatch.setattr(covertree, "BAG_BYTES", 1 << 16, raising=False)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 32)).astype(np.float32)
    df = spark.createDataFrame(
        [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int"
    )
    before = shuffle_files(spark)
    assert covertree.link_vectors(df, leaf=64).filter("n_links > 0").count() == 0
    written = sum(size for name, size in shuffle_files(spark).items() if name not in before)
    assert written < 4 * vectors.nbytes


def test_pairs_next_to_the_threshold():
    rng = np.random.default_rng(6)
    a = unit(rng.normal(size=(300, 64)))
    side = rng.normal(size=(300, 64))
    side = unit(side - np.sum(side * a, axis=1)[:, None] * a)
    cosine = 0.93 + np.where(np.arange(300) % 2, 1e-9, -1e-9)
    b = cosine[:, None] * a + np.sqrt(1 - cosine**2)[:, None] * side
    found = set()
    for rows, columns, hits in covertree.traverse(covertree.Tree(a), covertree.Tree(b), 0.93):
        found |= {(rows[i], columns[j]) for i, j in zip(*np.nonzero(hits))}
    assert {(i, i) for i in range(300) if i % 2} <= found
    assert found == set(zip(*np.nonzero(a @ b.T >= 0.93)))
