"""Packing: every id in one piece, sequences without gaps, and little padding."""

import collections
import random
import struct

import pyarrow as pa
import pytest
from test_operators import DOCS, sample, with_clashes
from tokenizers import Tokenizer

from tallyloom.llm import bpe, packing
from tallyloom.llm.common import session


def expected(texts):
    library = Tokenizer.from_file(bpe.default_path())
    library.no_truncation()
    library.no_padding()
    found = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [tuple(e.ids + [1]) for e in found]


def check(rows, texts, length):
    """Pieces are whole documents when joined, sequences have no gaps; the share of padding."""
    documents, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for row in rows:
        ids = struct.unpack(f"<{row.length}I", row.piece_ids)
        documents[row.doc_id, row.doc_tokens].append((row.start, ids))
        sequences[row.sequence_id].append((row.offset, row.length))
    want = collections.Counter(expected(texts))
    flat = []
    for (_, tokens), pieces in documents.items():
        copies = collections.Counter(start for start, _ in pieces)[0]
        if copies == 1:
            pieces.sort()
            assert [s for s, _ in pieces] == [sum(len(i) for _, i in pieces[:k]) for k in range(len(pieces))]
            ids = sum((i for _, i in pieces), ())
            assert len(ids) == tokens
            flat.append(ids)
        else:  # rows that share key and length: compared as a bag of ids
            assert sum(len(i) for _, i in pieces) == tokens * copies
            flat.append(None)
    assert all(want[ids] for ids in flat if ids is not None)
    assert sum(row.length for row in rows) == sum(len(ids) * n for ids, n in want.items())
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at and size > 0
            at += size
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / max(1, sum(row.length for row in rows))


@pytest.mark.parametrize("length", [64, 2048])
def test_packs_odd_rows(spark, length):
    session(spark)
    rows = sample()
    docs = with_clashes(spark.createDataFrame(rows, DOCS).repartition(3))
    got = packing.pack(docs, bpe.default_path(), length=length)
    assert got.columns == ["doc_id", "start", "length", "sequence_id", "offset", "doc_tokens", "piece_ids"]
    check(got.collect(), [r[1] for r in rows], length)


def test_little_padding_whatever_the_lengths(spark):
    session(spark)
    draw = random.Random(2)
    texts = [" ".join(["a"] * draw.choice([400, 390, 410, 30, 700, draw.randrange(1500)])) for _ in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = packing.pack(docs, bpe.default_path(), length=512).collect()
    assert check(rows, texts, 512) < 0.02
    # Lengths that never fit together are cut instead of padded.
    texts = ["a " * 350] * 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert check(packing.pack(docs, bpe.default_path(), length=512).collect(), texts, 512) < 0.01


def test_empty_table(spark):
    session(spark)
    assert packing.pack(spark.createDataFrame([], DOCS), bpe.default_path()).count() == 0


def test_plans_never_use_more_than_there_is():
    draw = random.Random(4)
    for _ in range(15):
        histogram = {draw.randint(1, 60): draw.choice([1, 3, 50, 10**9]) for _ in range(draw.randint(1, 40))}
        used = collections.Counter()
        for pattern, copies in packing.plan(histogram, 60, slack=1):
            assert copies > 0 and 59 <= sum(size * n for size, n in pattern) <= 60
            for size, n in pattern:
                used[size] += n * copies
        assert all(n <= histogram[size] for size, n in used.items())


def test_the_linear_program_comes_near_its_bound():
    draw = random.Random(8)
    histogram = collections.Counter(draw.randint(1, 100) for _ in range(50000))
    sizes = sorted(histogram)
    demand = [histogram[s] for s in sizes]
    found = packing.column_generation(sizes, demand, 100)
    for i, wanted in enumerate(demand):
        assert sum(dict(p).get(i, 0) * times for p, times in found) == pytest.approx(wanted, abs=0.5)
    assert sum(times for _, times in found) <= 1.002 * sum(s * n for s, n in histogram.items()) / 100


def test_words_merged_side_by_side_equal_the_search():
    vocabulary = bpe.read_vocabulary(bpe.default_path())
    batch, plain = packing.BatchEncoder(vocabulary), bpe.Encoder(vocabulary)
    draw = random.Random(1)
    words = ["".join(draw.choices("aeioutnrs" + "öé漢😀'-.7Σ", k=draw.randint(1, 24))) for _ in range(3000)]
    words += ["a" * 40, "a" * 5000, "erer" * 800, "x<|endoftext|>y", "a\x1cb", ""]
    texts = words + [" ".join(words[i : i + 40]) for i in range(0, 3000, 40)]
    assert batch.encode(texts) == [plain(t) for t in texts]
    assert batch.encode(texts[::-1]) == [plain(t) for t in texts[::-1]]


def test_a_task_encodes_its_texts_in_groups():
    texts = ["a b", None, "", "c" * 50, "a<|endoftext|> b", "é", "x y z"] * 3
    batches = [
        pa.record_batch([pa.array(range(i, i + 3)), pa.array(texts[i : i + 3], pa.binary())], ["key", "body"])
        for i in range(0, 21, 3)
    ]
    held = list(packing.groups(iter(batches), 40))
    keys = [[k for batch in group for k in batch.column(0).to_pylist()] for group in held]
    assert sum(keys, []) == list(range(21))
    assert 1 < len(keys) < len(batches)  # over batches, and bounded
    for group in keys:
        assert sum(len((texts[k] or "").encode()) for k in group[:-1]) < 40
    encoder = packing.BatchEncoder(bpe.read_vocabulary(bpe.default_path()))
    for group in [*keys, []]:
        want = expected([texts[k] for k in group])
        counts, ids = encoder.arrays([texts[k] or "" for k in group], struct.pack("<I", 1))
        assert [struct.unpack(f"<{n}I", i) for n, i in zip(counts, ids.to_pylist(), strict=True)] == want
