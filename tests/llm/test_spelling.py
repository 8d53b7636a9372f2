"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import pytest
from test_operators import DOCS, sample, with_clashes

from tallyloom.llm import spelling
from tallyloom.llm.common import session


def brute_words(rows, min_length, min_count, every):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= min_length:
                n[word] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def brute_variants(n, ratio):
    shorter = collections.defaultdict(set)
    for word in n:
        for i in range(len(word)):
            shorter[i, word[:i] + word[i + 1 :]].add(word)
    near = collections.defaultdict(set)
    for (_, left), group in shorter.items():
        for word in group:
            near[word] |= group - {word}
            if left in n:
                near[word].add(left)
                near[left].add(word)
    best = {w: min(others, key=lambda o: (-n[o], o)) for w, others in near.items() if others}
    form = {w: b for w, b in best.items() if n[b] >= ratio * n[w]}
    out = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        known = form.get(word)
        out.append((word, known, root, n[word], len(near[word]), n[known] if known else None))
    return sorted(out, key=repr)


def texts():
    draw = random.Random(9)
    stems = ["bridge", "rivers", "aaaaaa", "ÿÿÿÿÿÿ", "Élève×s", "millstone", "th" * 6, "z" * 90]
    rows = []
    for i in range(120):
        body = []
        for _ in range(60):
            word = list(draw.choice(stems))
            for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
                at = draw.randrange(len(word))
                word[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "ÿ", "h", "zz"])
            body.append("".join(word))
        rows.append((i, draw.choice([" ", ",\n", " 7-"]).join(body)))
    return rows


@pytest.mark.parametrize("segment", [40_000, 7], ids=["one segment", "many segments"])
def test_variants_equal_brute_force(spark, rows_of, monkeypatch, segment):
    monkeypatch.setattr(spelling, "SEGMENT_WORDS", segment)
    monkeypatch.setattr(spelling, "TALLY_WORDS", 100)
    monkeypatch.setattr(spelling, "DEEP", 40)
    session(spark)
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = spelling.group_variants(docs, damage_every=19, min_count=2)
    want = brute_variants(brute_words(rows, 6, 2, 19), 5)
    assert sum(w[1] is not None for w in want) > 20 and any(w[2] != w[1] for w in want if w[1])
    assert rows_of(got) == want


def test_odd_rows(spark, rows_of):
    session(spark)
    rows = sample()
    docs = with_clashes(spark.createDataFrame(rows, DOCS).repartition(3))
    got = spelling.group_variants(docs, min_length=4, min_count=1, damage_every=3)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == brute_variants(brute_words([r[:2] for r in rows], 4, 1, 3), 5)


def test_empty_table(spark):
    session(spark)
    assert spelling.group_variants(spark.createDataFrame([], DOCS)).count() == 0


def test_a_ratio_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_long_ways_end(spark, rows_of):
    links = spelling.stage(
        spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)], "word string, root string"), "ways"
    )
    assert rows_of(spelling._roots(links)) == sorted((f"w{i}", "w13") for i in range(13))


def test_long_words_that_differ_late():
    long = b"x" * 3000
    words = sorted([long + b"a", long + b"b", long + b"ac", long[:-1] + b"y", b"short1"])
    listed = spelling.SortedList(words)
    a, b = listed.near([long + b"a"])
    assert {words[i] for i in b} == {long + b"b", long + b"ac"}


def test_a_long_word_that_is_the_end_of_its_range_counts_once():
    words = [b"z" * 90, b"z" * 91]
    a, b = spelling.SortedList(words).near([b"z" * 90])
    assert [words[i] for i in b] == [b"z" * 91]


def test_a_vocabulary_without_near_words(spark, rows_of):
    session(spark)
    words = spark.createDataFrame([("bridge", 9), ("rivers", 5)], "word string, n long")
    assert rows_of(spelling.variants(words)) == [
        ("bridge", None, "bridge", 9, 0, None), ("rivers", None, "rivers", 5, 0, None)]
