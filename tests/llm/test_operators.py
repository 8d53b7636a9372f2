"""The corpus operators against brute force on small tables, and their odd inputs."""

import collections
import hashlib
import itertools
import math
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import bpe, covertree, katz, lines, mixing, quality, sharding, simhash, spans, urls
from tallyloom.llm.common import session

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = (
    "The committee met on a cold morning and talked about the river for a long time. "
    "Nobody wanted to be the first to say that the old bridge would have to go. "
    "In the end it was the baker who stood up and asked for a vote on the plan. "
)


def sample():
    """Documents with everything at once: nulls, empty and long texts, ties, repeats, hot sources."""
    words = "river bridge stone the of and to mill field house tree road wall door".split()
    rows = []
    for i in range(40):
        body = " ".join(words[(i * 7 + k * (k % 5 + i % 3 + 1)) % len(words)] + str(k * i % 9) for k in range(60))
        rows.append((i, body.replace(" river0", ".\nRiver"), "en", "big" if i % 3 else f"s{i % 4}", len(body)))
    long = " ".join(f"w{k % 997}" for k in range(30000))
    rows += [
        (100, PROSE * 2, "en", "big", 1),
        (101, PROSE * 2, "en", "big", 1),
        (101, PROSE * 2, "en", "big", 1),
        (102, None, None, None, None),
        (103, "", "xx", None, 0),
        (104, " \n\t ", "de", "s1", 4),
        (105, "Ünï — 漢字 <|endoftext|> ΑΣ 😀", "fr", "", 9),
        (None, "no key here. none at all.\nsame", "en", "big", 5),
        (None, None, "en", "big", None),
        (106, long, "en", "s2", len(long)),
        (107, "a b", "en", "s2", 3),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    session(spark)
    return spark.createDataFrame(sample(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    session(spark)
    return spark.createDataFrame([], DOCS)


CLASHING = "text2 size target repeats slot shard n_words kept fingerprint component_id n_deleted n_removed token_ids decoded node root doc _row _doc _gone _h _source a b h pos cell row train block".split()


def with_clashes(df):
    return df.select("*", *[F.lit("mine").alias(c) for c in CLASHING])


OPERATORS = {
    "lines": lines.delete_repeated_lines,
    "place": lambda d: sharding.place(d, ["a", "b", "c"], 101),
    "spans": spans.delete_repeated_spans,
    "simhash": simhash.link_fingerprints,
    "near": simhash.drop_near_duplicates,
    "quality": quality.quality_rules,
    "mixing": mixing.mix_sources,
    "mixed": mixing.mixed_rows,
    "katz": katz.katz_scores,
    "encode": lambda d: bpe.decode(bpe.encode(d, bpe.default_path()), bpe.default_path()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_and_clashing_columns(name, docs, none):
    operator = OPERATORS[name]
    assert operator(none).count() == 0
    plain = operator(docs)
    clashing = operator(with_clashes(docs))
    shared = [c for c in plain.columns if c not in CLASHING]
    key = lambda r: repr(r)
    want = sorted((tuple(r) for r in plain.select(*shared).collect()), key=key)
    assert sorted((tuple(r) for r in clashing.select(*shared).collect()), key=key) == want
    kept = set(clashing.columns) & set(CLASHING)
    if name not in ("simhash", "katz"):  # these return keys and results alone
        untouched = kept - set(plain.columns)
        assert {"text2", "_row", "_doc", "_h", "a"} <= untouched
        assert all(
            r[c] == "mine" for r in clashing.select(*sorted(untouched)).collect() for c in untouched
        )


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# 1 -----------------------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(400):
        own = centres[i % 6] * rng.uniform(0.5, 4) + rng.normal(size=8) * 0.25
        rows.append((i, [float(np.float32(x)) for x in own], int(i % 4 > 0)))
    rows += [(500 + i, rows[7][1], 1) for i in range(30)]
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 8, 1), (603, [None] + [1.0] * 7, 1)]
    rows += [(604, [float("nan")] * 8, 1), (605, [float("inf")] + [1.0] * 7, 1), (606, rows[7][1], None)]
    rows += [(607, [1.0, 2.0], 1), (608, [2.0, 4.0], 1), (608, [2.0, 4.0], 1)]
    return rows


@pytest.mark.parametrize("leaf", [16, 4096])
def test_vectors_against_all_pairs(spark, leaf):
    session(spark)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = sorted(tuple(r) for r in covertree.link_vectors(df, leaf=leaf).collect())
    good = [
        (i, k, np.array(v, float) / np.linalg.norm(np.array(v, float)), g)
        for i, (k, v, g) in enumerate(rows)
        if v and g is not None and None not in v and np.all(np.isfinite(v)) and any(v)
    ]
    links = [
        (a, b)
        for a, b in itertools.combinations(good, 2)
        if a[3] == b[3] and len(a[2]) == len(b[2]) and a[2] @ b[2] >= 0.93
    ]
    n = collections.Counter(x[0] for pair in links for x in pair)
    found = components([(a[1], b[1]) for a, b in links], {r[0] for r in rows})
    want = sorted((r[0], n[i], found[r[0]], found[r[0]] == r[0]) for i, r in enumerate(rows))
    assert got == want and len(links) > 1000


def test_cover_tree_levels():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 4))
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = covertree.Tree(points)
    for node, children in enumerate(tree.children):
        away = np.linalg.norm(points[tree.members[node]] - tree.centre[node], axis=1)
        assert away.max() <= tree.radius[node]
        if children:
            assert sorted(np.concatenate([tree.members[c] for c in children])) == sorted(tree.members[node])
    hits = sum(int(h.sum()) for _, _, h in covertree.traverse(tree, tree, 0.95))
    assert hits == int(np.triu(points @ points.T >= 0.95, 1).sum())


def test_vectors_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert covertree.link_vectors(empty).collect() == []


def test_one_key_at_several_vectors(spark):
    session(spark)
    rows = [(1, "a", [1.0, 0.0]), (1, "b", [0.0, 1.0]), (2, "a", [1.0, 0.01]), (3, "b", [1.0, 0.0]), (1, "a", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = sorted(tuple(r)[:3] for r in covertree.link_vectors(df).collect())
    assert got == [(1, 0, 1), (1, 0, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]


@pytest.mark.parametrize("name", ["vectors", "urls"])
def test_clashing_columns_and_empty_tables_of_other_kinds(spark, name):
    session(spark)
    if name == "vectors":
        df = spark.createDataFrame([(1, "a", [1.0]), (2, "a", [2.0])], "vec_id long, label string, embedding array<double>")
        got = covertree.link_vectors(with_clashes(df))
        assert sorted(tuple(r)[:3] for r in got.collect()) == [(1, 1, 1), (2, 1, 1)]
        assert covertree.link_vectors(df.limit(0)).count() == 0
    else:
        df = spark.createDataFrame([(1, "http://a.net/x", None)], "page_id long, url string, html string")
        got = urls.filter_urls(with_clashes(df)).collect()
        assert len(got) == 1 and got[0]["verdict"] == "block"
        assert urls.filter_urls(df.limit(0)).count() == 0


def test_a_source_without_words_is_not_taken(spark):
    session(spark)
    rows = [(i, "a b c", "s0") for i in range(20)] + [(100 + i, " ", "s1") for i in range(20)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.repeats for r in mixed.filter("source = 's1'").collect()} == {0}


def test_a_language_without_a_reference_is_judged_by_characters(spark):
    session(spark)
    body = " ".join(f"{a}{b}o" for a in ("kal", "mer", "ton", "vus") for b in ("ali", "emo", "uni") for _ in range(10))
    rows = [(i, " ".join(["the", "of", "and", "river", "house", "to"][(i * k + k) % 6] + str(k % 7) for k in range(90)), "en") for i in range(5)]
    words = body.split()
    body = " ".join(w + "xyzab"[i % 5] + "klmno"[i * 7 % 5] + "e" * (i % 3) + "rst"[i % 3] for i, w in enumerate(words))
    df = spark.createDataFrame([*rows, (9, body, "eo")], "doc_id long, text string, lang string")
    row = [r for r in quality.quality_rules(df).collect() if r.doc_id == 9][0]
    assert row.word_divergence is None and row.char_divergence is not None


# 2 -----------------------------------------------------------------------------------------


def test_line_runs(spark):
    session(spark)
    rows = [
        (1, "start\none\ntwo\nthree\nfour\nend"),
        (2, "other\n\none\ntwo\n\nthree\nfour\nlast"),  # blank lines do not part a run, and stay
        (3, "one\ntwo\nnothing else"),  # two lines are too few
        (4, "x\ny\nx\ny\nx\ny"),  # repeats itself
        (5, "one\ntwo\nthree\nfour"),
        (None, "one\ntwo\nthree\nfour"),
        (7, None),
        (8, ""),
        (9, "\n\n\n\n"),
        (10, "start\none\ntwo\nthree\nfour\nend"),
        (10, "start\none\ntwo\nthree\nfour\nend"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r[0], r[1], r[2]) for r in lines.delete_repeated_lines(df).collect())
    assert got == collections.Counter(
        [
            (1, rows[0][1], 0),
            (2, "other\n\n\nlast", 4),
            (3, rows[2][1], 0),
            (4, "x\ny", 4),
            (5, "", 4),
            (None, "", 4),
            (7, None, 0),
            (8, "", 0),
            (9, "\n\n\n\n", 0),
            (10, "", 6),
            (10, "", 6),
        ]
    )


def test_line_runs_whose_pieces_stand_earlier_elsewhere(spark):
    session(spark)
    given = []
    for i in range(20):  # either half of the run holds the least hash; so both stand earlier
        x, y, z = (f"{c} {i}" for c in "XYZ")
        given += [["p", x, y, "q"], ["r", y, z, "s"], ["a", x, y, z, "b"], ["c", x, y, z, "d"]]
    rows = [(k, "\n".join(f"{v} {k}" if len(v) == 1 else v for v in ls)) for k, ls in enumerate(given)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: r[1] for r in lines.delete_repeated_lines(df).select("doc_id", "text").collect()}
    assert [got[k] for k in range(3, 80, 4)] == [f"c {k}\nd {k}" for k in range(3, 80, 4)]
    assert all(got[k] == rows[k][1] for k in range(80) if k % 4 < 2)


def test_runs_of_different_places_are_not_counted_together(spark):
    session(spark)
    rows = [(1, "p\nX\nY\nq\nr"), (2, "p2\nZ\nW\nq2\nr2"), (3, "s\nX\nY\nZ\nW\nt")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: r[1] for r in lines.delete_repeated_lines(df).collect()} == dict(rows)


def test_long_lines_and_long_texts(spark):
    session(spark)
    passage = " ".join(f"w{i}" for i in range(50))
    short = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"a\n{passage}\n{short}"), (2, f"{passage}\nb"), (3, f"{short}\nc"), (4, "x\ny\n" * 10000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in lines.delete_repeated_lines(df).collect()}
    assert got[1] == (rows[0][1], 0) and got[2] == ("b", 1) and got[3] == (rows[2][1], 0)
    assert got[4] == ("x\ny\n", 19998)


def test_hot_passage_keeps_one_copy(spark):
    session(spark)
    passage = "\n".join(f"line {i}" for i in range(5))
    df = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("own "), F.col("id").cast("string"), F.lit("\n" + passage)).alias("text"),
    )
    got = lines.delete_repeated_lines(df).groupBy("n_deleted").count().collect()
    assert {r[0]: r[1] for r in got} == {0: 1, 5: 299}


# 3 -----------------------------------------------------------------------------------------


def brute_katz(rows):
    train = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 != 2
    single, pairs = collections.Counter(), collections.defaultdict(collections.Counter)
    for key, text in rows:
        if train(key):
            words = katz.words_of(text)
            single.update(words)
            for a, b in zip([katz.START, *words], words):
                pairs[a][b] += 1
    n, of = sum(single.values()), collections.Counter(single.values())
    unigrams = katz.Unigrams(n, [0] + [of[r] for r in range(1, 7)])
    one = {w: float(unigrams(np.array([c]))[0]) for w, c in single.items()}
    of = collections.Counter(c for x in pairs.values() for c in x.values())
    discount = katz.discounts([0] + [of[r] for r in range(1, 7)])
    d = lambda c: discount[c] if c <= 5 else 1.0
    contexts = {}
    for h, x in pairs.items():
        total, left = sum(x.values()), sum((1 - d(c)) * c for c in x.values())
        if left <= 0:
            total, left = total + 1, 1
        contexts[h] = total, left / total / (1 - sum(one[w] for w in x))

    def chance(h, w):
        if h not in contexts:
            return one.get(w, unigrams.unknown)
        c = pairs[h][w] if w in pairs[h] else 0
        return d(c) * c / contexts[h][0] if c else contexts[h][1] * one.get(w, unigrams.unknown)

    return train, single, n, chance, contexts, one, unigrams


@pytest.mark.parametrize("split", [1 << 19, 40])
def test_katz_against_brute_force(docs, split, monkeypatch):
    monkeypatch.setattr(katz, "CONTEXT_TOKENS", split)
    rows = [(r[0], r[1]) for r in sample()]
    train, single, n, chance, contexts, one, unigrams = brute_katz(rows)
    for h in contexts:  # exactly normalised
        assert math.isclose(sum(chance(h, w) for w in one) + chance(h, b"?"), 1, rel_tol=1e-9)
    assert math.isclose(sum(one.values()) + unigrams.unknown, 1, rel_tol=1e-9)
    want = []
    for key, text in rows:
        words = katz.words_of(text)
        base = sum(math.log10((single[w] + 1) / (n + len(single) + 1)) for w in words)
        score = sum(math.log10(chance(h, w)) for h, w in zip([katz.START, *words], words))
        known = sum(single[w] > 0 for w in words)
        want.append((key, not train(key), len(words), known, n, base, score))
    got = katz.katz_scores(docs, block_bytes=20_000).collect()
    order = lambda r: (str(r[0]), r[2])
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:], b[5:], rtol=1e-9)


def test_katz_without_training(spark):
    session(spark)
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = katz.katz_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 3, 0, 0)
    assert row["score"] == 0


def test_discounts_fall_back():
    assert list(katz.discounts([0])) == [1, 0.5, 1, 1, 1, 1]
    assert katz.Unigrams(10, [0, 0, 5]).unknown > 0


# 4 -----------------------------------------------------------------------------------------


def test_lookup_table_turns():
    names, slots = ["a", "b", "c"], 13
    prefer = {}
    for name in names:
        digest = hashlib.md5(name.encode()).digest()
        offset = int.from_bytes(digest[:8], "big") % slots
        skip = int.from_bytes(digest[8:], "big") % (slots - 1) + 1
        prefer[name] = [(offset + j * skip) % slots for j in range(slots)]
    owner = {}
    for turn in itertools.cycle(names):
        owner[next(s for s in prefer[turn] if s not in owner)] = names.index(turn)
        if len(owner) == slots:
            break
    assert sharding.lookup_table(names, slots) == [owner[s] for s in range(slots)]


def test_lookup_table_balance_and_stability():
    names = sharding.shard_names(16)
    full = sharding.lookup_table(names, 4099)
    assert max(np.bincount(full)) - min(np.bincount(full)) <= 1
    fewer = sharding.lookup_table(names[:-1], 4099)
    moved = sum(a != b for a, b in zip(full, fewer) if a != 15)
    assert moved < 0.15 * 4099
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 4096)
    with pytest.raises(ValueError):
        sharding.lookup_table([], 13)


def test_place_and_write(docs, tmp_path):
    placed = sharding.place(docs, ["a", "b", "c"], 101)
    owners = sharding.lookup_table(["a", "b", "c"], 101)
    for r in placed.collect():
        digest = hashlib.md5(f"shard:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()
        assert r["slot"] == int(digest[:15], 16) % 101 and r["shard"] == owners[r["slot"]]
    sharding.write_shards(placed, str(tmp_path / "out"), 2)
    again = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert again.count() == placed.count()


# 5 -----------------------------------------------------------------------------------------


def test_url_rules_and_aliases(spark):
    session(spark)
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://A.example.com/x", link.format("http://spam.net/y")),
        (2, "http://b.example.com/z?q=1#f", "<META HTTP-EQUIV=refresh content='0; url=http://a.example.com/x'>"),
        (3, "https://b.example.com/z?q=1", None),
        (4, None, None),
        (5, "nohost", link.format("/r")),
        (6, "http://c.example.com", link.format("/de/k")),
        (7, "http://c.example.com/", link.format("//q.org/fr/1")),
        (8, "http://EX.example.net/en/1?a", ""),
        (9, "http://net", ""),
        (10, "http://d.com/a/b", link.format("c&amp;d")),
        (11, "http://d.com/a/c&d", link.format("http://evil.example.net/")),
        (12, "http://x.example.com/de/1", link.format("http://ok.org/fr/2")),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(df).collect()}
    assert got == {
        1: ("a.example.com", "/x", None, "block"),
        2: ("b.example.com", "/z", None, "block"),
        3: ("b.example.com", "/z", None, "block"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("c.example.com", "", None, "allow"),  # an allowed alias comes before a blocked one
        7: ("c.example.com", "/", None, "allow"),
        8: ("ex.example.net", "/en/1", "example.net/en/", "allow"),
        9: ("net", "", None, "allow"),
        10: ("d.com", "/a/b", None, "block"),
        11: ("d.com", "/a/c&d", None, "block"),
        12: ("x.example.com", "/de/1", "example.com/de/", "block"),  # its own rule decides
    }
    table = spark.createDataFrame([("http://c.com/1", "http://m.net/2"), (None, "http://x.net/")], "from_url string, to_url string")
    more = spark.createDataFrame([(1, "https://c.com/1", "x", "y")], "page_id long, url string, verdict string, _own string")
    row = urls.filter_urls(more, redirects=table, html=None).first()
    assert (row["verdict"], row["_own"], row["alias_root"]) == ("block", "y", "c.com/1")


# 6 -----------------------------------------------------------------------------------------


def test_spans_against_brute_force(docs):
    seen, want = set(), []
    rows = sample()
    unique = sorted({(r[0] is None, r[0] or 0, r[1] is None, r[1] or "") for r in rows})
    texts = {}
    for no_key, key, no_text, text in unique:
        gone = set()
        for a, b, *h in spans.spans(text, spans.MIN_SENTENCES, spans.MIN_WORDS).tolist():
            if tuple(h) in seen:
                gone |= set(range(a, b + 1))
            seen.add(tuple(h))
        left = "".join(s for i, s in enumerate(spans.sentences(text)) if i not in gone)
        texts[no_key, key, no_text, text] = (None if no_text else left, len(gone))
    for r in rows:
        want.append((r[0], *texts[r[0] is None, r[0] or 0, r[1] is None, r[1] or ""]))
    got = spans.delete_repeated_spans(docs).select("doc_id", "text", "n_removed").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert sum(w[2] for w in want) >= 8


def test_repeated_passage_is_removed_in_other_surroundings(spark):
    session(spark)
    rows = [(1, "Alpha beta gamma. " + PROSE + "Omega."), (2, "Quite another start here. " + PROSE.upper()), (3, "One. Two. Three.")]
    got = {r[0]: r[1] for r in spans.delete_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "Quite another start here. ", 3: rows[2][1]}
    assert "".join(spans.sentences(PROSE)) == PROSE and spans.sentences("") == []


def test_every_repeated_run_of_sentences_goes(spark):
    session(spark)
    rng = np.random.default_rng(6)
    pool = [" ".join(f"s{i}w{k}" for k in range(rng.integers(1, 13))) + ". " for i in range(60)]
    pool[:3] = [" ".join(f"t{i}w{k}" for k in range(n)) + ". " for i, n in enumerate((8, 8, 7))]
    given = [[0, 1, 2, 50], [51, 0, 1, 2, 52]]
    for _ in range(60):
        start, n = rng.integers(0, 50), rng.integers(1, 7)
        given.append([*rng.integers(0, 60, 2), *range(start, start + n), *rng.integers(0, 60, 2)])
    seen, want = set(), {}
    for doc, numbers in enumerate(given):
        gone = set()
        for a, b in itertools.combinations(range(len(numbers) + 1), 2):
            run = "".join(pool[i] for i in numbers[a:b])
            if b - a >= 2 and len(run.split()) >= 16:
                if run in seen:
                    gone |= set(range(a, b))
                seen.add(run)
        want[doc] = "".join(pool[i] for k, i in enumerate(numbers) if k not in gone)
    assert want[1] == pool[51] + pool[52]
    rows = [(doc, "".join(pool[i] for i in numbers)) for doc, numbers in enumerate(given)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r[0]: r[1] for r in spans.delete_repeated_spans(df).collect()} == want


# 7 -----------------------------------------------------------------------------------------


def test_fingerprint_of_few_and_many_words():
    def slow(text):
        words = text.encode().lower().split()
        runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for text in ("", " \n", "One", "one two", "a B c", "É a É b  c", PROSE, PROSE * 40):
        got = simhash.majority_bits(simhash.shingle_hashes(text, 3)) % (1 << 64)
        assert got == slow(text)


@pytest.mark.parametrize("threshold", [0, 3, 5, 7, 11, 15])
def test_cover_misses_no_pair(threshold):
    cover = simhash.Cover(threshold)
    rng = np.random.default_rng(threshold)
    base = rng.integers(-(2**63), 2**63 - 1, 500, dtype=np.int64)
    other = base.view(np.uint64).copy()
    for k in range(len(other)):
        for place in rng.choice(64, threshold, replace=False):
            other[k] ^= np.uint64(1 << int(place))
    met = np.zeros(len(base), bool)
    for part in range(cover.parts):
        home = cover.homes(base, part)
        rows, anchors = cover.visits(other.view(np.int64), part)
        met[rows[home[rows] == anchors]] = True
    assert met.all()


@pytest.mark.parametrize("block", [4096, 8])
def test_near_links_components(spark, block, monkeypatch):
    session(spark)
    monkeypatch.setattr(simhash, "HOME_BLOCK", block)
    monkeypatch.setattr(simhash, "VISITOR_BLOCK", 4 * block)
    rng = np.random.default_rng(9)
    seeds = rng.integers(-(2**63), 2**63 - 1, 30, dtype=np.int64)
    prints = set()
    for k in range(600):
        value = np.array([seeds[k % 30 if k % 2 else 0]]).view(np.uint64)
        for place in rng.choice(64, rng.integers(0, 4), replace=False):
            value ^= np.uint64(1 << int(place))
        prints.add(int(value.view(np.int64)[0]))
    prints = sorted(prints)
    df = spark.createDataFrame([(p, p) for p in prints], "node long, fingerprint long").repartition(4)
    got = simhash.near_links(df, 3).collect()
    array = np.array(prints, np.int64)
    true = [(prints[i], prints[j]) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(array[i] ^ array[i + 1 :]) <= 3) + i + 1]
    assert components([(r[0], r[1]) for r in got], prints) == components(true, prints)


def test_near_duplicates_keep_one_of_each_group(spark):
    session(spark)
    words = [f"word{i}" for i in range(200)]
    near = words[:100] + ["changed"] + words[101:]
    far = words[:100] + [f"x{i}" for i in range(100)]
    rows = [
        (5, " ".join(words)),
        (3, " ".join(near)),
        (9, " ".join(words).upper()),
        (4, " ".join(far)),
        (None, " ".join(words)),
        (7, None),
        (8, ""),
        (2, "short text"),
        (1, "short text too"),
        (6, " ".join(reversed(words))),
        (6, " ".join(reversed(words))),
    ]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r[0] for r in got) == [1, 2, 3, 4, 6, 7]


@pytest.mark.parametrize("block", [768, 3])
def test_near_duplicates_against_all_pairs(spark, block, monkeypatch):
    session(spark)
    monkeypatch.setattr(simhash, "GROUP_BLOCK", block)
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in rng.integers(0, 5000, 150)]
    rows = []
    for i in range(60):
        own = list(base) if i % 2 else [f"v{x}" for x in rng.integers(0, 5000, 150)]
        for place in rng.integers(0, 150, i % 5):
            own[place] = f"e{i}"
        rows.append((i, " ".join(own)))
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t in rows]
    links = [(i, j) for i, j in itertools.combinations(range(60), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = sorted(set(components(links, range(60)).values()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r[0] for r in simhash.drop_near_duplicates(df).collect()) == want


@pytest.mark.parametrize("size", [100, 300])
def test_near_duplicates_of_block_edits_against_all_pairs(spark, size):
    session(spark)
    rng = np.random.default_rng(size)
    rows = []
    for i in range(100):
        base = [f"w{x}" for x in rng.integers(0, 50000, size)]
        other = [f"f{x}" for x in rng.integers(0, 50000, size)]
        # A footer of up to a quarter of the text, or a paragraph of up to a ninth replaced.
        if i % 2:
            edited = base + other[: int(size * rng.uniform(0.18, 0.25))]
        else:
            n = int(size * rng.uniform(0.06, 0.11)) - 4
            edited = base[: size // 2] + other[:n] + base[size // 2 + n :]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited))]
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t in rows]
    alike = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    want = [2 * i for i in range(100)] + [2 * i + 1 for i, x in enumerate(alike) if x < 0.8]
    assert sum(0.8 <= x <= 0.85 for x in alike) >= 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r[0] for r in simhash.drop_near_duplicates(df).collect()) == sorted(want)


def test_near_duplicates_with_other_repeat_counts(spark):
    session(spark)
    rows = []
    for i in range(20):
        own = " ".join(f"d{i}w{k}" for k in range(200))
        footer = " ".join(f"f{k}" for k in range(12))
        rows += [(2 * i, f"{own} {' '.join([footer] * 3)}"), (2 * i + 1, f"{own} {' '.join([footer] * 9)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r[0] for r in simhash.drop_near_duplicates(df).collect()) == list(range(0, 40, 2))


# 8 -----------------------------------------------------------------------------------------


def test_base_statistics(spark):
    session(spark)
    text = "a b c d e x a b c d e\n\nfoo # $\nfoo # $\n é"
    rows = [(1, text, "en"), (2, None, None), (3, "w " * 50, "en"), (4, "", "zz")]
    got = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    r = got[1]
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (18, 22, 4, 1, 10)
    assert got[1]["base_failed"] and not got[1]["kept"]
    assert got[2]["n_words"] == 0 and got[2]["base_failed"]
    assert got[3]["n_repeat_words"] == 50 and got[3]["base_failed"]
    assert got[4]["base_failed"]


def test_divergence_is_jensen_shannon():
    assert quality.divergence(np.array([1, 0]), np.array([0, 7])) == 1
    assert quality.divergence(np.array([2, 4]), np.array([1, 2])) == 0
    assert quality.divergence(np.array([0, 0]), np.array([1, 2])) == 0
    assert math.isclose(quality.divergence(np.array([1, 1]), np.array([1, 0])), 0.31127812445913283)


def test_repeated_windows_cover_words():
    words = "a b c d e f a b c d e f g".split()
    assert quality.repeated_words(words) == 12
    assert quality.repeated_words(words[:4]) == 0
    assert quality.repeated_words(["x"] * 6) == 6


def test_labelled_documents(spark):
    """Held against the labels: junk goes, clean documents stay."""
    session(spark)
    folder = "/root/testdata/sf0.01"
    judged = quality.quality_rules(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("quality", "kept", "n_words").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["n_words"] >= 10]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(junk) <= 0.25 * len(junk)


# 9 -----------------------------------------------------------------------------------------


def brute_targets(sizes, weights, cap):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= cap * sizes[s]}
        for s in full or open_:
            target[s] = cap * sizes[s] if full else level * weight[s]
        left -= sum(cap * sizes[s] for s in full)
        open_ = open_ - full if full else set()
    return target


def test_mixing_targets_and_taken(docs):
    got = mixing.mix_sources(docs).collect()
    sizes, targets, taken = collections.Counter(), {}, collections.Counter()
    largest = collections.Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
        taken[r["source"]] += r["size"] * r["repeats"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert 0 <= r["repeats"] <= 3
        assert r["size"] == len((r["text"] or "").encode().split())
    want = brute_targets(sizes, (5, 2, 1), 3)
    for s in sizes:
        assert math.isclose(targets[s], want[s], rel_tol=1e-12, abs_tol=1e-9)
        assert abs(taken[s] - targets[s]) <= 2 * largest[s]
    assert math.isclose(sum(targets.values()), sum(sizes.values()))
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["repeats"] for r in got)


# 10 ----------------------------------------------------------------------------------------


def test_encoder_against_the_library(docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_path()
    library = tokenizers.Tokenizer.from_file(path)
    both = bpe.decode(bpe.encode(docs, path), path).collect()
    for r in both:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(want)}I", r["token_ids"])) == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_encoder_on_random_texts():
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_path()
    library = tokenizers.Tokenizer.from_file(path)
    vocabulary = bpe.read_vocabulary(path)
    encoder, decoder = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    rng = np.random.default_rng(0)
    letters = list("aaaeinthsr '.!?\t\x1c\x85​　éÉΣσςİßǅ1٣½漢한글😀́ͅ") + ["<|endoftext|>", "<|", "'LL", "</w>"]
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 30)))
        want = library.encode(text, add_special_tokens=False).ids
        got = encoder(text)
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want, text
        assert decoder(got) == library.decode(want, skip_special_tokens=False)
    word = "".join(rng.choice(list("aeinthr"), 20000))
    assert len(encoder(word)) == 4 * len(library.encode(word, add_special_tokens=False).ids)


def test_compatible_pairs_are_what_merging_keeps():
    """A pair of tokens is compatible exactly if merging its letters by rank gives it back."""
    path = bpe.default_path()
    vocabulary = bpe.read_vocabulary(path)
    encoder = bpe.Encoder(vocabulary)
    rank = {m: i for i, m in enumerate(vocabulary["merges"])}
    ascii_tokens = [t for t in vocabulary["vocab"] if t.isascii() and t.isalpha() and len(t) < 6]

    def merged(symbols):
        while True:
            best = min(((rank.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))), default=(1 << 30, 0))
            if best[0] == 1 << 30:
                return symbols
            pair = symbols[best[1]], symbols[best[1] + 1]
            out, i = [], 0
            while i < len(symbols):
                if tuple(symbols[i : i + 2]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out

    rng = np.random.default_rng(4)
    for a, b in rng.choice(ascii_tokens, (4000, 2)):
        want = merged(list(a + b)) == [a, b]
        assert encoder.compatible(vocabulary["vocab"][a], vocabulary["vocab"][b]) == want, (a, b)
