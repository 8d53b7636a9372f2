"""SimHash near-dedup with anchors of a covering code."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import BLANK, free_name, session, table
from tallyloom.operators.components import component_roots
from tallyloom.session import bounded_broadcast, stage

SEED = 42
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Members of a cell that one task compares with one another; a fuller cell is cut into more tasks.
HOME_BLOCK = 4096
VISITOR_BLOCK = 65536
# Members of cells that share a task.
TASK_MEMBERS = 50_000
# Elements of a comparison held at once.
MATRIX = 1 << 19


# fingerprints ------------------------------------------------------------------------------


def shingle_hashes(text: str, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words (repeats included), joined by single blanks; A-Z are
    lower-cased. Fewer words give one run of them all, and no words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :])], np.uint64
    )


def majority_bits(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes, as a signed number; 0 without any."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):  # sums of 255 bits fit in a byte
        octets = hashes[at : at + 255].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def remixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes whose bits say nothing about the given ones: a second draw without hashing again."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def fingerprints(
    docs: DataFrame, text: str = "text", width: int = 3, second: bool = False
) -> DataFrame:
    """Input rows with ``fingerprint`` (a long), ``n_shingles``, and with ``second`` also a
    fingerprint of remixed hashes, ``second``. Columns of those names are replaced. A null text
    counts as empty."""
    names = ["fingerprint", "n_shingles", *(["second"] if second else [])]

    @F.pandas_udf(", ".join(f"{n} long" for n in names))
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for body in batch:
                hashes = shingle_hashes(body or "", width)
                row = (majority_bits(hashes), len(hashes))
                rows.append((*row, majority_bits(remixed(hashes))) if second else row)
            yield pd.DataFrame(rows, columns=names)

    base = docs.drop(*names)
    made = free_name(base.columns, "_made")
    return base.withColumn(made, measured(F.col(text))).select(
        *base.columns, *[F.col(f"{made}.{n}").alias(n) for n in names]
    )


# covering code -----------------------------------------------------------------------------


class Cover:
    """Anchors for fingerprints that differ in at most ``threshold`` bits.

    The 64 bits are cut into parts that all carry the same perfect code, whose words are the
    anchors. Two fingerprints within the threshold differ in at most ``near`` bits of some part.
    There, the first lies within the code's covering radius of its nearest anchor, its home, and
    so the second lies within radius + near of it. Every fingerprint visits all anchors that near,
    and meets in each the fingerprints at home there: no pair within the threshold is missed.

    Small thresholds use the Golay code (23 bits, radius 3) in two parts; larger ones the Hamming
    code of 15 bits (radius 1) in four.
    """

    def __init__(self, threshold: int):
        if not 0 <= threshold <= 15:
            raise ValueError("thresholds from 0 to 15 bits are covered")
        self.threshold = threshold
        if threshold <= 5:
            self.length, self.radius, self.parts = 23, 3, 2
            # Remainders of the powers of x by the code's polynomial, x^11+x^9+x^7+x^6+x^5+x+1.
            columns, value = [], 1
            for _ in range(23):
                columns.append(value)
                value <<= 1
                value ^= 0xAE3 if value >> 11 else 0
        else:
            self.length, self.radius, self.parts = 15, 1, 4
            columns = list(range(1, 16))
        self.near = threshold // self.parts
        self.syndromes = 2048 if self.length == 23 else 16
        self.columns = columns
        # All error patterns up to radius + near, by the syndrome they cause.
        found: list[list[int]] = [[] for _ in range(self.syndromes)]
        for weight in range(self.radius + self.near + 1):
            for places in itertools.combinations(range(self.length), weight):
                syndrome = pattern = 0
                for p in places:
                    syndrome ^= columns[p]
                    pattern |= 1 << p
                found[syndrome].append(pattern)
        self.home = np.array([f[0] for f in found], np.int64)  # the lightest
        sizes = [len(f) for f in found]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.patterns = np.array([p for f in found for p in f], np.int64)
        self.reach = math.ceil(sum(sizes) / len(sizes))

    def part(self, prints: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The bits of one part and their syndromes."""
        shift = np.uint64(number * self.length)
        bits = ((prints.view(np.uint64) >> shift) & np.uint64((1 << self.length) - 1)).astype(np.int64)
        syndromes = np.zeros(len(bits), np.int64)
        for place, column in enumerate(self.columns):
            syndromes ^= ((bits >> place) & 1) * column
        return bits, syndromes

    def homes(self, prints: np.ndarray, number: int) -> np.ndarray:
        bits, syndromes = self.part(prints, number)
        return bits ^ self.home[syndromes]

    def visits(self, prints: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and anchors, one pair for each anchor within reach of a row."""
        bits, syndromes = self.part(prints, number)
        sizes = self.first[syndromes + 1] - self.first[syndromes]
        rows = np.repeat(np.arange(len(bits)), sizes)
        ends = np.cumsum(sizes)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        return rows, bits[rows] ^ self.patterns[self.first[syndromes[rows]] + within]


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked members the least label among them, in place; labels are member numbers."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped


def _cell_forest(cell: pd.DataFrame, threshold: int, check: int | None) -> pd.DataFrame:
    """Links that connect what a cell's comparisons connect: each member with one other at most."""
    home = cell["home"].to_numpy()
    node = cell["node"].to_numpy(np.int64)
    prints = cell["fingerprint"].to_numpy(np.int64)
    second = cell["second"].to_numpy(np.int64) if check is not None else None
    size = cell["size"].to_numpy(np.int64) if check is not None else None
    at_home, guests = np.flatnonzero(home), np.flatnonzero(~home)
    _, number = np.unique(node, return_inverse=True)
    first_row = np.zeros(number.max() + 1, np.int64)
    first_row[number] = np.arange(len(node))
    labels = np.arange(len(first_row))
    step = max(1, MATRIX // max(1, len(guests)))
    for start in range(0, len(at_home), step):
        rows = at_home[start : start + step]
        apart = np.bitwise_count(prints[rows, None] ^ prints[None, guests])
        i, j = np.nonzero(apart <= threshold)
        a, b = rows[i], guests[j]
        if check is not None:
            near = np.bitwise_count(second[a] ^ second[b]) <= check
            # Sets as similar as 0.8 are at most a quarter larger.
            near &= 5 * np.minimum(size[a], size[b]) >= 4 * np.maximum(size[a], size[b]) - 20
            a, b = a[near], b[near]
        _merge(labels, number[a], number[b])
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return pd.DataFrame({"a": node[first_row[linked]], "b": node[first_row[labels[linked]]]})


def _forests(part: pd.DataFrame, threshold: int, check: int | None) -> pd.DataFrame:
    """The links of all cells of a task."""
    part = part.sort_values("cell", kind="stable", ignore_index=True)
    cells = part["cell"].to_numpy()
    cuts = np.flatnonzero(np.diff(cells)) + 1
    found = []
    for start, end in zip([0, *cuts], [*cuts, len(cells)]):
        if end - start > 2:  # one fingerprint alone is its own guest
            links = _cell_forest(part.iloc[start:end], threshold, check)
            if len(links):
                found.append(links)
    return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)


def near_links(prints: DataFrame, threshold: int, check: int | None = None) -> DataFrame:
    """``a, b``: links between nodes whose fingerprints differ in at most ``threshold`` bits, one
    for each member of a compared block at most, so that exactly the true links' components come
    out. ``prints`` has one row per node: ``node, fingerprint`` (longs), and with ``check`` also
    ``second`` and ``size``: then a link also needs second fingerprints within ``check`` bits and
    sizes that a similarity of 0.8 allows (with 4 to spare).

    Cells are anchors. Their members are counted first (one row per anchor; the code fixes how many
    there are, at most 8,192), and a cell with many members is cut into blocks, each pair of blocks
    being a task of its own; so no cell is ever too large for a task, whatever a hot one holds.
    """
    cover = Cover(threshold)
    extra = ["second", "size"] if check is not None else []
    spark = prints.sparkSession

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 1 << cover.length
        guests, hosts = {}, {}
        for batch in batches:
            values = batch["fingerprint"].to_numpy(np.int64)
            for part in range(cover.parts):
                for into, anchors in (
                    (hosts, cover.homes(values, part)),
                    (guests, cover.visits(values, part)[1]),
                ):
                    for anchor, n in zip(*np.unique(anchors, return_counts=True)):
                        key = part * size + int(anchor)
                        into[key] = into.get(key, 0) + int(n)
        yield pd.DataFrame(
            [(k, hosts.get(k, 0), n) for k, n in guests.items()], columns=["cell", "hosts", "guests"]
        )

    counts = (
        prints.select("fingerprint")
        .mapInPandas(counted, "cell long, hosts long, guests long")
        .groupBy("cell")
        .agg(F.sum("hosts").alias("hosts"), F.sum("guests").alias("guests"))
        .collect()
    )
    split = spark.sparkContext.broadcast(
        {
            r["cell"]: (-(-r["hosts"] // HOME_BLOCK) or 1, -(-r["guests"] // VISITOR_BLOCK))
            for r in counts
            if r["hosts"] > HOME_BLOCK or r["guests"] > VISITOR_BLOCK
        }
    )
    # Cells that share a task, so that a task has enough to do however thin the cells are.
    tasks = min(cover.parts << cover.length, sum(r["guests"] for r in counts) // TASK_MEMBERS + 64)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 1 << cover.length
        large = np.array(sorted(split.value), np.int64)
        for batch in batches:
            values = batch["fingerprint"].to_numpy(np.int64)
            nodes = batch["node"].to_numpy(np.int64)
            for part in range(cover.parts):
                homes = cover.homes(values, part)
                rows, anchors = cover.visits(values, part)
                place = np.concatenate([np.arange(len(values)), rows])
                cells = np.concatenate([homes, anchors]) + part * size
                home = np.zeros(len(place), bool)
                home[: len(values)] = True
                block = np.zeros(len(place), np.int64)
                hot = np.flatnonzero(np.isin(cells, large)) if len(large) else []
                if len(hot):
                    keep = np.ones(len(place), bool)
                    keep[hot] = False
                    more = []
                    for at in hot:
                        hosts, guests = split.value[int(cells[at])]
                        own = hash(int(nodes[place[at]]))
                        if home[at]:
                            more += [(at, own % hosts * guests + g) for g in range(guests)]
                        else:
                            more += [(at, h * guests + own % guests) for h in range(hosts)]
                    again, blocks = (np.array(x, np.int64) for x in zip(*more))
                    order = np.concatenate([np.flatnonzero(keep), again])
                    block = np.concatenate([block[keep], blocks])
                    place, cells, home = place[order], cells[order], home[order]
                out = {"task": cells % tasks, "block": block, "cell": cells, "home": home, "node": nodes[place]}
                out |= {"fingerprint": values[place]}
                out |= {c: batch[c].to_numpy(np.int64)[place] for c in extra}
                yield pd.DataFrame(out)

    fields = "task long, block long, cell long, home boolean, node long, fingerprint long"
    fields += "".join(f", {c} long" for c in extra)
    members = prints.select("node", "fingerprint", *extra).mapInPandas(dealt, fields)
    return members.groupBy("task", "block").applyInPandas(
        lambda part: _forests(part, threshold, check), "a long, b long"
    )


def link_fingerprints(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 3, threshold: int = 3
) -> DataFrame:
    """``key, fingerprint`` (a long) and ``component_id`` (the least key reachable by links) of
    every row.

    Equal fingerprints are one node, so copies never meet one another. Texts without words have
    the fingerprint 0 and are linked like any other; null texts count as empty. Null keys take part
    and never name a component that has another key. Repeated rows stay.
    """
    rows = stage(
        fingerprints(
            docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", width
        ).select("key", "fingerprint"),
        "fingerprints",
    )
    nodes = rows.groupBy("fingerprint").agg(F.min("key").alias("least"))
    links = near_links(nodes.select(F.col("fingerprint").alias("node"), "fingerprint"), threshold)
    roots = component_roots(links).select(F.col("node").alias("fingerprint"), "root")
    owned = nodes.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    named = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    found = owned.join(named, "root").select("fingerprint", "component_id")
    return rows.join(found, "fingerprint").select(
        F.col("key").alias(key), "fingerprint", "component_id"
    )


# near duplicates ---------------------------------------------------------------------------

# Bits that the fingerprints of near duplicates may differ in. A bound on bits alone loses pairs with an
# appended or replaced block, so texts whose shingles are so alike are near duplicates too.
BITS = 3
SIMILARITY = 0.8
SHINGLE = 5
# A prefix holds one shingle more than it must for each so many shingles of the text. Two alike
# texts then share as many more, and so many of a prefix's most frequent ones need not be met on.
SPARE_SHARE = 10
# Texts of a candidate group that one task holds; larger groups are compared block by block.
GROUP_BLOCK = 768


def normal_text(text: Column) -> Column:
    """The words with A-Z lower-cased, joined by single blanks."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_join(F.array_remove(F.split(lowered, BLANK + "+"), ""), " ")


def _least_overlap(size: int, min_similarity: float) -> int:
    """Shingles that a set of ``size`` shares at least with any set that similar."""
    return max(1, math.ceil(min_similarity * size - 1e-9))


def shingle_prefix(text: str, min_similarity: float) -> tuple[np.ndarray, int]:
    """The least hashes among a text's distinct five-word shingles, and how many of them any text
    that similar has among its own: no such text has fewer, whatever the two differ in.

    Of ``n`` shingles at most ``n - o`` are missing from a text that shares ``o``, so the first
    ``k`` shared ones, in any order of all hashes, are among the first ``n - o + k`` of both.
    """
    hashes = np.unique(shingle_hashes(text, SHINGLE).view(np.int64))
    n = len(hashes)
    least = _least_overlap(n, min_similarity)
    return hashes[: n - least + 1 + n // SPARE_SHARE], 1 + least // SPARE_SHARE


def prefix_links(rows: DataFrame, min_similarity: float) -> DataFrame:
    """``a, b``: links whose components hold every two nodes with texts similar enough. ``rows``
    are ``node, text``; rows of one node have the same words.

    A shingle of few nodes comes before one of many: of the prefix shingles that other nodes have
    too, all but the most frequent are kept, as many less one as similar texts share. Two similar
    texts still have a kept one in common, and boilerplate seldom joins others. Each kept
    shingle is joined with its least node alone, one row per occurrence.
    """

    @F.pandas_udf("need int, prefix array<long>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingle_prefix(body or "", min_similarity) for body in batch]
            yield pd.DataFrame({"need": [n for _, n in found], "prefix": [p for p, _ in found]})

    members = rows.select("node", cut(F.col("text")).alias("made")).select(
        "node", "made.need", F.explode("made.prefix").alias("h")
    )
    ends = (F.min("node").alias("a"), F.max("node").alias("b"))
    counted = members.groupBy("h").agg(*ends, F.count("*").alias("n"))
    shared = stage(counted.filter("a < b").select("h", "n"), "near-shared")
    met = (
        members.join(bounded_broadcast(shared), "h")
        .groupBy("node")
        .agg(
            F.first("need").alias("need"),
            F.array_sort(F.collect_set(F.struct("n", "h"))).alias("met"),  # bounded by one text
        )
        .filter(F.size("met") >= F.col("need"))
    )
    rare = F.slice("met", F.lit(1), F.size("met") - F.col("need") + 1)
    kept = stage(met.select("node", F.explode(rare).alias("s")).select("node", "s.h"), "near-kept")
    least = stage(kept.groupBy("h").agg(*ends).filter("a < b").drop("b"), "near-least")
    joined = kept.join(bounded_broadcast(least), "h").filter("node != a")
    return joined.select("a", F.col("node").alias("b"))


def _verified(group: pd.DataFrame, min_similarity: float) -> pd.DataFrame:
    """Links that connect the texts of a block pair whose shingle sets are similar enough."""
    group = group.drop_duplicates("node").sort_values("node", ignore_index=True)
    node = group["node"].to_numpy(np.int64)
    sets = [np.unique(shingle_hashes(text or "", SHINGLE)) for text in group["text"]]
    size = np.array([len(x) for x in sets], np.int64)
    ends = np.cumsum(size)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    # The texts of each shingle, one shingle after the other.
    owner = np.repeat(np.arange(len(node)), size)[np.argsort(ids, kind="stable")]
    until = np.cumsum(np.bincount(ids))
    since = np.concatenate([[0], until[:-1]])
    label = np.arange(len(node))
    links = []
    for i in range(len(node) - 1):
        after = np.arange(i + 1, len(node))
        small, large = np.minimum(size[i], size[after]), np.maximum(size[i], size[after])
        after = after[(label[after] != label[i]) & (small + 1e-6 >= min_similarity * large)]
        if not len(after):
            continue
        own = ids[ends[i] - size[i] : ends[i]]
        many = until[own] - since[own]
        place = np.arange(many.sum()) + np.repeat(since[own] - np.cumsum(many) + many, many)
        both = np.bincount(owner[place], minlength=len(node))[after]
        for j in after[both >= min_similarity * (size[i] + size[after] - both)].tolist():
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                links.append((node[i], node[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def fingerprint_links(nodes: DataFrame, threshold: int) -> DataFrame:
    """``a, b``: links that connect every two nodes whose fingerprints differ in at most
    ``threshold`` bits, found by the anchors. ``nodes`` are ``node, fingerprint`` (longs)."""
    least = stage(nodes.groupBy("fingerprint").agg(F.min("node").alias("least")), "near-fingerprints")
    small = bounded_broadcast(least)
    equal = nodes.join(small, "fingerprint").filter("node != least").select(
        F.col("least").alias("a"), F.col("node").alias("b")
    )
    close = near_links(least.select(F.col("fingerprint").alias("node"), "fingerprint"), threshold)
    for end in ("a", "b"):
        named = small.select(F.col("fingerprint").alias(end), F.col("least").alias(f"least_{end}"))
        close = close.join(named, end)
    close = close.select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    return equal.unionByName(close)


def near_duplicate_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_similarity: float = SIMILARITY,
    threshold: int | None = None,
) -> DataFrame:
    """``doc, node, root``: every document's text class and its group of near duplicates.

    Texts equal in their words are one class. With a ``threshold``, two classes are linked if their
    fingerprints differ in at most so many bits (see ``Cover``); whatever their fingerprints, they
    are linked if the sets of their five-word shingles have a Jaccard similarity of at least
    ``min_similarity``. For the latter, classes that share a rare shingle of their prefixes become
    candidates, and no similar pair is left out; the candidates' connected groups are then checked
    exactly. Groups of any size are compared in pairs of bounded blocks, and only connecting links
    leave a task.
    """
    rows = docs.select(row_key(docs, key).alias("doc"), F.col(text).alias("text")).withColumn(
        "node", F.xxhash64(normal_text(F.col("text")))
    )
    with_bits = [] if threshold is None else ["fingerprint"]
    prints = (fingerprints(rows) if with_bits else rows).select("doc", "node", *with_bits)
    prints = stage(prints, "near-prints")
    # Equal words have equal fingerprints.
    least = [F.min(c).alias(c) for c in ("doc", *with_bits)]
    nodes = stage(prints.groupBy("node").agg(*least), "near-nodes")
    candidates = component_roots(prefix_links(rows.select("node", "text"), min_similarity))
    sizes = candidates.groupBy("root").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / GROUP_BLOCK).cast("int")
    wanted = stage(
        candidates.join(sizes, "root")
        .join(nodes.select("node", "doc"), "node")
        .select("node", "root", "doc", blocks.alias("blocks")),
        "near-wanted",
    )
    # One text per class: that of its least document (of several rows equal in all, any).
    texts = rows.select("doc", "text").join(
        bounded_broadcast(wanted), "doc"
    )
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    dealt = (
        texts.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "root",
            F.least("own", "other").alias("lo"),
            F.greatest("own", "other").alias("hi"),
            "node",
            "text",
        )
    )
    verified = dealt.groupBy("root", "lo", "hi").applyInPandas(
        lambda group: _verified(group, min_similarity), "a long, b long"
    )
    if with_bits:
        verified = verified.unionByName(
            fingerprint_links(nodes.select("node", "fingerprint"), threshold)
        )
    roots = component_roots(verified)
    return prints.select("doc", "node").join(roots, "node", "left").select(
        "doc", "node", F.coalesce("root", "node").alias("root")
    )


def row_key(docs: DataFrame, key: str) -> Column:
    """What tells rows apart and orders them: the key (null last) and a hash of all columns."""
    return F.struct(
        F.col(key).isNull().alias("no_key"),
        F.col(key).alias("key"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_similarity: float = SIMILARITY,
    threshold: int | None = None,
) -> DataFrame:
    """One row of each group of near duplicates: that with the least key (null last).

    Groups are the components of links between texts at least ``min_similarity`` alike in their
    five-word shingles, and with a ``threshold`` also between texts whose fingerprints differ in at
    most so many bits. Texts without words, null ones included, are equal and make one group.
    Rows equal in every column stand for one another: one of them stays. Columns are unchanged.
    """
    groups = stage(near_duplicate_groups(docs, key, text, min_similarity, threshold), "near-groups")
    counted = groups.groupBy("root", "doc").agg(F.count("*").alias("n"))
    best = counted.groupBy("root").agg(F.min(F.struct("doc", "n")).alias("best"))
    best = stage(best.select("root", "best.doc", "best.n"), "near-best")
    losers = counted.join(best.select("doc"), "doc", "left_anti").select("doc")
    repeated = best.filter("n > 1").select("doc")
    own, other = free_name(docs.columns, "_row"), free_name(docs.columns, "_other")
    keyed = docs.withColumn(own, row_key(docs, key))
    losers = bounded_broadcast(stage(losers.withColumnRenamed("doc", other), "near-losers"))
    repeated = bounded_broadcast(repeated.withColumnRenamed("doc", other))
    same = F.col(own).eqNullSafe(F.col(other))
    kept = keyed.join(losers, same, "left_anti")
    once = kept.join(repeated, same, "left_anti")
    twice = kept.join(repeated, same, "left_semi").dropDuplicates([own])
    return once.unionByName(twice).select(*docs.columns)


def op7_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    docs = table(session(spark), sf_dir, "documents")
    return link_fingerprints(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
