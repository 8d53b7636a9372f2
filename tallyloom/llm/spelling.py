"""Spelling variants: near words of a vocabulary, found by scanning it in sorted order."""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import session, table
from tallyloom.session import bounded_broadcast, drop_staged, stage

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5

# Words a task counts before it hands them on, words of a sorted list that one task scans, words
# that walk down it together, and the depth from which a lone word is compared in one go.
TALLY_WORDS = 500_000
SEGMENT_WORDS = 40_000
WALKERS = 8192
DEEP = 64

# Latin-1 bytes: A-Z become small, a-z and U+00C0 to U+00FF stay, all others become blanks.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


# the vocabulary ----------------------------------------------------------------------------


def vocabulary(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damage_every: int | None = None,
) -> DataFrame:
    """``word, n``: the words of ``min_length`` letters or more that occur ``min_count`` times.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased. Null and empty texts
    have none. With ``damage_every``, a word in a document whose CRC32 (of ``key:word``, a null key
    being empty) that number divides loses the letter at that CRC modulo its length: repeatable
    typing errors, as a trial needs them. Tasks count whole texts and pass counts on in parts of
    ``TALLY_WORDS``; the sums are grouped by word.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in tally], pa.string())
            return pa.record_batch([words, pa.array(tally.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                octets = (body or b"").decode("utf-8", "replace").encode("latin-1", "replace")
                found = Counter(w for w in octets.translate(_FOLD).split() if len(w) >= min_length)
                if damage_every:
                    before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word in list(found):
                        utf8 = word if word.isascii() else word.decode("latin-1").encode()
                        h = zlib.crc32(utf8, before)
                        if h % damage_every == 0:
                            times, at = found.pop(word), h % len(word)
                            if len(word) > min_length:
                                tally[word[:at] + word[at + 1 :]] += times
                tally.update(found)
                if len(tally) >= TALLY_WORDS:
                    yield rows()
                    tally.clear()
        yield rows()

    pairs = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("binary").alias("body"))
    counts = pairs.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stage(counts.filter(F.col("n") >= min_count), "vocabulary")


# the scan ----------------------------------------------------------------------------------


def _after(prefix: bytes) -> bytes | None:
    """The least text above all that start with ``prefix``; None if there is none."""
    cut = prefix.rstrip(b"\xff")
    return cut[:-1] + bytes([cut[-1] + 1]) if cut else None


def _fits(word: bytes, prefix: bytes) -> bool:
    """Whether a word that starts with ``prefix`` can be ``word`` with one letter replaced or added."""
    at = next((i for i, (a, b) in enumerate(zip(word, prefix)) if a != b), min(len(word), len(prefix)))
    rest = prefix[at + 1 :]
    return word[at + 1 :].startswith(rest) or word[at:].startswith(rest)


class SortedList:
    """A sorted list of words, walked in step with shorter or equally long ones.

    The walk scans the list by its longest common prefixes: all words between two places where
    neighbours share at most ``d`` letters have their first ``d + 1`` in common, so the row of the
    edit matrix after these letters is computed once for all of them. A range whose shared prefix
    leaves no entry below two in the band is skipped as a whole.
    """

    def __init__(self, words: list[bytes]):
        self.words = words
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.octets = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        common = [0]
        for a, b in zip(words, words[1:]):
            limit = min(len(a), len(b))
            same = a[:limit] == b[:limit]
            common.append(limit if same else next(i for i in range(limit) if a[i] != b[i]))
        self.common = np.array(common, np.int64)

    def _letter(self, word: np.ndarray, depth: int) -> np.ndarray:
        there = depth < self.sizes[word]
        return np.where(there, self.octets[np.where(there, self.starts[word] + depth, -1)], 0)

    def near(self, asking: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``(number in asking, number here)`` of words at edit distance one that share the
        first half of the asking word, where the word here is as long or one letter longer."""
        one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        halves: dict[bytes, tuple[int, int]] = {}
        by_half: dict[int, list[int]] = {}
        for number, word in enumerate(asking):
            by_half.setdefault(len(word) // 2, []).append(number)
        for depth, numbers in by_half.items():
            for at in range(0, len(numbers), WALKERS):
                group = numbers[at : at + WALKERS]
                ranges = []
                for number in group:
                    half = asking[number][:depth]
                    if half not in halves:
                        top = _after(half)
                        halves[half] = (
                            bisect.bisect_left(self.words, half),
                            len(self.words) if top is None else bisect.bisect_left(self.words, top),
                        )
                    ranges.append(halves[half])
                a, b = self._walk([asking[n] for n in group], depth, np.array(ranges, np.int64))
                one.append(np.array(group, np.int64)[a])
                two.append(b)
        return np.concatenate(one), np.concatenate(two)

    def _walk(self, asking: list[bytes], depth: int, ranges: np.ndarray) -> tuple:
        sizes = np.array([len(w) for w in asking], np.int64)
        octets = np.frombuffer(b"".join(asking) + b"\0", np.uint8)
        starts = np.cumsum(sizes) - sizes

        def letter(who: np.ndarray, place: int) -> np.ndarray:
            there = place < sizes[who]
            return np.where(there, octets[np.where(there, starts[who] + place, -1)], 0)

        who = np.arange(len(asking))
        low, high = ranges[:, 0], ranges[:, 1]
        # The matrix row after `depth` letters here: columns depth - 1, depth and depth + 1 of the
        # asking word. Two stands for two or more.
        before, level, beyond = (np.full(len(asking), v, np.int8) for v in (1, 0, 1))
        hits_a, hits_b = [], []
        kept = low < high
        while kept.any():
            who, low, high = who[kept], low[kept], high[kept]
            before, level, beyond = before[kept], level[kept], beyond[kept]
            # A word that ends here was looked at when its last letter was.
            if depth >= DEEP and (lone := (high - low == 1) & (self.sizes[low] > depth)).any():
                for a, b in zip(who[lone], low[lone]):
                    if _one_more(asking[a], self.words[b]):
                        hits_a.append(np.array([a]))
                        hits_b.append(np.array([b]))
                kept = ~lone
                if not kept.any():
                    break
                who, low, high = who[kept], low[kept], high[kept]
                before, level, beyond = before[kept], level[kept], beyond[kept]
            # The parts of each range that share one letter more.
            cuts = np.flatnonzero(self.common <= depth)
            first, last = np.searchsorted(cuts, low), np.searchsorted(cuts, high)
            parts = last - first
            each = np.repeat(np.arange(len(who)), parts)
            cut = np.arange(len(each)) - np.repeat(np.cumsum(parts) - parts, parts) + first[each]
            low = cuts[cut]
            high = np.where(cut + 1 < last[each], np.append(cuts, len(self.words))[cut + 1], high[each])
            who, before, level, beyond = who[each], before[each], level[each], beyond[each]
            here = self._letter(low, depth)
            new_before = np.minimum(before + (here != letter(who, depth - 1)), level + 1)
            new_level = np.minimum(level + (here != letter(who, depth)), beyond + 1)
            new_level = np.minimum(new_level, new_before + 1)
            new_beyond = np.minimum(beyond + (here != letter(who, depth + 1)), new_level + 1)
            depth += 1
            size = sizes[who]
            before = np.where(depth - 1 <= size, np.minimum(new_before, 2), 2).astype(np.int8)
            level = np.where(depth <= size, np.minimum(new_level, 2), 2).astype(np.int8)
            beyond = np.where(depth + 1 <= size, np.minimum(new_beyond, 2), 2).astype(np.int8)
            # Words that ended before this letter have no letter here and end their part.
            alive = here > 0
            ends = alive & (self.sizes[low] == depth)
            same = ends & (size == depth) & (level == 1)
            longer = ends & (size + 1 == depth) & (before == 1)
            for found in (same, longer):
                hits_a.append(who[found])
                hits_b.append(low[found])
            kept = alive & (np.minimum(np.minimum(before, level), beyond) <= 1)
        if not hits_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(hits_a), np.concatenate(hits_b)


def _one_more(word: bytes, other: bytes) -> bool:
    """Whether ``other`` is ``word`` with one letter replaced or added."""
    if word == other or len(other) - len(word) not in (0, 1):
        return False
    at = next((i for i, (a, b) in enumerate(zip(word, other)) if a != b), len(word))
    return other[at + 1 :] == word[at + (len(word) == len(other)) :]


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words found in one segment of a list: per word their number and the commonest."""
    listed = rows[rows["listed"]].sort_values("key", kind="stable")
    octets = [k.encode("latin-1") for k in listed["key"]]
    guests = rows[~rows["listed"]]
    asking = octets + [k.encode("latin-1") for k in guests["key"]]
    counts = np.concatenate([listed["n"].to_numpy(), guests["n"].to_numpy()])
    a, b = SortedList(octets).near(asking)
    backward = bool(rows["backward"].iloc[0])

    def counted_once(x: bytes, y: bytes) -> bool:
        # Of two equally long words the lesser one asks; what both halves share is found forward.
        half = len(x) // 2
        return (len(x) < len(y) or x < y) and not (backward and x[-half:] == y[-half:])

    once = np.fromiter((counted_once(asking[i], octets[j]) for i, j in zip(a, b)), bool, len(a))
    a, b = a[once], b[once]
    own = [w[::-1] for w in asking] if backward else asking
    rank = np.empty(len(own), np.int64)
    rank[sorted(range(len(own)), key=own.__getitem__)] = np.arange(len(own))
    word, other = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((rank[other], -counts[other], word))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else word
    # Without a type an empty list is one of numbers, which Spark does not take for texts.
    return pd.DataFrame(
        {
            "word": pd.Series([own[i].decode("latin-1") for i in word[first]], dtype=object),
            "n_near": np.diff(np.append(first, len(word))).astype(np.int64),
            "best_n": counts[other[first]].astype(np.int64),
            "best": pd.Series([own[i].decode("latin-1") for i in other[first]], dtype=object),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best, best_n`` of the words that have near ones.

    Two words are near if one inserted, deleted or replaced letter makes one of the other. The
    edit leaves the first or the last half of the shorter word alone (the longer half, if they
    differ), so the vocabulary is sorted twice, by the words and by the words reversed, and a word
    looks for partners only among those that share its first half there. Both lists are cut into
    segments of about ``SEGMENT_WORDS`` words in sorted order; a task scans one. A word whose range
    goes on in other segments is sent there too, unless their shared prefixes exclude it. Only the
    first and last word of each segment come to the driver. Words are of Latin-1 letters, distinct,
    with at least two letters.
    """
    spark = words.sparkSession
    both = words.select("n", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"), "word")
    both = both.select(
        "n", "backward", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")).alias("key")
    )
    segments = -(-max(1, 2 * words.count()) // SEGMENT_WORDS)
    lists = stage(
        both.repartitionByRange(segments, "backward", "key").withColumn("segment", F.spark_partition_id()),
        "sorted-words",
    )
    ends = lists.groupBy("backward", "segment").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    borders = {False: ([], [], []), True: ([], [], [])}
    for row in ends.orderBy("backward", "segment").collect():
        for column, value in zip(borders[row.backward], (row.segment, row.least, row.most)):
            column.append(value if isinstance(value, int) else value.encode("latin-1"))

    def guests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for n, backward, key, own in batch.itertuples(index=False):
                numbers, least, most = borders[backward]
                word = key.encode("latin-1")
                half = word[: len(word) // 2]
                at = bisect.bisect_left(most, half)
                while at < len(numbers) and least[at][: len(half)] <= half:
                    if numbers[at] != own:
                        a, b = least[at], most[at]
                        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                        if _fits(word, a[:shared]):
                            out.append((n, backward, key, numbers[at]))
                    at += 1
            yield pd.DataFrame(out, columns=["n", "backward", "key", "segment"])

    sent = lists.mapInPandas(guests, lists.schema)
    found = (
        lists.withColumn("listed", F.lit(True))
        .unionByName(sent.withColumn("listed", F.lit(False)))
        .groupBy("segment", "backward")
        .applyInPandas(_scan, "word string, n_near long, best_n long, best string")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.n")).alias("best_n")
    )


# the groups --------------------------------------------------------------------------------


def _roots(links: DataFrame) -> DataFrame:
    """``word, root`` of links ``word, root`` that never return: each round halves the ways.

    A way is as long as counts can grow by the ratio, so a handful of rounds reach its end.
    """
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = links.join(bounded_broadcast(onward), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        longer = stage(longer, "spelling-roots")
        moved = longer.agg(F.max("moved")).first()[0]
        drop_staged(links)
        if not moved:
            return longer.select("word", "root")
        # A dropped column would lose the folder's name.
        links = longer


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of a vocabulary ``word, n``.

    A word's form is its commonest near word (of equally common ones the first in code-point
    order) if that is at least ``ratio`` times as common, else null; its root is where the forms
    lead, the word itself without any. ``ratio`` is above one, so forms never lead back. ``n_near``
    counts the near words.
    """
    if ratio <= 1:
        raise ValueError("a form must be more common than its variant")
    near = near_words(words)
    good = F.col("best_n") >= F.col("n") * ratio
    named = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.when(good, F.col("best")).alias("form"),
            F.when(good, F.col("best_n")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        ),
        "spelling-forms",
    )
    links = stage(named.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-links")
    return named.join(bounded_broadcast(_roots(links)), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The spelling variants of a corpus: ``variants`` of its ``vocabulary``, which takes options."""
    return variants(vocabulary(docs, key, text, **options))


def op13_spelling(spark, sf_dir):
    """The words of all documents, some damaged on purpose, with the forms they are variants of."""
    documents = table(session(spark), sf_dir, "documents").select("doc_id", "text")
    return group_variants(documents, damage_every=199)
