"""Packing of token sequences as a cutting-stock problem, solved by column generation."""

from __future__ import annotations

import math
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.bpe import (
    _NEW_CAPITALS,
    _SPLIT_ONLY,
    Encoder,
    default_path,
    read_vocabulary,
)
from tallyloom.llm.common import session, table
from tallyloom.session import bounded_broadcast, stage

LENGTH = 2048
# Lengths are told apart in steps of so many tokens; a pattern may leave this part of a sequence
# unused; the linear program ends within this part of its optimum, or after so many new patterns
# per size.
STEP = 4
SLACK = 0.01
GAP = 0.0005
TURNS = 4
# Chunks whose ids a task remembers before it starts afresh: bounds memory, not results.
KNOWN_CHUNKS = 600_000
# Text that is encoded at once; a longer document is by itself at worst.
GROUP_BYTES = 4 << 20


# the plan: a linear program over patterns of lengths --------------------------------------------


def _priced(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The dearest pattern: how many of each size fit the capacity, by dynamic programming."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room], chosen[room] = best[room - 1], -1
        k = fitting[room]
        if k:
            values = prices[:k] + best[room - sizes[:k]]
            top = int(values.argmax())
            if values[top] > best[room]:
                best[room], chosen[room] = values[top], top
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            pattern[chosen[room]] += 1
            room -= sizes[chosen[room]]
    return float(best[capacity]), pattern


def _fullest(sizes: list[int], left: list[int], first: int, capacity: int) -> list[tuple[int, int]]:
    """The fullest pattern of what is left that holds size number ``first``: numbers and counts.

    Reachable sums are the bits of one integer; each step remembers which sums it reached first.
    """
    room = capacity - sizes[first]
    reached, limit, steps = 1, (1 << room + 1) - 1, []
    for number in range(first, -1, -1):
        many = min(math.ceil(left[number]) - (number == first), room // sizes[number])
        times = 1
        while many > 0 and not reached >> room & 1:
            times = min(times, many)
            grown = (reached | reached << sizes[number] * times) & limit
            if grown != reached:
                steps.append((number, times, grown & ~reached))
                reached = grown
            many -= times
            times *= 2
    total, counts = reached.bit_length() - 1, {first: 1}
    for number, times, new in reversed(steps):
        if total and new >> total & 1:
            counts[number] = counts.get(number, 0) + times
            total -= sizes[number] * times
    return sorted(counts.items(), reverse=True)


def _one_after_another(sizes: list[int], left: list, capacity: int, whole: bool) -> Iterator[tuple]:
    """``(pattern, copies, sizes used up)``: the largest size left in its fullest pattern, as often
    as it goes, and so on; ``left`` is counted down. Patterns are numbers and counts. Without
    ``whole``, copies are fractions and each pattern uses up a size."""
    for first in range(len(sizes) - 1, -1, -1):
        while left[first]:
            counts = _fullest(sizes, left, first, capacity)
            copies, least = min((left[i] // c if whole else left[i] / c, i) for i, c in counts)
            for i, c in counts:
                left[i] -= c * copies
                if not whole and (i == least or left[i] < 1e-6):
                    left[i] = 0
            yield counts, copies, [i for i, _ in counts if left[i] == 0]


def column_generation(
    sizes: list[int], demand: list[int], capacity: int
) -> list[tuple[list[tuple[int, int]], float]]:
    """Patterns, as numbers and counts of sizes, and how often each is used, so that the demand is
    met with the fewest sequences.

    The simplex method starts with the patterns of ``_one_after_another``: one for each size, all
    but used up by it, which makes the basis triangular. Its dual prices make the next pattern a
    knapsack; the dearest one enters the basis. That price bounds the optimum, as the sum of all
    sizes does, and the search ends at the bound or after ``TURNS`` patterns per size; what it has
    meets the demand at any time.
    """
    n = len(sizes)
    basis, used, whole = np.zeros((n, n)), np.zeros(n), np.array(sizes)
    wanted = np.array(demand, float)
    taken = set()
    left = [float(n) for n in demand]
    for counts, copies, gone in _one_after_another(sizes, left, capacity, whole=False):
        for place, own in enumerate(i for i in gone if i not in taken):
            # The first size that ends here gives the pattern its column; others that end with it
            # get one of their own that is not used yet.
            taken.add(own)
            if place == 0:
                for i, c in counts:
                    basis[i, own] = c
                used[own] = copies
            else:
                basis[own, own] = capacity // sizes[own]
    inverse = np.linalg.inv(basis)
    bound = float(whole @ wanted) / capacity
    for turn in range(1, TURNS * n + 1):
        if used.sum() <= bound * (1 + GAP):
            break
        prices = inverse.sum(axis=0)
        value, pattern = _priced(prices, whole, capacity)
        bound = max(bound, float(prices @ wanted) / value)
        if value <= 1 + GAP:
            break
        change = inverse @ pattern
        rising = change > 1e-9
        steps = np.full(n, np.inf)
        steps[rising] = used[rising] / change[rising]
        leaving = int(steps.argmin())
        step = steps[leaving]
        used = np.maximum(used - step * change, 0)
        used[leaving] = step
        basis[:, leaving] = pattern
        if turn % 100 == 0:
            inverse = np.linalg.inv(basis)
            used = np.maximum(inverse @ wanted, 0)
        else:
            row = inverse[leaving] / change[leaving]
            inverse = inverse - np.outer(change, row)
            inverse[leaving] = row
    return [
        ([(i, int(c)) for i, c in enumerate(np.rint(basis[:, k])) if c > 0], float(used[k]))
        for k in range(n)
    ]


def plan(histogram: dict[int, int], capacity: int, slack: int) -> list[tuple[list, int]]:
    """``(pattern, copies)`` with patterns ``[(size, count), ...]`` that fill the capacity but for
    ``slack``, made from a histogram of sizes.

    The patterns of the linear program are used as often as whole numbers allow. What rounding
    leaves, at most some pieces per pattern, is put together one pattern after the other, the
    largest size first. Pieces that no full pattern takes are in none. Bounded by the number of
    sizes, not by the number of pieces.
    """
    sizes = sorted(size for size, n in histogram.items() if n > 0)
    if not sizes:
        return []
    left = [histogram[size] for size in sizes]

    def full(counts) -> bool:
        return capacity - sum(sizes[i] * c for i, c in counts) <= slack

    made = []
    for counts, times in column_generation(sizes, left, capacity):
        copies = min(int(times + 1e-6), *[left[i] // c for i, c in counts])
        if copies > 0 and full(counts):
            made.append((counts, copies))
            for i, c in counts:
                left[i] -= c * copies
    rounds = _one_after_another(sizes, left, capacity, whole=True)
    made += [(counts, n) for counts, n, _ in rounds if full(counts)]
    return [([(sizes[i], c) for i, c in reversed(sorted(counts))], n) for counts, n in made]


# tokens ----------------------------------------------------------------------------------------


class BatchEncoder(Encoder):
    """The ids of many texts at once, equal to those of ``Encoder``.

    Known chunks are remembered. The words of all unknown ones are merged side by side in arrays,
    one row a word: in each round every row takes its merge of least rank, leftmost first, until
    none is left. Words of more than ``LONGEST`` bytes are encoded one by one.
    """

    LONGEST = 48

    def __init__(self, vocabulary: dict):
        super().__init__(vocabulary)
        vocab = vocabulary["vocab"]
        self.inner = np.array([vocab[c] for c in self.alphabet])
        self.last = np.array([vocab[c + "</w>"] for c in self.alphabet])
        self.radix = max(vocab.values()) + 1
        pairs = sorted((a * self.radix + b, *found) for (a, b), found in self.merge.items())
        self.keys, self.ranks, self.made = (np.array(c, np.int64) for c in zip(*pairs))
        self.none = len(pairs)
        self.capitals = chr(min(_NEW_CAPITALS))
        self.by_chunk: dict[str, bytes] = dict(self.special)
        self.by_word: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the merge of each pair in the sorted table, by rank; ``none`` without one."""
        key = left * self.radix + right
        at = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.made[np.searchsorted(self.keys, left * self.radix + right)]

    def _merged(self, words: list[bytes], size: int) -> list[bytes]:
        """Packed ids of words of ``size`` bytes."""
        octets = np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)
        ids = self.inner[octets]
        ids[:, -1] = self.last[octets[:, -1]]
        out: list[bytes] = [b""] * len(words)
        numbers = np.arange(len(words))
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        while True:
            width = ids.shape[1]
            best = ranks.argmin(axis=1) if width > 1 else np.zeros(len(ids), np.int64)
            rows = np.arange(len(ids))
            done = ranks[rows, best] == self.none if width > 1 else np.ones(len(ids), bool)
            packed = ids[done].astype("<u4").tobytes()
            for i, number in enumerate(numbers[done].tolist()):
                out[number] = packed[i * width * 4 : (i + 1) * width * 4]
            if done.all():
                return out
            going = ~done
            ids, ranks, best, numbers = ids[going], ranks[going], best[going], numbers[going]
            rows = np.arange(len(ids))
            ids[rows, best] = self._made(ids[rows, best], ids[rows, best + 1])
            # Close the gap that the right one of the pair leaves.
            columns = np.arange(width - 1)
            ids = np.take_along_axis(ids, columns + (columns > best[:, None]), 1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= best[:, None]), 1)
            for beside, there in ((best - 1, best > 0), (best, best < width - 2)):
                row, at = rows[there], beside[there]
                ranks[row, at] = self._ranks(ids[row, at], ids[row, at + 1])

    def _learn(self, chunks: list[str]) -> None:
        # What Python knows as letters alone is one word; the library knows the same and some more.
        letters = [chunk for chunk in chunks if chunk.isalpha()]
        mixed = [chunk for chunk in chunks if not chunk.isalpha()]
        found = [
            self.ascii_words.findall(chunk)
            if chunk.isascii()
            else self.any_words.findall(
                chunk if max(chunk) < self.capitals else chunk.translate(_NEW_CAPITALS)
            )
            for chunk in mixed
        ]
        fresh = list(set(letters).union(*found).difference(self.by_word))
        octets = [word.encode("utf-8", "surrogatepass") for word in fresh]
        sizes = np.fromiter(map(len, octets), np.int64, len(octets))
        for size in np.unique(sizes).tolist():
            same = np.flatnonzero(sizes == size).tolist()
            words = [fresh[i] for i in same]
            if size > self.LONGEST:
                self.by_word.update((word, self.word(word)) for word in words)
            else:
                self.by_word.update(zip(words, self._merged([octets[i] for i in same], size)))
        packed = self.by_word.__getitem__
        self.by_chunk.update(zip(letters, map(packed, letters)))
        self.by_chunk.update((c, b"".join(map(packed, words))) for c, words in zip(mixed, found))

    def _chunks(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(map(text.__contains__, _SPLIT_ONLY)):
            return self.spaces.split(text)
        return text.split()

    def arrays(self, texts: list[str], close: bytes = b"") -> tuple[np.ndarray, pa.Array]:
        """Numbers of ids and the packed ids of each text, closed by ``close``. Equal chunks of the
        texts are looked up once, and their ids gathered side by side."""
        end = " "  # no chunk is blank
        chunks, ends = [], []
        for text in texts:
            if any(map(text.__contains__, self.special)):
                for piece in self.cut.split(text):
                    chunks += [piece] if piece in self.special else self._chunks(piece)
            else:
                chunks += self._chunks(text)
            chunks.append(end)
            ends.append(len(chunks))
        coded = pa.array(chunks, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.by_chunk) > KNOWN_CHUNKS:
            self.by_chunk, self.by_word = dict(self.special), {}
        self.by_chunk[end] = close
        self._learn([chunk for chunk in distinct if chunk not in self.by_chunk])
        packed = pa.array(map(self.by_chunk.__getitem__, distinct), pa.binary())
        gathered = packed.take(coded.indices)
        _, offsets, octets = gathered.buffers()
        # A text's ids end where those of its last chunk do.
        offsets = np.frombuffer(offsets, np.int32)[[0, *ends]]
        buffers = [None, pa.py_buffer(offsets), octets or pa.py_buffer(b"")]
        return np.diff(offsets) // 4, pa.Array.from_buffers(pa.binary(), len(texts), buffers)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.arrays(texts)[1].to_pylist()


def groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """The rows in groups of about ``most`` bytes of their second column."""
    held, size = [], 0
    for batch in batches:
        start = 0
        for row, length in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
            size += length or 0
            if size >= most:
                yield [*held, batch.slice(start, row + 1 - start)]
                held, size, start = [], 0, row + 1
        if start < len(batch):
            held.append(batch.slice(start))
    if held:
        yield held


def _encoded(docs: DataFrame, path: str, key: str, text: str, end: int, length: int) -> DataFrame:
    """A written table of the packed ids of each document and its place in the task that read it:
    ``part, seq``, the number of whole sequences (``fulls``) and of documents with as long a
    remainder (``same``) before it there, and the remainder's size in steps (0: none)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    type_of = docs.schema[key].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker that is used again keeps the value of a broadcast, and so what it has learnt.
        known, close = vocabulary.value, struct.pack("<I", end)
        if "encoder" not in known:
            known["encoder"] = BatchEncoder(known)
        encoder = known["encoder"]
        part, seq, fulls, same = TaskContext.get().partitionId(), 0, 0, {}
        for held in groups(batches, GROUP_BYTES):
            columns = [[] for _ in range(4)]
            bodies = chain.from_iterable(batch.column(1).to_pylist() for batch in held)
            texts = [(body or b"").decode("utf-8", "replace") for body in bodies]
            doc_tokens, ids = encoder.arrays(texts, close)
            for tokens in doc_tokens.tolist():
                size = -(-(tokens % length) // STEP)
                for column, value in zip(columns, (seq, fulls, size, same.get(size, 0))):
                    column.append(value)
                seq, fulls = seq + 1, fulls + tokens // length
                same[size] = same.get(size, 0) + 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            keys = pa.concat_arrays([batch.column(0) for batch in held])
            yield pa.record_batch(
                [keys, pa.array([part] * len(texts), pa.int32())]
                + [pa.array(c, k) for c, k in zip(columns, kinds)]
                + [pa.array(doc_tokens, pa.int64()), ids],
                ["key", "part", "seq", "fulls", "size", "same", "doc_tokens", "ids"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("body"))
    schema = (
        f"key {type_of}, part int, seq long, fulls long, size int, same long, doc_tokens long, "
        "ids binary"
    )
    return stage(rows.mapInArrow(encoded, schema), "token-ids")


# the packing -----------------------------------------------------------------------------------


def _running(rows: DataFrame, value: str, made: str) -> DataFrame:
    """One row per part with the sum of ``value`` over the parts before it. Parts are the input
    splits, so this orders one short row per split."""
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(made, F.coalesce(F.sum(value).over(order), F.lit(0))).drop(value)


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 1,
    length: int = LENGTH,
) -> DataFrame:
    """Pieces ``key, start, length, sequence_id, offset, doc_tokens, piece_ids`` that lay all
    documents, each closed by the id ``end``, into sequences of at most ``length`` tokens.

    Whole sequences are cut off from the start of a document. The histogram of what remains, at
    most ``length / STEP`` counts, goes to the driver, which solves the cutting-stock problem over
    it; documents are ranked within their size by the place where they were read (a count per size
    and input split, no sort), and ranks are dealt over the copies of the patterns. Remainders that
    no pattern takes are laid end to end and cut where a sequence is full; only its last one, and
    what sizes in steps and patterns leave open, is padding.

    Null and empty texts are the closing id alone. Rows repeated and null keys are documents like
    any other, and other columns don't matter. An empty table gives no pieces. ``piece_ids`` are
    little-endian unsigned 32-bit integers.
    """
    spark = docs.sparkSession
    if length % STEP:
        raise ValueError(f"the length must be a multiple of {STEP}")
    encoded = _encoded(docs, path, key, text, end, length)
    meta = encoded.drop("key", "ids")
    rest = F.col("doc_tokens") % length

    tails = meta.filter("size > 0")
    counts = stage(tails.groupBy("part", "size").count(), "tail-counts")
    found = counts.groupBy("size").agg(F.sum("count").alias("n")).collect()
    slots, sequences, ranks = [], 0, {}
    steps = length // STEP
    for pattern, copies in plan({r["size"]: r["n"] for r in found}, steps, int(steps * SLACK)):
        slot = 0
        for size, each in pattern:
            low = ranks.get(size, 0)
            ranks[size] = low + each * copies
            slots.append((size, low, low + each * copies, sequences, each, slot))
            slot += each
        sequences += copies
    # Bounded by the patterns of the plan.
    places = F.broadcast(
        spark.createDataFrame(
            slots, "of_size int, low long, high long, base long, each long, slot long"
        )
    )

    so_far = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "size", F.coalesce(F.sum("count").over(so_far), F.lit(0)).alias("before"))
    ranked = tails.join(bounded_broadcast(stage(before, "tail-ranks")), ["part", "size"]).withColumn(
        "rank", F.col("before") + F.col("same")
    )
    here = (F.col("size") == F.col("of_size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    dealt = stage(
        ranked.join(places, here, "left").select(
            "part",
            "seq",
            rest.alias("rest"),
            (F.col("base") + F.expr("(rank - low) DIV each")).alias("sequence_id"),
            (F.col("slot") + nth % F.col("each")).alias("slot"),
        ),
        "tail-slots",
    )
    in_sequence = Window.partitionBy("sequence_id").orderBy("slot")
    patterned = dealt.filter("sequence_id IS NOT NULL").select(
        "part", "seq", "sequence_id", (F.sum("rest").over(in_sequence) - F.col("rest")).alias("at")
    )
    loose = dealt.filter("sequence_id IS NULL")
    by_part = _running(loose.groupBy("part").agg(F.sum("rest").alias("sum")), "sum", "ahead")
    in_part = Window.partitionBy("part").orderBy("seq")
    streamed = loose.join(bounded_broadcast(by_part), "part").select(
        "part",
        "seq",
        "sequence_id",
        (F.col("ahead") + F.sum("rest").over(in_part) - F.col("rest")).alias("at"),
    )
    placed = stage(patterned.unionByName(streamed), "tail-places")

    whole = meta.groupBy("part").agg(F.sum(F.expr(f"doc_tokens DIV {length}")).alias("sum"))
    whole = stage(whole, "whole-sequences")
    n_whole = whole.agg(F.sum("sum")).first()[0] or 0
    rows = encoded.join(bounded_broadcast(placed), ["part", "seq"], "left").join(
        bounded_broadcast(_running(whole, "sum", "whole")), "part"
    )
    n = F.col("doc_tokens")

    def piece(start, size, sequence, offset):
        return F.struct(
            start.cast("long").alias("start"),
            size.cast("long").alias("length"),
            sequence.cast("long").alias("sequence_id"),
            offset.cast("long").alias("offset"),
        )

    def full(i):
        return piece(
            i * length, F.lit(length), F.lit(sequences) + F.col("whole") + F.col("fulls") + i, F.lit(0)
        )

    def cut(i):
        low = F.greatest(F.col("at"), i * length)
        high = F.least(F.col("at") + rest, (i + 1) * length)
        return piece(
            n - rest + low - F.col("at"), high - low, F.lit(sequences + n_whole) + i, low - i * length
        )

    none = F.array().cast(
        "array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>"
    )
    fulls = F.sequence(F.lit(0).cast("long"), F.expr(f"doc_tokens DIV {length} - 1"))
    cuts = F.sequence(
        F.expr(f"at DIV {length}"), F.expr(f"(at + doc_tokens % {length} - 1) DIV {length}")
    )
    heads = F.when(n >= length, F.transform(fulls, full)).otherwise(none)
    kept = F.array(piece(n - rest, rest, F.col("sequence_id"), F.col("at")))
    tail = (
        F.when(rest == 0, none)
        .when(F.col("sequence_id").isNotNull(), kept)
        .otherwise(F.transform(cuts, cut))
    )
    pieces = F.concat(heads, tail)
    return rows.select("key", "ids", "doc_tokens", F.inline(pieces)).select(
        F.col("key").alias(key),
        "start",
        "length",
        "sequence_id",
        "offset",
        "doc_tokens",
        F.substring("ids", F.col("start").cast("int") * 4 + 1, F.col("length").cast("int") * 4).alias(
            "piece_ids"
        ),
    )


def op12_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    documents = table(session(spark), sf_dir, "documents").select("doc_id", "text")
    packed = pack(documents, default_path())
    return packed.withColumn("ids_crc32", F.crc32("piece_ids")).drop("piece_ids")
