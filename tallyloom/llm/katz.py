"""LM scoring with a Katz backoff model of word pairs.

The documents a task reads are cut into blocks of bounded size, whose words are numbered once. A
block asks, once for each of its distinct words and pairs, what the whole corpus knows of them, and
says how often it has them itself; the answers come back in the order of the questions. So keys
travel one way only, equal n-grams of a block travel once, and neither the vocabulary nor the counts
are ever held in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import session, table

# Text of a block; a longer document is a block's only one at worst.
BLOCK_BYTES = 8 << 20
# Followers of one context that one task counts; a more frequent context is split by follower.
CONTEXT_TOKENS = 1 << 19
# Counts up to this one are discounted.
GOOD_TURING = 5

# How many pairs were seen 1, 2, ... times in training; tokens, words, and how many words were.
PAIR_FACTS = [f"n{r}" for r in range(1, GOOD_TURING + 2)]
WORD_FACTS = ["tokens", "vocabulary", *[f"w{r}" for r in range(1, GOOD_TURING + 2)]]

# An answer to a block: kind 1 for words, 2 for pairs.
ANSWER_COLUMNS = ["block", "part", "kind", "counts", "large", "types", "types_large", "mass"]
ANSWER_TYPES = "long long int binary array<long> binary array<long> binary".split()

# A block as it travels: its number, and frames.
BLOCK_COLUMNS = ["block", "docs", "words", "tokens"]

# The end of a text, and what stands before its first word: no word contains a blank.
END, START = b"\n", b" "


def word_hash(word: bytes) -> int:
    digest = xxhash.xxh64_intdigest(word)
    return digest - (1 << 64) if digest >> 63 else digest


def words_in(octets: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased, and the end."""
    words = (octets or b"").lower().split()
    words.append(END)
    return words


def words_of(text: str | None) -> list[bytes]:
    return words_in((text or "").encode("utf-8", "surrogatepass"))


# the model's arithmetic --------------------------------------------------------------------


def discounts(of_count: list[int]) -> np.ndarray:
    """Katz's Good-Turing discounts of the counts 1, 2, ...; ``of_count[r]`` n-grams occur r times.

    Uses the largest cutoff up to GOOD_TURING for which every discount lies between 0 and 1, and
    halves single counts if there is none (too few n-grams). Larger counts are kept.
    """
    n = [*of_count, *[0] * (GOOD_TURING + 2)]
    for cutoff in range(GOOD_TURING, 0, -1):
        if not all(n[r] > 0 for r in range(1, cutoff + 2)):
            continue
        rest = (cutoff + 1) * n[cutoff + 1] / n[1]
        found = [
            ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if rest != 1 else -1.0
            for r in range(1, cutoff + 1)
        ]
        if all(0 < d < 1 for d in found):
            return np.array([1.0, *found, *[1.0] * (GOOD_TURING - cutoff)])
    return np.array([1.0, 0.5, *[1.0] * (GOOD_TURING - 1)])


class Unigrams:
    """Probabilities of single words: discounted counts, and one class for all unknown words that
    takes exactly what they leave."""

    def __init__(self, tokens: int, of_count: list[int]):
        self.tokens, self.discount = tokens, discounts(of_count)
        rare = range(1, min(GOOD_TURING + 1, len(of_count)))
        left = sum((1 - self.discount[r]) * r * of_count[r] for r in rare)
        if left <= 0:  # no rare word: the unknown ones get one count
            self.discount, self.tokens, left = np.ones(GOOD_TURING + 1), tokens + 1, 1.0
        self.unknown = left / self.tokens

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        kept = self.discount[np.where(counts <= GOOD_TURING, counts, 0)] * counts / self.tokens
        return np.where(counts > 0, kept, self.unknown)


def backoff(
    totals: np.ndarray, types: np.ndarray, mass: np.ndarray, discount: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Per context the divisor of its counts and its weight for unseen words.

    ``types[:, r - 1]`` followers were seen r times and all followers seen have the unigram
    probability ``mass``. The weight gives the unseen words exactly what discounting leaves. A
    context without rare followers leaves nothing, so its divisor grows by one count.
    """
    ranks = np.arange(1, GOOD_TURING + 1)
    left = (types * ((1 - discount[1:]) * ranks)).sum(axis=1)
    divisor = totals + (left <= 0)
    left = np.where(left > 0, left, 1.0)
    return divisor, left / divisor / np.maximum(1 - mass, 1e-300)


# blocks ------------------------------------------------------------------------------------


def pack(values: np.ndarray, width: int) -> tuple[bytes, np.ndarray]:
    """Counts as unsigned numbers of one or two bytes, and the places and values of larger ones."""
    most = (1 << 8 * width) - 1
    large = np.flatnonzero(values > most)
    small = np.minimum(values, most).astype(f"<u{width}").tobytes()
    return small, np.concatenate([large, values[large]]).astype(np.int64)


def unpack(small: bytes, large: np.ndarray, width: int) -> np.ndarray:
    values = np.frombuffer(small, f"<u{width}").astype(np.int64)
    half = len(large) // 2
    if half:
        values[np.asarray(large[:half], np.int64)] = large[half:]
    return values


def pack_hashes(hashes: np.ndarray) -> bytes:
    """The lower six bytes of each: enough to tell the contexts of one part apart, and the followers
    of one context."""
    return hashes.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack_hashes(packed: bytes) -> np.ndarray:
    octets = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    whole = np.zeros((len(octets), 8), np.uint8)
    whole[:, :6] = octets
    return whole.reshape(-1).view("<i8").astype(np.int64)


def pack_masses(masses: np.ndarray) -> bytes:
    """The upper six bytes of each: 36 bits after the point."""
    return masses.astype("<f8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpack_masses(packed: bytes) -> np.ndarray:
    octets = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    whole = np.zeros((len(octets), 8), np.uint8)
    whole[:, 2:] = octets
    return whole.reshape(-1).view("<f8").astype(float)


def planes(values: np.ndarray, width: int) -> pa.Table:
    """The lower ``width`` bytes of each number, a column for each: equal ones compress well."""
    octets = values.astype("<i8").view(np.uint8).reshape(-1, 8)
    return pa.table({str(i): np.ascontiguousarray(octets[:, i]) for i in range(width)})


def from_planes(columns: pa.Table) -> np.ndarray:
    octets = np.zeros((len(columns), 8), np.uint8)
    for i, column in enumerate(columns.columns):
        octets[:, i] = column.to_numpy()
    return octets.reshape(-1).view("<i8").astype(np.int64)


def framed(whole: pa.Table) -> bytes:
    """A compressed frame of a table."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, whole.schema, options=options) as stream:
        stream.write_table(whole.combine_chunks())
    return sink.getvalue().to_pybytes()


def unframed(frame: bytes) -> pa.Table:
    return pa.ipc.open_stream(frame).read_all()


def numbered(rows: list[pa.RecordBatch], block: int) -> pa.RecordBatch:
    """A block: its documents, the hashes of its distinct words, the most frequent first, and the
    number of each token's word."""
    docs = pa.Table.from_batches(rows)
    tokens, sizes = [], []
    for octets in docs.column("text").cast(pa.binary()).to_pylist():
        words = words_in(octets)
        tokens += words
        sizes.append(len(words))
    coded = pa.array(tokens, pa.large_binary()).dictionary_encode()
    code, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
    digests = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    hashes = digests.view(np.int64)
    order = np.lexsort((hashes, -np.bincount(code)))
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    width = (len(order).bit_length() + 7) // 8
    docs = docs.drop_columns("text").append_column("size", pa.array(sizes, pa.int64()))
    frames = (docs, planes(hashes[order], 8), planes(place[code], width))
    return pa.record_batch(
        [pa.array([block]), *[pa.array([framed(f)], pa.binary()) for f in frames]], BLOCK_COLUMNS
    )


def blocks_of(block_bytes: int):
    """Cuts the rows a task reads into blocks of about ``block_bytes`` of text. Their words are
    numbered here, once; they travel as compressed frames, and equal rows are dealt like any others."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            start = 0
            for row, length in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
                size += (length or 0) + 16
                if size >= block_bytes:
                    yield numbered([*held, batch.slice(start, row + 1 - start)], block)
                    block, held, size, start = block + 1, [], 0, row + 1
            if start < len(batch):
                held.append(batch.slice(start))
        if held:
            yield numbered(held, block)

    return blocks


class Block:
    """The words of a block's documents: numbered, and as pairs of a word and the one before."""

    def __init__(self, frames: pd.DataFrame):
        docs, words, tokens = (unframed(frames[c].iloc[0]) for c in BLOCK_COLUMNS[1:])
        self.docs = docs.to_pandas(integer_object_nulls=True)
        self.sizes = self.docs["size"].to_numpy(np.int64)
        self.code = from_planes(tokens)
        self.hashes = from_planes(words)
        self.train = np.repeat(self.docs["train"].to_numpy(bool), self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def by_part(self, parts: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """The words' order by the part that counts them, and each part's words."""
        part = self.hashes % parts
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        groups = np.split(order, cuts) if len(order) else []
        return order, [(int(part[g[0]]), g) for g in groups]

    def counts(self, answers: pd.DataFrame, parts: int) -> np.ndarray:
        """The answered training counts, by word number."""
        first = answers[answers["kind"] == 1]
        given = {
            p: unpack(small, large, 2)
            for p, small, large in zip(first["part"], first["counts"], first["large"])
        }
        found = np.zeros(len(self.hashes), np.int64)
        for part, group in self.by_part(parts)[1]:
            found[group] = given[part]
        return found

    def pairs(self, counts: np.ndarray, parts: int) -> dict:
        """The distinct pairs of known words, ordered by the part that counts them.

        A context that occurs more than CONTEXT_TOKENS times in training is split by follower into
        slots; all of them are asked, so that each block learns of all its followers.
        """
        size = len(self.hashes)
        before = np.empty_like(self.code)
        before[1:] = self.code[:-1]
        before[self.starts] = size  # the start of a text
        context_hash = np.append(self.hashes, word_hash(START))
        end = np.flatnonzero(self.hashes == word_hash(END))
        totals = np.append(counts, counts[end[0]] if len(end) else 0)
        # Owners of pairs: known contexts, or their slots, by the part that counts them.
        slots = -(-totals // CONTEXT_TOKENS)
        first = np.cumsum(slots) - slots
        context = np.repeat(np.arange(size + 1), slots)
        slot = np.arange(len(context)) - first[context]
        part = ((context_hash[context] >> 3) + slot * 0x9E3779B1) % parts
        order = np.argsort(part, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        asked = (totals[before] > 0) & (counts[self.code] > 0)
        of_asked, word = before[asked], self.code[asked]
        owner = first[of_asked]
        split = np.flatnonzero(slots[of_asked] > 1)
        owner[split] += (self.hashes[word[split]] >> 7) % slots[of_asked[split]]
        # Split contexts have a question for every slot, and contexts that only unknown words
        # follow have one without a follower: their weights are needed too.
        present, followed = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        present[before], followed[of_asked] = True, True
        bare = np.flatnonzero(present[context] & ((slots[context] > 1) | ~followed[context]))
        key = np.concatenate([place[owner] * (size + 1) + word + 1, place[bare] * (size + 1)])
        by_key = np.argsort(key)
        key = key[by_key]
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        number = np.empty(len(key), np.int64)
        number[by_key] = np.cumsum(fresh) - 1
        key = key[fresh]
        inverse = number[: len(word)]
        owner, follower = np.divmod(key, size + 1)
        return {
            "asked": asked,
            "inverse": inverse,
            "totals": totals,
            "before": before,
            "owner": owner,
            "context": context[order],
            "slot": slot[order],
            "part": part[order],
            "follower": follower - 1,
            "seen": np.bincount(inverse[self.train[asked]], minlength=len(key)),
            "context_hash": context_hash,
        }


def _questions(found: dict) -> Iterator[tuple[int, slice, np.ndarray]]:
    """Per part: its number, its questions, and the owners they belong to with where each begins."""
    owner = found["owner"]
    if not len(owner):
        return
    begins = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    part = found["part"][owner[begins]]
    cuts = np.flatnonzero(np.diff(part)) + 1
    ends = np.append(begins, len(owner))
    for low, high in zip([0, *cuts], [*cuts, len(begins)]):
        yield int(part[low]), slice(ends[low], ends[high]), begins[low:high]


def _ask_words(parts: int):
    def ask(docs: pd.DataFrame) -> pd.DataFrame:
        block = Block(docs)
        number = int(docs["block"].iloc[0])
        counts = np.bincount(block.code[block.train], minlength=len(block.hashes))
        rows = [
            (part, number, block.hashes[group].astype("<i8").tobytes(), *pack(counts[group], 1))
            for part, group in block.by_part(parts)[1]
        ]
        return pd.DataFrame(rows, columns=["part", "block", "words", "seen", "seen_large"])

    return ask


def _joined_words(asks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All words asked of a part, as numbers, and the training count of each."""
    words = np.frombuffer(b"".join(asks["words"]), "<i8")
    seen = np.concatenate([unpack(x, y, 1) for x, y in zip(asks["seen"], asks["seen_large"])])
    distinct, number = np.unique(words, return_inverse=True)
    return number, np.bincount(number, weights=seen, minlength=len(distinct)).astype(np.int64)


def _count_words(asks: pd.DataFrame) -> pd.DataFrame:
    """A part's training tokens and words, and how many words were seen 1, 2, ... times."""
    totals = _joined_words(asks)[1]
    n = np.bincount(np.minimum(totals, GOOD_TURING + 2), minlength=GOOD_TURING + 3)
    facts = [totals.sum(), np.count_nonzero(totals), *n[1 : GOOD_TURING + 2]]
    return pd.DataFrame({name: [int(f)] for name, f in zip(WORD_FACTS, facts)})


def _answer_words(asks: pd.DataFrame) -> pd.DataFrame:
    number, totals = _joined_words(asks)
    found, rows, at = totals[number], [], 0
    for part, block, words in zip(asks["part"], asks["block"], asks["words"]):
        here = found[at : at + len(words) // 8]
        at += len(here)
        rows.append((block, part, 1, *pack(here, 2), None, None, None))
    return pd.DataFrame(rows, columns=ANSWER_COLUMNS)


def _place_type(words: int) -> str:
    return "<u2" if words <= 1 << 16 else "<u4"


def _places(words: bytes, places: bytes) -> np.ndarray:
    return np.frombuffer(places, _place_type(len(words) // 6))


def _ask_pairs(parts: int):
    def ask(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["part", "block", "contexts", "runs", "words"]
        columns += ["known", "known_large", "places", "seen", "seen_large"]
        if not len(docs):
            return pd.DataFrame([], columns=columns)
        block = Block(docs)
        counts = block.counts(answers, parts)
        found = block.pairs(counts, parts)
        number = int(docs["block"].iloc[0])
        rows = []
        for part, at, begins in _questions(found):
            follower = found["follower"][at]
            owner = found["owner"][begins]
            real = follower >= 0
            runs = np.add.reduceat(real.astype(np.int32), begins - at.start)
            # Each follower once, with its count; the pairs say which one they mean.
            named, places = np.unique(follower[real], return_inverse=True)
            rows.append(
                (
                    part,
                    number,
                    pack_hashes(found["context_hash"][found["context"][owner]] + found["slot"][owner]),
                    runs.astype(np.int32),
                    pack_hashes(block.hashes[named]),
                    *pack(counts[named], 2),
                    places.astype(_place_type(len(named))).tobytes(),
                    *pack(found["seen"][at][real], 1),
                )
            )
        return pd.DataFrame(rows, columns=columns)

    return ask


def _joined(asks: pd.DataFrame) -> tuple:
    """All questions of a part as one list of pairs: numbers of context and pair for each."""
    contexts = np.concatenate([unpack_hashes(c) for c in asks["contexts"]])
    runs = np.concatenate([*asks["runs"]]).astype(np.int64)
    places = [_places(w, p) for w, p in zip(asks["words"], asks["places"])]
    words = np.concatenate([unpack_hashes(w)[p] for w, p in zip(asks["words"], places)])
    known = np.concatenate(
        [unpack(x, y, 2)[p] for x, y, p in zip(asks["known"], asks["known_large"], places)]
    )
    seen = np.concatenate([unpack(x, y, 1) for x, y in zip(asks["seen"], asks["seen_large"])])
    distinct, context = np.unique(contexts, return_inverse=True)
    of_pair = np.repeat(context, runs)
    # One number of 64 bits for a pair: an odd multiple of the context's hash and the word's.
    pair = contexts[np.repeat(np.arange(len(contexts)), runs)] * -0x61C8864680B583EB + words
    order = np.argsort(pair)
    pair = pair[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = pair[1:] != pair[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    first = order[fresh]
    totals = np.bincount(number, weights=seen, minlength=len(first)).astype(np.int64)
    return len(distinct), context, number, of_pair[first], known[first], totals


def _count_types(asks: pd.DataFrame) -> pd.DataFrame:
    """How many pairs of a part were seen 1, 2, ... times."""
    totals = _joined(asks)[5]
    n = np.bincount(np.minimum(totals, GOOD_TURING + 2), minlength=GOOD_TURING + 3)
    return pd.DataFrame({name: [int(n[r])] for r, name in enumerate(PAIR_FACTS, 1)})


def _unigrams(facts: pd.Series) -> Unigrams:
    return Unigrams(int(facts["tokens"]), [0, *[int(facts[n]) for n in WORD_FACTS[2:]]])


def _answer_pairs():
    def answer(asks: pd.DataFrame) -> pd.DataFrame:
        unigrams = _unigrams(asks.iloc[0])
        size, context, number, owner, known, totals = _joined(asks)
        mass = np.bincount(owner, weights=unigrams(known) * (totals > 0), minlength=size)
        types = np.stack(
            [np.bincount(owner[totals == r], minlength=size) for r in range(1, GOOD_TURING + 1)], 1
        )
        rows, at, pair_at = [], 0, 0
        for part, block, contexts, words, places in zip(
            asks["part"], asks["block"], asks["contexts"], asks["words"], asks["places"]
        ):
            size_here, n = len(contexts) // 6, len(_places(words, places))
            own, pairs = context[at : at + size_here], number[pair_at : pair_at + n]
            at, pair_at = at + size_here, pair_at + n
            counts, rare = pack(totals[pairs], 1), pack(types[own].ravel(), 1)
            rows.append((block, part, 2, *counts, *rare, pack_masses(mass[own])))
        return pd.DataFrame(rows, columns=ANSWER_COLUMNS)

    return answer


def _score(parts: int):
    columns = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame([], columns=columns)
        block = Block(docs)
        counts = block.counts(answers, parts)
        found = block.pairs(counts, parts)
        facts = answers.iloc[0]
        unigrams, tokens = _unigrams(facts), int(facts["tokens"])
        second = answers[answers["kind"] == 2]
        given = {
            part: (unpack(*counts, 1), unpack(*rare, 1), mass)
            for part, mass, *counts_and_rare in zip(
                *(second[c] for c in ("part", "mass", "counts", "large", "types", "types_large"))
            )
            for counts, rare in [(counts_and_rare[:2], counts_and_rare[2:])]
        }
        pair_seen = np.zeros(len(found["owner"]), np.int64)
        of_owner = np.zeros((GOOD_TURING + 1, len(found["context"])))
        for part, at, begins in _questions(found):
            part_counts, part_types, part_mass = given[part]
            pair_seen[at][found["follower"][at] >= 0] = part_counts
            owners = found["owner"][begins]
            of_owner[0, owners] = unpack_masses(part_mass)
            of_owner[1:, owners] = part_types.reshape(-1, GOOD_TURING).T
        # The slots of a context are added up.
        mass, *types = (
            np.bincount(found["context"], weights=x, minlength=len(found["totals"])) for x in of_owner
        )
        types = np.stack(types, 1)
        discount = discounts([0, *[int(facts[n]) for n in PAIR_FACTS]])
        divisor, weight = backoff(found["totals"], types, mass, discount)
        single = unigrams(counts)
        # A token's probability: from its pair if that was seen, else from the word alone, with the
        # context's weight if the context was seen.
        context, word = found["context"][found["owner"]], found["follower"]
        kept = discount[np.where(pair_seen <= GOOD_TURING, pair_seen, 0)] * pair_seen / divisor[context]
        pair = np.where(pair_seen > 0, kept, weight[context] * single[word])
        before = found["before"]
        chance = np.where(found["totals"][before] > 0, weight[before], 1.0) * single[block.code]
        chance[found["asked"]] = pair[found["inverse"]]
        base = np.log10((counts + 1) / (tokens + int(facts["vocabulary"]) + 1))[block.code]
        return pd.DataFrame(
            {
                "key": block.docs["key"],
                "held_out": ~block.docs["train"].to_numpy(bool),
                "n_tokens": block.sizes,
                "n_known": np.add.reduceat((counts[block.code] > 0).astype(np.int64), block.starts),
                "train_tokens": tokens,
                "base_score": np.add.reduceat(base, block.starts),
                "score": np.add.reduceat(np.log10(chance), block.starts),
            }
        )

    return score


def _facts(asks: DataFrame, counted, names: list[str]) -> DataFrame:
    """One row with the sums of what ``counted`` gives for each part."""
    each = asks.groupBy("part").applyInPandas(counted, ", ".join(f"{n} long" for n in names))
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    return each.agg(F.struct(*sums).alias("facts"))


def katz_scores(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    modulus: int = 7,
    held_remainder: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from all whole texts whose crc32 of the key as text leaves another remainder
    than ``held_remainder``; a null key counts as the empty text, a null text as empty. A text's
    score is the log10 probability of its words and its end, each given the one before (the first
    given the start): the discounted pair count if the pair was seen; else the context's weight
    times the word's own discounted probability, or that alone after an unseen context. All unknown
    words are one class, which takes what discounting leaves; so for every context the known words,
    the end and that class add up to one. ``base_score`` is the add-one unigram model's.

    Words are told apart by 64-bit hashes, contexts within a part and followers within a context by 48
    bits. A context that makes up most tokens is counted by many tasks, each taking some of its
    followers. An empty input gives an empty result, and one without
    training texts scores every token as unknown. Repeated rows are scored, and learnt, each.
    """
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).select(
        "key",
        "text",
        (F.crc32(name.cast("binary")) % modulus != held_remainder).alias("train"),
    )
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-total // block_bytes))

    # One exchange of the numbered texts serves all three visits to the blocks.
    dealt = rows.mapInArrow(
        blocks_of(block_bytes), "block long, docs binary, words binary, tokens binary"
    ).repartition(parts, "block")
    answer = ", ".join(f"{name} {kind}" for name, kind in zip(ANSWER_COLUMNS, ANSWER_TYPES))
    word_asks = (
        dealt.groupBy("block")
        .applyInPandas(
            _ask_words(parts), "part long, block long, words binary, seen binary, seen_large array<long>"
        )
        .repartition(parts, "part")
    )
    word_facts = _facts(word_asks, _count_words, WORD_FACTS)
    word_answers = word_asks.groupBy("part").applyInPandas(_answer_words, answer)
    pair_asks = (
        dealt.groupBy("block")
        .cogroup(word_answers.groupBy("block"))
        .applyInPandas(
            _ask_pairs(parts),
            "part long, block long, contexts binary, runs array<int>, words binary, "
            "known binary, known_large array<long>, places binary, seen binary, "
            "seen_large array<long>",
        )
        .repartition(parts, "part")
    )
    pair_facts = _facts(pair_asks, _count_types, PAIR_FACTS)
    pair_answers = (
        pair_asks.withColumn("f", word_facts.scalar())
        .select(*pair_asks.columns, "f.*")
        .groupBy("part")
        .applyInPandas(_answer_pairs(), answer)
    )
    answers = (
        word_answers.unionByName(pair_answers)
        .withColumns({"f": word_facts.scalar(), "g": pair_facts.scalar()})
        .select(*ANSWER_COLUMNS, "f.*", "g.*")
    )
    scored = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(
            _score(parts),
            f"key {dict(rows.dtypes)['key']}, held_out boolean, n_tokens long, n_known long, "
            "train_tokens long, base_score double, score double",
        )
    )
    return scored.withColumnRenamed("key", key)


def op3_katz(spark, sf_dir):
    """Scores of all documents under the model and the unigram base."""
    docs = table(session(spark), sf_dir, "documents")
    return katz_scores(docs)
