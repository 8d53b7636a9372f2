"""Ranked lexical search: an inverted index in shards of documents, searched by Block-Max MaxScore."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import session, table
from tallyloom.session import bounded_broadcast, stage

# Bytes of text that one shard of the index covers (a longer text is a shard by itself), postings
# in a block, queries that visit a shard together, and ordinals that are scored at a time.
SHARD_BYTES = 16 << 20
BLOCK = 128
QUERY_BLOCK = 256
STRETCH = 1024

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of UTF-8 text: A-Z become small, other ASCII but digits and letters becomes blank.
_FOLD = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)

INDEX = (
    "shard long, term string, n_docs long, n_terms long, heads binary, impacts binary, "
    "postings binary, doc_ids array<long>"
)


# the index ---------------------------------------------------------------------------------


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in seven bits a byte, low bits first, and where each of them ends."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        longer = values >= 1 << bits
        if not longer.any():
            break
        sizes += longer
    ends = np.cumsum(sizes)
    packed = np.zeros(int(ends[-1]), np.uint8)
    for place in range(int(sizes.max())):
        here = sizes > place
        more = (sizes[here] > place + 1).astype(np.uint8) << 7
        packed[(ends - sizes)[here] + place] = (values[here] >> 7 * place & 127).astype(np.uint8) | more
    return packed, ends


def _unpacked(octets: np.ndarray) -> np.ndarray:
    """The numbers that ``_varints`` packed."""
    last = octets < 128
    if last.all():
        return octets.astype(np.int64)
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(octets)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((octets & 127).astype(np.int64) << 7 * place, starts)


def _slices(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose values lie one after the other in ``data``."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _shard(
    number: int, ids: list, terms: list[bytes], codes: list[np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """One shard: a row without a term that holds its documents, and one row per term.

    A posting is the distance to the ordinal before and the number of occurrences, both of variable
    length. A block head gives the last ordinal, and where the block's postings and impacts end.
    Impacts are the pairs of occurrences and document length that no other posting of the block
    beats in both: they bound the block's score whatever the totals of the whole corpus are.
    """
    schema = pa.schema(
        [
            ("shard", pa.int64()), ("term", pa.string()), ("n_docs", pa.int64()),
            ("n_terms", pa.int64()), ("heads", pa.binary()), ("impacts", pa.binary()),
            ("postings", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
        ]
    )
    lengths = np.array([len(c) for c in codes], np.int64)
    own = [[number], [None], [len(ids)], [int(lengths.sum())], [b""], [b""],
           [lengths.astype("<i8").tobytes()], [ids]]
    yield pa.record_batch([pa.array(v, f.type) for v, f in zip(own, schema)], schema=schema)

    places = np.repeat(np.arange(len(codes)), lengths)
    found, counts = np.unique(np.concatenate(codes) << 32 | places, return_counts=True)
    code, ordinal = found >> 32, found & 0xFFFFFFFF
    new = np.concatenate([[True], code[1:] != code[:-1]])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([starts, [len(found)]]))
    at = np.arange(len(found)) - np.repeat(starts, sizes)
    opens = np.flatnonzero(at % BLOCK == 0)
    closes = np.concatenate([opens[1:], [len(found)]]) - 1
    block = np.cumsum(at % BLOCK == 0) - 1

    values = np.empty(2 * len(found), np.int64)
    values[0::2] = ordinal - np.where(new, -1, np.concatenate([[-1], ordinal[:-1]]))
    values[1::2] = counts
    packed, ends = _varints(values)
    ends = ends[1::2]

    # Impacts: by falling occurrences, those that are shorter than all before them in the block.
    order = np.lexsort((lengths[ordinal], -counts, block))
    fallen = lengths[ordinal][order] - block * (int(lengths.max()) + 1)
    kept = np.concatenate([[True], fallen[1:] < np.minimum.accumulate(fallen)[:-1]])
    chosen = order[kept]
    impacts = np.stack([counts[chosen], lengths[ordinal[chosen]]], 1).astype("<i4")
    impact_ends = np.searchsorted(block[chosen], np.arange(len(opens)), "right")

    first_block = block[starts]
    per_list = np.diff(np.concatenate([first_block, [len(opens)]]))
    post_from = np.concatenate([[0], ends])[starts]
    impact_from = np.concatenate([[0], impact_ends])[first_block]
    heads = np.stack(
        [
            ordinal[closes],
            ends[closes] - np.repeat(post_from, per_list),
            impact_ends - np.repeat(impact_from, per_list),
        ],
        1,
    ).astype("<i4")
    names = _slices(
        np.frombuffer(b"".join(terms), np.uint8),
        np.concatenate([[0], np.cumsum([len(t) for t in terms])]),
    )
    n = len(terms)
    yield pa.record_batch(
        [
            pa.array(np.full(n, number)),
            names.cast(pa.string()),
            pa.array(sizes),
            pa.nulls(n, pa.int64()),
            _slices(heads, np.concatenate([first_block, [len(opens)]]) * 12),
            _slices(impacts, np.concatenate([impact_from, [len(chosen)]]) * 8),
            _slices(packed, np.concatenate([post_from, [len(packed)]])),
            pa.nulls(n, pa.list_(pa.int64())),
        ],
        schema=schema,
    )


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents as a written table, in shards of about ``SHARD_BYTES`` of text.

    A task indexes the documents it reads, shard by shard, so nothing is shuffled and memory is
    bounded by one shard or one text. ``key`` is a long; null keys and rows repeated are documents
    like any other. Texts without a term, null ones among them, are in no shard.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class Codes(dict):
            def __missing__(self, term: bytes) -> int:
                self[term] = number = len(self)
                return number

        made, held, ids, seen, codes = TaskContext.get().partitionId() << 32, 0, [], Codes(), []
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = (body or b"").translate(_FOLD).split()
                if not found:
                    continue
                ids.append(doc)
                codes.append(np.fromiter(map(seen.__getitem__, found), np.int64, len(found)))
                held += len(body)
                if held >= SHARD_BYTES:
                    yield from _shard(made, ids, list(seen), codes)
                    made, held, ids, seen, codes = made + 1, 0, [], Codes(), []
        if ids:
            yield from _shard(made, ids, list(seen), codes)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("body"))
    return stage(rows.mapInArrow(shards, INDEX), "lexical-index")


# the search --------------------------------------------------------------------------------


class _List:
    """The postings of a term in a shard; blocks are unpacked when they are first needed."""

    def __init__(self, weight: int, heads: bytes, impacts: bytes, postings: bytes, size: int, m):
        self.weight, self.size, self.m, self.octets = weight, size, m, postings
        head = np.frombuffer(heads, "<i4").reshape(-1, 3)
        self.last, self.ends = head[:, 0].astype(np.int64), head[:, 1]
        pair = np.frombuffer(impacts, "<i4").reshape(-1, 2).astype(np.int64)
        gains = self.gain(pair[:, 0], m(pair[:, 1]))
        self.bounds = np.maximum.reduceat(gains, np.concatenate([[0], head[:-1, 2]]))
        self.bound = int(self.bounds.max())
        # A packed block stands as repeats of its last ordinal, which keeps the array sorted.
        blocks = np.minimum(np.arange(1, len(head) + 1) * BLOCK, size) - np.arange(len(head)) * BLOCK
        self.ordinals = np.repeat(self.last, blocks)
        self.gains = np.zeros(size, np.int64)
        self.open = np.zeros(len(head), bool)

    def gain(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))

    def unpack(self, blocks: np.ndarray, of_document: np.ndarray) -> None:
        """Unpack the blocks of these ascending numbers that are still packed, run by run."""
        closed = blocks[~self.open[blocks]]
        if not len(closed):
            return
        for run in np.split(closed, np.flatnonzero(np.diff(closed) > 1) + 1):
            a, b = int(run[0]), int(run[-1])
            octets = np.frombuffer(self.octets, np.uint8)
            values = _unpacked(octets[self.ends[a - 1] if a else 0 : self.ends[b]])
            base = self.last[a - 1] if a else -1
            here = slice(a * BLOCK, min((b + 1) * BLOCK, self.size))
            self.ordinals[here] = base + np.cumsum(values[0::2])
            self.gains[here] = self.gain(values[1::2], of_document[self.ordinals[here]])
        self.open[closed] = True


def _best(lists: list[_List], m: np.ndarray, ranks: np.ndarray, k: int) -> tuple:
    """Ordinals and scores of the ``k`` best documents of a shard, equal scores by rank of the id.

    Lists stand by rising bound. While the bounds of the first ones together stay below the score
    to reach, no document can enter by these alone: they are not essential, and only documents of
    the others are looked up in them, if the maximum of the block where they would stand allows it.
    """
    lists = sorted((one for one in lists if one.bound), key=lambda one: one.bound)
    reach = np.cumsum([0] + [one.bound for one in lists])
    tops, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for low in range(0, len(m), STRETCH):
        high = min(low + STRETCH, len(m))
        held = np.zeros(high - low, np.int64)
        # reach[i] bounds what the first i lists give together.
        essential = int(np.searchsorted(reach, least, "left")) - 1
        for one in lists[essential:]:
            a, b = np.searchsorted(one.last, [low, high])
            one.unpack(np.arange(a, min(b + 1, len(one.last))), m)
            a, b = np.searchsorted(one.ordinals, [low, high])
            held[one.ordinals[a:b] - low] += one.gains[a:b]
        found = np.flatnonzero(held)
        for i in range(essential - 1, -1, -1):
            one = lists[i]
            found = found[held[found] + reach[i + 1] >= least]
            if not len(found):
                break
            block = np.searchsorted(one.last, found + low)
            inside = block < len(one.last)
            bound = np.where(inside, one.bounds[np.where(inside, block, 0)], 0)
            may = held[found] + bound + reach[i] >= least
            found, block, inside = found[may], block[may], inside[may]
            one.unpack(np.unique(block[inside]), m)
            asked = found[inside]
            at = np.searchsorted(one.ordinals, asked + low)
            held[asked] += np.where(one.ordinals[at] == asked + low, one.gains[at], 0)
        found = found[held[found] >= least]
        if len(found):
            tops = np.concatenate([tops, found + low])
            scores = np.concatenate([scores, held[found]])
            order = np.lexsort((ranks[tops], -scores))[:k]
            tops, scores = tops[order], scores[order]
            if len(tops) == k:
                least = max(1, int(scores[-1]))
    return tops, scores


def search(
    index: DataFrame, queries: DataFrame, key: str = "item_id", text: str = "text", k: int = 10
) -> DataFrame:
    """``key, rank, doc_id, score`` of the ``k`` best documents of each query.

    Queries of one key count as one query with the terms of all; a null key is a key. Queries
    without terms, null ones among them, find nothing, and so does an empty index. Equal scores
    rank by document id, null last. Blocks of queries visit all shards: only the lists of their
    terms are moved, to one task per shard and block, and each task returns the best of its shard,
    of which the best are ranked. Nothing else is capped. A query sums less than 2^63.
    """
    spark = index.sparkSession
    name = F.to_json(F.struct(F.col(key).alias("key")))
    folded = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"({TERM})"), F.lit(1))
    asked = stage(
        queries.select(name.alias("name"), F.explode(folded).alias("term")).distinct(), "asked"
    )
    n_blocks = -(-max(1, asked.select("name").distinct().count()) // QUERY_BLOCK)
    total = index.filter("term IS NULL").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n, tokens = total["n"] or 0, total["l"] or 1

    wanted = bounded_broadcast(asked.select("term").distinct())
    holding = index.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n_docs").alias("df"))
    odds = F.lit(2 * n + 2) / (F.lit(2) * F.col("df") + F.lit(1))
    weights = holding.select("term", F.floor(F.lit(1000) * F.log(odds)).cast("long").alias("weight"))
    # At most the queries of one block are collected beside a term.
    block = F.pmod(F.xxhash64("name"), F.lit(n_blocks)).cast("int").alias("block")
    by_term = stage(
        asked.groupBy(block, "term").agg(F.collect_set("name").alias("names")).join(weights, "term"),
        "asked-terms",
    )

    lists = index.join(bounded_broadcast(by_term), "term").drop("n_terms")
    documents = (
        index.filter("term IS NULL").drop("n_terms")
        .withColumn("names", F.lit(None).cast("array<string>"))
        .withColumn("weight", F.lit(None).cast("long"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["term"].isna()
        documents = rows[own].iloc[0]
        ids = [None if pd.isna(i) else int(i) for i in documents["doc_ids"]]
        lengths = np.frombuffer(documents["postings"], "<i8")
        ranks = np.empty(len(ids), np.int64)
        ranks[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))] = np.arange(len(ids))

        def m_of(length: np.ndarray) -> np.ndarray:
            return 10 + 90 * length.astype(np.int64) * n // tokens

        m, lists, terms_of = m_of(lengths), [], {}
        for row in rows[~own].itertuples():
            for asking in row.names:
                terms_of.setdefault(asking, []).append(len(lists))
            lists.append(
                _List(int(row.weight), row.heads, row.impacts, row.postings, int(row.n_docs), m_of)
            )
        out = []
        for asking, numbers in terms_of.items():
            tops, scores = _best([lists[i] for i in numbers], m, ranks, k)
            out += [(asking, ids[o], int(s)) for o, s in zip(tops, scores)]
        made = pd.DataFrame(out, columns=["name", "doc_id", "score"])
        return made.astype({"doc_id": "Int64", "score": "int64"})

    heaps = (
        lists.unionByName(documents)
        .groupBy("block", "shard")
        .applyInPandas(best, "name string, doc_id long, score long")
    )
    order = Window.partitionBy("name").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    back = F.from_json("name", f"key {dict(queries.dtypes)[key]}")["key"]
    return (
        heaps.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(back.alias(key), "rank", "doc_id", "score")
    )


def op11_search(spark, sf_dir):
    """The ten best documents for each benchmark item."""
    documents = table(session(spark), sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return search(build_index(documents), items)


OP11_SQL = rf"""
WITH terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), tf AS (
  SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY r, doc_id, term
), sizes AS (
  SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r
), whole AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM sizes
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM benchmark)
), scored AS (
  SELECT item_id, r, doc_id, CAST(sum(
    w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (r), whole
  GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INTEGER)
    AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
