"""Substring dedup by sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import free_name, session, table
from tallyloom.llm.lines import document_key
from tallyloom.session import bounded_broadcast, stage

# A span is the shortest run from a sentence on, or up to one, with this many sentences and words.
MIN_SENTENCES = 2
MIN_WORDS = 16

# A sentence ends after marks and blanks, or after the end of a line; what it ends with is its own.
_END = re.compile(r"[.!?][ \t\r\v\f]+|\n")
_END_BYTES = re.compile(_END.pattern.encode())


def sentences(text: str) -> list[str]:
    """The sentences of a text with all that stands between them; joined they are the text."""
    cuts = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


# Odd numbers without a pattern: two polynomials over sentence hashes, modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


class _Powers:
    """Powers of the bases and of their inverses, as many as the longest text so far needs."""

    def __init__(self) -> None:
        self.up = [np.ones(1, np.uint64) for _ in _BASES]
        self.down = [np.ones(1, np.uint64) for _ in _BASES]

    def grow(self, n: int) -> None:
        if n > len(self.up[0]):
            for i, base in enumerate(_BASES):
                for table, factor in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                    factors = np.full(2 * n, factor, np.uint64)
                    factors[0] = 1
                    table[i] = np.cumprod(factors)


def spans(
    text: str, min_sentences: int, min_words: int, powers: _Powers | None = None
) -> np.ndarray:
    """Rows ``first, last, hash, check`` of the spans from each sentence on and up to each, by
    sentence number, with 64 and 32 bits that tell the sequence of their sentences.

    A sentence is told by the XXH64 of its words with A-Z lower-cased; those without words are
    passed over. Sums of the sentence hashes times powers of a number give the hash of any span in
    one step. The last sentences of a text start no span when too little follows, and the first
    end none. Of a run that is long enough, the span from its start on reaches some sentence, and
    the span up to any later one starts within the run: so together they cover it, to its end.
    """
    data = text.encode("utf-8", "surrogatepass").lower()
    cuts = [0, *(m.end() for m in _END_BYTES.finditer(data)), len(data)]
    split = [(data[a:b].split(), i) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    parts = [(words, i) for words, i in split if words]
    n = len(parts)
    if n < min_sentences:
        return np.zeros((0, 4), np.int64)
    numbers = np.array([i for _, i in parts], np.int64)
    words = np.cumsum([0] + [len(w) for w, _ in parts])
    # The shortest spans from each sentence on, and up to each.
    start = np.arange(n)
    end = np.maximum(start + min_sentences, np.searchsorted(words, words[:-1] + min_words))
    on = start[end <= n] * (n + 1) + end[end <= n]
    stop = np.arange(1, n + 1)
    begin = np.minimum(
        stop - min_sentences, np.searchsorted(words, words[1:] - min_words, "right") - 1
    )
    upto = begin[begin >= 0] * (n + 1) + stop[begin >= 0]
    start, end = np.divmod(np.unique(np.concatenate([on, upto])), n + 1)
    powers = powers or _Powers()
    powers.grow(n + 1)
    own = np.array([xxhash.xxh64_intdigest(b" ".join(w)) for w, _ in parts], np.uint64)
    found = np.empty((len(start), 4), np.int64)
    found[:, 0], found[:, 1] = numbers[start], numbers[end - 1]
    for i, (up, down) in enumerate(zip(powers.up, powers.down)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * up[:n])])
        found[:, 2 + i] = ((sums[end] - sums[start]) * down[start]).view(np.int64)
    found[:, 3] >>= 32
    return found


def repeated_sentences(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``doc, gone``: per document the non-first spans, as numbers of their first and last sentences.

    Every span of every document is hashed once and written. Hashes are counted first, so that only
    spans whose hash occurs again take part in the join with their first place (a grouped minimum);
    a passage that a third of all documents share costs one row per occurrence, and its key is split
    by the adaptive skew join. Spans are equal if 96 bits are.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            found = [
                spans((body or b"").decode("utf-8", "replace"), min_sentences, min_words, powers)
                for body in batch.column(1).to_pylist()
            ]
            rows = np.concatenate(found)
            own = np.repeat(np.arange(len(found)), [len(f) for f in found])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32())
            yield pa.record_batch(
                [batch.column(0).take(pa.array(own))]
                + [pa.array(rows[:, i]).cast(kind) for i, kind in enumerate(kinds)],
                ["doc", "first", "last", "h", "g"],
            )

    rows = docs.select(document_key(key, text).alias("doc"), F.col(text).cast("binary").alias("body"))
    schema = T.StructType([rows.schema["doc"], *T.StructType.fromDDL("first int, last int, h long, g int")])
    every = stage(rows.mapInArrow(hashed, schema), "spans")
    again = every.groupBy("h", "g").count().filter("count > 1").select("h", "g")
    again = stage(again, "span-repeats")
    shared = stage(every.join(bounded_broadcast(again), ["h", "g"], "left_semi"), "spans-shared")
    place = F.struct("doc", "first")
    first = stage(shared.groupBy("h", "g").agg(F.min(place).alias("at")), "span-first-places")
    # Always shuffled: the first places are not much fewer than the spans.
    later = shared.join(first, ["h", "g"]).filter(place > F.col("at"))
    # At most two spans per sentence of a document are collected.
    return later.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("gone"))


def delete_repeated_spans(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Input rows with the text freed of repeated spans of sentences, and with ``n_removed``.

    The first place of a span keeps it: the document with the least key (null last), in it the
    first sentence. Every sentence covered by a span that occurs at an earlier place goes, with the
    blanks that follow it; the others stay as they are. A repeated passage of at least
    ``min_sentences`` sentences and ``min_words`` words loses all its whole sentences, wherever it
    stands. A text may become empty; null stays null. Rows equal in key and text
    stand for one document: they are first together and treated alike. A column ``n_removed`` of
    the input is replaced.
    """
    base = docs.drop("n_removed")
    names = {n: free_name(base.columns, n) for n in ("_doc", "_gone")}
    gone = stage(repeated_sentences(base, key, text, min_sentences, min_words), "spans-gone")
    found = gone.select(F.col("doc").alias(names["_doc"]), F.col("gone").alias(names["_gone"]))
    own = document_key(key, text)
    joined = base.join(found, own.eqNullSafe(F.col(names["_doc"])), "left")

    cleaned = "text string, n long"

    @F.pandas_udf(cleaned)
    def clean(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        kept, removed = [], []
        for body, ranges in zip(texts, gone):
            numbers = {
                i for r in (() if ranges is None else ranges) for i in range(r["first"], r["last"] + 1)
            }
            # A sentence without words within a span goes with it.
            kept.append(
                "".join(s for i, s in enumerate(sentences(body)) if i not in numbers)
                if numbers
                else body
            )
            removed.append(len(numbers))
        return pd.DataFrame({"text": kept, "n": removed})

    made = free_name(joined.columns, "_clean")
    joined = joined.withColumn(made, clean(F.col(text), F.col(names["_gone"])))
    return joined.select(
        *[F.col(made)["text"].alias(c) if c == text else F.col(c) for c in base.columns],
        F.col(made)["n"].alias("n_removed"),
    )


def op6_spans(spark, sf_dir):
    """All documents without their repeated spans of sentences."""
    docs = table(session(spark), sf_dir, "documents")
    return delete_repeated_spans(docs.select("doc_id", "text")).select(
        "doc_id", "n_removed", "text"
    )
