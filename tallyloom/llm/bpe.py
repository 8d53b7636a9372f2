"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

The vocabulary is a ``tokenizers`` BPE file with word ends. Nothing of that library runs here.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, session, table

# Entries a worker remembers before it starts afresh; a bound on memory, not on results.
MEMO_ENTRIES = 300_000
MEMO_PAIRS = 1_000_000

# The white space of the file's pattern, and the contractions it cuts off.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
# Letters and numbers that Unicode got after version 16, the vocabulary's library's.
_NEWER = """
    a7dd 11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6
    0558 058b-058c 088f 0c5c 0cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7e2 a7f1 ab6c-ab6d
    107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11df1 16ea0-16eb8
    16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191
    191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff
    1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e
    2cea2-2cead 323b0-33479 3d000-3fc3f
"""
# Capitals new since version 16 and their small letters, which Python has not yet.
_NEW_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_NEW_CAPITALS |= {0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
_NEW_CAPITALS |= {capital: capital + 0x20 for capital in range(0x10D50, 0x10D66)}
_NEW_CAPITALS |= {capital: capital + 0x1B for capital in range(0x16EA0, 0x16EB9)}
# White space to str.split, but not to the pattern.
_SPLIT_ONLY = "\x1c\x1d\x1e\x1f"

# Stands for the end of a word inside a token; no byte is mapped to it.
_END = "\uffff"


def read_vocabulary(path: str) -> dict:
    """What encoder and decoder need of a tokenizer file: tokens by id, merges, special tokens."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model = whole["model"]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>":
        raise ValueError("a BPE vocabulary with </w> as the end of words is needed")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {
        "vocab": model["vocab"],
        "merges": merges,
        "special": {t["content"]: t["id"] for t in whole["added_tokens"]},
    }


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(moved)) for b in range(256)]


class Encoder:
    """Packed token ids (little-endian, 32 bits) of whole texts.

    A word's encoding is the one chain of tokens from its start to its end in which all
    neighbours are compatible, that is, merging their joined bytes by rank gives the same two
    tokens back. Every prefix has at most one such chain, so a position that a chain has left in
    vain never needs a second visit, and the search is linear in the word's length.
    """

    def __init__(self, vocabulary: dict):
        vocab, end = vocabulary["vocab"], "</w>"
        text_of = {t: (t[: -len(end)] + _END if t.endswith(end) and t != end else t) for t in vocab}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(vocabulary["merges"]):
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.merge[pair] = (rank, made)
            self.parts[made] = pair
        self.rank = {made: self.merge[pair][0] for made, pair in self.parts.items()}
        self.matches = ahocorasick.Automaton()
        for token, number in vocab.items():
            self.matches.add_word(text_of[token], (number, len(text_of[token])))
        self.matches.make_automaton()
        self.special = {k: struct.pack("<I", v) for k, v in vocabulary["special"].items()}
        self.cut = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        newer = "".join(
            "-".join(rf"\U{int(end, 16):08x}" for end in span.split("-")) for span in _NEWER.split()
        )
        letter, number = rf"[\p{{L}}--[{newer}]]", rf"[\p{{N}}--[{newer}]]"
        self.any_words = regex.compile(
            rf"(?V1){_SHORT}|{letter}+|{number}|(?:[^{_SPACE}\p{{L}}\p{{N}}]|[{newer}])+"
        )
        self.ascii_words = re.compile(f"{_SHORT}|[a-z]+|[0-9]|[^{_SPACE}a-z0-9]+")
        self.whole = {text_of[token]: struct.pack("<I", number) for token, number in vocab.items()}
        self.spaces = re.compile(f"[{_SPACE}]+")
        self.alphabet = _byte_alphabet()
        self.pairs: dict[tuple[int, int], bool] = {}
        outer = self

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= MEMO_ENTRIES:
                    self.clear()
                self[word] = packed = outer.word(word)
                return packed

        class Chunks(dict):
            def __missing__(self, chunk: str) -> bytes:
                if len(self) >= MEMO_ENTRIES:
                    self.clear()
                if chunk.isascii():
                    found = outer.ascii_words.findall(chunk)
                else:
                    found = outer.any_words.findall(chunk.translate(_NEW_CAPITALS))
                self[chunk] = packed = b"".join(map(words.__getitem__, found))
                return packed

        words = Words()
        self.memo = Chunks()

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge would ever reach across the border between two tokens.

        Walks the pieces that touch the border back in time: the right edge of ``left`` and the
        left edge of ``right``, from the whole tokens to their last and first symbols. Two pieces
        touch until one of them is merged away; if their own merge ranks before that, it wins. A
        merge of equal rank inside ``left`` lies further left and so comes first.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        a, b = left, right
        a_gone = b_gone = len(self.merge) + 1
        verdict = True
        while True:
            crossing = self.merge.get((a, b))
            if crossing and crossing[0] < a_gone and crossing[0] <= b_gone:
                verdict = False
                break
            a_made, b_made = self.rank.get(a, -1), self.rank.get(b, -1)
            if a_made < 0 and b_made < 0:
                break
            # Undo the later of the two; of equal ranks the right one was made later.
            if a_made > b_made:
                a_gone, a = a_made, self.parts[a][1]
            else:
                b_gone, b = b_made, self.parts[b][0]
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = verdict
        return verdict

    def word(self, word: str) -> bytes:
        """The packed ids of one word."""
        if word.isascii() and word.isprintable():
            mapped = word + _END
        else:
            octets = word.encode("utf-8", "surrogatepass")
            mapped = "".join(map(self.alphabet.__getitem__, octets)) + _END
        if mapped in self.whole:
            return self.whole[mapped]
        length = len(mapped)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(length)]
        for last, (token, size) in self.matches.iter(mapped):
            starts[last + 1 - size].append((token, size))
        # Ends come in ascending order, so the longest match of a start is popped first.
        path: list[tuple[int, int]] = []
        at, dead = 0, set()
        while at < length:
            waiting = starts[at]
            while waiting:
                token, size = waiting.pop()
                if at + size not in dead and (not path or self.compatible(path[-1][0], token)):
                    path.append((token, size))
                    at += size
                    break
            else:
                if not path:
                    raise ValueError(f"no chain of tokens spells {word!r}")
                dead.add(at)
                at -= path.pop()[1]
        return struct.pack(f"<{len(path)}I", *[token for token, _ in path])

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower() gives it another form at the end of a word
            text = text.replace("Σ", "σ")
        text = text.lower()
        chunks = (
            self.spaces.split(text) if any(map(text.__contains__, _SPLIT_ONLY)) else text.split()
        )
        return b"".join(map(self.memo.__getitem__, chunks))

    def __call__(self, text: str) -> bytes:
        if not self.special or not any(map(text.__contains__, self.special)):
            return self._plain(text)
        pieces = self.cut.split(text)
        return b"".join(self.special.get(p) or self._plain(p) for p in pieces)


class Decoder:
    """Texts of packed ids: all tokens lie in one array of bytes, each followed by the blank that
    joins it to the next, and a table of offsets says where each begins."""

    def __init__(self, vocabulary: dict):
        tokens = {**vocabulary["vocab"], **vocabulary["special"]}
        by_id = {number: token for token, number in tokens.items()}
        pieces = [f"{by_id.get(n, '')} ".encode() for n in range(max(by_id) + 1)]
        self.octets = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def __call__(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0)
        places += np.repeat(starts - ends + sizes, sizes)
        return self.octets[places].tobytes()[:-1].decode()


def encode(docs: DataFrame, path: str, text: str = "text", packed: str = "token_ids") -> DataFrame:
    """Input rows with the ids of the whole text, packed as little-endian unsigned 32-bit integers.

    Equal to the ``tokenizers`` library with ``add_special_tokens=False``: special tokens written
    in a text count as such. Null and empty texts give no ids. A column named like ``packed`` is
    replaced. Only the vocabulary is sent to the tasks; no row is shuffled.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("binary")
    def packed_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            yield pd.Series([encoder(text or "") for text in batch], dtype=object)

    others = [c for c in docs.columns if c.lower() != packed.lower()]
    return docs.withColumn(made := free_name(docs.columns, "_made"), packed_ids(F.col(text))).select(
        *others, F.col(made).alias(packed)
    )


def decode(
    docs: DataFrame, path: str, packed: str = "token_ids", decoded: str = "decoded"
) -> DataFrame:
    """Input rows with the text of the packed ids, as ``decode(ids, skip_special_tokens=False)``
    gives it for a file without a decoder: tokens joined by blanks. Null counts as no ids."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(vocabulary.value)
        for batch in batches:
            yield pd.Series([decoder(bytes(ids or b"")) for ids in batch], dtype=object)

    others = [c for c in docs.columns if c.lower() != decoded.lower()]
    return docs.withColumn(made := free_name(docs.columns, "_made"), text_of(F.col(packed))).select(
        *others, F.col(made).alias(decoded)
    )


def default_path() -> str:
    """The public word-end vocabulary of this installation."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_bpe(spark, sf_dir):
    """Token counts and digests of ids and decoded texts of all documents."""
    docs = table(session(spark), sf_dir, "documents").select("doc_id", "text")
    path = default_path()
    both = decode(encode(docs, path).drop("text"), path)
    return both.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
