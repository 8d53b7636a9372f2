"""Quality rules by divergence from language references."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, session, table

# Frequent function words of the languages that have a reference.
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was with as be by this are at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un une du que dans qui pour au sur par est pas elle".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo".split(),
}

# Classes of characters.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "mark", "symbol", "shout", "other")

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
# Divergences in bits. Guards: a histogram of fewer counts than these is not judged.
MAX_CHAR_DIVERGENCE = 0.105
MIN_CHARS = 200
MAX_WORD_DIVERGENCE = 0.08
MIN_HISTOGRAM_WORDS = 100

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_BLANKS = " \t\n\v\f\r"


def _char_classes() -> np.ndarray:
    """The class of each code point below 0x3000; all later ones are letters without case."""
    classes = np.zeros(0x3001, np.int8)
    for point in range(0x3000):
        c = chr(point)
        if c in SYMBOLS:
            name = "symbol"
        elif c in "!?+=@~^_\\{}[]":
            name = "shout"
        elif c in _BLANKS:
            name = "blank"
        elif c.isdigit():
            name = "digit"
        elif c.isupper():
            name = "upper"
        elif c.isalpha():
            name = "lower"
        elif 32 < point < 127 or point in (0xAB, 0xBB, 0xBF, 0xA1) or 0x2010 <= point <= 0x2027:
            name = "mark"
        else:
            name = "other"
        classes[point] = CLASSES.index(name)
    classes[0x3000] = CLASSES.index("lower")
    return classes


def char_histogram(text: str, classes: np.ndarray) -> np.ndarray:
    """Characters of the text by class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(classes[np.minimum(points, 0x3000)], minlength=len(CLASSES))


def word_forms(common: list[str]) -> dict[bytes, int]:
    """The place of every form of the common words: three cases, with a mark before or after."""
    return {
        f"{before}{form}{after}".encode(): place
        for place, word in enumerate(common)
        for form in (word, word.capitalize(), word.upper())
        for before in ("", '"', "'", "(", "¿", "¡", "«")
        for after in ("", ".", ",", ";", ":", "!", "?", '"', "'", ")", "»")
    }


def word_histogram(words: list[bytes], forms: dict[bytes, int], common: int) -> np.ndarray:
    """How often each common word occurs in any of its forms; last, all other words."""
    counts = np.zeros(common + 1, np.int64)
    for place, n in Counter(map(forms.get, words)).items():
        counts[common if place is None else place] = n
    return counts


def divergence(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon divergence of two histograms in bits, from 0 to 1; its square root is the
    distance. 0 if either is empty."""
    if not a.sum() or not b.sum():
        return 0.0
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    halves = (np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])) for x in (p, q))
    return float(max(0.0, sum(halves) / 2))


def repeated_words(words: list, width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the list."""
    windows = list(zip(*[words[i:] for i in range(width)]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    covered, upto = 0, 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered += at + width - max(at, upto)
            upto = at + width
    return covered


def duplicate_lines(text: str) -> int:
    r"""Lines with a word that equal an earlier line of the text; lines end at \n alone."""
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _words(text: str) -> list[bytes]:
    """Words between ASCII blanks, as UTF-8: what ``bytes.split`` splits at."""
    return text.encode("utf-8", "surrogatepass").split()


def language_references(
    docs: DataFrame, text: str = "text", lang: str = "lang", common: dict = COMMON_WORDS
) -> dict[str, dict[str, np.ndarray]]:
    """Per language its two reference histograms, summed over every document of that language.

    What reaches the driver is one row per language of ``common``: its size is bounded by the word
    lists, not by the data. The sums are whole numbers, so runs agree.
    """
    sizes = {k: len(v) + 1 for k, v in common.items()}
    width = len(CLASSES) + max(sizes.values())

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes = _char_classes()
        forms = {k: word_forms(v) for k, v in common.items()}
        sums = {k: np.zeros(width, np.int64) for k in common}
        for batch in batches:
            for language, body in zip(batch["l"], batch["t"]):
                if language in sums and body:
                    own = sums[language]
                    own[: len(CLASSES)] += char_histogram(body, classes)
                    counts = word_histogram(_words(body), forms[language], sizes[language] - 1)
                    own[len(CLASSES) : len(CLASSES) + len(counts)] += counts
        yield pd.DataFrame(
            [(k, i, int(n)) for k, own in sums.items() for i, n in enumerate(own) if n],
            columns=["l", "i", "n"],
        )

    narrow = docs.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"))
    parts = narrow.mapInPandas(counted, "l string, i int, n long")
    found: dict[str, np.ndarray] = {}
    for row in parts.groupBy("l", "i").agg(F.sum("n").alias("n")).collect():
        found.setdefault(row["l"], np.zeros(width, np.int64))[row["i"]] = row["n"]
    return {
        k: {
            "chars": v[: len(CLASSES)],
            "words": v[len(CLASSES) : len(CLASSES) + sizes[k]],
        }
        for k, v in found.items()
    }


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    common: dict = COMMON_WORDS,
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
    max_char_divergence: float = MAX_CHAR_DIVERGENCE,
    max_word_divergence: float = MAX_WORD_DIVERGENCE,
    min_chars: int = MIN_CHARS,
    min_histogram_words: int = MIN_HISTOGRAM_WORDS,
) -> DataFrame:
    """Input rows with the text's statistics, its two divergences, ``base_failed`` and ``kept``.

    A first pass over all documents sums the references; a second measures and judges each
    document. The base rules fail texts under ``min_words`` words, and those with more than
    ``max_repeated_percent`` per cent of their words in repeated 5-word windows. Beyond them, a
    text is rejected if its histogram of character classes, or of common words, lies further than
    the limit from the reference of its language, by the square root of the Jensen-Shannon
    divergence; the limits are given as divergences. Histograms of fewer than ``min_chars``
    characters or ``min_histogram_words`` words are not judged.

    A document of a language without a reference, null among them, is judged by its characters alone,
    against the nearest reference; its word divergence is null. Null texts count as empty: no words, base_failed. Rows with equal texts and languages get equal verdicts.
    Columns of the input named like the added ones are replaced. An empty input gives an empty
    result.
    """
    references = language_references(docs, text, lang, common)
    fields = f"{_STATS}, char_divergence double, word_divergence double"

    @F.pandas_udf(fields)
    def measured(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        classes = _char_classes()
        forms = {k: word_forms(common[k]) for k in references}
        for texts, languages in batches:
            rows = []
            for body, language in zip(texts, languages):
                body = body or ""
                words = _words(body)
                own = [language] if language in references else list(references)
                chars = char_histogram(body, classes)
                rows.append(
                    (
                        len(words),
                        len(body) - sum(map(body.count, _BLANKS)),
                        sum(map(body.count, SYMBOLS)),
                        duplicate_lines(body),
                        repeated_words(words),
                        min((divergence(chars, references[k]["chars"]) for k in own), default=0.0)
                        if len(body) >= min_chars
                        else None,
                        min(
                            (
                                divergence(
                                    word_histogram(words, forms[k], len(common[k])),
                                    references[k]["words"],
                                )
                                for k in own
                            ),
                            default=0.0,
                        )
                        if len(words) >= min_histogram_words and language in references
                        else None,
                    )
                )
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    names = [f.split()[0] for f in fields.split(", ")]
    base = docs.drop(*names, "base_failed", "kept")
    found = free_name(base.columns, "_found")
    stats = base.withColumn(found, measured(F.col(text), F.col(lang).cast("string"))).select(
        *base.columns, *[F.col(f"{found}.{n}").alias(n) for n in names]
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words")
    )

    def far(column: str, limit: float):
        return F.coalesce(F.sqrt(column) > math.sqrt(limit), F.lit(False))

    divergent = far("char_divergence", max_char_divergence) | far(
        "word_divergence", max_word_divergence
    )
    return stats.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~divergent
    )


def op8_quality(spark, sf_dir):
    """Statistics and verdict of every document."""
    docs = table(session(spark), sf_dir, "documents")
    names = [f.split()[0] for f in _STATS.split(", ")]
    return quality_rules(docs.select("doc_id", "text", "lang")).select(
        "doc_id", *names, "base_failed", "kept", "char_divergence", "word_divergence"
    )
