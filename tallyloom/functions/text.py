"""Splitting text the way the JVM's ``String.split`` does."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_drop_trailing(text: Column, separator: str) -> Column:
    """Split on a literal separator, keeping inner empty pieces and dropping trailing ones.

    A text without a separator gives itself as the only piece, even when it is empty; a text of
    separators alone gives an empty array. Spark's ``split`` keeps the trailing empties.
    """
    pattern = re.escape(separator)
    if len(separator) == 1:
        body = F.rtrim(text, F.lit(separator))
        return F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(
            F.split(body, pattern)
        )
    pieces = F.split(text, pattern)
    filled = F.array_position(F.transform(F.reverse(pieces), lambda p: p != ""), True)
    kept = F.when(filled == 0, F.lit(0)).otherwise(F.size(pieces) - filled + 1)
    return F.when(F.size(pieces) == 1, pieces).otherwise(
        F.slice(pieces, F.lit(1), kept.cast("int"))
    )


def words(text: Column) -> Column:
    """Space-separated words of a line."""
    return split_drop_trailing(text, " ")
