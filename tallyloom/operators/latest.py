"""Latest rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import bounded_broadcast, stage


def latest_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """All rows that carry the greatest ``order`` value of their key; ties stay.

    Rows with a null in a key column match no maximum and drop out, as in a join on the key.
    The maxima come from a map-side combined grouping and are written once. A set of maxima within
    the broadcast limit turns the second pass into a filter without a shuffle; a larger one is
    joined on key *and* order value, which spreads a frequent key over many partitions and leaves
    exact copies to the adaptive skew join. A window would sort each key's rows in one task.
    """
    newest = df.groupBy(*keys).agg(F.max(order).alias(order))
    newest = stage(newest, "newest")
    return df.join(bounded_broadcast(newest), [*keys, order], "left_semi")
