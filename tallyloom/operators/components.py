"""Connected components of an edge table, without collecting any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import drop_staged, stage


def _least_around(edges: DataFrame) -> DataFrame:
    """The least node among each ``u`` and its neighbours, by a map-side combined grouping."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every greater neighbour of a node on the least node around it.

    The join back has one row per node on its other side, so a node with very many neighbours is
    split by the adaptive skew join.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_least_around(both), "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    least = _least_around(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter(F.col("u") > F.col("v")).distinct()


def _summary(edges: DataFrame) -> tuple:
    """What two equal edge tables have in common, and practically no others: one aggregation."""
    h = F.xxhash64("u", "v")
    found = edges.agg(
        F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 24)).alias("s")
    ).first()
    return tuple(found)


def component_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an undirected edge table ``a, b`` (flat, comparable ids).

    The root is the least node of the component and is its own root. Alternates the large-star and
    small-star steps of Kiveris et al. (2014), which need a number of rounds logarithmic in the
    component size in practice, until a round changes nothing, that is, until the edges form stars.
    The input is computed once, each round is one written table, and superseded ones are deleted.
    """
    given = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    current, summary = None, None
    while True:
        start = given.filter(F.col("u") != F.col("v")) if current is None else current
        following = stage(_small_star(_large_star(start)), "edges")
        if current is not None:
            drop_staged(current)
        current, before, summary = following, summary, _summary(following)
        if summary == before or summary[0] == 0:
            break
    nodes = given.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    parents = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stage(
        nodes.join(parents, "node", "left").select(
            "node", F.coalesce("root", "node").alias("root")
        ),
        "roots",
    )
    drop_staged(given)
    drop_staged(current)
    return roots
