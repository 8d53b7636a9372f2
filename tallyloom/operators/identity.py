"""Identity that is kept: which identifiers belong together, over all batches so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.components import component_roots
from tallyloom.session import scratch_scope, stage
from tallyloom.sources.keyed import KeyedTable


class Identities:
    """A keyed table ``node, root`` of identifiers and the least identifier each is linked with.

    A batch of links is contracted first: an identifier that is known stands for its root. Only
    the contracted links are searched for components, and only rows of new identifiers and of roots
    that were joined are written. Any split of the links into batches, in any order, gives the
    table that one batch of all links gives.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, buckets: int | None = None):
        self.table = KeyedTable(
            spark, name, "node string, root string", folder, key="node", buckets=buckets,
            indexes=("root",),
        )

    def read(self) -> DataFrame:
        return self.table.read()

    def absorb(self, links: DataFrame) -> DataFrame:
        """Add links ``a, b``. A link of an identifier with itself makes it known; null ones link
        nothing."""
        with scratch_scope(self.table.spark):
            links = links.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct()
            links = stage(links, "batch-links")
            nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            known = stage(self.table.with_keys(stage(nodes, "batch-nodes")), "known-nodes")
            heads = {
                c: known.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
                for c in ("a", "b")
            }
            contracted = (
                links.join(heads["a"], "a", "left")
                .join(heads["b"], "b", "left")
                .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
            )
            roots = component_roots(contracted)
            joined = stage(roots.filter("node != root").withColumnsRenamed(
                {"node": "old", "root": "new"}), "joined-roots")
            fresh = roots.join(known.select("root").distinct().toDF("node"), "node", "left_anti")
            fresh = fresh.select("node", "root")
            members = self.table.matching("root", joined.select(F.col("old").alias("root")))
            moved = members.join(joined, members.root == joined.old).select(
                "node", F.col("new").alias("root")
            )
            # A node has one root, and is either new or stored.
            return self.table.upsert(fresh.unionByName(moved), unique=True)
