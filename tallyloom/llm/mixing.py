"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, hash60, session, table, word_count
from tallyloom.session import bounded_broadcast, drop_staged, stage

HASH_BITS = 60
LEVEL_BITS = 12

_ADDED = ("size", "source_size", "target", "repeats")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    The sources, in code point order with null last, take the weights in turn and share all sizes;
    a target stops at ``cap`` times its source's size and the excess is shared again by weight.
    That is one water level: in the order of cap / weight, the sources up to some place are full
    and the others get level * weight. Works on one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]),
        ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"),
    )
    ranked = sizes.select(
        "source", "source_size", weight.alias("w"), (F.col("source_size") * cap).alias("limit")
    )
    filling = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = ranked.select(
        "*",
        F.coalesce(F.sum("limit").over(before), F.lit(0)).alias("full"),
        F.sum("w").over(onward).alias("open_w"),
        F.sum("source_size").over(everything).alias("total"),
    ).withColumn(
        "is_open",
        (F.col("total") - F.col("full")) * F.col("w") < F.col("limit") * F.col("open_w"),
    )
    # The first source that does not fill up fixes the level for itself and all later ones.
    place = F.struct((-F.col("limit") / F.col("w")).alias("k"), "full", "open_w")
    seen = F.max(F.when(F.col("is_open"), place)).over(
        filling.rowsBetween(Window.unboundedPreceding, 0)
    )
    return levels.withColumn("level", seen).select(
        "source",
        "source_size",
        F.when(F.col("level").isNull(), F.col("limit").cast("double"))
        .otherwise(
            ((F.col("total") - F.col("level.full")) * F.col("w")).cast("double")
            / F.col("level.open_w")
        )
        .alias("target"),
    )


def _refined(rows: DataFrame, state: DataFrame, shift: int, last: bool) -> DataFrame:
    """One level: within the boundary bucket of each source, the sub-bucket that crosses the budget.

    ``state`` has per source the boundary bucket so far (``prefix``, null once everything fits) and
    the budget left inside it. The histogram has at most 2^LEVEL_BITS rows per source.
    """
    parent = F.shiftright("h", shift + LEVEL_BITS)
    inside = rows.join(
        bounded_broadcast(state.filter(F.col("prefix").isNotNull())),
        rows["source"].eqNullSafe(state["source"]) & (parent == state["prefix"]),
    ).select(rows["source"], F.shiftright("h", shift).alias("bucket"), "size", "rest")
    histogram = inside.groupBy("source", "bucket").agg(
        F.sum("size").alias("size"), F.first("rest").alias("rest")
    )
    upto = Window.partitionBy("source").orderBy("bucket")
    summed = histogram.withColumn("upto", F.sum("size").over(upto))
    below = F.col("upto") - F.col("size")
    # The last level's buckets are single hash values: taken where that comes nearer the budget.
    over = (below + F.col("upto") > 2 * F.col("rest")) if last else F.col("upto") > F.col("rest")
    found = (
        summed.filter(over)
        .groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("rest") - below).alias("rest"))).alias("m"))
        .select(F.col("source").alias("s"), F.col("m.bucket").alias("b"), F.col("m.rest").alias("r"))
    )
    return state.join(F.broadcast(found), state["source"].eqNullSafe(found["s"]), "left").select(
        "source",
        "source_size",
        "target",
        "fills",
        F.when(F.col("prefix").isNotNull(), F.col("b")).alias("prefix"),
        F.coalesce("r", F.lit(0.0)).alias("rest"),
        # Where everything in the boundary bucket fits after all, the bucket's end is the threshold.
        F.when(F.col("prefix").isNull(), F.col("ends"))
        .when(F.col("b").isNull(), F.shiftleft(F.col("prefix") + 1, shift + LEVEL_BITS))
        .alias("ends"),
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    seed: str = "mix",
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Input rows with ``size, source_size, target, repeats`` (how often the mix takes the row).

    Every document is taken ``floor(target / source_size)`` times; what is left of the budget goes
    to the documents whose hash of the key lies below the source's threshold. The threshold is
    found by histograms of size over hash buckets, five nested levels of 12 bits, refining the one
    bucket per source where the budget ends, so nothing is sorted and a source that holds most
    rows is summed map-side like any other. Each source misses its target by at most half of one
    document (or of the rows that share one key). Runs agree, because hashes depend on keys alone.

    Null texts and texts without a word have size 0; a source without words has target 0 and is
    taken 0 times. Null keys share one hash, and so do repeated keys: they are taken or left
    together. Null is a source of its own. Columns of the input named like the added ones are
    replaced. An empty input gives an empty result.
    """
    added = _ADDED
    base = docs.drop(*added)
    sized = base.withColumn("size", word_count(F.col(text)))
    h = hash60(F.col(key), seed)
    rows = stage(
        sized.select(F.col(source).cast("string").alias("source"), h.alias("h"), "size"), "mix-sizes"
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    fills = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    state = stage(
        source_targets(sizes, weights, cap)
        .withColumn("fills", F.coalesce(fills, F.lit(0)))
        .select(
            "*",
            F.lit(0).cast("long").alias("prefix"),
            (F.col("target") - F.col("fills") * F.col("source_size")).alias("rest"),
            F.lit(None).cast("long").alias("ends"),
        ),
        "mix-state",
    )
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        following = stage(_refined(rows, state, shift, shift == 0), "mix-state")
        drop_staged(state)
        state = following
    drop_staged(rows)
    own, place, fills, ends = (
        free_name([*base.columns, *added], n) for n in ("_source", "_h", "_fills", "_ends")
    )
    bounds = state.select(
        F.col("source").alias(own),
        "source_size",
        "target",
        F.col("fills").alias(fills),
        F.when(F.col("target") == 0, 0).otherwise(F.coalesce("prefix", "ends")).alias(ends),
    )
    return (
        sized.withColumn(place, h)
        .join(bounded_broadcast(bounds), F.col(source).cast("string").eqNullSafe(F.col(own)))
        .withColumn("repeats", F.col(fills) + (F.col(place) < F.col(ends)).cast("long"))
        .select(*base.columns, *added)
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as ``mix_sources`` takes it, with the input's columns."""
    # Columns that the operator would replace pass it under another name.
    safe = {c: f"given_{i}" for i, c in enumerate(docs.columns) if c in _ADDED}
    mixed = mix_sources(docs.withColumnsRenamed(safe), **options)
    copy = free_name(mixed.columns, "_copy")
    again = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
    return (
        mixed.filter(F.col("repeats") > 0)
        .withColumn(copy, again)
        .select(*[F.col(safe.get(c, c)).alias(c) for c in docs.columns])
    )


def op9_mixing(spark, sf_dir):
    """All documents mixed to the weights 5, 2, 1 under a cap of three times a source's size."""
    docs = table(session(spark), sf_dir, "documents")
    return mix_sources(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS lim,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, lim / w AS ratio,
         CAST(coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS full_,
         CAST(sum(w) OVER (ORDER BY lim / w, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_w
  FROM sources),
level AS (
  SELECT full_ AS lf, open_w AS lw, ratio AS lr FROM filled
  WHERE (total - full_) * w < lim * open_w ORDER BY ratio, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN lr IS NULL OR ratio < lr THEN CAST(lim AS DOUBLE)
              ELSE CAST((total - lf) * w AS DOUBLE) / lw END AS target
  FROM filled LEFT JOIN level ON true),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS fills
  FROM targets),
placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.fills,
         b.target - b.fills * b.source_size AS rest,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS BIGINT) AS upto,
         CAST(sum(s.size) OVER (PARTITION BY s.source, s.h) AS BIGINT) AS own
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (fills + CASE WHEN upto + upto - own > 2 * rest THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM placed
"""
