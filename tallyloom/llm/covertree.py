"""Embedding near-dedup by dual traversal of cover trees."""

from __future__ import annotations

import contextlib
import hashlib
import math
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import session, table
from tallyloom.operators.components import component_roots
from tallyloom.session import BROADCAST_LIMIT, bounded_broadcast, drop_staged, stage

# Points that a leaf node holds, and bytes of their vectors; larger nodes get children, so many.
LEAF = 16384
LEAF_BYTES = 4 << 20
FAN_OUT = 16
# Bytes of vectors in a bag, which is a row of leaf nodes. A task holds two bags.
BAG_BYTES = 8 << 20
# Bags that one job holds against all their partners.
BAGS_A_JOB = 32
# Points of a node inside a task that are compared outright, and the mean of a node's children
# below which opening it costs more than comparing all its points.
BUCKET = 256
CHILD = 32
# Points of either side in one block of products, and the share of hits from which it is dense.
BLOCK = 512
DENSE = 64
# Links that wait to be merged.
WAITING = 1 << 20
# Rows in an Arrow batch of single vectors.
BATCH = "1024"
# Rounding of distances between unit vectors in double precision, many times over.
SLACK = 1e-9


class Tree:
    """A cover tree over unit vectors: nested levels whose radii halve from one to the next.

    The children of a node are a net of its points: each point lies within the level's radius of
    its child's centre, and centres lie further than that apart. ``radius`` is the measured
    covering radius, never more than the level's. A node of few points has no children, nor has
    one whose net would have almost as many centres as points.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        # The first dimensions, and as one more the length of the rest.
        part = points.shape[1] // 2 if points.shape[1] >= 32 else points.shape[1]
        rest = np.sqrt(np.einsum("ij,ij->i", points[:, part:], points[:, part:]))
        self.short = np.column_stack([points[:, :part], rest]).astype(np.float32)
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[list[int]] = []
        if len(points):
            self._node(np.arange(len(points)), points[0], 2.0)

    def _node(self, members: np.ndarray, centre: np.ndarray, level: float) -> int:
        number = self._bucket(members, centre)
        # Skip the levels that would only repeat this node.
        while level / 2 >= self.radius[number] and level > 1e-6:
            level /= 2
        if len(members) > BUCKET and level > 1e-6:
            block, left, found = self.points[members], np.ones(len(members), bool), []
            while left.any():
                if len(found) > CHILD + (len(members) - np.count_nonzero(left)) // CHILD:
                    return number
                first = int(np.argmax(left))
                near = (2.0 - 2.0 * (block @ block[first]) <= (level / 2) ** 2) & left
                near[first] = True
                found.append((members[near], block[first]))
                left &= ~near
            # Children of one point each are one bucket: comparing them outright costs less.
            alone = [m for m, _ in found if len(m) == 1]
            for group, own in found:
                if len(group) > 1:
                    self.children[number].append(self._node(group, own, level / 2))
            for start in range(0, len(alone), BUCKET):
                group = np.concatenate(alone[start : start + BUCKET])
                self.children[number].append(self._bucket(group, self.points[group[0]]))
        return number

    def _bucket(self, members: np.ndarray, centre: np.ndarray) -> int:
        away = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.points[members] @ centre)))
        self.centre.append(centre)
        self.radius.append(float(away.max()) + SLACK)
        self.members.append(members)
        self.children.append([])
        return len(self.centre) - 1


def _near(a: Tree, left: list[int], b: Tree, right: list[int], reach: float) -> np.ndarray:
    """Which nodes ``left`` of one tree may hold a link to which nodes ``right`` of the other."""
    dots = np.stack([a.centre[i] for i in left]) @ np.stack([b.centre[j] for j in right]).T
    radii = np.add.outer([a.radius[i] for i in left], [b.radius[j] for j in right])
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots)) <= radii + reach


def _blocks(a: Tree, rows: np.ndarray, b: Tree, columns: np.ndarray, min_cosine: float, same: bool):
    """Blocks of two sets of points that hold a hit, with their hits; of one set, each pair once.

    A product over some dimensions plus the product of the lengths of the others is at least the
    whole one. In single precision it leaves few pairs of most blocks; their cosines are computed in
    double precision.
    """
    floor = np.float32(min_cosine - (a.short.shape[1] + 4) * 2.0**-22)
    above = np.ascontiguousarray(b.short[columns].T)
    shape = min(BLOCK, len(rows)), min(BLOCK, len(columns))
    products, near = np.empty(shape, np.float32), np.empty(shape, bool)
    for i in range(0, len(rows), BLOCK):
        left = rows[i : i + BLOCK]
        own = a.short[left]
        for j in range(i if same else 0, len(columns), BLOCK):
            right = columns[j : j + BLOCK]
            if (len(left), len(right)) != shape:
                near = own @ above[:, j : j + BLOCK] >= floor
            else:
                if near.shape != shape:
                    near = np.empty(shape, bool)
                np.matmul(own, above[:, j : j + BLOCK], out=products)
                np.greater_equal(products, floor, out=near)
            n = np.count_nonzero(near)
            if not n:
                continue
            if n > near.size // DENSE:
                hits = a.points[left] @ b.points[right].T >= min_cosine
            else:
                x, y = np.divmod(np.flatnonzero(near), near.shape[1])
                exact = np.einsum("ij,ij->i", a.points[left[x]], b.points[right[y]])
                hits = np.zeros(near.shape, bool)
                hits[x, y] = exact >= min_cosine
            if same:
                hits &= left[:, None] < right[None, :]
            if hits.any():
                yield left, right, hits


def traverse(a: Tree, b: Tree, min_cosine: float):
    """Blocks ``rows of a, rows of b, hits`` of the points that survive the pruning.

    Both trees are walked at once. A pair of nodes is dropped when their centres lie further apart
    than both covering radii and the threshold's distance together; else the one with the larger
    radius is opened. If ``a is b``, each pair of different points comes once.
    """
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * min_cosine)) + SLACK
    waiting = []
    if len(a.points) and len(b.points) and _near(a, [0], b, [0], reach)[0, 0]:
        waiting.append((0, 0))
    while waiting:
        i, j = waiting.pop()
        inner, outer = a.children[i], b.children[j]
        if a is b and i == j:
            if inner:
                x, y = np.nonzero(np.triu(_near(a, inner, b, inner, reach)))
                waiting += [(inner[k], inner[m]) for k, m in zip(x, y)]
                continue
        elif inner and (not outer or a.radius[i] >= b.radius[j]):
            waiting += [(inner[k], j) for k in np.flatnonzero(_near(a, inner, b, [j], reach))]
            continue
        elif outer:
            waiting += [(i, outer[k]) for k in np.flatnonzero(_near(a, [i], b, outer, reach))]
            continue
        yield from _blocks(a, a.members[i], b, b.members[j], min_cosine, a is b and i == j)


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked members the least label among them, in place."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(labels[labels], labels):
            labels[:] = labels[labels]


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows with their greatest component at one, so that no square overflows or vanishes."""
    with np.errstate(all="ignore"):
        return matrix / np.abs(matrix).max(axis=1, initial=0.0)[:, None] + 0.0


def _units(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    scaled = _scaled(matrix.astype(np.float64))
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _matrices(column: pa.Array, dtype: type):
    """``row numbers, matrix`` of a column of packed vectors, one for each length."""
    held = [np.frombuffer(v.as_buffer(), dtype) for v in column]
    lengths = np.array([len(v) for v in held])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, np.vstack([held[r] for r in rows])


def _packed(dtype: type):
    """``key, label, vector`` to ``key, label, size, digest, raw``, all but the first two null for a
    vector without direction. Equal digests are equal directions; ``raw`` is the vector as given."""

    def pack(batches):
        for batch in batches:
            vectors = batch.column(2)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(dtype)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
            sizes, digests, raw = ([None] * len(lengths) for _ in range(3))
            for length in np.unique(lengths[lengths > 0]):
                rows = np.flatnonzero(lengths == length)
                given = flat[starts[rows][:, None] + np.arange(length)]
                double = given.astype(np.float64)
                sound = np.isfinite(double).all(axis=1) & double.any(axis=1)
                rows, given = rows[sound], given[sound]
                for row, own, scaled in zip(rows, given, _scaled(double[sound])):
                    sizes[row] = int(length)
                    digests[row] = hashlib.blake2b(scaled, digest_size=16).digest()
                    raw[row] = own.tobytes()
            columns = [pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], ["key", "label", "size", "digest", "raw"]
            )

    return pack


@contextlib.contextmanager
def _settings(spark: SparkSession, **values: str):
    """Session settings for what is planned and run inside."""
    names = {
        "batch": "spark.sql.execution.arrow.maxRecordsPerBatch",
        "split": "spark.sql.files.maxPartitionBytes",
        "opening": "spark.sql.files.openCostInBytes",
    }
    before = {names[k]: spark.conf.get(names[k]) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(names[k], v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


SMALL = {
    "share": pa.float64(),
    "radius": pa.float64(),
    "centre": pa.list_(pa.float64()),
}


def _small(spark: SparkSession, **columns) -> DataFrame:
    """A table of what the driver knows; columns are longs unless ``SMALL`` names them."""
    return spark.createDataFrame(
        pa.table({n: pa.array(list(v), SMALL.get(n, pa.int64())) for n, v in columns.items()})
    )


def _child(cell: int, number: int, level: int) -> int:
    text = f"{cell},{number},{level}".encode()
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _nearest(centres: dict, level: int, dtype: type):
    """Moves each point to the child whose centre is nearest, ``centres`` being matrices by cell."""

    def assign(batches):
        for batch in batches:
            names = batch.schema.names
            cells = batch.column(names.index("cell")).to_numpy(zero_copy_only=False).copy()
            away = batch.column(names.index("away")).to_numpy(zero_copy_only=False).copy()
            for rows, matrix in _matrices(batch.column(names.index("raw")), dtype):
                units, own = _units(matrix), cells[rows]
                order = np.argsort(own, kind="stable")
                bounds = np.flatnonzero(np.diff(own[order], prepend=own[order[0]] - 1))
                for part in np.split(order, bounds[1:]):
                    cell = int(own[part[0]])
                    dots = units[part] @ centres[cell].T
                    best = np.argmax(dots, axis=1)
                    children = np.array([_child(cell, k, level) for k in range(dots.shape[1])])
                    cells[rows[part]] = children[best]
                    least = np.maximum(0.0, 2.0 - 2.0 * dots[np.arange(len(part)), best])
                    away[rows[part]] = np.sqrt(least)
            columns = {"cell": pa.array(cells), "away": pa.array(away)}
            yield pa.RecordBatch.from_arrays(
                [columns.get(n, batch.column(k)) for k, n in enumerate(names)], names
            )

    return assign


def grow_top(points: DataFrame, width: int, leaf: int = LEAF) -> tuple[list, dict, int]:
    """The upper levels of the trees.

    ``points`` are staged: ``node, root, copies, size, raw, cell, away``. The first ``cell`` is the
    group's ``root``, with all points 2 ``away`` from its centre at most. Returns staged tables of
    the points with their leaf nodes, for which ``points`` are dropped if one was split; the nodes of groups of more than one leaf, ``cell: (parent, centre, radius,
    bytes)``, no bytes for inner ones; and the bytes of all other groups.

    Every round splits all nodes of more than ``leaf`` points at once: a hash threshold picks up to
    about ``FAN_OUT`` of a node's points as centres, the others join the nearest, and the covering
    radius is measured. Sizes are grouped map-side first and a node of any size is split by many
    tasks; only large nodes' sizes and centres, about one point in a thousand, come to the driver,
    and no more than ``BROADCAST_LIMIT`` of centres are sent out at once. Vectors are not shuffled.
    A node whose points no round could part (fewer than two were picked) is tried again with other
    hashes.
    """
    spark, dtype = points.sparkSession, np.float32 if width == 4 else np.float64
    columns = ["node", "root", "copies", "size", "raw", "cell", "away"]
    tables, nodes, others = [], {}, 0
    current = [points]
    for level in range(60):
        together = reduce(DataFrame.unionByName, current)
        sizes = together.groupBy("cell").agg(
            F.count("*").alias("n"), F.max("away").alias("radius"), F.max("size").alias("size")
        )
        sizes = stage(sizes.withColumn("bytes", F.col("n") * F.col("size") * width), "tree-sizes")
        full = F.greatest(F.col("n") / leaf, F.col("bytes") / LEAF_BYTES)
        large = sizes.filter(full > 1).withColumn("full", full)
        if level:
            for cell, radius, held in sizes.select("cell", "radius", "bytes").toLocalIterator():
                nodes[cell] = (*nodes[cell][:2], radius + SLACK, held)
        else:
            others = sizes.filter(full <= 1).agg(F.sum("bytes")).first()[0] or 0
        large = large.select("cell", "n", "size", "full").collect()
        for row in large:
            parent, centre, radius, _ = nodes.get(row.cell, (None, None, 2.0, 0))
            nodes[row.cell] = (parent, centre, radius, 0)  # no bytes of its own
        if not large:
            return [*tables, *current], nodes, others
        asked = {r.cell: min(FAN_OUT, max(8, math.ceil(4 * r.full))) / r.n for r in large}
        shares = F.broadcast(_small(spark, cell=asked.keys(), share=asked.values()))
        if len(large) < sizes.count():
            rest = together.join(shares.select("cell"), "cell", "left_anti").select(*columns)
            tables.append(stage(rest, "tree-leaves"))
        step = max(1, BROADCAST_LIMIT // (2 * FAN_OUT * 8 * max(r["size"] for r in large)))
        following = []
        for start in range(0, len(asked), step):
            part = dict(list(asked.items())[start : start + step])
            crowd = together.join(F.broadcast(_small(spark, cell=part.keys(), share=part.values())), "cell")
            draw = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1 << 30)) / float(1 << 30)
            picked = defaultdict(list)
            for row in crowd.filter(draw < F.col("share")).select("cell", "node", "raw").collect():
                picked[row.cell].append((row.node, bytes(row.raw)))
            centres = {}
            for cell, found in picked.items():
                if len(found) > 1:
                    centres[cell] = _units(np.vstack([np.frombuffer(v, dtype) for _, v in sorted(found)]))
                    for k, centre in enumerate(centres[cell]):
                        nodes[_child(cell, k, level)] = (cell, centre, 0.0, 0)
            tried = F.broadcast(_small(spark, cell=centres.keys()))
            still = crowd.join(tried, "cell", "left_anti").select(*columns)
            moved = crowd.join(tried, "cell", "left_semi").select(*columns)
            with _settings(spark, batch=BATCH):
                following.append(stage(moved.mapInArrow(_nearest(centres, level, dtype), moved.schema), "tree-points"))
            if len(centres) < len(part):
                following.append(stage(still, "tree-points"))
        for t in current:
            drop_staged(t)
        current = following
    raise RuntimeError("vectors could not be parted; choose a larger leaf")


def surviving_pairs(nodes: DataFrame, min_cosine: float) -> DataFrame:
    """``x, y`` (x <= y): pairs of leaf nodes that pruning by covering radii leaves.

    Starts with each root and itself; every round opens all pairs by one level on both sides.
    """
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * min_cosine)) + SLACK
    children = nodes.filter("parent is not null").select(
        F.col("parent").alias("up"), "cell", "centre", "radius"
    )
    inner = stage(children.select(F.col("up").alias("inner")).distinct(), "tree-inner")
    # A leaf stands for its own child, so that both sides always go one level down.
    leaves = nodes.join(inner, F.col("cell") == F.col("inner"), "left_anti").select(
        F.col("cell").alias("up"), "cell", "centre", "radius"
    )
    down = stage(children.unionByName(leaves), "tree-down")
    pairs = stage(
        nodes.filter("parent is null").select(F.col("cell").alias("x"), F.col("cell").alias("y")),
        "tree-pairs",
    )
    while True:
        open_x = pairs.join(inner.withColumnRenamed("inner", "x"), "x", "left_semi")
        open_y = pairs.join(inner.withColumnRenamed("inner", "y"), "y", "left_semi")
        if open_x.isEmpty() and open_y.isEmpty():
            return pairs
        left, right = (
            down.select(
                F.col("up").alias(side),
                *[F.col(c).alias(f"{side}_{c}") for c in ("cell", "centre", "radius")],
            )
            for side in ("x", "y")
        )
        both = pairs.join(bounded_broadcast(left), "x").join(bounded_broadcast(right), "y")
        products = F.zip_with("x_centre", "y_centre", lambda a, b: a * b)
        dot = F.aggregate(products, F.lit(0.0), lambda s, v: s + v)
        apart = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * dot))
        # Roots have no centre and are opened whatever lies in them.
        near = apart <= F.col("x_radius") + F.col("y_radius") + reach + SLACK
        low, high = F.least("x_cell", "y_cell"), F.greatest("x_cell", "y_cell")
        pairs = stage(
            both.filter(F.coalesce(near, F.lit(True)))
            .select(low.alias("x"), high.alias("y"))
            .distinct(),
            "tree-pairs",
        )


def _node_table(spark: SparkSession, nodes: dict) -> DataFrame:
    parent, centre, radius, _ = zip(*nodes.values())
    made = _small(spark, cell=nodes, parent=parent, centre=centre, radius=radius)
    return stage(made, "tree-nodes")


def _bags_of(nodes: dict) -> dict[int, int]:
    """The bag of each leaf node: leaves in the order of the trees, up to ``BAG_BYTES`` together."""
    below = defaultdict(list)
    for cell, node in nodes.items():
        below[node[0]].append(cell)
    bags, bag, held = {}, 0, 0
    waiting = sorted(below[None], reverse=True)
    while waiting:
        cell = waiting.pop()
        if cell in below:
            waiting += sorted(below[cell], reverse=True)
            continue
        if held and held + nodes[cell][3] > BAG_BYTES:
            bag, held = bag + 1, 0
        bags[cell] = bag
        held += nodes[cell][3]
    return bags


BAG = "leaves binary, nodes binary, copies binary, raw binary, bag long"


def _pack_bag(points: pa.Table) -> pa.Table:
    """One row of a bag's points, leaf node by leaf node, the points next to its centre first."""
    held = {n: points[n].to_numpy() for n in ("root", "cell", "away", "node", "copies", "size")}
    order = np.lexsort((held["node"], held["away"], held["cell"], held["root"]))
    held = {n: v[order] for n, v in held.items()}
    raw = [v.as_py() for v in points["raw"].combine_chunks().take(pa.array(order))]
    new = np.flatnonzero((np.diff(held["cell"]) != 0) | (np.diff(held["root"]) != 0)) + 1
    starts = np.concatenate([[0], new])
    counts = np.diff(np.concatenate([starts, [len(order)]]))
    leaves = np.stack([held["root"][starts], counts, held["size"][starts]], axis=1).astype(np.int64)
    return pa.table(
        {
            "leaves": pa.array([leaves.tobytes()], pa.binary()),
            "nodes": pa.array([held["node"].astype(np.int64).tobytes()], pa.binary()),
            "copies": pa.array([held["copies"].astype(np.int64).tobytes()], pa.binary()),
            "raw": pa.array([b"".join(raw)], pa.binary()),
            "bag": pa.array([points["bag"][0].as_py()], pa.int64()),
        }
    )


class _Bag:
    """A bag's leaf nodes by group; trees are built when they are asked for."""

    def __init__(self, leaves, nodes, copies, raw, dtype: type):
        self.nodes = np.frombuffer(nodes, np.int64)
        self.copies = np.frombuffer(copies, np.int64)
        self.raw = np.frombuffer(raw, dtype)
        self.groups: dict[int, list[tuple]] = defaultdict(list)
        self.trees: dict[int, Tree] = {}
        held = np.frombuffer(leaves, np.int64).reshape(-1, 3)
        # Units of all leaves at once if they have one length.
        self.units = None
        if len(np.unique(held[:, 2])) == 1:
            self.units = _units(self.raw.reshape(-1, held[0, 2]))
        start = at = 0
        for root, count, size in held.tolist():
            self.groups[root].append((start, count, at, size))
            start, at = start + count, at + count * size

    def points(self, leaf: tuple) -> np.ndarray:
        start, count, at, size = leaf
        if self.units is not None:
            return self.units[start : start + count]
        return _units(self.raw[at : at + count * size].reshape(count, size))

    def tree(self, leaf: tuple) -> Tree:
        if leaf[0] not in self.trees:
            self.trees[leaf[0]] = Tree(self.points(leaf))
        return self.trees[leaf[0]]

    def blocks(self, leaf: tuple, other: _Bag, its: tuple, min_cosine: float):
        """Rows of a leaf of this bag, of one of another, and their hits."""
        if leaf[1] > BUCKET or its[1] > BUCKET:
            yield from traverse(self.tree(leaf), other.tree(its), min_cosine)
            return
        hits = self.points(leaf) @ other.points(its).T >= min_cosine
        if self is other and leaf is its:
            hits = np.triu(hits, 1)
        yield np.arange(leaf[1]), np.arange(its[1]), hits


def _compared(a: _Bag, b: _Bag, min_cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two bags: per point its number of links, and a link to another of its component."""
    same = a is b
    node = a.nodes if same else np.concatenate([a.nodes, b.nodes])
    copies = a.copies if same else np.concatenate([a.copies, b.copies])
    shift = 0 if same else len(a.nodes)
    labels, counts = np.arange(len(node)), np.zeros(len(node), np.int64)
    links, n_links = [], 0
    for root in a.groups.keys() & b.groups.keys():
        left, right = a.groups[root], b.groups[root]
        if same and len(left) == 1 and left[0][1] == 1:
            continue
        for k, x in enumerate(left):
            for y in left[k:] if same else right:
                for rows, columns, hits in a.blocks(x, b, y, min_cosine):
                    rows, columns = rows + x[0], columns + (y[0] + shift)
                    n = np.count_nonzero(hits)
                    if not n:
                        continue
                    if n > BLOCK and n > hits.size // DENSE:
                        counts[rows] += hits @ copies[columns]
                        counts[columns] += copies[rows] @ hits
                        # Most dense blocks lie in a component that earlier ones have joined.
                        p, q = labels[rows[hits.any(axis=1)]], labels[columns[hits.any(axis=0)]]
                        if (p == p[0]).all() and (q == p[0]).all():
                            continue
                        i, j = np.nonzero(hits)
                        _merge(labels, rows[i], columns[j])
                        continue
                    i, j = np.nonzero(hits)
                    i, j = rows[i], columns[j]
                    np.add.at(counts, i, copies[j])
                    np.add.at(counts, j, copies[i])
                    differ = labels[i] != labels[j]
                    links.append((i[differ], j[differ]))
                    n_links += len(links[-1][0])
                    if n_links > WAITING:
                        _merge(labels, *map(np.concatenate, zip(*links)))
                        links, n_links = [], 0
    if links:
        _merge(labels, *map(np.concatenate, zip(*links)))
    touched = np.flatnonzero(counts)
    return node[touched], node[labels[touched]], counts[touched]


def _compare(min_cosine: float, dtype: type):
    """Rows of one bag (``x_``), held against itself, or of two to ``a, b, n``; see ``_compared``."""

    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                value = {n: batch.column(k)[row] for k, n in enumerate(batch.schema.names)}
                sides = [
                    _Bag(*(value[side + n].as_buffer() for n in ("leaves", "nodes", "copies", "raw")), dtype)
                    for side in ("x_", "y_")
                    if f"{side}bag" in value
                ]
                found = _compared(sides[0], sides[-1], min_cosine)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], ["a", "b", "n"])

    return compare


def _links_of(bags: DataFrame, partners: dict[int, list[int]], min_cosine: float, dtype: type) -> DataFrame:
    """``a, b, n`` of each bag and of all pairs of different bags in ``partners``.

    A task reads both bags of a pair from the written table, so no vector is shuffled, however many
    partners its bag has: a bag and each of its partners are one partition of a cartesian product.
    """
    one_file = str(2 * BAG_BYTES)
    left, right = (bags.select(*[F.col(n).alias(side + n) for n in bags.columns]) for side in ("x_", "y_"))
    jobs, todo = [left], sorted(partners)
    for start in range(0, len(todo), BAGS_A_JOB):
        pairs = [
            right.filter(F.col("y_bag").isin(partners[bag])).crossJoin(
                left.filter(F.col("x_bag") == bag).hint("shuffle_replicate_nl")
            )
            for bag in todo[start : start + BAGS_A_JOB]
        ]
        jobs.append(reduce(DataFrame.unionByName, pairs))
    found = []
    with _settings(bags.sparkSession, batch="1", split=one_file, opening=one_file):
        for job in jobs:
            links = job.mapInArrow(_compare(min_cosine, dtype), "a long, b long, n long")
            found.append(stage(links, "vector-links"))
    return reduce(DataFrame.unionByName, found)


def link_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    group: str = "label",
    min_cosine: float = 0.93,
    leaf: int = LEAF,
) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Two vectors of one group (and one length) are linked if their cosine in double precision is at
    least ``min_cosine``. All such pairs are found: the covering radii only prune pairs of nodes
    that cannot hold one. Equal vectors are one point with a number of copies, so they are never
    paired; the pairs themselves are counted inside the tasks and leave them as one link per point.

    Vectors are written as they are given and shuffled once, to put leaf nodes together, some of
    which make a bag, a row of a table. Tasks read pairs of bags from it.

    A vector that is null, empty, zero or holds null or non-finite components, and one whose group
    is null, links with nothing: no links, itself its component, kept. ``component_id`` is the least
    key reachable by links, ``kept`` marks it. Repeated rows count as vectors of their own.
    """
    spark = vectors.sparkSession
    single = vectors.schema[vector].dataType
    single = isinstance(single, T.ArrayType) and isinstance(single.elementType, T.FloatType)
    width, dtype = (4, np.float32) if single else (8, np.float64)
    usable = F.col("label").isNotNull() & F.col("key").isNotNull()
    rows = vectors.select(
        F.col(key).alias("key"),
        F.col(group).cast("string").alias("label"),
        F.col(vector).cast("array<float>" if single else "array<double>").alias("v"),
    ).withColumn("v", F.when(usable, F.col("v")))
    made = {"size": T.IntegerType(), "digest": T.BinaryType(), "raw": T.BinaryType()}
    kind = T.StructType([*rows.schema.fields[:2], *(T.StructField(n, t) for n, t in made.items())])
    root = F.xxhash64("label", "size")
    with _settings(spark, batch=BATCH):
        marked = rows.mapInArrow(_packed(dtype), kind)
        node = F.when(F.col("size").isNotNull(), F.xxhash64("label", "size", "digest"))
        marked = marked.select("key", root.alias("root"), node.alias("node"), "size", "raw")
        marked = stage(marked.withColumn("row", F.monotonically_increasing_id()), "vectors")
    keys = stage(marked.select("key", "node"), "vector-keys")
    sound = marked.filter("node is not null")
    heads = sound.groupBy("node").agg(
        F.min("key").alias("least"), F.count("*").alias("copies"), F.min("row").alias("first")
    )
    heads = stage(heads, "vector-heads")
    # Only vectors that occur again are looked up, so that others need not be shuffled.
    again = heads.filter("copies > 1").select("node", "copies", "first")
    points = (
        sound.join(bounded_broadcast(again), "node", "left")
        .filter("first is null or first = row")
        .select(
            "node",
            "root",
            F.coalesce("copies", F.lit(1)).alias("copies"),
            "size",
            "raw",
            F.col("root").alias("cell"),
            F.lit(2.0).alias("away"),
        )
    )
    points = stage(points, "vector-points")
    drop_staged(marked)

    placed, nodes, others = grow_top(points, width, leaf)
    bag_of = _bags_of(nodes)
    split = len(set(bag_of.values()))
    small = max(1, math.ceil(2 * others / BAG_BYTES))
    chosen = stage(_small(spark, cell=bag_of.keys(), bag=bag_of.values()), "tree-bags")
    # A group of one leaf meets no other: any bag will do.
    whole = F.lit(split) + F.pmod("cell", F.lit(small))
    bags = stage(
        reduce(DataFrame.unionByName, placed)
        .join(bounded_broadcast(chosen), "cell", "left")
        .withColumn("bag", F.coalesce("bag", whole))
        .groupBy("bag")
        .applyInArrow(_pack_bag, BAG),
        "vector-bags",
        by="bag",
    )
    for used in placed:
        drop_staged(used)
    partners = defaultdict(list)
    if nodes:
        pairs = surviving_pairs(_node_table(spark, nodes), min_cosine)
        left, right = (
            bounded_broadcast(chosen.select(F.col("cell").alias(s), F.col("bag").alias(f"{s}_bag")))
            for s in ("x", "y")
        )
        low, high = F.least("x_bag", "y_bag"), F.greatest("x_bag", "y_bag")
        met = pairs.join(left, "x").join(right, "y").select(low.alias("x"), high.alias("y"))
        for x, y in met.filter("x <> y").distinct().collect():
            partners[x].append(y)
    found = _links_of(bags, partners, min_cosine, dtype)

    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = component_roots(found.filter("a <> b").select("a", "b"))
    # Nodes are hashes of group and vector, since one key may stand at several vectors.
    linked = counts.join(roots, "node").join(heads.select("node", "least"), "node")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").select("node", "n", "component_id")
    known = heads.join(linked, "node", "left").select(
        "node",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    return keys.join(known, "node", "left").select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "key").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("key"), F.lit(True)).alias("kept"),
    )


def op1_covertree(spark, sf_dir):
    """Links and components of all embeddings with equal labels."""
    return link_vectors(table(session(spark), sf_dir, "embeddings"))
