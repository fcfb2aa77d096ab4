"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most
tau = sqrt(2 - 2c). Vectors are classes of equal components first, so copies
cost one row. The top level of the cover is made in Spark: every class goes to
its nearest pivot among those of its dimension, and two nodes whose pivots lie
further apart than the sum of their covering radii and tau are never compared.
Nodes are cut into blocks. Each block gets its cover tree of nested levels with
halving radii once and is stored once, in a file of the shared folder. Each pair
of blocks that may meet is one cell, a short row that says where its two blocks
lie; so what is shuffled and written grows with the vectors and not with the
cells, and a task reads the blocks of its cells as it comes to them. In a cell
node pairs are followed down both trees and pruned by the same bound with their
own covering radii, and what reaches the leaves is compared by cosine in double
precision. Single precision is used where a margin above its rounding only opens
more pairs.

A cell gives back link counts per vector and a spanning forest of its links,
never the pairs themselves. Vectors without structure cannot be pruned above
the leaves: then the number of cells grows with the square of the number of
different vectors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.chat import rows_of
from courierlens.llm.common import connected, new_path, written
from courierlens.llm.warc import open_folder


@dataclass(frozen=True)
class CoverParams:
    """``most_pivots`` bounds what is sampled for the top level; every vector is compared whatever it is.

    A block has at most about ``block`` vectors and ``block_bytes`` of components;
    a node of at most ``leaf_size`` vectors, or of a small radius, is a leaf.
    """

    cosine: float = 0.9
    block: int = 3072
    block_bytes: int = 8 << 20
    most_pivots: int = 1024
    leaf_radius: float = 0.25
    leaf_size: int = 8

    @property
    def tau(self) -> float:
        # the margin is far above the rounding of distances, and only opens more pairs
        return float(np.sqrt(2 - 2 * self.cosine)) + 1e-6


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, scaled first so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


@dataclass
class Tree:
    """A cover tree over rows that are ordered so that every node holds a run of them.

    Node n is a ball of ``radius[n]`` around the row ``point[n]``; it holds the
    rows ``low[n]`` to ``high[n]`` and has the children ``child[n]`` to
    ``child[n] + children[n]``, whose points are among its rows. Node 0 is the root.
    """

    point: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    children: np.ndarray

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The children of nodes, or leaves themselves."""
        inner = self.children[nodes] > 0
        n, first = np.where(inner, self.children[nodes], 1), np.where(inner, self.child[nodes], nodes)
        return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def by_first(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each different u, and what is paired with it."""
    order = np.argsort(u, kind="stable")
    named, starts = np.unique(u[order], return_index=True)
    return zip(named[:, None], np.split(v[order], starts[1:]), strict=False)


def centres(x: np.ndarray, members: np.ndarray, first: int, reach: float) -> Iterator[tuple[int, np.ndarray]]:
    """Greedy cover of ``members``: centres further than ``reach`` apart, each with what it is the first to cover."""
    at = int(np.flatnonzero(members == first)[0])
    turn = np.concatenate([[at], np.delete(np.arange(len(members)), at)])
    rows, left = x[members], np.ones(len(members), bool)
    for start in range(0, len(turn), 256):
        some = turn[start : start + 256]
        some = some[left[some]]
        near = rows[some] @ rows.T >= 1 - reach * reach / 2
        for centre, covered in zip(some, near, strict=True):
            if left[centre]:
                covered &= left
                covered[centre] = True
                left &= ~covered
                yield int(members[centre]), members[covered]


def cover_tree(x: np.ndarray, params: CoverParams) -> tuple[Tree, np.ndarray]:
    """Nested cover of the rows of x, and their order: children lie within half the radius of their level.

    A few rows that lie far apart are children by themselves, as the ball around them would be open to all others.
    """
    order = np.arange(len(x))
    nodes = [(0, 2.0, 0, len(x))]
    radii, child, children = [], [], []
    for point, reach, low, high in nodes:  # grows while it is read
        members = order[low:high].copy()
        far = distances(x[members], x[point : point + 1]).max() if high - low > 1 else 0.0
        radius = float(far) + 1e-6
        radii.append(radius)
        child.append(len(nodes))
        if high - low > params.leaf_size and radius > params.leaf_radius:
            half = reach / 2
            while half > radius:
                half /= 2
            for centre, covered in centres(x, members, point, half):
                order[low : low + len(covered)] = covered
                some = 1 < len(covered) <= params.leaf_size
                if some and distances(x[covered], x[centre : centre + 1]).max() > params.leaf_radius:
                    nodes += [(int(row), half, low + n, low + n + 1) for n, row in enumerate(covered)]
                else:
                    nodes.append((centre, half, low, low + len(covered)))
                low += len(covered)
        children.append(len(nodes) - child[-1])
    place = np.empty(len(x), int)
    place[order] = np.arange(len(x))
    points, _, lows, highs = (np.array(c) for c in zip(*nodes, strict=True))
    return Tree(place[points], np.array(radii), lows, highs, np.array(child), np.array(children)), order


def compare_leaves(
    links: np.ndarray, x: np.ndarray, mine: Tree, u: np.ndarray, y: np.ndarray, theirs: Tree, v: np.ndarray, cosine: float
) -> None:
    """Fill in the links of the leaf pairs (u, v); all partners of a leaf are compared in one product."""
    for (node,), partners in by_first(u, v):
        low, rows = theirs.low[partners], theirs.high[partners] - theirs.low[partners]
        columns = np.repeat(low - np.cumsum(rows) + rows, rows) + np.arange(rows.sum())
        own = slice(mine.low[node], mine.high[node])
        links[own, columns] = x[own] @ y[columns].T >= cosine


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what holds in a matrix, in order; where little holds, eight values are looked at at once."""
    flat = mask.reshape(-1)
    whole = len(flat) // 8 * 8
    some = np.flatnonzero(flat[:whole].view(np.uint64))
    if len(some) * 16 < whole:
        near = (some[:, None] * 8 + np.arange(8)).reshape(-1)
        near = np.concatenate([near[flat[near]], whole + np.flatnonzero(flat[whole:])])
    else:
        near = np.flatnonzero(flat)
    return np.divmod(near, mask.shape[1])


def opened(
    x: np.ndarray, y: np.ndarray, short: tuple[np.ndarray, np.ndarray], radii: np.ndarray, their_radii: np.ndarray, params: CoverParams
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of balls around the rows of x and y that may hold a link, and the cosines of their centres.

    ``short`` has the rows in single precision. Balls of at most ``leaf_radius``,
    usually nearly all, share one bound, so most of their pairs cost a product and
    a comparison; only what passes has its cosine and its own bound worked out.
    """
    small, theirs_small = radii <= params.leaf_radius, their_radii <= params.leaf_radius
    found = []
    for mine in (small, ~small):
        for theirs in (theirs_small, ~theirs_small):
            here, there = np.flatnonzero(mine), np.flatnonzero(theirs)
            if not len(here) or not len(there):
                continue
            right = short[1][there].T
            margin = 1e-6 + 2e-7 * x.shape[1]
            least = np.float32(1 - (radii[here].max() + params.tau + their_radii[there].max()) ** 2 / 2 - margin)
            for low in range(0, len(here), 256):
                some = here[low : low + 256]
                i, j = places(short[0][some] @ right >= least)
                found.append((some[i], there[j]))
    u, v = (np.concatenate(side) if found else np.zeros(0, int) for side in (zip(*found, strict=True) if found else ((), ())))
    kept = []
    for low in range(0, len(u), 1 << 15):
        i, j = u[low : low + (1 << 15)], v[low : low + (1 << 15)]
        cosines = np.einsum("ij,ij->i", x[i], y[j])
        near = cosines >= 1 - (radii[i] + params.tau + their_radii[j]) ** 2 / 2
        kept.append((i[near], j[near], cosines[near]))
    return tuple(np.concatenate(c) for c in zip(*kept, strict=True)) if kept else (u, v, np.zeros(0))


def traverse(x: np.ndarray, mine: Tree, y: np.ndarray, theirs: Tree, params: CoverParams) -> np.ndarray:
    """Boolean matrix of the rows of x and y, in the order of their trees, whose cosine reaches the threshold."""
    links = np.zeros((len(x), len(y)), bool)
    alone, alone_there = mine.high - mine.low == 1, theirs.high - theirs.low == 1
    short, short_there = x.astype(np.float32), y.astype(np.float32)
    stack = [(np.zeros(1, int), np.zeros(1, int))]
    while stack:  # nodes of either tree, all of which meet
        a, b = stack.pop()
        here, front = mine.below(a), theirs.below(b)
        at, there = mine.point[here], theirs.point[front]
        i, j, cosines = opened(x[at], y[there], (short[at], short_there[there]), mine.radius[here], theirs.radius[front], params)
        u, v = here[i], front[j]
        single = alone[u] & alone_there[v]
        links[mine.low[u[single]], theirs.low[v[single]]] = cosines[single] >= params.cosine
        inner, inner_there = mine.children[u] > 0, theirs.children[v] > 0
        stack.extend(by_first(u[inner], v[inner]))
        other = inner_there & ~inner
        stack.extend((partners, node) for node, partners in by_first(v[other], u[other]))
        leaves = ~inner & ~inner_there
        wide = leaves & ~alone[u]
        compare_leaves(links, x, mine, u[wide], y, theirs, v[wide], params.cosine)
        wide = leaves & alone[u] & ~alone_there[v]
        compare_leaves(links.T, y, theirs, v[wide], x, mine, u[wide], params.cosine)
    return links


def linked_pairs(x: np.ndarray, y: np.ndarray, params: CoverParams) -> np.ndarray:
    """Boolean matrix of the rows of x and y whose cosine reaches the threshold."""
    (mine, here), (theirs, there) = cover_tree(x, params), cover_tree(y, params)
    links = np.empty((len(x), len(y)), bool)
    links[np.ix_(here, there)] = traverse(x[here], mine, y[there], theirs, params)
    return links


def spanning(links: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the two-sided graph, as (row, column) pairs."""
    rows, columns, edges = links.any(axis=1), links.any(axis=0), []
    for root in np.flatnonzero(rows):
        if not rows[root]:
            continue
        rows[root], front = False, [(0, int(root))]
        while front:
            side, at = front.pop()
            new = np.flatnonzero(links[at] & columns) if side == 0 else np.flatnonzero(links[:, at] & rows)
            (columns if side == 0 else rows)[new] = False
            edges += [(at, int(n)) if side == 0 else (int(n), at) for n in new]
            front += [(1 - side, int(n)) for n in new]
    return edges


def cell_links(links: np.ndarray, ids: np.ndarray, times: np.ndarray, others: np.ndarray, others_times: np.ndarray, same: bool) -> tuple:
    """Columns a, b (missing in counts) and links: how many vectors each row is linked with, copies counted, and forest edges."""
    i, j = places(links)
    rows, columns = np.unique(i), np.unique(j)
    counts = [(ids, np.bincount(i, others_times[j], len(ids)))]
    if not same:
        counts.append((others, np.bincount(j, times[i], len(others))))
    edges = np.array(spanning(links[np.ix_(rows, columns)]), int).reshape(-1, 2)
    a = np.concatenate([*(named[found > 0] for named, found in counts), ids[rows[edges[:, 0]]] if len(edges) else ids[:0]])
    b = others[columns[edges[:, 1]]] if len(edges) else others[:0]
    counted = np.concatenate([found[found > 0] for _, found in counts]).astype("int64")
    none = np.zeros(len(counted), "int64")
    return a, np.concatenate([none, b]), np.concatenate([counted, np.zeros(len(b), "int64")]), len(counted)


def _coded(rows: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Valid vectors as bytes, in single precision if that holds them exactly; and which are valid."""
    good = np.isfinite(rows).all(axis=1) & rows.any(axis=1)
    with np.errstate(over="ignore", invalid="ignore"):
        short = rows.astype("<f4")
    narrow = (short == rows).all(axis=1)
    found = np.empty(len(rows), object)
    for which, values in ((narrow, short), (~narrow, rows.astype("<f8"))):
        width, some = values.itemsize * values.shape[1], values[which].tobytes()
        found[which] = [some[low : low + width] for low in range(0, len(some), width)]
    return found, good


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes and their dimension; those that are not valid have neither."""
    for batch in batches:
        lists = batch.column(1)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        values = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        found, sizes = np.full(len(batch), None, object), np.zeros(len(batch), "int32")
        for size in np.unique(lengths[lengths > 0]):
            which = np.flatnonzero(lengths == size)
            coded, good = _coded(values[starts[which][:, None] + np.arange(size)])
            found[which[good]], sizes[which[good]] = coded[good], size
        columns = [batch.column(0), pa.array(sizes, mask=sizes == 0), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "vector"])


CLEANED = "vec_id bigint, size int, vector binary"


def _matrix(values: list[bytes], size: int) -> np.ndarray:
    """Vectors of one dimension in double precision."""
    rows = np.empty((len(values), size))
    narrow = np.array([len(v) == 4 * size for v in values], bool)
    for which, kind in ((narrow, "<f4"), (~narrow, "<f8")):
        rows[which] = np.frombuffer(b"".join(values[i] for i in np.flatnonzero(which)), kind).reshape(-1, size)
    return rows


def _to_pivots(pivots: dict[int, np.ndarray]):
    """Nearest pivot of a vector among those of its dimension and its distance; node -1 where there is none."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for size, some in rows.groupby("size"):
                if size not in pivots:
                    yield some.assign(node=-1, far=2.0)
                    continue
                far = distances(unit(_matrix(some["vector"].tolist(), size)), pivots[size])
                node = far.argmin(axis=1)
                yield some.assign(node=node, far=far[np.arange(len(far)), node])

    return nearest


def _meeting(pivots: dict[int, np.ndarray], tau: float):
    """Pairs of nodes whose balls come as near as the threshold."""

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for size, some in rows.groupby("size"):
                if size in pivots:
                    p = pivots[size]
                    cosines = np.einsum("ij,ij->i", p[some["node"]], p[some["other"]])
                    apart = np.sqrt(np.maximum(0.0, 2 - 2 * cosines))
                    some = some[(some["node"] == some["other"]) | (apart <= some["far"] + some["other_far"] + tau)]
                yield some[["size", "node", "other"]]

    return met


PLANTED = "size int, node int, part int, file string, start bigint, n int, tree int, width int"


def _planted(params: CoverParams, folder: str):
    """Stores blocks, rows of which come together, each with its cover tree; returns where they lie.

    A block is its vectors in the order of the tree, their representatives and
    copies, the tree's nodes and their radii. A task writes a file of its own.
    """

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        name, out, start, key, held = f"{uuid.uuid4().hex}.blocks", None, 0, None, []

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal out, start
            if not held:
                return
            size = key[0]
            reps, coded, times = zip(*held, strict=True)
            vectors = _matrix(coded, size)
            tree, order = cover_tree(unit(vectors), params)
            kind = "<f4" if all(len(v) == 4 * size for v in coded) else "<f8"
            shape = np.stack((tree.point, tree.low, tree.high, tree.child, tree.children))
            parts = (
                vectors[order].astype(kind),
                np.array(reps, "<i8")[order],
                np.array(times, "<i8")[order],
                shape.astype("<i4"),
                tree.radius.astype("<f8"),
            )
            if out is None:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(f"{base}/{name}")
            bytes_ = b"".join(p.tobytes() for p in parts)
            out.write(bytes_)
            row = (*key, name, start, len(held), shape.shape[1], int(kind[2]))
            start += len(bytes_)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        schema = pa.schema(
            [*((c, pa.int32()) for c in ("size", "node", "part")), ("file", pa.string()), ("start", pa.int64())]
            + [(c, pa.int32()) for c in ("n", "tree", "width")]
        )
        for *at, rep, vector, times in rows_of(batches):
            if key != tuple(at):
                yield from block()
                key, held = tuple(at), []
            held.append((rep, vector, times))
        yield from block()
        if out is not None:
            out.close()

    return plant


class Blocks:
    """Reads stored blocks; keeps the last few."""

    def __init__(self, folder: str, keep: int = 4):
        (self.files, self.base), self.keep, self.held = open_folder(folder), keep, {}

    def get(self, size: int, file: str, start: int, n: int, tree: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Tree]:
        """Unit vectors, representatives, copies and tree of a block."""
        key = (file, start)
        if key not in self.held:
            if len(self.held) >= self.keep:
                self.held.pop(next(iter(self.held)))
            lengths = (n * size * width, n * 8, n * 8, 5 * tree * 4, tree * 8)
            with self.files.open_input_file(f"{self.base}/{file}") as f:
                f.seek(start)
                whole = f.read(sum(lengths))
            ends = np.cumsum(lengths)
            vectors, reps, times, shape, radii = (whole[end - length : end] for end, length in zip(ends, lengths, strict=True))
            point, low, high, child, children = np.frombuffer(shape, "<i4").reshape(5, -1)
            self.held[key] = (
                unit(np.frombuffer(vectors, f"<f{width}").reshape(n, size).astype(float)),
                np.frombuffer(reps, "<i8"),
                np.frombuffer(times, "<i8"),
                Tree(point, np.frombuffer(radii, "<f8"), low, high, child, children),
            )
        self.held[key] = self.held.pop(key)  # the last used is the last to go
        return self.held[key]


def _compared(params: CoverParams, folder: str):
    """Counts and forest edges of cells, rows of a size and of where two blocks lie."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(folder)
        for size, *places in rows_of(batches):
            one, two = places[:5], places[5:]
            (x, ids, times, mine), (y, others, others_times, theirs) = blocks.get(size, *one), blocks.get(size, *two)
            links = traverse(x, mine, y, theirs, params)
            if one == two:
                np.fill_diagonal(links, False)
            a, b, counted, n = cell_links(links, ids, times, others, others_times, one == two)
            if len(a):
                columns = [pa.array(a), pa.array(b, mask=np.arange(len(b)) < n), pa.array(counted)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])

    return compare


def class_links(classes: DataFrame, params: CoverParams) -> DataFrame:
    """(a, null, links) and forest edges (a, b, 0) between classes (size, rep, vector, times) of equal dimension.

    The dimension is part of every key, so any number of them is one job; only
    the sampled pivots pass through the driver.
    """
    spark = classes.sparkSession
    sized = classes.select("size", "rep", "vector", "times")
    wanted = min(params.most_pivots, classes.count() // params.block)
    # a sample by hash whose size is bounded by most_pivots; dimensions without a pivot are one node each
    sample = sized.select("size", "vector", F.xxhash64("rep").alias("h")).orderBy("h", "vector").limit(wanted).collect()
    sizes = {r["size"] for r in sample}
    pivots = {n: unit(_matrix([r["vector"] for r in sample if r["size"] == n], n)) for n in sizes}
    # worked out twice rather than written with its vectors
    placed = sized.mapInPandas(_to_pivots(pivots), "size int, rep bigint, vector binary, times bigint, node int, far double")
    fitting = F.greatest(F.lit(64), F.least(F.lit(params.block), F.lit(params.block_bytes) / (F.col("size") * 8)))
    nodes = written(
        placed.groupBy("size", "node")
        .agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"))
        .withColumn("blocks", F.ceil(F.col("n") / F.least(fitting, F.lit(params.block))).cast("int")),
        "cover-nodes",
    )
    dealt = placed.join(nodes.select("size", "node", "blocks"), ["size", "node"])
    keys, folder = ["size", "node", "part"], new_path(spark, "cover-blocks")
    blocks = written(
        dealt.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .select(*keys, "rep", "vector", "times")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_planted(params, folder), PLANTED),
        "cover-places",
    )
    theirs = nodes.select("size", F.col("node").alias("other"), F.col("far").alias("other_far"))
    pairs = (
        nodes.select("size", "node", "far")
        .join(theirs, "size")
        .filter("node <= other")
        .mapInPandas(_meeting(pivots, params.tau), "size int, node int, other int")
    )
    place = ["file", "start", "n", "tree", "width"]
    second = blocks.select("size", F.col("node").alias("other"), F.col("part").alias("there"), *[F.col(c).alias(f"other_{c}") for c in place])
    cells = written(
        blocks.join(pairs, ["size", "node"]).join(second, ["size", "other"]).filter("node < other or part <= there"), "cover-cells"
    )
    # cells of one block lie next to each other, a few in a task
    order = ["size", "node", "part", "other", "there"]
    tasks = max(1, min(20_000, cells.count() // 8))
    ordered = cells.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    found = ordered.select("size", *place, *[f"other_{c}" for c in place])
    return found.mapInArrow(_compared(params, folder), "a bigint, b bigint, links bigint")


def near_vectors(embeddings: DataFrame, params: CoverParams = CoverParams()) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (vec_id = component_id).

    Null, zero and empty vectors and those with null or non-finite components
    link with nothing, as do vectors of different dimensions with each other.
    Rows that repeat an id count as vectors of their own but share the id's
    component. A row without id links with nothing, its component is null and
    it is kept. Other columns are ignored; no rows give no rows.
    """
    cleaned = embeddings.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")).mapInArrow(_cleaned, CLEANED)
    good = cleaned.filter("vec_id is not null and vector is not null")
    classes = written(
        good.groupBy("size", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times")), "cover-classes"
    )
    # rows meet their class by a digest of the vector, so that vectors are not shuffled again
    digest = F.unhex(F.sha2("vector", 256)).alias("digest")
    named = classes.select("size", digest, "rep", "times")
    base = cleaned.select("vec_id", "size", digest).join(named, ["size", "digest"], "left")
    base = written(base.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("rep")).alias("rep"), "times"), "cover-base")
    found = written(class_links(classes, params), "cover-links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    edges = found.filter("b is not null").select("a", "b").union(
        base.filter("rep <> vec_id").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))
    )
    labels = connected(edges.distinct(), "cover-components").withColumnRenamed("id", "vec_id")
    return (
        base.join(counts, "rep", "left")
        .withColumn("n_links", F.when(F.col("rep").isNull(), 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("times") - 1))
        .join(labels, "vec_id", "left")
        .withColumn("component_id", F.coalesce("component", "vec_id"))
        .select(
            "vec_id",
            F.col("n_links").cast("bigint").alias("n_links"),
            "component_id",
            F.coalesce(F.expr("vec_id = component_id"), F.lit(True)).alias("kept"),
        )
    )
