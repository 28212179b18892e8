"""Exact top-k search by inner product: cover trees over queries and data, searched together.

Vectors are dealt to blocks around pivots, queries to smaller groups likewise; each gets a
cover tree.  A group is searched in its most promising block first.  The k-th scores found
there rule out blocks, and below them pairs of nodes: no query of a node reaches more than
``q.x + |q| rx + |x| rq + rq rx`` with a point of another, where q and x are the nodes' points
and rq and rx the radii that cover what is below.

For the rest a task gets a chunk of the groups and a part of the blocks, so each tree moves once
per chunk or part and not once per pair.  Where the bounds rule out less than half of a block
for a group, all its products are taken at once, exact in floats.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_table, keep_table, ship

LEAF = 24
MOST_PIVOTS = 1024
CHUNK_BYTES = 32 * 2**20  # of the queries that a task holds, in 32-bit floats
PART_BYTES = 64 * 2**20  # of the trees that a task reads
TASK_SCORES = 4e9  # of a task, while trees move little
TILE = 512  # queries and points whose products are taken at once
LARGEST = 2**63 - 1  # of a long
LARGEST_COMPONENT = 9223372036854774784.0  # the largest double below 2**63
ROUNDING = 1e-14  # of floating sums of products, per term and length; far above what occurs


class CoverTree:
    """Points in the order of the tree, nodes as ranges of them, level by level.

    A node covers its points within its radius; children of a node at scale 2**i are centres
    over 2**(i-1) apart that cover it within that distance.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        n = len(points)
        self.ids, self.points = ids, points
        order = np.arange(n)
        exact = points.astype(np.float64)
        nodes: list[tuple[int, int, int, float, int]] = []  # from, to, centre, radius, children

        squares = (exact**2).sum(1)
        # all at once where the sums of products are exact
        at_once = 64 if n and 4 * squares.max() < 2**52 else 1

        def distances(at: np.ndarray, centre: int) -> np.ndarray:
            return np.sqrt(((exact[at] - exact[centre]) ** 2).sum(1))

        def cover(rest: np.ndarray, width: float) -> list[tuple[np.ndarray, int, float]]:
            """Points by the first of them, from the front, that is within ``width`` of them."""
            found = []
            while len(rest):
                heads = rest[:at_once]
                if at_once > 1:
                    d = np.sqrt(squares[heads][:, None] + squares[rest] - 2 * (exact[heads] @ exact[rest].T))
                else:
                    d = distances(rest, heads[0])[None]
                left = np.ones(len(rest), bool)
                for i, head in enumerate(heads.tolist()):
                    if left[i]:
                        near = left & (d[i] <= width)
                        found.append((rest[near], head, float(d[i][near].max())))
                        left &= ~near
                rest = rest[left]
            return found

        far = float(distances(order, 0).max()) if n else 0.0
        waiting = [(0, n, 0, far, int(np.ceil(np.log2(far))) if far else 0)]
        first_child: list[tuple[int, int]] = []
        at = 0
        while at < len(waiting):
            begin, to, centre, radius, scale = waiting[at]
            at += 1
            nodes.append((begin, to, centre, radius, 0))
            if to - begin <= LEAF or radius == 0:
                first_child.append((0, 0))
                continue
            rest = order[begin:to].copy()
            rest = np.concatenate([[centre], rest[rest != centre]])  # the centre keeps its own
            children = []
            while not children or len(children) == 1 and scale > -60:
                # one child alone says nothing new: go down a scale at once
                scale -= 1
                children = cover(rest, 2.0**scale)
            place = begin
            first_child.append((len(waiting), len(waiting) + len(children)))
            for mine, head, r in children:
                order[place : place + len(mine)] = mine
                waiting.append((place, place + len(mine), head, r, scale))
                place += len(mine)
        self.ids, self.points = ids[order], points[order]
        self.begin = np.array([x[0] for x in nodes], np.int64)
        self.to = np.array([x[1] for x in nodes], np.int64)
        centres = np.array([x[2] for x in nodes], np.int64)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.centre = place[centres] if n else centres  # among the points as ordered
        self.radius = np.array([x[3] for x in nodes])
        self.child = np.array(first_child, np.int64)
        self.norms = np.sqrt((self.centres**2).sum(1))
        low, high = (int(points.min()), int(points.max())) if points.size else (0, 0)
        self.largest = float(max(-low, high))
        # all points lie in a cone around the root's centre: its cosine, and the greatest length
        lengths, axis = np.sqrt(squares), self.norms[0]
        self.longest = float(lengths.max(initial=0))
        self.cone = -1.0
        if axis > 0:
            some = lengths > 0
            self.cone = float((exact[some] @ exact[centres[0]] / lengths[some] / axis).min(initial=1.0)) - 1e-9

    @cached_property
    def floats(self) -> np.ndarray:
        return self.points.astype(np.float64)

    @cached_property
    def centres(self) -> np.ndarray:
        return self.centres_of(slice(None)) if len(self.points) else np.zeros((1, 0))

    def centres_of(self, nodes) -> np.ndarray:
        return self.points[self.centre[nodes]].astype(np.float64)

    def __getstate__(self):
        """Points in the narrowest integers that hold them."""
        kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if self.largest <= np.iinfo(t).max)
        nodes = {x: getattr(self, x).astype(np.int32) for x in ("begin", "to", "centre", "child")}
        rest = {x: getattr(self, x) for x in ("ids", "radius", "norms", "largest", "longest", "cone")}
        return rest | nodes | {"points": self.points.astype(kind)}

    def __setstate__(self, state) -> None:
        for name in ("begin", "to", "centre", "child"):
            state[name] = state[name].astype(np.int64)
        self.__dict__.update(state)

    def coarse(self) -> np.ndarray:
        """Nodes that cover all points: several, but at most one for every eight points; else the root."""
        nodes = np.zeros(1, np.int64)
        while len(nodes) < 8:
            below = _expand(self, nodes)
            if len(below) == len(nodes) and (below == nodes).all() or 8 * len(below) > len(self.ids):
                break
            nodes = below
        return nodes


def _expand(tree: CoverTree, nodes: np.ndarray) -> np.ndarray:
    """Children of inner nodes; leaves stay."""
    child = tree.child[nodes]
    inner = child[:, 1] > child[:, 0]
    size = (child[:, 1] - child[:, 0])[inner]
    below = np.repeat(child[inner, 0] - np.cumsum(size) + size, size) + np.arange(size.sum())
    return np.concatenate([nodes[~inner], below])


def _offer(scores: np.ndarray, own: np.ndarray, ids: np.ndarray, best: Best, rows: np.ndarray) -> None:
    """Add those of a table of scores, of queries ``rows`` by points ``ids``, that may be among the best."""
    cut = best.floor[rows]
    free = np.flatnonzero(np.isneginf(cut))
    if len(free) and len(ids) > 4 * best.k:
        # all that could be among the k best, and k more for rows of the query's own id
        cut[free] = np.partition(scores[free], len(ids) - 2 * best.k, axis=1)[:, len(ids) - 2 * best.k]
    at = np.flatnonzero(scores >= cut.astype(scores.dtype if scores.dtype.kind == "f" else np.float64)[:, None])
    if not len(at):
        return
    r, c = at // len(ids), at % len(ids)
    others = own[r] != ids[c]
    r, c = r[others], c[others]
    best.add(rows[r], scores[r, c].astype(np.int64), ids[c])


class Best:
    """The k best of each query so far; ``floor`` is a score that k others reach for sure."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)
        self.count = np.zeros(n, np.int64)
        self.scores, self.ids = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(rows):
            return
        met = np.unique(rows)
        known = np.arange(self.k) < self.count[met][:, None]
        row = np.concatenate([np.repeat(met, self.count[met]), rows])
        score = np.concatenate([self.scores[met][known], scores])
        ids = np.concatenate([self.ids[met][known], ids])
        order = np.lexsort((ids, ~score, row))
        row, score, ids = row[order], score[order], ids[order]
        start = np.flatnonzero(np.diff(row, prepend=-1))
        rank = np.arange(len(row)) - np.repeat(start, np.diff([*start, len(row)]))
        keep = rank < self.k
        row, rank = row[keep], rank[keep]
        self.scores[row, rank], self.ids[row, rank] = score[keep], ids[keep]
        self.count[row] = np.maximum(self.count[row], rank + 1)
        last = row[rank == self.k - 1]
        self.floor[last] = np.maximum(self.floor[last], self.scores[last, self.k - 1])

    def _flat(self) -> np.ndarray:
        return np.arange(self.k) < self.count[:, None]

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    @property
    def score(self) -> np.ndarray:
        return self.scores[self._flat()]

    @property
    def id(self) -> np.ndarray:
        return self.ids[self._flat()]


def search(queries: CoverTree, data: CoverTree, best: Best, first: int = 0) -> None:
    """Bring ``best`` up to date for all queries against all points but those of their own id.

    The queries are the rows of ``best`` from ``first``.
    """
    dim = queries.points.shape[1]
    largest = queries.largest * data.largest
    exact_floats = largest * dim < 2**52
    may_leave_long = largest * dim >= LARGEST
    kind = np.float64 if exact_floats else np.int64
    of_data = data.floats if exact_floats else data.points.astype(np.int64)
    rounding = dim * ROUNDING

    def products(a: int, b: int, at: np.ndarray) -> np.ndarray:
        """Inner products, exact; those beyond a long are the largest or smallest long."""
        asked = queries.points[a:b].astype(kind)
        if not may_leave_long:
            return asked @ of_data[at].T
        wide = asked.astype(object) @ of_data[at].T.astype(object)
        return np.clip(wide, -LARGEST - 1, LARGEST).astype(np.int64)

    def compare(q: int, nodes: np.ndarray) -> None:
        a, b = queries.begin[q], queries.to[q]
        size = data.to[nodes] - data.begin[nodes]
        at = np.repeat(data.begin[nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())
        _offer(products(a, b, at), queries.ids[a:b], data.ids[at], best, first + np.arange(a, b))

    waiting = [(0, np.zeros(1, np.int64))]
    while waiting:
        q, nodes = waiting.pop()
        reach = (
            data.centres[nodes] @ queries.centres_of(q)
            + queries.norms[q] * data.radius[nodes]
            + data.norms[nodes] * queries.radius[q]
            + queries.radius[q] * data.radius[nodes]
        )
        lengths = (data.norms[nodes] + data.radius[nodes]) * (queries.norms[q] + queries.radius[q])
        reach = reach + lengths * rounding + 1e-3
        worst = best.floor[first + queries.begin[q] : first + queries.to[q]].min()
        open_ = reach >= worst
        nodes = nodes[open_][np.argsort(-reach[open_], kind="stable")]
        if not len(nodes):
            continue
        leaf = data.child[nodes, 1] == data.child[nodes, 0]
        q_child = queries.child[q]
        if leaf.all() and q_child[1] == q_child[0]:
            for i in range(0, len(nodes), 256):
                compare(q, nodes[i : i + 256])
            continue
        below = nodes if leaf.all() else _expand(data, nodes)
        if q_child[1] == q_child[0] or queries.radius[q] < data.radius[nodes].max():
            waiting.append((q, below))
        else:
            waiting += [(c, below) for c in range(q_child[0], q_child[1])]


# ---- on Spark --------------------------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes: the width of a component, then all in that width, the least that holds them."""
    for batch in batches:
        ids, column = batch.column(0).to_numpy(), batch.column(1)
        size = np.diff(column.offsets.to_numpy())
        for dim in np.unique(size).tolist():
            mine = np.flatnonzero(size == dim)
            points = column.take(pa.array(mine)).flatten().to_numpy().reshape(len(mine), dim)
            low, high = points.min(axis=1), points.max(axis=1)
            width = np.full(len(mine), 8)
            for t in (np.int32, np.int16, np.int8):
                width[(low >= np.iinfo(t).min) & (high <= np.iinfo(t).max)] = np.dtype(t).itemsize
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                flat = np.empty((len(at), 1 + w * dim), np.uint8)
                flat[:, 0] = w
                flat[:, 1:] = points[at].astype(f"<i{w}").view(np.uint8)
                ends = pa.py_buffer(np.arange(len(at) + 1, dtype=np.int32) * flat.shape[1])
                packed = pa.Array.from_buffers(pa.binary(), len(at), [None, ends, pa.py_buffer(flat)])
                yield pa.record_batch([pa.array(ids[mine[at]]), packed], names=["vec_id", "v"])


def _unpacked(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors, of each width and length in turn."""
    size = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(size).tolist():
        mine = np.flatnonzero(size == length)
        some = column.take(pa.array(mine))
        begin = some.offset  # of a slice
        ends = np.frombuffer(some.buffers()[1], np.int32)[begin : begin + len(mine) + 1]
        flat = np.frombuffer(some.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(mine), length)
        for w in np.unique(flat[:, 0]).tolist():
            at = np.flatnonzero(flat[:, 0] == w)
            yield mine[at], np.ascontiguousarray(flat[at, 1:]).view(f"<i{w}").astype(np.int64)


def _pivot(pivots: np.ndarray):
    """The length and nearest pivot of each vector, -1 where none has its length."""
    squares = (pivots**2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = np.full(batch.num_rows, -1, np.int32)
            size = np.zeros(batch.num_rows, np.int32)
            for at, points in _unpacked(batch.column(1)):
                size[at] = points.shape[1]
                if len(pivots) and points.shape[1] == pivots.shape[1]:
                    for i in range(0, len(at), 256):
                        square = squares - 2 * (points[i : i + 256].astype(np.float64) @ pivots.T)
                        nearest[at[i : i + 256]] = square.argmin(1)
            yield pa.record_batch(
                [*batch.columns, pa.array(size), pa.array(nearest)], names=["vec_id", "v", "dim", "pivot"]
            )

    return run


def _build(table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").to_numpy()
    points = np.empty((len(ids), table.column("dim")[0].as_py()), np.int64)
    for at, some in _unpacked(table.column("v").combine_chunks()):
        points[at] = some
    order = np.lexsort((*points.T[:1], ids))
    tree = CoverTree(ids[order], points[order])
    return pa.table(
        {
            "block": table.column("block")[:1],
            "dim": table.column("dim")[:1],
            "center": pa.array([tree.centres_of(0).tolist()], pa.list_(pa.float64())),
            "radius": pa.array([float(tree.radius[0])]),
            "n": pa.array([len(np.unique(ids))], pa.int64()),
            "points": pa.array([len(ids)], pa.int64()),
            "tree": pa.array([pickle.dumps(tree)], pa.binary()),
        }
    )


def _trees(vectors: DataFrame, size: int, label: str) -> DataFrame:
    """block, dim, center, radius, n, points, tree: cover trees of about ``size`` vectors each.

    ``n`` counts distinct ids, ``points`` rows.
    """
    vectors = keep_table(vectors, f"{label}-pivots")
    counts = vectors.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / size).alias("salts"))
    counts = keep_table(counts, f"{label}-counts")
    salted = vectors.join(counts, ["dim", "pivot"]).select(
        "vec_id",
        "v",
        "dim",
        F.xxhash64("dim", "pivot", F.pmod(F.xxhash64("vec_id", "v"), F.col("salts"))).alias("block"),
    )
    built = salted.groupBy("block").applyInArrow(
        _build, "block long, dim int, center array<double>, radius double, n long, points long, tree binary"
    )
    built = keep_table(built, f"{label}-trees")
    drop_table(vectors)
    return built


def _search(k: int):
    """Rows of a block: its tree (kind 0), then the trees of groups to search in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, name = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    data, name = pickle.loads(row["tree"]), row["block"]
                    continue
                assert row["block"] == name
                queries = pickle.loads(row["tree"])
                best = Best(len(queries.ids), k, np.full(len(queries.ids), -np.inf))
                search_chunk([queries], np.array([-1]), [(-1, data)], best, all_blocks=True)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(best.row), row["group"]), pa.int64()),
                        pa.array(queries.ids[best.row]),
                        pa.array(best.id),
                        pa.array(best.score),
                    ],
                    names=["group", "query_id", "vec_id", "score"],
                )

    return run


def _run(pairs: DataFrame, blocks: DataFrame, groups: DataFrame, k: int):
    """Search the (group, block) ``pairs``, one of each group; many groups of a block are split over tasks."""
    load = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / 128).alias("salts"))
    data = blocks.join(load, "block").select(
        "block",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("group"),
        "tree",
    )
    trees = groups.select(F.col("block").alias("group"), "tree")
    asked = (
        pairs.join(load, "block")
        .join(trees, "group")
        .select(
            "block",
            F.pmod(F.xxhash64("group"), F.col("salts")).alias("salt"),
            F.lit(1).alias("kind"),
            "group",
            "tree",
        )
    )
    return (
        data.unionByName(asked)
        .repartition("block", "salt")
        .sortWithinPartitions("block", "salt", "kind", "group")
        .mapInArrow(_search(k), "group long, query_id long, vec_id long, score long")
    )


def in_cone(near: np.ndarray, lengths: np.ndarray, data: CoverTree) -> np.ndarray:
    """The most that queries reach within the cone of ``data``; ``near``: products with its centre."""
    if data.norms[0] == 0 or data.cone <= 0:
        return lengths * data.longest
    cosine = np.clip(near / np.maximum(lengths, 1e-300) / data.norms[0] + 1e-5, -1, 1)
    edge = np.sqrt(1 - data.cone**2)
    apart = cosine * data.cone + np.sqrt(1 - cosine**2) * edge
    return lengths * data.longest * np.where(cosine >= data.cone, 1.0, np.maximum(apart, 0.0))


def search_chunk(trees: list[CoverTree], skip: np.ndarray, blocks, best: Best, all_blocks: bool = False) -> None:
    """Bring ``best`` up to date for the queries of all ``trees``, in order, against ``blocks``.

    ``blocks`` gives (name, tree); a tree of queries leaves out the block that ``skip`` names,
    unless it is to meet ``all_blocks``.
    """
    begin = np.cumsum([0, *[len(t.ids) for t in trees]])
    own = np.concatenate([t.ids for t in trees])
    centres = np.concatenate([t.centres_of([0]) for t in trees])
    norms, radius = (np.concatenate([getattr(t, x)[:1] for t in trees]) for x in ("norms", "radius"))
    largest = np.array([t.largest for t in trees])
    dim = centres.shape[1]
    tables: dict = {}

    def table(kind) -> tuple[np.ndarray, np.ndarray]:
        if kind not in tables:
            points = np.concatenate([t.points.astype(kind) for t in trees])
            tables[kind] = points, np.sqrt((points**2).sum(1, dtype=np.float64))
        return tables[kind]

    def asked_by(kind, rows: np.ndarray) -> np.ndarray:
        points = table(kind)[0]
        return points if len(rows) == len(points) else points[rows]

    def lengths_of(kind) -> np.ndarray:
        return table(kind)[1]

    for name, data in blocks:
        nodes = data.coarse()
        reach = (
            centres @ data.centres_of(nodes).T
            + norms[:, None] * data.radius[nodes]
            + radius[:, None] * data.norms[nodes]
            + radius[:, None] * data.radius[nodes]
        )
        lengths = (norms + radius)[:, None] * (data.norms[nodes] + data.radius[nodes])
        worst = np.minimum.reduceat(best.floor, begin[:-1])
        open_ = reach + lengths * (dim * ROUNDING) + 1e-3 >= worst[:, None]
        if not all_blocks:
            open_ &= (skip != name)[:, None]
        share = open_ @ (data.to[nodes] - data.begin[nodes]) / len(data.ids)
        products = largest * data.largest * dim
        dense = share >= 0.5
        for kind, of in ((np.float32, products < 2**24), (np.float64, (products >= 2**24) & (products < 2**52))):
            groups = np.flatnonzero(dense & of)
            if not len(groups):
                continue
            points = data.points.astype(kind)
            rows = np.flatnonzero(np.repeat(np.isin(np.arange(len(trees)), groups), np.diff(begin)))
            # a query is a node of radius 0
            near = (asked_by(kind, rows) @ data.centres_of(0).astype(kind)).astype(np.float64)
            lengths = lengths_of(kind)[rows]
            most = np.minimum(near + lengths * data.radius[0], in_cone(near, lengths, data))
            rows = rows[most + lengths * (data.norms[0] + data.radius[0]) * 1e-5 + 1 >= best.floor[rows]]
            for i in range(0, len(rows), TILE):
                some = rows[i : i + TILE]
                asked = asked_by(kind, some)
                for j in range(0, len(points), 2 * TILE):
                    _offer(asked @ points[j : j + 2 * TILE].T, own[some], data.ids[j : j + 2 * TILE], best, some)
        for g in np.flatnonzero((share > 0) & ~(dense & (products < 2**52))):
            search(trees[g], data, best, int(begin[g]))


def _search_rest(k: int):
    """Rows of a chunk and part: the trees of groups (kind 0), then those of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield batch.slice(i, 1).to_pylist()[0]

        for _, of_task in itertools.groupby(rows(), lambda r: (r["dim"], r["task"])):
            trees, skip, floors, blocks = [], [], [], of_task
            for row in of_task:
                if row["kind"]:
                    blocks = itertools.chain([row], of_task)
                    break
                tree = pickle.loads(row["tree"])
                known = {f["query_id"]: f["floor"] for f in row["floors"] or []}
                trees.append(tree)
                skip.append(row["nearest"])
                floors += [known.get(q, -np.inf) for q in tree.ids.tolist()]
            if not trees:
                continue
            best = Best(len(floors), k, np.array(floors))
            search_chunk(trees, np.array(skip), ((r["block"], pickle.loads(r["tree"])) for r in blocks), best)
            own = np.concatenate([t.ids for t in trees])
            yield pa.record_batch(
                [pa.array(own[best.row]), pa.array(best.id), pa.array(best.score)],
                names=["query_id", "vec_id", "score"],
            )

    return run


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk and part: the centres of groups (kind 0) and blocks; the best block of each group."""
    found = list(batches)
    if not found:
        return
    table = pa.Table.from_batches(found)
    task, kind, dim, name = (table.column(c).to_numpy() for c in ("task", "kind", "dim", "block"))
    for t, d in sorted(set(zip(task.tolist(), dim.tolist()))):
        mine = (task == t) & (dim == d)
        sides = []
        for side in (0, 1):
            at = np.flatnonzero(mine & (kind == side))
            centres = table.column("center").take(pa.array(at)).combine_chunks().flatten().to_numpy()
            sides.append((name[at], centres.reshape(len(at), d)))
        (groups, asked), (blocks, centres) = sides
        if not len(groups) or not len(blocks):
            continue
        order = np.argsort(-blocks, kind="stable")  # of equal ones the block of the largest name
        blocks, centres = blocks[order], centres[order]
        for i in range(0, len(groups), 1024):
            near = asked[i : i + 1024] @ centres.T
            at = near.argmax(1)
            yield pa.record_batch(
                [pa.array(groups[i : i + 1024]), pa.array(blocks[at]), pa.array(near[np.arange(len(at)), at])],
                names=["group", "block", "near"],
            )


def _tasks(blocks: DataFrame, groups: DataFrame) -> tuple[int, int]:
    """How many chunks of groups and parts of blocks: each group meets each block in one task."""
    size = [F.coalesce(F.sum(F.length("tree")), F.lit(0)), F.coalesce(F.sum("points"), F.lit(0))]
    floats = F.coalesce(F.sum(F.col("points") * F.col("dim") * 4), F.lit(0))
    read, points = blocks.agg(*size).first()
    asked, queries, held = groups.agg(*size, floats).first()
    n_chunks = max(1, -(-held // CHUNK_BYTES))
    busy = min(points * queries / TASK_SCORES / n_chunks, read / max(1, asked), points / 4096)
    return n_chunks, max(1, -(-read // PART_BYTES), math.ceil(busy))


def _dealt(blocks: DataFrame, groups: DataFrame, n_chunks: int, n_parts: int) -> DataFrame:
    """Every group in its chunk's tasks and every block in its part's, groups (kind 0) first."""

    def spread(df: DataFrame, kind: int, task) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), "*", F.explode(task).alias("task"))

    of = F.xxhash64(F.col("block"))
    chunk, part = F.pmod(of, F.lit(n_chunks)), F.pmod(of, F.lit(n_parts))
    every_part = F.transform(F.sequence(F.lit(0), F.lit(n_parts - 1)), lambda p: (chunk * n_parts + p).cast("int"))
    every_chunk = F.transform(F.sequence(F.lit(0), F.lit(n_chunks - 1)), lambda c: (c * n_parts + part).cast("int"))
    both = spread(groups, 0, every_part).unionByName(spread(blocks, 1, every_chunk), allowMissingColumns=True)
    dealt = both.repartitionById(n_chunks * n_parts, F.col("task"))
    return dealt.sortWithinPartitions("task", "dim", "kind", "block")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    block_size: int = 2048,
    group_size: int = 128,
    n_pivots: int = 64,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query, exact.

    ``vectors`` and ``queries`` have vec_id and ``v``, an array of long.  Ties go to the
    smaller vec_id.  A query meets all vectors of its length but those with its own id.  Rows
    that repeat an id, with the same vector or another, count one by one: as vectors each can
    take a rank, as queries their finds are ranked together.  Rows with a null id or vector
    take no part, nor do vectors without components.  Inner products are exact; one that
    leaves the long range becomes the largest or smallest long.
    """
    spark = vectors.sparkSession
    ship(spark)

    packed = "vec_id long, v binary"

    def clean(df: DataFrame, label: str) -> DataFrame:
        """Distinct rows; ``n``: how often each occurs, k if more, as no more can matter."""
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), "v")
        counted = df.where("vec_id is not null and size(v) > 0").mapInArrow(_packed, packed).groupBy("vec_id", "v")
        return keep_table(
            counted.agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n")), label
        )

    def repeated(df: DataFrame) -> DataFrame:
        return df.select("vec_id", "v", F.explode(F.sequence(F.lit(1), "n"))).drop("col")

    data, asked = clean(vectors, "top-vectors"), repeated(clean(queries, "top-queries"))
    # pivots only shape the blocks: a bounded sample, the least hashes, n_pivots or one for four blocks
    n_pivots = max(n_pivots, min(data.count() // (4 * block_size), MOST_PIVOTS))
    sample = data.select("v").orderBy(F.xxhash64("v")).limit(n_pivots).collect()
    found = [x for _, x in _unpacked(pa.array([bytes(r["v"]) for r in sample], pa.binary()))]
    size = found[-1].shape[1] if found else 0
    pivots = np.concatenate([x for x in found if x.shape[1] == size] or [np.zeros((0, 0))]).astype(np.float64)
    # of equal vectors only the least ids can be among the best, one more for the own id
    equal = Window.partitionBy("v").orderBy("vec_id")
    data = data.withColumn("place", F.row_number().over(equal)).where(F.col("place") <= k + 1)
    data = repeated(data)
    with_pivot = packed + ", dim int, pivot int"
    blocks = _trees(data.mapInArrow(_pivot(pivots), with_pivot), block_size, "top-blocks")
    groups = _trees(asked.mapInArrow(_pivot(pivots), with_pivot), group_size, "top-groups")

    n_chunks, n_parts = _tasks(blocks, groups)
    summaries = [x.select("block", "dim", "center") for x in (blocks, groups)]
    near = _dealt(*summaries, n_chunks, n_parts).mapInArrow(_nearest, "group long, block long, near double")
    nearest = near.groupBy("group").agg(F.max_by("block", F.struct("near", "block")).alias("block"))
    nearest = keep_table(nearest, "top-nearest")
    first = keep_table(_run(nearest, blocks, groups, k), "top-first")
    kth = first.groupBy("group", "query_id").agg(
        F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")
    )
    floors = kth.where(F.col("n") >= k).groupBy("group").agg(
        F.collect_list(F.struct("query_id", "floor")).alias("floors")
    )
    asking = (
        groups.select(F.col("block").alias("group"), "dim", "tree")
        .join(nearest.withColumnRenamed("block", "nearest"), "group")
        .join(floors, "group", "left")
        .withColumnRenamed("group", "block")
    )
    rest = _dealt(blocks.select("block", "dim", "tree"), asking, n_chunks, n_parts).mapInArrow(
        _search_rest(k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.drop("group")
        .unionByName(rest)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v: components scaled and rounded down, of vectors that are whole and finite.

    Vectors that are null, or hold a null or non-finite component, take no part.  A scaled
    component beyond the long range becomes the double next to its end.
    """
    x = F.transform("embedding", lambda e: e.cast("double"))
    infinity = F.lit(float("inf"))
    fits = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < infinity))
    low, high = F.lit(-LARGEST_COMPONENT), F.lit(LARGEST_COMPONENT)
    return embeddings.where(F.col("embedding").isNotNull() & fits).select(
        "vec_id",
        F.transform(x, lambda e: F.floor(F.least(F.greatest(e * scale, low), high))).alias("v"),
    )


def op9_cover_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


QUERIES = {"op9_cover_tree_search": op9_cover_tree_search}
SQL = {
    "op9_cover_tree_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(
    least(greatest(256 * CAST(x AS DOUBLE), -9223372036854774784), 9223372036854774784)) AS HUGEINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(least(greatest(list_sum(list_transform(a.q, lambda x, i: x * b.q[i])),
      -9223372036854775808), 9223372036854775807) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    AND len(a.q) > 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
}
