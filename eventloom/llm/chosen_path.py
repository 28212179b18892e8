"""Set similarity join of documents on word shingles by chosen paths.

Documents with the same shingles form a class; the join is between classes.  A run splits all
classes by the token that a random order puts first in each set (equal tokens: same bucket),
and splits buckets that are still large by another order, to a depth of ``DEPTH``.  What is
left in a bucket is compared by brute force, large ones in pairs of blocks.  Two sets of
similarity s stay together in a run with a chance of s ** DEPTH at least, so the number of
runs follows from the recall wanted at the threshold.  A pair that met in an earlier run is
not compared or counted again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, drop_table, keep_table, ship
from .components import components
from .tokens import slices
from .words import mix, shingles, word_hashes

DEPTH = 3
BLOCK = 256  # classes that are compared with each other in one go
BROADCAST_ROWS = 500_000  # ids of documents


def runs_for(recall: float, threshold: float) -> int:
    """Runs until a pair at the threshold has met with this chance."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**DEPTH)))


def least_matches(orders: int, threshold: float, miss: float = 1e-7) -> int:
    """First tokens that two sets at the threshold share, but for a chance of ``miss``."""
    tail = 0.0
    for k in range(orders + 1):
        tail += math.comb(orders, k) * threshold**k * (1 - threshold) ** (orders - k)
        if tail > miss:
            return k
    return orders


# ---- sets and sketches -----------------------------------------------------


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, one text after another; how many per text."""
    found, counts = shingles(*word_hashes(texts), width)
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[first], np.bincount(text[first], minlength=len(counts))


def _digest(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits for each set."""
    starts, has = np.cumsum(counts) - counts, counts > 0
    out = np.zeros((len(counts), 2), np.uint64)
    for k in range(2):
        salted = mix(found, np.full(len(found), k + 1, np.uint64))
        if has.any():
            out[has, k] = np.add.reduceat(salted, starts[has])
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a contiguous matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    flat = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]
    )
    return flat.cast(pa.binary())


def _long_lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1).view(np.int64)))


def _sketch(width: int, orders: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                found, counts = _sets(part.column(2), width)
                starts, has = np.cumsum(counts) - counts, counts > 0
                first = np.zeros((len(counts), orders), np.uint64)
                if has.any():
                    for k in range(orders):
                        salted = (found ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(
                            0xD6E8FEB86659FD93
                        )
                        salted ^= salted >> np.uint64(32)
                        salted *= np.uint64(0xD6E8FEB86659FD93)
                        first[has, k] = np.minimum.reduceat(salted, starts[has])
                yield pa.record_batch(
                    [
                        part.column(0),
                        part.column(1),
                        _binary(_digest(found, counts)),
                        pa.array(counts, pa.int64()),
                        _long_lists(first),
                    ],
                    names=["doc_id", "text_hash", "class", "n", "first"],
                )

    return run


def _sets_again(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                found, counts = _sets(part.column(0), width)
                raw = found.astype("<u8")
                ends = np.cumsum(counts)
                sets = [raw[e - c : e].tobytes() for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.record_batch(
                    [_binary(_digest(found, counts)), pa.array(sets, pa.binary())],
                    names=["class", "tokens"],
                )

    return run


# ---- buckets ---------------------------------------------------------------


def _buckets(classes: DataFrame, runs: int, most: int) -> DataFrame:
    """class, run, bucket, size of all buckets with company, as a kept table."""
    at = F.col("run") * DEPTH
    paths = [[F.get("first", at + k) for k in range(d + 1)] for d in range(DEPTH)]
    left = classes.select(
        "class", "first", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    ).select("class", "run", *[F.xxhash64("run", *p).alias(f"path{d}") for d, p in enumerate(paths)])
    done, levels = [], []
    for depth in range(DEPTH):
        path = f"path{depth}"
        sizes = left.groupBy(path).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        # a table of its own, so that the join can split the classes of a hot path
        sizes = keep_table(sizes, f"join-sizes{depth}")
        left = keep_table(left.join(sizes, path), f"join-level{depth}")
        levels += [sizes, left]
        small = F.lit(True) if depth == DEPTH - 1 else F.col("size") <= most
        done.append(left.where(small).select("class", "run", F.col(path).alias("bucket"), "size"))
        left = left.where(~small).drop("size")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    kept = keep_table(found, "join-buckets")
    for table in levels:
        drop_table(table)
    return kept


def _cells(buckets: DataFrame) -> DataFrame:
    """class, run, cell, block, cross: a bucket, or the pairs of blocks of a large one.

    A cell of two blocks (``cross``) compares only what is not of the same block.
    """
    n = F.greatest(F.lit(1), F.ceil(F.col("size") * 2 / BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("class", "bucket"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        buckets.withColumn("blocks", n)
        .withColumn("block", block)
        .withColumn("other", other)
        .select(
            "class",
            "run",
            F.xxhash64(
                "bucket", F.least("block", "other"), F.greatest("block", "other"), "run"
            ).alias("cell"),
            "block",
            (F.col("block") != F.col("other")).alias("cross"),
        )
    )


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Regroup batches, sorted by ``cell``, so that no cell is cut; many cells at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy()
        last = int(np.searchsorted(cell, cell[-1]))
        if last:
            held.append(batch.slice(0, last))
            yield pa.Table.from_batches(held)
            held = []
        elif held and held[-1].column("cell")[0].as_py() != cell[0]:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _new_pairs(labels: np.ndarray, run: int, block: np.ndarray, cross: bool) -> np.ndarray:
    """Pairs of a cell that no earlier run has brought together; 0 is no bucket."""
    new = np.ones((len(labels), len(labels)), bool)
    for k in range(run):
        mine = labels[:, k]
        new &= (mine[:, None] != mine) | (mine == 0)[:, None]
    if cross:
        new &= block[:, None] != block
    np.fill_diagonal(new, False)
    return new


def _sizes_fit(n: np.ndarray, threshold: Fraction) -> np.ndarray:
    low, high = np.minimum(n[:, None], n), np.maximum(n[:, None], n)
    return low * threshold.denominator >= high * threshold.numerator


def _likely(runs: int, threshold: Fraction):
    """Rows of a cell with a partner that sizes and first tokens do not rule out."""
    orders = runs * DEPTH
    matches = least_matches(orders, float(threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            cell = table.column("cell").to_numpy()
            block, n = table.column("block").to_numpy(), table.column("n").to_numpy()
            cross, of_run = table.column("cross").to_numpy(), table.column("run").to_numpy()
            labels = _matrix(table.column("labels"), runs)
            first = _matrix(table.column("first"), orders)
            wanted = np.zeros(len(cell), bool)
            starts = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
            for a, b in zip(starts, [*starts[1:], len(cell)]):
                if b - a < 2:
                    continue
                pairs = _new_pairs(labels[a:b], int(of_run[a]), block[a:b], bool(cross[a]))
                pairs &= _sizes_fit(n[a:b], threshold)
                if pairs.any():
                    same = np.zeros(pairs.shape, np.int32)
                    for k in range(orders):
                        same += first[a:b, k][:, None] == first[a:b, k]
                    wanted[a:b] = (pairs & (same >= matches)).any(1)
            keep = table.filter(pa.array(wanted)).select(
                ["class", "run", "cell", "block", "cross", "n", "labels"]
            )
            yield from keep.combine_chunks().to_batches()

    return run


def _shared(tokens: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    flat, g = np.concatenate(tokens), len(tokens)
    owner = np.repeat(np.arange(g), [len(t) for t in tokens])
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    common = times > 1
    column = np.cumsum(common) - 1
    at = common[place]
    rows, columns = owner[at], column[place[at]]
    total = int(common.sum())
    out = np.zeros((g, g), np.float64)
    step = max(1, 4_000_000 // g)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for begin in range(0, total, step):
        a, b = np.searchsorted(columns, [begin, begin + step])
        dense = np.zeros((g, min(step, total - begin)), np.float32)
        dense[rows[a:b], columns[a:b] - begin] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


def _verify(runs: int, threshold: Fraction):
    """Per class of a cell: its links found here, and the least class it hangs together with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            cell = table.column("cell").to_numpy()
            block, n = table.column("block").to_numpy(), table.column("n").to_numpy()
            cross, of_run = table.column("cross").to_numpy(), table.column("run").to_numpy()
            labels = _matrix(table.column("labels"), runs)
            names = table.column("class").to_pylist()
            raw = table.column("tokens").to_pylist()
            out: list[tuple[bytes, bytes, int]] = []
            starts = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)]):
                if b - a < 2:
                    continue
                pairs = _new_pairs(labels[a:b], int(of_run[a]), block[a:b], bool(cross[a]))
                pairs &= _sizes_fit(n[a:b], threshold)
                if not pairs.any():
                    continue
                both = _shared([np.frombuffer(t, "<u8") for t in raw[a:b]])
                union = n[a:b][:, None] + n[a:b] - both
                pairs &= both * threshold.denominator >= union * threshold.numerator
                least = np.arange(b - a)
                while True:
                    near = np.where(pairs, least, b - a).min(1)
                    now = np.minimum(least, near)
                    now = now[now]
                    if np.array_equal(now, least):
                        break
                    least = now
                links = pairs.sum(1)
                out += [
                    (names[a + i], names[a + int(least[i])], int(links[i]))
                    for i in np.flatnonzero(links).tolist()
                ]
            yield pa.record_batch(
                [
                    pa.array([o[0] for o in out], pa.binary()),
                    pa.array([o[1] for o in out], pa.binary()),
                    pa.array([o[2] for o in out], pa.int64()),
                ],
                names=["class", "with", "links"],
            )

    return run


def _by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition("cell").sortWithinPartitions("cell", "class")


def similarity_join(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
) -> DataFrame:
    """Per row doc_id, text_hash, class_id, copy_id, n_links.

    Sets are the distinct shingles of ``width`` words, in lower case, between ASCII white
    space; a shorter text has one shingle.  ``copy_id`` is the least id among documents with
    the same set, ``n_links`` the number of other sets with a Jaccard similarity of
    ``threshold`` or more, ``class_id`` the least id among all that links connect.  Texts
    without words (null, empty) are copies of each other without links.  A null id counts
    only where a class has no other; repeated rows are copies.  ``text_hash`` (xxhash64 of
    the text) tells rows with the same id apart.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    exact = Fraction(str(threshold))
    runs = runs_for(recall, threshold)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    sketches = keep_table(
        rows.mapInArrow(
            _sketch(width, runs * DEPTH),
            "doc_id long, text_hash long, class binary, n long, first array<long>",
        ),
        "join-sketches",
    )
    classes = keep_table(
        sketches.groupBy("class").agg(
            F.min("doc_id").alias("copy_id"), F.min("n").alias("n"), F.any_value("first").alias("first")
        ),
        "join-classes",
    )
    buckets = _buckets(classes.where("n > 0"), runs, BLOCK // 4)
    labels = buckets.groupBy("class").agg(
        F.map_from_entries(F.collect_list(F.struct("run", "bucket"))).alias("met")
    )
    labels = labels.select(
        "class",
        F.transform(
            F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.coalesce(F.col("met")[r], F.lit(0))
        ).alias("labels"),
    )
    candidates = keep_table(classes.join(labels, "class").drop("copy_id"), "join-candidates")
    likely = _by_cell(_cells(buckets).join(candidates, "class")).mapInArrow(
        _likely(runs, exact),
        "class binary, run int, cell long, block int, cross boolean, n long, labels array<long>",
    )
    likely = keep_table(likely, "join-likely")
    drop_table(buckets)
    drop_table(candidates)

    wanted = classes.join(likely.select("class").distinct(), "class", "left_semi")
    wanted = keep_table(wanted.select(F.col("copy_id").alias("id"), "class"), "join-wanted")
    ids = wanted.select("id").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    texts = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    sets = texts.mapInArrow(_sets_again(width), "class binary, tokens binary")
    sets = keep_table(
        sets.join(wanted.select("class"), "class", "left_semi")
        .groupBy("class")
        .agg(F.any_value("tokens").alias("tokens")),
        "join-sets",
    )
    found = _by_cell(likely.join(sets, "class")).mapInArrow(
        _verify(runs, exact), "class binary, with binary, links long"
    )
    found = keep_table(found, "join-found")
    for table in (likely, wanted, sets):
        drop_table(table)

    groups = components(
        found.where(F.col("class") != F.col("with")).select(
            F.col("class").alias("a"), F.col("with").alias("b")
        )
    )
    n_links = found.groupBy("class").agg(F.sum("links").alias("n_links"))
    linked = (
        classes.select("class", "copy_id")
        .join(n_links, "class", "left")
        .join(groups.select(F.col("node").alias("class"), "group"), "class", "left")
        .withColumn("group", F.coalesce("group", "class"))
    )
    linked = keep_table(linked, "join-linked")
    # a table of its own, so that the join can split a large group
    least = keep_table(
        linked.groupBy("group").agg(F.min("copy_id").alias("class_id")), "join-least"
    )
    result = keep_table(
        linked.join(least, "group").select(
            "class", "class_id", "copy_id", F.coalesce("n_links", F.lit(0)).alias("n_links")
        ),
        "join-result",
    )
    for table in (classes, found, linked, least):
        drop_table(table)
    return sketches.select("doc_id", "text_hash", "class").join(result, "class").drop("class")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group that links connect: that of the least id.

    Rows without an id stay, as nothing names them.  Rows that repeat an id and a text stay
    or go together.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    joined = similarity_join(docs, **options)
    gone = keep_table(
        joined.where(F.col("doc_id") != F.col("class_id"))
        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
        .distinct(),
        "join-gone",
    )
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    def column(name: str):
        return F.col("`" + name.replace("`", "``") + "`")

    # the caller's columns go into one, so that no name of theirs meets one of ours
    keyed = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
        column(id_col).cast("long").alias("id"),
        F.xxhash64(column(text_col)).alias("hash"),
    )
    return keyed.join(gone, ["id", "hash"], "left_anti").select("row.*")


def op7_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join(documents(spark, sf_dir)).drop("text_hash")


QUERIES = {"op7_chosen_path_join": op7_chosen_path_join}
SQL: dict[str, str] = {}
