"""Best-fit packing of documents into sequences by bin completion."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keep_table, ship
from .tokens import default_tokenizer, encoder, slices

PIECES = (
    "doc_id long, piece int, start long, length long, ids binary, "
    "sequence_id long, offset long, settled boolean"
)
SECOND_ROUND = 10_000  # pieces of a task of the second round


# ---- one bin problem -------------------------------------------------------


def _largest(mask: int, most: int) -> int:
    """The largest size in the set ``mask`` that is at most ``most``; 0 if there is none."""
    below = mask & ((1 << (most + 1)) - 1) if most > 0 else 0
    return below.bit_length() - 1 if below else 0


def _best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each size goes to the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_spaces = 0
    for size in sizes:
        fitting = open_spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            at = by_space[space].pop()
            if not by_space[space]:
                open_spaces &= ~(1 << space)
        else:
            space, at = capacity, len(bins)
            bins.append([])
        bins[at].append(size)
        if space > size:
            by_space[space - size].append(at)
            open_spaces |= 1 << (space - size)
    return bins


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: total size, and items too large to share a bin."""
    sizes = np.arange(capacity + 1)
    total = int((counts * sizes).sum())
    best = -(-total // capacity)
    n_upto = np.cumsum(counts)
    s_upto = np.cumsum(counts * sizes)
    for k in range(0, capacity // 2 + 1, max(1, capacity // 128)):
        # over capacity - k: alone even among items of k; over half: one to a bin
        alone = int(n_upto[capacity] - n_upto[capacity - k])
        large = int(n_upto[capacity - k] - n_upto[capacity // 2])
        s_large = int(s_upto[capacity - k] - s_upto[capacity // 2])
        s_mid = int(s_upto[capacity // 2] - (s_upto[k - 1] if k else 0))
        rest = max(0, -(-(s_mid - (large * capacity - s_large)) // capacity))
        best = max(best, alone + large + rest)
    return best


def _fillings(counts: list[int], mask: int, space: int, width: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``space``, least waste first, ``width`` at most.

    A filling is dominated if one of its items can give way to a larger one that fits.
    """
    if not _largest(mask, space):
        return [()]
    found: dict[tuple[int, ...], int] = {}
    used: dict[int, int] = {}
    filling: list[int] = []
    tries = 16 * width

    def free(most: int) -> int:
        size = _largest(mask, most)
        while size and counts[size] <= used.get(size, 0):
            size = _largest(mask, size - 1)
        return size

    def grow(left: int, most: int) -> bool:
        """Add items of at most ``most``, larger ones first; true ends the search."""
        nonlocal tries
        if not free(left):  # nothing fits any more
            tries -= 1
            if not any(free(s + left) > s for s in used):
                found[tuple(filling)] = left
            return not left or tries <= 0
        size = free(min(left, most))
        while size:
            filling.append(size)
            used[size] = used.get(size, 0) + 1
            end = grow(left - size, size)
            filling.pop()
            used[size] -= 1
            if not used[size]:
                del used[size]
            if end:
                return True
            size = free(size - 1)
        return False

    grow(space, space)
    if not found:  # only dominated ones within the tries: best fit
        size, left = free(space), space
        while size:
            filling.append(size)
            used[size] = used.get(size, 0) + 1
            left -= size
            size = free(left)
        found[tuple(filling)] = left
    return sorted(found, key=lambda f: (found[f], len(f)))[:width]


def complete_bins(
    sizes: np.ndarray, capacity: int, width: int = 4, extra_nodes: int = 4000
) -> list[list[int]]:
    """Bins, as lists of sizes, for items of 1 to ``capacity``.

    Branch and bound by bin completion: take the largest item left, branch over the
    undominated fillings around it, cut a branch once its waste rules out a better packing
    than the incumbent.  The best-fit packing is the first incumbent; the search ends when
    the lower bound is met, or after one node per bin and ``extra_nodes`` for turning back.
    """
    histogram = np.bincount(sizes, minlength=capacity + 1)
    incumbent = _best_fit(sorted(sizes.tolist(), reverse=True), capacity)
    least = lower_bound(histogram, capacity)
    if len(incumbent) <= least:
        return incumbent
    total = int(sizes.sum())
    counts = histogram.tolist()
    mask = sum(1 << s for s in range(1, capacity + 1) if counts[s])
    nodes = len(incumbent) + extra_nodes
    # per bin on the way down: its fillings, which comes next, the waste before it
    path: list[tuple[list[list[int]], int, int]] = []

    def change(bin_: list[int], by: int) -> None:
        nonlocal mask
        for s in bin_:
            counts[s] += by
            if by > 0:
                mask |= 1 << s
            elif not counts[s]:
                mask &= ~(1 << s)

    chosen: list[list[int]] = []
    waste = 0
    while True:
        largest = _largest(mask, capacity)
        if not largest:
            if len(chosen) < len(incumbent):
                incumbent = [list(b) for b in chosen]
            options: list[list[int]] = []
        elif not nodes:
            return incumbent
        else:
            nodes -= 1
            counts[largest] -= 1
            held = mask if counts[largest] else mask & ~(1 << largest)
            options = [
                [largest, *f] for f in _fillings(counts, held, capacity - largest, width)
            ]
            counts[largest] += 1
        path.append((options, 0, waste))
        while path:
            options, at, before = path[-1]
            if len(chosen) == len(path):
                change(chosen.pop(), 1)
            if len(incumbent) <= least:
                return incumbent
            if at < len(options) and (
                before + capacity - sum(options[at])
                <= (len(incumbent) - 1) * capacity - total
            ):
                path[-1] = (options, at + 1, before)
                change(options[at], -1)
                chosen.append(options[at])
                waste = before + capacity - sum(options[at])
                break
            path.pop()
        if not path:
            return incumbent


def place(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each item its bin and its place there; for each bin its free space."""
    bins = complete_bins(sizes, capacity)
    by_size = np.argsort(sizes, kind="stable")
    next_of = np.searchsorted(sizes[by_size], np.arange(capacity + 2))
    bin_of = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    free = np.empty(len(bins), np.int64)
    for b, items in enumerate(bins):
        at = 0
        for s in items:
            i = by_size[next_of[s]]
            next_of[s] += 1
            bin_of[i], offset[i] = b, at
            at += s
        free[b] = capacity - at
    return bin_of, offset, free


# ---- on Spark --------------------------------------------------------------


class _Window:
    """Pieces of some documents, until they are packed."""

    def __init__(self, rows: list[tuple] | None = None):
        self.rows = rows or []  # doc_id, piece, start, length, ids
        self.tokens = sum(r[3] for r in self.rows)

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.tokens += row[3]

    def pack(self, capacity: int, base: int, carry: int) -> tuple[pa.RecordBatch | None, list, int]:
        """Packed rows; rows of the ``carry`` emptiest bins; the next free bin number."""
        if not self.rows:
            return None, [], base
        bin_of, offset, free = place(np.array([r[3] for r in self.rows], np.int64), capacity)
        back = set()
        if carry:
            back = {int(b) for b in np.argsort(-free, kind="stable")[:carry] if free[b]}
        stay = [i for i, b in enumerate(bin_of.tolist()) if b not in back]
        left = [self.rows[i] for i in range(len(self.rows)) if int(bin_of[i]) in back]
        batch = _rows([self.rows[i] for i in stay], bin_of[stay] + base, offset[stay], True)
        return batch, left, base + len(free)


def _rows(rows: list[tuple], sequences, offsets, settled: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    n = len(rows)
    return pa.record_batch(
        [
            pa.array(columns[0], pa.int64()),
            pa.array(columns[1], pa.int32()),
            pa.array(columns[2], pa.int64()),
            pa.array(columns[3], pa.int64()),
            pa.array(columns[4], pa.binary()),
            pa.array(sequences, pa.int64()),
            pa.array(offsets, pa.int64()),
            pa.array([settled] * n, pa.bool_()),
        ],
        names=[c.split()[0] for c in PIECES.split(", ")],
    )


def _first_round(path: str, capacity: int, end_id: int, window: int, carry: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        base = TaskContext.get().partitionId() << 32
        held = _Window()
        for batch in batches:
            for part in slices(batch, 1):
                ids, counts = code.encode(part.column(1))
                at = 0
                for doc, n in zip(part.column(0).to_pylist(), counts.tolist()):
                    raw = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    # one shorter piece at most, and it comes first
                    to, begin, piece = len(raw) % capacity or capacity, 0, 0
                    while begin < len(raw):
                        held.add((doc, piece, begin, to - begin, raw[begin:to].tobytes()))
                        begin, to, piece = to, to + capacity, piece + 1
                if held.tokens >= window:
                    out, left, base = held.pack(capacity, base, carry)
                    held = _Window(left)
                    yield out
        out, left, base = held.pack(capacity, base, carry)
        if out is not None:
            yield out
        if left:
            yield _rows(left, [None] * len(left), [None] * len(left), False)

    return run


def _second_round(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (1 << 62) + (TaskContext.get().partitionId() << 32)
        # a task's rows, some SECOND_ROUND pieces, are packed together however they are batched;
        # their ids stay in Arrow's memory
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).select(range(5))
        bin_of, offset, _ = place(table.column("length").to_numpy(), capacity)
        for name, column in (
            ("sequence_id", pa.array(bin_of + base)),
            ("offset", pa.array(offset)),
            ("settled", pa.array(np.ones(len(offset), bool))),
        ):
            table = table.append_column(name, column)
        yield from table.to_batches()

    return run


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 1024,
    end_id: int = 2,
    tokenizer: str | None = None,
    window_tokens: int = 1 << 22,
    carry_bins: int = 32,
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``length`` tokens.

    A document is the ids of its text and ``end_id``.  Only longer ones are cut, so that all
    pieces but the first are full.  Each task packs windows of ``window_tokens`` by bin
    completion; the ``carry_bins`` emptiest bins of a window go on to the next, those of a
    task's last window to a second round over all tasks.  Nothing is shuffled but these.

    Null or empty text: one piece with the end id.  A null id stays null, repeated rows are
    documents of their own, an empty table gives no rows, other columns are left out.
    ``ids`` holds little-endian unsigned 32-bit ids; ``sequence_id`` is unique, no more.
    """
    ship(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = keep_table(
        texts.mapInArrow(_first_round(path, length, end_id, window_tokens, carry_bins), PIECES),
        "pack-pieces",
    )
    left = first.where(~F.col("settled"))
    tasks = max(1, -(-left.count() // SECOND_ROUND))
    again = left.repartition(tasks).mapInArrow(_second_round(length), PIECES)
    return first.where("settled").unionByName(again).drop("settled")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir))
    return pieces.select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


QUERIES = {"op1_best_fit_packing": op1_best_fit_packing}
SQL: dict[str, str] = {}
