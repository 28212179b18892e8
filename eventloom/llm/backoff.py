"""Stupid-backoff scores of documents from n-gram counts over all of them.

Rows of single n-grams would make the shuffle many times the text, so n-grams travel in packed
form.  Documents are gathered in windows.  A window sends each hash bucket its distinct
n-grams with their counts; the bucket adds up its count table and answers each window, in the
same order, with the totals.  The window joins the answers to its positions and sums the logs
of each document.  A document is scored by the counts of all others: its own are taken off.

The buckets are asked in ``PARTS``, one after another.  Answers are kept as tables, so that the
n-grams of one part only lie on disk at a time.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keep_table, ship
from .tokens import slices
from .words import mix, word_hashes

BACKOFF = 0.4
PARTS = 2  # a power of two


def gram_hashes(texts: pa.Array, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text; per order the n-grams that end at each position; which of these exist."""
    words, counts = word_hashes(texts)
    n = len(words)
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes, valid = [], []
    for k in range(1, order + 1):
        salted = np.full(n, k, np.uint64)
        grams = np.zeros(n, np.uint64)
        if n >= k:  # ends at its position, starts k - 1 words before
            grams[k - 1 :] = mix(salted[k - 1 :], *[words[i : n - k + 1 + i] for i in range(k)])
        hashes.append(grams)
        valid.append(place >= k - 1)
    return counts, hashes, valid


def part_grams(texts: pa.Array, order: int, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of the texts in a part of the hashes, and how often they occur."""
    _, hashes, valid = gram_hashes(texts, order)
    held = []
    for grams, here in zip(hashes, valid):
        if parts > 1:
            here = here & (grams >> np.uint64(65 - parts.bit_length()) == np.uint64(part))
        held.append(grams[here])
    return np.unique(np.concatenate(held), return_counts=True)


class Grams:
    """n-grams of some texts: of each position and order, and of each text."""

    def __init__(self, texts: pa.Array, order: int):
        self.counts, hashes, self.valid = gram_hashes(texts, order)
        n = len(hashes[0])
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        valid = np.concatenate(self.valid) if n else np.zeros(0, bool)
        flat = np.concatenate(hashes)[valid] if n else np.zeros(0, np.uint64)
        self.distinct, which, self.times = np.unique(flat, return_inverse=True, return_counts=True)
        self.which = np.full((order, n), -1, np.int64)
        self.which[np.array(self.valid).reshape(order, n)] = which

    def own(self) -> np.ndarray:
        """How often the text of a position holds the n-gram that ends there, per order."""
        out = np.zeros(self.which.shape, np.int64)
        for k, valid in enumerate(self.valid):
            key = self.text[valid] * (len(self.distinct) + 1) + self.which[k, valid]
            _, back, times = np.unique(key, return_inverse=True, return_counts=True)
            out[k, valid] = times[back]
        return out

    def log_scores(self, totals: np.ndarray, all_words: int) -> np.ndarray:
        """Sum of log scores per text; ``totals`` are the counts of ``distinct`` over all."""
        n = self.which.shape[1]
        seen = np.where(self.which >= 0, totals[self.which], 0) - self.own() if n else self.which
        return self.log_sums(seen, all_words)

    def log_sums(self, seen: np.ndarray, all_words: int) -> np.ndarray:
        """The same from ``seen``, per order and position the count in other texts."""
        order, n = self.which.shape
        rest = np.maximum(all_words - self.counts, 1)[self.text]
        # a word that no other text holds counts as one
        score = np.log(np.maximum(seen[0], 1) / rest) if n else np.zeros(0)
        for k in range(1, order):
            # the context ends one word earlier; its own count excludes the same text
            context = np.zeros(n, np.int64)
            context[1:] = seen[k - 1][:-1]
            hit = (seen[k] > 0) & self.valid[k]
            ratio = np.log(np.where(hit, seen[k], 1) / np.maximum(context, 1))
            score = np.where(hit, ratio, np.where(self.valid[k], score + math.log(BACKOFF), score))
        return np.bincount(self.text, score, minlength=len(self.counts))


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def pack_grams(grams: np.ndarray, base: int) -> bytes:
    """Sorted hashes from ``base`` on as differences, in as few bytes each as they need."""
    steps = np.diff(grams, prepend=np.uint64(base))
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    rows = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(rows).tobytes()


def unpack_grams(data: bytes, base: int) -> np.ndarray:
    width = data[0]
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, :width] = rows
    return np.cumsum(wide.view("<u8").reshape(-1), dtype=np.uint64) + np.uint64(base)


def _windows(window_bytes: int):
    """Texts of a task in windows, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                out.write_table(table)
            return pa.record_batch(
                [pa.array([base + number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["window", "texts"],
            )

        for batch in batches:
            for part in slices(batch, 1):
                held.append(part)
                size += part.nbytes
                if size >= window_bytes:
                    yield close()
                    held, size, number = [], 0, number + 1
        if held:
            yield close()

    return run


def _texts(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def _ask(order: int, bucket_bits: int, part: int, parts: int):
    """Per window and bucket of a part of all buckets the distinct n-grams and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for window, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, times = part_grams(_texts(data).column(1).combine_chunks(), order, part, parts)
                top = (grams >> np.uint64(64 - bucket_bits)).astype(np.int64)
                starts = np.flatnonzero(np.diff(top, prepend=-1))
                ends = [*starts[1:].tolist(), len(top)]
                starts = starts.tolist()
                yield pa.record_batch(
                    [
                        pa.array(top[starts]),
                        pa.array([window] * len(starts), pa.int64()),
                        pa.array(
                            [
                                pack_grams(grams[a:b], int(top[a]) << (64 - bucket_bits))
                                for a, b in zip(starts, ends)
                            ],
                            pa.binary(),
                        ),
                        pa.array([_pack(times[a:b].astype("<u4")) for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    names=["bucket", "window", "grams", "times"],
                )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Totals of a bucket for each window that asked, in the order it asked."""
    # hashes of a bucket share their base, so the packed differences can start from 0
    grams = [unpack_grams(g, 0) for g in table.column("grams").to_pylist()]
    times = [np.frombuffer(zlib.decompress(t), "<u4") for t in table.column("times").to_pylist()]
    _, which = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(which, np.concatenate(times)).astype(np.int64)[which]
    cuts = np.cumsum([len(g) for g in grams])[:-1]
    return pa.table(
        {
            "window": table.column("window"),
            "bucket": table.column("bucket"),
            "data": pa.array([_pack(t.astype("<i8")) for t in np.split(totals, cuts)], pa.binary()),
        }
    )


def _score(order: int, all_words: int):
    """A window's texts (bucket -1) and its answers, in order of window and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, data, answers = None, None, []

        def close() -> pa.RecordBatch:
            table = _texts(data)
            grams = Grams(table.column(1).combine_chunks(), order)
            totals = np.concatenate([np.zeros(0, np.int64), *answers])
            score = grams.log_scores(totals, all_words)
            return pa.record_batch(
                [
                    table.column(0).combine_chunks(),
                    pa.array(grams.counts, pa.int64()),
                    pa.array(score, pa.float64()),
                ],
                names=["doc_id", "n_words", "log_score"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if row["window"] != window:
                    if data is not None:
                        yield close()
                    window, data, answers = row["window"], row["data"], []
                else:
                    answers.append(np.frombuffer(zlib.decompress(row["data"]), "<i8"))
        if data is not None:
            yield close()

    return run


def backoff_scores(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 3,
    window_bytes: int = 8_000_000,
    bucket_grams: int = 1 << 20,
) -> DataFrame:
    """Per row doc_id, n_words, log_score: the sum of natural logs of stupid-backoff scores.

    The score of a word after its ``order - 1`` words before is the share of their n-gram
    count in that of the context, if any other document holds the n-gram; else it is 0.4
    times the score after one word less.  A single word's is its share of all words, a word
    that no other document holds counting as one.  Words are in lower case, between ASCII
    white space.  Counts are over all documents but the one scored; copies are others.

    Null or empty text has no words and a score of 0.  A null id is kept, repeated rows are
    documents of their own, an empty table gives no rows, other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    windows = keep_table(
        texts.mapInArrow(_windows(window_bytes), "window long, texts binary"), "backoff-windows"
    )
    counted = texts.select(
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).alias("n")
    )
    all_words = int(counted.agg(F.sum("n")).first()[0] or 0)
    bucket_bits = max(4, (all_words * order // bucket_grams).bit_length())
    both = windows.select("window", F.lit(-1).cast("long").alias("bucket"), F.col("texts").alias("data"))
    for part in range(PARTS):
        asked = windows.mapInArrow(
            _ask(order, bucket_bits, part, PARTS), "bucket long, window long, grams binary, times binary"
        )
        answers = asked.groupBy("bucket").applyInArrow(_answer, "window long, bucket long, data binary")
        both = both.unionByName(keep_table(answers, f"backoff-answers{part}"))
    return (
        both.repartition("window")
        .sortWithinPartitions("window", "bucket")
        .mapInArrow(_score(order, all_words), "doc_id long, n_words long, log_score double")
    )


# ---- the same with rows for n-grams ----------------------------------------


def _gram_rows(order: int):
    """row, gram, own: the distinct n-grams of each text and how often it holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                grams = Grams(part.column(1), order)
                held = max(1, len(grams.distinct))
                here = grams.which >= 0
                pairs = (grams.text * held + grams.which)[here]
                pairs, own = np.unique(pairs, return_counts=True)
                row = part.column(0).to_numpy()
                yield pa.record_batch(
                    [
                        pa.array(row[pairs // held], pa.int64()),
                        pa.array(grams.distinct[pairs % held].view(np.int64), pa.int64()),
                        pa.array(own, pa.int64()),
                    ],
                    names=["row", "gram", "own"],
                )

    return run


def _score_rows(order: int, all_words: int):
    """doc_id, n_words, log_score of texts with the counts of their n-grams in other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                grams = Grams(part.column(1), order)
                held = max(1, len(grams.distinct))
                lists = part.column(2)
                text = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0))
                found = lists.flatten()
                hashes = found.field("gram").to_numpy().view(np.uint64)
                keys = text * held + np.searchsorted(grams.distinct, hashes)
                by_key = np.argsort(keys)
                keys = np.append(keys[by_key], np.iinfo(np.int64).max)
                counts = np.append(found.field("seen").to_numpy()[by_key], 0)
                asked = grams.text * held + grams.which
                at = np.searchsorted(keys, asked)
                seen = np.where((keys[at] == asked) & (grams.which >= 0), counts[at], 0)
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array(grams.counts, pa.int64()),
                        pa.array(grams.log_sums(seen, all_words), pa.float64()),
                    ],
                    names=["doc_id", "n_words", "log_score"],
                )

    return run


def relational_scores(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = 3
) -> DataFrame:
    """What ``backoff_scores`` returns, by a count table joined to a row per n-gram of a text.

    Needs far more disk, as every n-gram of a text is a row of two shuffles.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = keep_table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(text_col).alias("text"),
            F.col(id_col).cast("long").alias("doc_id"),
        ),
        "backoff-texts",
    )
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    all_words = int(texts.agg(F.sum(words)).first()[0] or 0)
    rows = texts.select("row", "text").mapInArrow(_gram_rows(order), "row long, gram long, own long")
    # an n-gram of one text has no count in others
    counts = rows.groupBy("gram").agg(F.sum("own").alias("total"), F.count(F.lit(1)).alias("texts"))
    counts = keep_table(counts.where("texts > 1").select("gram", "total"), "backoff-counts")
    seen = rows.join(counts, "gram").select(
        "row", F.struct("gram", (F.col("total") - F.col("own")).alias("seen")).alias("found")
    )
    lists = seen.groupBy("row").agg(F.collect_list("found").alias("found"))
    return (
        texts.join(lists, "row", "left")
        .select("doc_id", "text", "found")
        .mapInArrow(_score_rows(order, all_words), "doc_id long, n_words long, log_score double")
    )


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(documents(spark, sf_dir))


QUERIES = {"op3_stupid_backoff": op3_stupid_backoff}
SQL: dict[str, str] = {}
