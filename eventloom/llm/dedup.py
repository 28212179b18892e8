"""Exact dedup: counting quotient filters find repeated fingerprints, bytes decide."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keep_table, ship

WHITE_SPACE = " \t\n\x0b\x0c\r"
BROADCAST_ROWS = 1_000_000  # longs; beyond it the join shuffles


class CountingQuotientFilter:
    """Fingerprints that share their top ``prefix`` bits, with counts, without loss.

    A fingerprint is prefix, quotient and remainder.  A slot per quotient holds the length
    of its run; the runs hold sorted remainders.  Counts over one are kept aside, by place.
    """

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, prefix: int):
        """``fingerprints``: sorted, distinct uint64."""
        self.prefix = prefix
        self.top = int(fingerprints[0]) >> (64 - prefix) if prefix and len(fingerprints) else 0
        self.quotient_bits = max(1, int(len(fingerprints)).bit_length() - 1)
        self.remainder_bits = 64 - prefix - self.quotient_bits
        low = fingerprints & np.uint64((1 << (64 - prefix)) - 1)
        quotients = (low >> np.uint64(self.remainder_bits)).astype(np.int64)
        self.runs = np.bincount(quotients, minlength=1 << self.quotient_bits)
        self.remainders = low & np.uint64((1 << self.remainder_bits) - 1)
        self.more = np.flatnonzero(counts > 1)
        self.counts = counts[self.more].astype(np.int64)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints in order, and their counts."""
        quotients = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        found = (quotients << np.uint64(self.remainder_bits)) | self.remainders
        if self.prefix:
            found |= np.uint64(self.top << (64 - self.prefix))
        counts = np.ones(len(found), np.int64)
        counts[self.more] = self.counts
        return found, counts

    def to_bytes(self) -> bytes:
        width = -(-self.remainder_bits // 8)
        remainders = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = struct.pack(
            "<BQBQQ", self.prefix, self.top, self.quotient_bits, len(remainders), len(self.more)
        )
        return b"".join(
            [
                head,
                self.runs.astype("<u4").tobytes(),
                np.ascontiguousarray(remainders).tobytes(),
                self.more.astype("<u8").tobytes(),
                self.counts.astype("<u8").tobytes(),
            ]
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        new = cls.__new__(cls)
        new.prefix, new.top, new.quotient_bits, n, m = struct.unpack_from("<BQBQQ", data)
        new.remainder_bits = 64 - new.prefix - new.quotient_bits
        at, width = struct.calcsize("<BQBQQ"), -(-new.remainder_bits // 8)
        new.runs = np.frombuffer(data, "<u4", 1 << new.quotient_bits, at).astype(np.int64)
        at += 4 << new.quotient_bits
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        new.remainders = wide.view("<u8").reshape(-1).astype(np.uint64)
        at += n * width
        new.more = np.frombuffer(data, "<u8", m, at).astype(np.int64)
        new.counts = np.frombuffer(data, "<u8", m, at + 8 * m).astype(np.int64)
        return new


def merge_entries(
    parts: list[tuple[np.ndarray, np.ndarray]],
) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted fingerprints; equal ones add their counts."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(found, kind="stable")
    found, counts = found[order], counts[order]
    first = np.flatnonzero(np.diff(found, prepend=found[:1] + np.uint64(1)) != 0)
    return found[first], np.add.reduceat(counts, first) if len(first) else counts


def _build_filters(prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, waiting, n = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            waiting.append(np.unique(raw, return_counts=True))
            n += len(raw)
            if n > len(kept[0]) + 1_000_000:
                kept, waiting, n = merge_entries([kept, *waiting]), [], 0
        found, counts = merge_entries([kept, *waiting])
        tops = (found >> np.uint64(64 - prefix)).astype(np.int64)
        starts = np.flatnonzero(np.diff(tops, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(found)]):
            block = CountingQuotientFilter(found[a:b], counts[a:b], prefix)
            yield pa.record_batch(
                [pa.array([tops[a]], pa.int64()), pa.array([block.to_bytes()], pa.binary())],
                names=["range", "filter"],
            )

    return run


def _repeated(table: pa.Table) -> pa.Table:
    filters = [CountingQuotientFilter.from_bytes(b) for b in table.column("filter").to_pylist()]
    found, counts = merge_entries([f.entries() for f in filters])
    return pa.table({"fingerprint": pa.array(found[counts > 1].view(np.int64), pa.int64())})


def repeated_fingerprints(rows: DataFrame, per_range: int = 1 << 19) -> DataFrame:
    """Values of the long column of ``rows`` that occur more than once.

    Each task builds filters of its own rows, one per range of fingerprints; filters of a
    range then merge in one group, of about ``per_range`` fingerprints.
    """
    prefix = max(4, (max(1, rows.count()) // per_range).bit_length())
    blocks = rows.mapInArrow(_build_filters(prefix), "range long, filter binary")
    return blocks.groupBy("range").applyInArrow(_repeated, "fingerprint long")


def without_white_space(text: Column) -> Column:
    for character in WHITE_SPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    fingerprint_bits: int = 64,
) -> DataFrame:
    """Per row its group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after all ASCII white space is deleted; null counts as
    empty.  The row with the most code points stays, then the smallest id; a null id comes
    last.  Of rows that repeat an id with the same text one is kept.  ``carry`` adds the
    whole row as struct ``row``.  An empty table gives no rows.  Fewer ``fingerprint_bits``
    only send more rows to the comparison of bytes.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = without_white_space(text)
    fingerprint = F.xxhash64(body)
    if fingerprint_bits < 64:
        fingerprint = F.shiftleft(fingerprint, 64 - fingerprint_bits)
    repeated = keep_table(
        repeated_fingerprints(docs.select(fingerprint.alias("fingerprint"))), "dedup-repeated"
    )
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("at"),
        F.length(text).alias("n"),
        body.alias("body"),
        fingerprint.alias("fingerprint"),
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry else [id_col])]).alias("row"),
    )
    rows = rows.join(repeated.withColumn("again", F.lit(True)), "fingerprint", "left").select(
        "doc_id",
        "at",
        "n",
        F.sha2("body", 256).alias("text_sha256"),
        F.when(F.col("again"), F.col("body")).alias("body"),
        "row",
    )
    rows = keep_table(rows, "dedup-rows")
    more = ["row"] if carry else []
    alone = rows.where(F.col("body").isNull()).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        *more,
    )
    # bitwise not turns the order of ids round without overflow
    rank = F.struct("n", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("at").alias("at"))
    candidates = rows.where(F.col("body").isNotNull())
    # a table of its own, so that the join can split the copies of a large group
    groups = candidates.groupBy("body").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(rank).alias("best")
    )
    groups = keep_table(groups, "dedup-groups")
    members = candidates.join(groups, "body").select(
        "doc_id",
        F.bitwise_not("best.id").alias("keep_id"),
        "group_size",
        (F.col("at") == F.bitwise_not("best.at")).alias("kept"),
        "text_sha256",
        *more,
    )
    return alone.unionByName(members)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


QUERIES = {"op10_exact_dedup": op10_exact_dedup}
SQL = {
    "op10_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM d WINDOW w AS (PARTITION BY body ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM g
""",
}
