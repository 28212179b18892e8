"""Token ids as canonical length-limited Huffman codes in blocks that decode on their own.

File format: a folder with two Parquet tables.

* ``code``: ``id``, ``bits``.  The length of each id's code; codes follow by the canonical rule
  (shorter first, then smaller id, each one more than the last).
* ``blocks``: documents in ascending order of doc_id, ``part`` by ``part`` and ``block`` by
  ``block``.  ``doc_ids`` (little-endian int64), ``no_id`` (a byte per document, 1 if its id is
  null) and ``counts`` (little-endian uint32 tokens per document) describe the documents;
  ``bits`` holds their codes, most significant bit first, each document from a new byte on;
  ``steps`` (little-endian uint16) has the bits of every ``STEP`` tokens of a document, whose
  sums are the checkpoints from which all pieces of a block are decoded at the same time.
  ``before`` is the number of tokens of earlier blocks of the part, ``tokens`` that of the block.

Spark writes and reads the tables, so the format works in any store that Spark can reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, keep_table, scratch_path, ship
from .tokens import default_tokenizer, encoder, slices

STEP = 64
LONGEST = 20  # bits of a code
MOST_PARTS = 10_000


# ---- the code --------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code with none over ``limit``; 0 for a count of 0.

    Package-merge: at each level leaves and pairs of the level before are merged by weight;
    the 2n - 2 lightest of the last level, followed down, say how often each leaf counts.
    """
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, kinds = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[0 : len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        kinds.append(by < n)
    take = 2 * n - 2
    for is_leaf in reversed(kinds):
        taken = int(is_leaf[:take].sum())
        lengths[order[:taken]] += 1
        take = 2 * (take - taken)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all symbols; the symbols that have one in the order of their codes."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        size = lengths[order]
        space = np.left_shift(1, int(size.max()) - size)
        codes[order] = (np.cumsum(space) - space) >> (size.max() - size)
    return codes, order


def encode(
    ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all documents, bytes per document, steps, steps per document."""
    size = lengths[ids]
    ends = np.cumsum(size)
    doc_end = np.cumsum(counts)
    upto = np.concatenate([[0], ends])[np.concatenate([[0], doc_end])]
    n_bytes = -(-np.diff(upto) // 8)
    shift = 8 * (np.cumsum(n_bytes) - n_bytes) - upto[:-1]
    at = ends - size + np.repeat(shift, counts)
    place = codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
    word = at >> 5
    n_words = int(n_bytes.sum()) // 4 + 2
    # the bits of a word are disjoint, so sums are exact and equal to a bitwise or
    words = np.bincount(word, (place >> np.uint64(32)).astype(np.float64), n_words)
    words += np.bincount(word + 1, (place & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
    data = words.astype(">u4").view(np.uint8)[: int(n_bytes.sum())]
    within = np.arange(len(ids)) - np.repeat(doc_end - counts, counts)
    first = np.flatnonzero(within % STEP == 0)
    steps = np.add.reduceat(size, first) if len(first) else np.zeros(0, np.int64)
    return data, n_bytes, steps.astype("<u2"), -(-counts // STEP)


def decode(
    data: np.ndarray, steps: np.ndarray, counts: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Ids of the documents of a block."""
    _, order = canonical(lengths)
    longest = int(lengths.max()) if len(order) else 1
    # by the next bits: which symbol, how long
    spread = np.left_shift(1, longest - lengths[order])
    symbol, used = np.repeat(order, spread), np.repeat(lengths[order], spread)
    per_doc = -(-counts // STEP)
    doc = np.repeat(np.arange(len(counts)), per_doc)
    bits = steps.astype(np.int64)
    ends = np.cumsum(bits)
    last = np.cumsum(per_doc)
    upto = np.concatenate([[0], ends])[np.concatenate([[0], last])]
    n_bytes = -(-np.diff(upto) // 8)
    at = ends - bits - upto[:-1][doc] + (8 * (np.cumsum(n_bytes) - n_bytes))[doc]
    within = np.arange(len(doc)) - np.repeat(last - per_doc, per_doc)
    todo = np.minimum(STEP, counts[doc] - within * STEP)
    begin = np.repeat(np.cumsum(counts) - counts, per_doc) + within * STEP
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    ids = np.zeros(int(counts.sum()), np.uint32)
    mask = (1 << longest) - 1
    going = np.arange(len(doc))
    for k in range(STEP):
        going = going[todo[going] > k]
        if not len(going):
            break
        a = at[going]
        next_bits = (window[a >> 3].astype(np.int64) >> (32 - longest - (a & 7))) & mask
        ids[begin[going] + k] = symbol[next_bits]
        at[going] = a + used[next_bits]
    return ids


# ---- on Spark --------------------------------------------------------------


def _tokens(path: str, end_id: int):
    """Per document its ids; at the end of a task how often it saw each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        size = len(code.n_bytes)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        seen = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, 1):
                ids, counts = code.encode(part.column(1))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                seen += np.bincount(ids, minlength=size)
                raw = ids.astype(kind).view(np.uint8)
                offsets = np.concatenate([[0], np.cumsum(counts)]) * np.dtype(kind).itemsize
                yield pa.record_batch(
                    [
                        pa.array([False] * len(counts)),
                        part.column(0),
                        pa.array(counts),
                        _binaries(raw, offsets),
                    ],
                    names=["count", "doc_id", "n", "ids"],
                )
        found = np.flatnonzero(seen)
        yield pa.record_batch(
            [
                pa.array([True] * len(found), pa.bool_()),
                pa.array(found, pa.int64()),
                pa.array(seen[found], pa.int64()),
                pa.nulls(len(found), pa.binary()),
            ],
            names=["count", "doc_id", "n", "ids"],
        )

    return run


def _binaries(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(
        pa.binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))],
    )


def _encode(model, bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = model.value
        kind = "<u2" if len(lengths) <= 1 << 16 else "<u4"
        codes, _ = canonical(lengths)
        for batch in batches:
            for part in slices(batch, 2):
                counts = part.column(1).to_numpy()
                ids = np.frombuffer(b"".join(part.column(2).to_pylist()), kind)
                data, n_bytes, steps, n_steps = encode(ids, counts, lengths, codes)
                doc = part.column(0)
                to = np.searchsorted(bounds, doc.fill_null(0).to_numpy(), "left")
                to[doc.is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.record_batch(
                    [
                        pa.array(to, pa.int32()),
                        doc,
                        part.column(1),
                        _binaries(data, np.concatenate([[0], np.cumsum(n_bytes)])),
                        _binaries(
                            steps.view(np.uint8), np.concatenate([[0], np.cumsum(n_steps)]) * 2
                        ),
                    ],
                    names=["part", "doc_id", "n", "bits", "steps"],
                )

    return run


_BLOCK = (
    "part int, block int, before long, tokens long, doc_ids binary, no_id binary, "
    "counts binary, steps binary, bits binary"
)


def _assemble(block_tokens: int):
    """Encoded documents in order to blocks; a block starts anew with each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before, tokens, held = -1, 0, 0, 0, []

        def close() -> pa.RecordBatch:
            docs, ns, bits, steps = zip(*held)
            missing = bytes(d is None for d in docs)
            row = (
                part,
                block,
                before,
                tokens,
                np.array([d or 0 for d in docs], "<i8").tobytes(),
                missing,
                np.array(ns, "<u4").tobytes(),
                b"".join(steps),
                b"".join(bits),
            )
            names = [c.split() for c in _BLOCK.split(", ")]
            kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
            return pa.record_batch(
                [pa.array([v], kinds[k]) for v, (_, k) in zip(row, names)],
                names=[n for n, _ in names],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "bits", "steps")]
            for to, doc, n, bits, steps in zip(*columns):
                if held and (to != part or tokens + n > block_tokens):
                    yield close()
                    block, before, tokens, held = block + 1, before + tokens, 0, []
                if to != part:
                    part, block, before = to, 0, 0
                held.append((doc, n, bits, steps))
                tokens += n
        if held:
            yield close()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    part_tokens: int = 8_000_000,
    block_tokens: int = 1_000_000,
) -> None:
    """Encode every text, and ``end_id`` after it, into the folder ``path``.

    Documents stand in ascending order of their ids, null first; documents with the same id
    in that of their length, then their codes.  Null or empty text is the end id alone.  A
    document of over ``block_tokens`` is a block of its own.  An empty table gives no block.
    """
    spark = docs.sparkSession
    ship(spark)
    file = tokenizer or default_tokenizer()
    staged = keep_table(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
            _tokens(file, end_id), "count boolean, doc_id long, n long, ids binary"
        ),
        "huffman-ids",
    )
    counted = (
        staged.where("count")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.sum("n").alias("n"))
        .collect()  # a row per id of the vocabulary at most
    )
    size = len(encoder(file).n_bytes)
    counts = np.zeros(size, np.int64)
    for row in counted:
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int"
    ).coalesce(1).write.parquet(f"{path}/code")

    texts = staged.where(~F.col("count"))
    parts = int(min(MOST_PARTS, max(1, -(-counts.sum() // part_tokens))))
    shares = [i / parts for i in range(1, parts)]
    bounds = (
        texts.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * parts))).first()[0]
        if shares
        else []
    )
    model = spark.sparkContext.broadcast(lengths)
    coded = texts.select("doc_id", "n", "ids").mapInArrow(
        _encode(model, np.array(bounds or [], np.int64)),
        "part int, doc_id long, n long, bits binary, steps binary",
    )
    (
        coded.repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", "doc_id", "n", "bits")
        .mapInArrow(_assemble(block_tokens), _BLOCK)
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )


def _decode_blocks(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = model.value
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                ids = decode(
                    np.frombuffer(row["bits"], np.uint8),
                    np.frombuffer(row["steps"], "<u2"),
                    counts,
                    lengths,
                )
                ends = np.cumsum(counts)
                missing = np.frombuffer(row["no_id"], np.uint8).astype(bool)
                yield pa.record_batch(
                    [
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=missing),
                        pa.array(ends - counts + row["start"]),
                        pa.array(counts),
                        _binaries(ids.astype("<u4").view(np.uint8), np.concatenate([[0], ends]) * 4),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids (uint32 binary)."""
    ship(spark)
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    code = spark.read.parquet(f"{path}/code").collect()  # the vocabulary at most
    lengths = np.zeros(max([r["id"] for r in code], default=0) + 1, np.int64)
    for row in code:
        lengths[row["id"]] = row["bits"]
    # a row per part, of which there are MOST_PARTS at most
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        blocks.groupBy("part")
        .agg(F.sum("tokens").alias("n"))
        .withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .drop("n")
    )
    model = spark.sparkContext.broadcast(lengths)
    return (
        blocks.join(F.broadcast(base), "part")
        .select(
            (F.col("base") + F.col("before")).alias("start"),
            "doc_ids",
            "no_id",
            "counts",
            "steps",
            "bits",
        )
        .mapInArrow(_decode_blocks(model), "doc_id long, start long, n_tokens long, ids binary")
    )


def op6_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "huffman-files")
    write_tokens(documents(spark, sf_dir), path)
    return read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


QUERIES = {"op6_huffman_tokens": op6_huffman_tokens}
SQL: dict[str, str] = {}
