"""Alignment of two tokenizers over a corpus, each distinct text tokenised and aligned once.

Rows are shuffled by their full text and equal ones become one row with its multiplicity.  A
task tokenises the texts it gets with both tokenizers, cuts their tokens into groups where
tokens of both end, and links the tokens whose bytes overlap.  It gathers its texts in windows
and adds up each window's id pairs, weighted by multiplicity, so a pair is one row per window
instead of one per link.  Spark adds these up to corpus counts, marks the pairs whose count is
the highest of their B id, and joins both back to the windows, where the measures of each text
are summed.  They are joined to all documents by a fingerprint (SHA-256) of the text.

Words repeat, so within a task a chunk of text is aligned once: both tokenizers start a token
at a blank or newline that stands between two characters which are not white space.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keep_table, ship
from .tokens import _ODD as ODD
from .tokens import default_tokenizer, slices

BLANK = "▁"
# Pairs a worker keeps numbers for; a window ends and it starts anew beyond that.
MOST_PAIRS = 2_000_000


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Aligned:
    """Units (chunks or texts) one after another: counts, links as pair numbers, group strings.

    ``groups`` has a string per unit, each group ended by a semicolon.  A unit whose tokens do
    not give back its bytes is not ``valid``, has counts of 0 and an empty string.
    """

    COUNTS = ("n_a", "n_b", "n_groups", "n_links")

    def __init__(self, n_a, n_b, n_groups, n_links, links: np.ndarray, groups: pa.Array, valid: np.ndarray):
        self.n_a, self.n_b, self.n_groups, self.n_links = n_a, n_b, n_groups, n_links
        self.links, self.groups, self.valid = links, groups, valid

    @classmethod
    def join(cls, parts: list[Aligned]) -> Aligned:
        counts = [np.concatenate([getattr(p, f) for p in parts]) for f in cls.COUNTS]
        return cls(
            *counts,
            np.concatenate([p.links for p in parts]),
            pa.concat_arrays([p.groups for p in parts]),
            np.concatenate([p.valid for p in parts]),
        )

    def take(self, which: np.ndarray) -> Aligned:
        counts = self.n_links[which]
        total = np.cumsum(counts)
        shift = (np.cumsum(self.n_links) - self.n_links)[which] - total + counts
        links = self.links[np.repeat(shift, counts) + np.arange(total[-1] if len(total) else 0)]
        rest = [getattr(self, f)[which] for f in self.COUNTS[:-1]]
        return Aligned(*rest, counts, links, self.groups.take(pa.array(which)), self.valid[which])

    def gather(self, ends: np.ndarray) -> Aligned:
        """Units joined to longer ones, which stop before ``ends``."""

        def summed(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(values)])[ends], prepend=0)

        valid = summed(~self.valid) == 0
        keep = np.repeat(valid, summed(self.n_links))
        n, offsets, data = len(self.groups), *self.groups.buffers()[1:]
        at = np.frombuffer(offsets, np.int64)[self.groups.offset : self.groups.offset + n + 1]
        cuts = at[np.concatenate([[0], ends])]
        groups = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts.astype(np.int64)), data])
        counts = [summed(getattr(self, f)) * valid for f in self.COUNTS]
        return Aligned(*counts, self.links[keep], groups, valid)


class Aligner:
    """Both tokenizers; remembers aligned chunks, up to ``most_chunks`` of them.

    The memory is a cache only: it is emptied when it is full, and results never depend on it.
    Pairs of ids are numbered as they come; ``forget`` starts anew.
    """

    def __init__(self, path_a: str, path_b: str, most_chunks: int = 250_000):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=path_b)
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        byte = byte_of_character()
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(byte[c] for c in token if c in byte)
        self.n_b = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (a_bytes, b_bytes))
        self.n_ids = max(len(a_bytes), len(b_bytes))
        self.signs = pa.array(
            [f"{i}{mark}" for mark in ",|;" for i in range(self.n_ids)], pa.large_string()
        ).cast(pa.large_binary())
        self.blank = self.b.piece_to_id(BLANK)
        # chunks stand by themselves only if no piece goes on after a word or newline
        self.chunked = not any(
            "\n" in p or any(x != BLANK and y == BLANK for x, y in zip(p, p[1:]))
            for i, p in enumerate(pieces)
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))
        )
        self.most = most_chunks
        self.forget()

    def forget(self) -> None:
        self.pairs = np.zeros(0, np.int64)  # by number
        self._sorted = self._numbers = np.zeros(0, np.int64)
        self._drop_chunks()

    def _drop_chunks(self) -> None:
        self.known: dict[str, int] = {}
        self.memory: Aligned | None = None

    def _numbered(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of pairs; new ones get the next."""
        found, which = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self._sorted, found)
        known = np.zeros(len(found), bool)
        inside = at < len(self._sorted)
        known[inside] = self._sorted[at[inside]] == found[inside]
        numbers = np.empty(len(found), np.int64)
        numbers[known] = self._numbers[at[known]]
        numbers[~known] = np.arange(len(self.pairs), len(self.pairs) + (~known).sum())
        self.pairs = np.concatenate([self.pairs, found[~known]])
        order = np.argsort(self.pairs, kind="stable")
        self._sorted, self._numbers = self.pairs[order], order
        return numbers[which].astype(np.int32)

    def _tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both; ``text`` starts with the blank that B puts in front, or with a newline."""
        ids_b = self.b.encode(text[1:] if text[0] == " " else text)
        if text[0] != " " and ids_b[:1] == [self.blank]:
            ids_b = ids_b[1:]
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, ids_b

    def _same(self, known: pa.Array, ids: np.ndarray, text: bytes) -> bool:
        taken = known.take(pa.array(ids))
        return len(ids) > 0 and taken.buffers()[2].to_pybytes()[: len(text) + 1] == text

    def align_units(self, units: list[str], step: int) -> Aligned:
        """Units that stand by themselves, tokenised ``step`` at a time."""
        sides: tuple[list, list] = ([], [])
        valid = np.ones(len(units), bool)
        for at in range(0, len(units), step):
            some = units[at : at + step]
            text = "".join(some)
            whole = text.encode()
            ids = [np.array(x, np.int64) for x in self._tokens(text)]
            if all(self._same(k, i, whole) for k, i in zip((self.a_bytes, self.b_bytes), ids)):
                sides[0].append(ids[0])
                sides[1].append(ids[1])
            elif len(some) > 1:  # find those that do not come back
                for k, unit in enumerate(some):
                    alone = [np.array(x, np.int64) for x in self._tokens(unit)]
                    good = [self._same(b, i, unit.encode()) for b, i in zip((self.a_bytes, self.b_bytes), alone)]
                    valid[at + k] = all(good)
                    if valid[at + k]:
                        sides[0].append(alone[0])
                        sides[1].append(alone[1])
            else:
                valid[at] = False
        size = np.array([len(u.encode()) for u in units], np.int64) * valid
        flat = [np.concatenate([np.zeros(0, np.int64), *s]) for s in sides]
        return self._linked(*flat, np.cumsum(size), valid)

    def _linked(self, a: np.ndarray, b: np.ndarray, stops: np.ndarray, valid: np.ndarray) -> Aligned:
        """Tokens of units that stop at the bytes ``stops``, where tokens of both end."""
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        n = len(stops)
        if not len(a):
            zeros = np.zeros(n, np.int64)
            empty = pa.array([b""] * n, pa.large_binary())
            return Aligned(zeros, zeros, zeros, zeros, np.zeros(0, np.int32), empty, valid)
        last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a
        last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        shared = ends_a[last_a]
        # a link is where the bytes of two tokens stop being shared: at the next end of either
        ends = np.sort(np.concatenate([ends_a, ends_b[~last_b]]), kind="stable")
        pairs = a[np.searchsorted(ends_a, ends)] * self.n_b + b[np.searchsorted(ends_b, ends)]

        def per_unit(at: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(at, stops, "right"), prepend=0)

        # tokens in the order of groups, A before B
        of_a, of_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        upto_a = np.cumsum(np.bincount(of_a, minlength=len(shared)))
        upto_b = np.cumsum(np.bincount(of_b, minlength=len(shared)))
        signs = np.empty(len(a) + len(b), np.int64)
        signs[np.arange(len(a)) + np.concatenate([[0], upto_b])[of_a]] = a + self.n_ids * last_a
        signs[np.arange(len(b)) + upto_a[of_b]] = b + 2 * self.n_ids * last_b
        strings = self.signs.take(pa.array(signs))
        n_a, n_b = per_unit(ends_a), per_unit(ends_b)
        cuts = np.frombuffer(strings.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(n_a + n_b)])]
        groups = pa.Array.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(cuts.astype(np.int64)), strings.buffers()[2]]
        )
        return Aligned(n_a, n_b, per_unit(shared), per_unit(ends), self._numbered(pairs), groups, valid)

    def _of_plain(self, texts: pa.Array) -> Aligned:
        """Texts that are chunks: neither empty nor with white space at an end or two in a row."""
        marked = pc.replace_substring(texts, " ", "\0 ")
        marked = pc.replace_substring(marked, "\n", "\0\n")
        parts = pc.split_pattern(pc.binary_join_element_wise(" ", marked, ""), "\0")
        ends = parts.offsets.to_numpy()[1:].astype(np.int64) - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) + len(new) > self.most:
                self._drop_chunks()
                new = words
            at = len(self.known)
            learned = self.align_units(new, 2000)
            self.memory = learned if self.memory is None else Aligned.join([self.memory, learned])
            self.known.update(zip(new, range(at, at + len(new))))
        which = np.fromiter((self.known[w] for w in words), np.int64, len(words))
        return self.memory.take(which[coded.indices.to_numpy(zero_copy_only=False)]).gather(ends)

    def align(self, texts: pa.Array) -> Aligned:
        """Space and text for each of ``texts``, none of them null or empty."""
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        if not self.chunked:
            odd = np.ones(len(texts), bool)
        parts = []
        if (~odd).any():
            parts.append(self._of_plain(texts.filter(pa.array(~odd))))
        if odd.any():
            parts.append(self.align_units([" " + t for t in texts.filter(pa.array(odd)).to_pylist()], 1))
        if len(parts) == 1:
            return parts[0]
        place = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        return Aligned.join(parts).take(place)


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this worker, kept from task to task."""
    return Aligner(path_a, path_b)


_WINDOW = (
    "window long, keys array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups array<string>, links binary, pairs array<long>, times array<long>"
)


def _as_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32, all their lowest bytes first: small ones compress to little."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)


def _align(path_a: str, path_b: str, window_bytes: int, with_groups: bool):
    """Texts (key, text, copies) to windows."""

    def close(number: int, held: list[tuple], pairs: np.ndarray) -> pa.RecordBatch:
        n_links = np.concatenate([a.n_links for _, _, a, _ in held])
        times, weight = np.zeros(len(pairs), np.int64), np.zeros(len(pairs))
        for _, copies, found, _ in held:
            times += np.bincount(found.links, minlength=len(pairs))
            weight += np.bincount(found.links, np.repeat(copies, found.n_links), minlength=len(pairs))
        # the window's pairs, frequent ones first
        order = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
        rank = np.zeros(len(pairs), np.int64)
        rank[order] = np.arange(len(order))
        # sums do not ask for the order of links, so a text's are sorted and kept as steps
        steps = []
        for _, _, found, _ in held:
            text = np.repeat(np.arange(len(found.n_links)) * len(order), found.n_links)
            ranked = np.sort(text + rank[found.links]) - text
            first = (np.cumsum(found.n_links) - found.n_links)[found.n_links > 0]
            step = np.diff(ranked, prepend=0)
            step[first] = ranked[first]
            steps.append(step.astype(np.uint32))
        lists = [
            pa.array(np.concatenate([getattr(a, f) for _, _, a, _ in held]), pa.int64()) for f in Aligned.COUNTS
        ]
        groups = pa.array([g for _, _, _, gs in held for g in gs], pa.string())
        return pa.record_batch(
            [
                pa.array([number]), _as_list(pa.concat_arrays([k for k, _, _, _ in held])),
                *[_as_list(v) for v in lists], _as_list(groups),
                pa.array([_planes(np.concatenate(steps))], pa.binary()),
                _as_list(pa.array(pairs[order], pa.int64())),
                _as_list(pa.array(weight[order].astype(np.int64), pa.int64())),
            ],
            names=[c.split()[0] for c in _WINDOW.split(", ")],
        )

    def strings(found: Aligned) -> list[str]:
        """Of each text its groups, or their digest, without the last semicolon."""
        data = memoryview(found.groups.buffers()[2] or b"")
        at = np.frombuffer(found.groups.buffers()[1], np.int64)[: len(found.valid) + 1].tolist()
        cut = [data[x : max(x, y - 1)] for x, y in zip(at, at[1:])]
        return [
            "" if not good else bytes(c).decode() if with_groups else hashlib.sha256(c).hexdigest()
            for c, good in zip(cut, (found.n_a > 0).tolist())
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        tool = aligner(path_a, path_b)
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, 1, min(2_000_000, window_bytes)):
                found = tool.align(part.column(1))
                groups = strings(found)
                found.groups = None
                held.append((part.column(0), part.column(2).to_numpy(zero_copy_only=False), found, groups))
                size += part.column(1).nbytes
                if size >= window_bytes or len(tool.pairs) > MOST_PAIRS:
                    yield close(number, held, tool.pairs)
                    held, size, number = [], 0, number + 1
                    if len(tool.pairs) > MOST_PAIRS:
                        tool.forget()
        if held:
            yield close(number, held, tool.pairs)

    return run


_MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _measure(window: pa.Table, counted: pa.Table) -> pa.Table:
    """Texts of a window with the corpus counts of its pairs."""

    def listed(name: str) -> pa.Array:
        return window.column(name).combine_chunks().flatten()

    pairs = listed("pairs").to_numpy(zero_copy_only=False)
    order = np.argsort(pairs)
    at = order[np.searchsorted(pairs[order], counted.column("pair").to_numpy())]
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    count[at] = counted.column("count").to_numpy()
    best[at] = counted.column("best").to_numpy()
    n_links = listed("n_links").to_numpy(zero_copy_only=False)
    total = np.cumsum(_from_planes(window.column("links")[0].as_py()))
    first = np.cumsum(n_links) - n_links
    links = total - np.repeat(np.concatenate([[0], total])[first], n_links)

    def summed(values: np.ndarray) -> pa.Array:
        upto = np.concatenate([[0], np.cumsum(values[links])])
        return pa.array(upto[first + n_links] - upto[first], pa.int64())

    return pa.table(
        {
            "key": listed("keys"), "n_a": listed("n_a"), "n_b": listed("n_b"), "n_groups": listed("n_groups"),
            "n_links": listed("n_links"), "n_best": summed(best), "count_sum": summed(count), "groups": listed("groups"),
        }
    )


class CrossAlignment:
    """Two tokenizers aligned over ``docs``: counts of id pairs, and measures per document.

    A is a byte-level BPE file of the ``tokenizers`` library, B a SentencePiece model that puts
    a blank in front and falls back to bytes.  Both see a blank and the text; strings of special
    tokens are plain text.  Texts that are null or empty, or that A's or B's tokens do not give
    back byte by byte, have no tokens: zeros, and an empty ``groups``.

    Null ids and repeated rows are documents like others, each with the measures of its text, and
    count in the weights; an empty table gives no rows; other columns are left out.
    """

    def __init__(
        self,
        docs: DataFrame,
        *,
        id_col: str = "doc_id",
        text_col: str = "text",
        path_a: str | None = None,
        path_b: str | None = None,
        window_bytes: int = 8_000_000,
        with_groups: bool = False,
    ):
        spark = docs.sparkSession
        ship(spark)
        path_a, path_b = path_a or default_tokenizer(), path_b or default_pieces()
        self.n_b = Aligner(path_a, path_b).n_b
        rows = docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
        )
        empty = F.coalesce(F.length("text"), F.lit(0)) == 0
        key = F.unhex(F.sha2("text", 256)).alias("key")
        self._keys = rows.where(~empty).select("doc_id", key)
        self._without = rows.where(empty).select("doc_id")
        # one row per distinct text; equal texts meet as counts already within a task
        texts = rows.where(~empty).groupBy("text").agg(F.count("*").alias("copies"))
        align = _align(path_a, path_b, window_bytes, with_groups)
        self.windows = keep_table(texts.select(key, "text", "copies").mapInArrow(align, _WINDOW), "align-windows")
        counts = keep_table(
            self._pairs(F.arrays_zip("pairs", "times"))
            .groupBy("x.pairs")
            .agg(F.sum("x.times").alias("count"))
            .select(F.col("pairs").alias("pair"), (F.col("pairs") % self.n_b).alias("b_id"), "count"),
            "align-counts",
        )
        most = counts.groupBy("b_id").agg(F.max("count").alias("most"))
        self.counts = keep_table(
            counts.join(most, "b_id").select(
                "pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")
            ),
            "align-counts",
        )

    def _pairs(self, column) -> DataFrame:
        return self.windows.select("window", F.explode(column).alias("x"))

    def pair_counts(self) -> DataFrame:
        """a_id, b_id, count (links of the corpus), best (whether it is the highest of b_id)."""
        return self.counts.select(
            F.floor(F.col("pair") / self.n_b).alias("a_id"),
            (F.col("pair") % self.n_b).alias("b_id"),
            "count",
            (F.col("best") == 1).alias("best"),
        )

    def documents(self) -> DataFrame:
        """Per row doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

        ``n_best`` are the links whose count is the highest of their B id, ``count_sum`` adds
        up the counts of all links.  ``groups`` is ``a1,a2|b1;a3|b2`` with ``with_groups``, or
        else its SHA-256.
        """
        counted = (
            self._pairs(F.col("pairs"))
            .select(F.col("window").alias("of"), F.col("x").alias("pair"))
            .join(self.counts, "pair")
        )
        measures = (
            self.windows.drop("times")
            .groupBy("window")
            .cogroup(counted.groupBy("of"))
            .applyInArrow(_measure, f"key binary, {_MEASURES}")
        )
        columns = [c.split()[0] for c in _MEASURES.split(", ")]
        zero = F.lit(0).cast("long")
        none = self._without.select("doc_id", *[zero.alias(c) for c in columns[:-1]], F.lit("").alias("groups"))
        return self._keys.join(measures, "key").select("doc_id", *columns).unionByName(none)


def op13_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CrossAlignment(documents(spark, sf_dir)).documents().withColumnRenamed("groups", "groups_sha256")


QUERIES = {"op13_cross_alignment": op13_cross_alignment}
SQL: dict[str, str] = {}
