"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

Encoding a text equals encoding its chunks one by one, if each chunk starts where the
pre-tokenizer must start a token: at a space or newline that stands between two
characters which are not white space.  Words repeat, so the library encodes each distinct
chunk once per worker; everything else is array work.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters the pre-tokenizer takes as white space.
_SPACE = "\t-\r \x85\xa0  -     　"
_RE2_SPACE = (
    r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_ODD = f"^{_RE2_SPACE}|{_RE2_SPACE}{_RE2_SPACE}|{_RE2_SPACE}$|\\x00"
_CHUNK = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder:
    """Whole texts to ids; remembers up to ``most_chunks`` distinct chunks.

    Chunks stay in an Arrow array and are looked up there, so that only new ones become Python
    strings.  The memory is a cache only, results never depend on it.  When it is full, chunks
    that were met again stay and the others make room.
    """

    def __init__(self, path: str, most_chunks: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)  # one character of a byte-level token is one byte
        self.most = most_chunks
        self._reset()

    def _reset(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.pool = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.met = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _make_room(self) -> None:
        """Keep the chunks met most often, half of what fits at most."""
        n = len(self.known)
        met = self.met[:n]
        least = max(2, int(np.partition(met, n // 2)[n // 2]) + 1) if n else 2
        keep = np.flatnonzero(met >= least)
        kept = self.known.take(pa.array(keep))
        counts = self.count[keep]
        shift = self.start[keep] - np.cumsum(counts) + counts
        ids = self.pool[np.repeat(shift, counts) + np.arange(counts.sum())]
        met = met[keep].copy()
        self._reset()
        self._add([(kept, ids, counts)])
        self.met[: len(kept)] = met

    def _learn(self, chunks: list[str]) -> None:
        new = []
        joined = [c for c in chunks if c[:1] in " \n" and not c[1:2].isspace() and len(c) > 1]
        alone = list(set(chunks).difference(joined))
        for i in range(0, len(joined), 2000):
            group = joined[i : i + 2000]
            ids = np.array(
                self.tokenizer.encode_batch_fast(["".join(group)], add_special_tokens=False)[0].ids,
                np.int64,
            )
            ends = np.cumsum([len(c.encode()) for c in group])
            at = np.cumsum(self.n_bytes[ids])
            cut = np.searchsorted(at, ends) + 1
            if at[-1] != ends[-1] or not np.array_equal(at[cut - 1], ends):
                alone += group  # a chunk that does not stand by itself
                continue
            new.append((pa.array(group, pa.large_string()), ids, np.diff(cut, prepend=0)))
        if alone:
            found = [
                e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
            ]
            ids = np.array([i for f in found for i in f], np.int64)
            counts = np.array([len(f) for f in found], np.int64)
            new.append((pa.array(alone, pa.large_string()), ids, counts))
        self._add(new)

    def _add(self, new: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> None:
        ids, counts = (np.concatenate([part[i] for part in new]) for i in (1, 2))
        at, n = len(self.known), len(counts)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while at + n > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.start[at : at + n] = self.used + np.cumsum(counts) - counts
        self.count[at : at + n] = counts
        self.used += len(ids)
        self.known = pa.concat_arrays([self.known, *[part[0] for part in new]])

    def _of_chunks(self, chunks: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in order; number of ids of each text, whose chunks stop at ends."""
        coded = chunks.dictionary_encode()
        words = coded.dictionary.cast(pa.large_string())
        found = pc.index_in(words, value_set=self.known)
        if found.null_count:
            if len(self.known) + found.null_count > self.most:
                self._make_room()
                found = pc.index_in(words, value_set=self.known)
            new, before = words.filter(found.is_null()), len(self.known)
            self._learn(new.to_pylist())
            learned = pc.add(pc.index_in(new, value_set=self.known.slice(before)), before)
            found = pc.replace_with_mask(found.cast(pa.int64()), found.is_null(), learned.cast(pa.int64()))
        which = found.to_numpy(zero_copy_only=False).astype(np.int64)
        self.met[which] += 1
        which = which[coded.indices.to_numpy(zero_copy_only=False)]
        counts = self.count[which]
        total = np.cumsum(counts)
        shift = self.start[which] - total + counts
        ids = self.pool[np.repeat(shift, counts) + np.arange(total[-1] if len(total) else 0)]
        upto = np.concatenate([[0], total])[ends]
        return ids, np.diff(upto, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as uint32, one text after another, and the number of ids per text."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        if not pc.any(odd).as_py():
            return self._of_plain(texts)
        odd = odd.to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        plain_ids, counts[~odd] = self._of_plain(texts.filter(pa.array(~odd)))
        split = [_CHUNK.findall(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        odd_ids, counts[odd] = self._of_chunks(
            pa.array([c for s in split for c in s], pa.string()), np.cumsum([len(s) for s in split])
        )
        ids = np.empty(counts.sum(), np.uint32)
        from_odd = np.repeat(odd, counts)
        ids[from_odd], ids[~from_odd] = odd_ids, plain_ids
        return ids, counts

    def _of_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = pc.replace_substring(texts, " ", "\0 ")
        marked = pc.replace_substring(marked, "\n", "\0\n")
        parts = pc.split_pattern(marked, "\0")
        offsets = parts.offsets.to_numpy()
        return self._of_chunks(parts.flatten(), offsets[1:] - offsets[0])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker, kept from task to task."""
    return ChunkEncoder(path)


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of about ``most_bytes`` of text, one row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to
