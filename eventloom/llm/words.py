"""Words of whole texts as 64-bit hashes: array work, with one hash per distinct word."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc


def hash_words(words: np.ndarray) -> np.ndarray:
    """A hash of each word; the same in every process."""
    return pd.util.hash_array(words, categorize=False)


def mix(*hashes: np.ndarray) -> np.ndarray:
    """One hash of several, order matters."""
    out = np.zeros_like(hashes[0])
    for h in hashes:
        out = (out ^ h) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the place of each text's words among them, words per text.

    Words stand between ASCII white space; null counts as empty.
    """
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary
    ends = offsets[1:] - offsets[0]
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not real.all():
        keep = real[which]
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        which = which[keep]
    return words, which, np.diff(ends, prepend=0)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in lower case, and words per text."""
    words, which, counts = words_of(texts)
    lower = pc.utf8_lower(words).to_numpy(zero_copy_only=False)
    hashes = hash_words(lower) if len(lower) else np.zeros(0, np.uint64)
    return hashes[which], counts


def shingles(
    hashes: np.ndarray, counts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row within a text, and how many per text.

    A shorter text with words has one shingle of all its words.
    """
    n = len(hashes)
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    place = np.arange(n)
    if n >= width:
        rolled = mix(*[hashes[i : n - width + 1 + i] for i in range(width)])
        rolled = np.concatenate([rolled, np.zeros(width - 1, np.uint64)])
    else:
        rolled = np.zeros(n, np.uint64)
    whole = place + width <= ends
    short = np.flatnonzero((counts > 0) & (counts < width))
    starts = np.cumsum(counts) - counts
    for t in short.tolist():
        a, c = starts[t], counts[t]
        rolled[a] = mix(*[hashes[a + i : a + i + 1] for i in range(c)])[0]
        whole[a] = True
    return rolled[whole], np.bincount(text[whole], minlength=len(counts))
