"""Periodic runs of words: stretches that repeat with some period, found by Lyndon roots.

Phase one of Baier's suffix sorter groups the suffixes of a text by their longest Lyndon
prefix, so the group in which a suffix ends up gives the Lyndon array, without sorting the
suffixes further.  It is done for an order of the words and for the opposite order: every run
holds, right after its first word at the latest, the longest Lyndon word of one of the two
orders, of the length of its period.  Such a word is extended to both sides by longest common
extensions (LCE), which gives the run's ends.

Texts are shared out by Spark and each is looked at whole by one task; nothing is shuffled.
Within a run of at least ``m`` words every word lies in a stretch of ``m // 2`` words that the
text holds twice, so only such parts of a text are grouped (a run never leaves its part).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, ship
from .tokens import slices
from .words import mix, words_of

# doc_id and number of words to the place of the first repeated word and the period, or None.
Repeat = Callable[[int | None, int], tuple[int, int] | None]

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_lengths(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, for the order of int.

    Groups are taken from the highest down.  A place whose group is done leaves the list of
    waiting places; the waiting place before it then starts with a longer Lyndon word, so it
    moves to a new group right above its own, above those that got fewer such words.  When
    a group is taken, its Lyndon words end at the next waiting place.
    """
    n = len(word)
    left = list(range(-1, n + 1))  # places are counted from 1; 0 and n + 1 are the ends
    right = list(range(1, n + 3))
    length = [0] * (n + 1)
    symbols = sorted(set(word))
    number = {s: g for g, s in enumerate(symbols, 1)}
    at = [0, *[number[s] for s in word]]
    members: list[list[int]] = [[] for _ in range(len(symbols) + 1)]
    for i in range(1, n + 1):
        members[at[i]].append(i)
    waiting = [len(m) for m in members]
    lower = list(range(-1, len(symbols)))
    upper = list(range(1, len(symbols) + 2))

    def move(places: list[int], group: int) -> None:
        """To a new group right above their own, unless that is all it has left."""
        if waiting[group] == len(places):
            return
        new = len(members)
        above = upper[group]
        members.append(places)
        waiting.append(len(places))
        waiting[group] -= len(places)
        lower.append(group)
        upper.append(above)
        lower[above] = new
        upper[group] = new
        for j in places:
            at[j] = new

    top = len(symbols)
    # the highest group has a stand-in above it, so that ``above`` always exists
    upper[top] = 0
    group = top
    while group > 0:
        places = members[group]
        if waiting[group] == 1 and len(places) == 1:
            i = places[0]
            before, after = left[i], right[i]
            length[i] = after - i
            right[before], left[after] = after, before
            if before:
                move([before], at[before])
        else:
            gained: dict[int, int] = {}
            for i in places:
                if at[i] == group:
                    before, after = left[i], right[i]
                    length[i] = after - i
                    right[before], left[after] = after, before
                    gained[before] = gained.get(before, 0) + 1
            gained.pop(0, None)
            split: dict[tuple[int, int], list[int]] = {}
            for j, times in gained.items():
                split.setdefault((times, at[j]), []).append(j)
            for times, own in sorted(split, reverse=True):
                move(split[times, own], own)
        members[group] = []
        group = lower[group]
    return length[1:]


def _names(text: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each power of two up to ``longest``, equal numbers for equal stretches of that length."""
    names = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
    size = 1
    while 2 * size <= longest:
        a, b = names[-1][:-size], names[-1][size:]
        names.append(np.unique(a * (len(text) + 1) + b, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return names


def _extend(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """LCE: words alike from places a and b on, or before them."""
    got = np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        name, size = names[k], 1 << k
        x, y = (a - got - size, b - got - size) if back else (a + got, b + got)
        inside = (x >= 0) & (y >= 0) & (x < len(name)) & (y < len(name))
        same = np.zeros(len(a), bool)
        same[inside] = name[x[inside]] == name[y[inside]]
        got += np.where(same, size, 0)
    return got


def runs_of(parts: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of at least ``least`` words and two periods: part, start, length, period, in order."""
    sizes = np.array([len(p) for p in parts], np.int64)
    if not len(sizes):
        return (np.zeros(0, np.int64),) * 4
    # parts one after another, each between marks that occur once
    top = max(int(p.max()) for p in parts) + 1
    text = np.concatenate([np.concatenate([[top + i], p]) for i, p in enumerate(parts)] + [[top + len(parts)]])
    begin = np.cumsum(sizes + 1) - sizes
    names = _names(text, int(sizes.max()))
    starts, lengths = [], []
    for part, at in zip(parts, begin.tolist()):
        words = part.tolist()
        for order in (words, [-w for w in words]):
            lengths.append(np.array(lyndon_lengths(order), np.int64))
            starts.append(np.arange(at, at + len(words)))
    i, period = np.concatenate(starts), np.concatenate(lengths)
    start = i - _extend(names, i, i + period, back=True)
    end = i + period + _extend(names, i, i + period, back=False)
    real = end - start >= np.maximum(2 * period, least)
    found = np.unique(np.stack([start[real], period[real], end[real]], axis=1), axis=0)
    start, period, end = found.T
    which = np.searchsorted(begin, start, "right") - 1
    return which, start - begin[which], end - start, period


def _repeated_parts(words: np.ndarray, counts: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches covered by grams that their text holds more than once."""
    n = len(words)
    if n < gram:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    last = n - gram + 1
    wide = words.astype(np.uint64)
    grams = mix(text[:last].astype(np.uint64), *[wide[k : last + k] for k in range(gram)])
    whole = np.flatnonzero(text[:last] == text[gram - 1 :])
    grams = grams[whole]
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = whole[twice]
    change = np.bincount(at, minlength=n + 1) - np.bincount(at + gram, minlength=n + 1)
    covered = np.concatenate([[False], np.cumsum(change)[:n] > 0, [False]])
    # stretches of neighbouring texts may touch
    ends_of_texts = np.cumsum(counts)
    begins = covered[1:-1] & (~covered[:-2] | (np.diff(text, prepend=-1) != 0))
    stops = covered[1:-1] & (~covered[2:] | (np.diff(text, append=len(ends_of_texts)) != 0))
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _reorder(ids: list, counts: np.ndarray, words: np.ndarray, repeat: Repeat) -> np.ndarray:
    words = words.copy()
    at = 0
    for doc_id, n in zip(ids, counts.tolist()):
        found = repeat(doc_id, n)
        if found is not None:
            first, period = found
            i = np.arange(first, n)
            words[at + i] = words[at + first + (i - first) % period]
        at += n
    return words


def _find(least: int, repeat: Repeat | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield _runs_of_slice(part, least, repeat)

    return run


def _runs_of_slice(part: pa.RecordBatch, least: int, repeat: Repeat | None) -> pa.RecordBatch:
    vocabulary, words, counts = words_of(part.column(1))
    words = words.astype(np.int64)
    if repeat is not None:
        words = _reorder(part.column(0).to_pylist(), counts, words, repeat)
    first = np.cumsum(counts) - counts
    begin, end = _repeated_parts(words, counts, least // 2)
    which, start, length, period = runs_of([words[a:b] for a, b in zip(begin.tolist(), end.tolist())], least)
    start = start + begin[which]  # among the words of the slice
    drop = np.bincount(start + period, minlength=len(words) + 1) - np.bincount(
        start + length, minlength=len(words) + 1
    )
    keep = np.cumsum(drop)[: len(words)] == 0
    text = np.repeat(np.arange(len(counts)), counts)
    kept = np.bincount(text[keep], minlength=len(counts))
    collapsed = pc.binary_join(
        pa.ListArray.from_arrays(
            np.concatenate([[0], np.cumsum(kept)]).astype(np.int32), vocabulary.take(pa.array(words[keep])).cast(pa.string())
        ),
        " ",
    )
    of = text[start] if len(start) else np.zeros(0, np.int64)
    # by place already: parts are in order and runs in order within a part
    runs = pa.ListArray.from_arrays(
        np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(counts)))]).astype(np.int32),
        pa.StructArray.from_arrays(
            [pa.array(start - first[of]), pa.array(length), pa.array(period)], fields=list(_RUN)
        ),
    )
    return pa.record_batch(
        [part.column(0), pa.array(counts, pa.int64()), runs, collapsed],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def find_runs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 12,
    repeat: Repeat | None = None,
) -> DataFrame:
    """Per row doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    A run is a longest stretch of words with smallest period ``p`` that has at least
    ``least`` words and two periods.  ``collapsed`` is the text without the words that stand in
    a run after its first period, the rest joined by one blank.  Words stand between ASCII white
    space and are compared as they are.  ``repeat`` may have the words of a text from some
    place on repeat those of a period, before runs are looked for.

    A null or empty text has no words and no runs.  Null ids and repeated rows are rows like
    any other, an empty table gives no rows, other columns are left out whatever their names.
    Runs that overlap or touch are all given.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInArrow(_find(least, repeat), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def tenth_repeats(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The contract's rule: every tenth id, by checksum, repeats from some word on."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    first = g % n
    return first, 1 + (n - first) // (3 + g % 8)


def op11_baier_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(documents(spark, sf_dir), repeat=tenth_repeats)
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    # the longest run; of those of one length the first, then that of the smallest period
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length.alias("length"), -r.start, -r.period, r.alias("run")))
    )["run"]
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_baier_runs": op11_baier_runs}
SQL: dict[str, str] = {}
