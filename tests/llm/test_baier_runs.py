import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm.runs import find_runs, lyndon_lengths, op11_baier_runs, runs_of, tenth_repeats


def brute_lyndon(word):
    def lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    n = len(word)
    return [max(m for m in range(1, n - i + 1) if lyndon(word[i : i + m])) for i in range(n)]


def brute_runs(words, least=12):
    """Every stretch of each period that cannot be extended, by its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, text, repeat=None):
    words = bytes(text or "", "utf8").split()
    n = len(words)
    if repeat and (r := repeat(doc_id, n)):
        a, p = r
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=18))
def test_lyndon_arrays(word):
    assert lyndon_lengths(word) == brute_lyndon(word)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=40), min_size=1, max_size=3), st.sampled_from([2, 5, 12]))
def test_runs_of_parts(parts, least):
    which, start, length, period = runs_of([np.array(p) for p in parts], least)
    got = sorted(zip(which.tolist(), start.tolist(), length.tolist(), period.tolist()))
    assert got == sorted((i, *r) for i, p in enumerate(parts) for r in brute_runs(p, least))


def texts():
    rng = random.Random(11)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 12), (5, "a " * 11), (5, "a " * 11), (6, "é\x85x " * 9), (7, "a b\x0bc " * 30)]
    for i in range(120):
        words = [rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            at, size = rng.randint(0, len(words)), rng.randint(1, 20)
            words[at:at] = words[at : at + size] * rng.randint(1, 4)
        rows.append((100 + i, rng.choice([" ", "\n", "\r\n "]).join(words)))
    rows.append((900, " ".join(rng.choice("xy") for _ in range(700))))
    rows.append((901, "run " * 1500 + "end"))
    thue = "0"
    for _ in range(9):
        thue += "".join("10"[int(c)] for c in thue)
    rows.append((902, " ".join(thue) + " " + " ".join(thue)))
    return rows


def test_against_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, start int, `a.b` string, runs string")
    got = {}
    for r in find_runs(docs.repartition(7)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    for doc_id, text in rows:
        words = bytes(text or "", "utf8").split()
        n, runs, collapsed = got[doc_id][0]
        assert n == len(words) and sorted(runs) == brute_runs(words) and runs == sorted(runs, key=lambda r: (r[0], r[2]))
        assert hashlib.sha256(collapsed.encode()).hexdigest() == brute_row(doc_id, text)[-1]
    assert sum(map(len, got.values())) == len(rows)


def test_query_against_brute_force(spark, tmp_path):
    rows = texts() + [(1000 + i, " ".join(random.Random(i).choices("abcdefghijk", k=60))) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op11_baier_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((brute_row(*r, tenth_repeats) for r in rows), key=repr)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None) > 10


def test_empty_table(spark):
    assert find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
