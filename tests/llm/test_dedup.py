import hashlib
import random
import re

import numpy as np
import pytest

from eventloom.llm.dedup import CountingQuotientFilter, exact_dedup, merge_entries


def expected(rows):
    """Brute force over (doc_id, text): groups of equal bodies."""
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((d, t or "", i))
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0, m[2]))
        for d, _, i in members:
            sha = hashlib.sha256(body.encode()).hexdigest()
            out.append((d, best[0], len(members), d == best[0], sha))
    return sorted(out, key=repr)


ROWS = [
    (1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, None), (5, ""), (6, " \r\n"), (7, "x" * 300_000),
    (8, "x" * 300_000 + " "), (9, "é b"), (10, "éb"), (11, "a b"), (None, "lone"), (12, "lone"),
]


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_against_brute_force(spark, bits):
    rng = random.Random(4)
    rows = ROWS + [(100 + i, rng.choice("ab ") + rng.choice("ab ") + "c") for i in range(60)]
    docs = spark.createDataFrame(
        [(*r, "x", 1, True) for r in rows], "doc_id long, text string, body string, at int, kept boolean"
    )
    got = exact_dedup(docs.repartition(5), fingerprint_bits=max(bits, 1)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_repeated_rows_keep_one_and_rows_are_carried(spark):
    docs = spark.createDataFrame([(1, "a", "s")] * 3 + [(2, "b", "t")], "doc_id long, text string, row string")
    got = exact_dedup(docs, carry=True).where("kept").select("row.*").collect()
    assert sorted(tuple(r) for r in got) == [(1, "a", "s"), (2, "b", "t")]


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(5)
    all_of = rng.integers(0, 1 << 62, 500, dtype=np.uint64) * np.uint64(3)
    parts, everything = [], []
    for _ in range(6):
        raw = rng.choice(all_of, 300)
        everything.append(raw)
        found, counts = np.unique(raw, return_counts=True)
        top = found >> np.uint64(62)
        for t in range(4):
            if (top == t).any():
                block = CountingQuotientFilter(found[top == t], counts[top == t], 2)
                parts.append(CountingQuotientFilter.from_bytes(block.to_bytes()).entries())
    found, counts = merge_entries(parts)
    want, n = np.unique(np.concatenate(everything), return_counts=True)
    assert (found == want).all() and (counts == n).all()
