import heapq
import random

import numpy as np
import pytest

from eventloom.llm.huffman import canonical, code_lengths, decode, encode, read_tokens, write_tokens
from eventloom.llm.tokens import default_tokenizer


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_lengths_are_optimal_and_limited():
    rng = random.Random(41)
    for _ in range(60):
        counts = np.array([rng.choice([0, 1, 2, 5, 100, 10_000]) for _ in range(rng.randint(2, 40))])
        lengths = code_lengths(counts, 20)
        used = lengths[lengths > 0]
        assert ((counts > 0) == (lengths > 0)).all()
        if len(used) > 1:
            assert abs(sum(2.0 ** -used) - 1) < 1e-12
            assert int((counts * lengths).sum()) == huffman_cost(counts.tolist())
    fibonacci = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    short = code_lengths(fibonacci, 4)
    assert short.max() == 4 and sum(2.0 ** -short) <= 1


@pytest.mark.parametrize("symbols", [1, 2, 700])
def test_round_trip(symbols):
    rng = np.random.default_rng(42)
    counts = rng.integers(0, 300, 50)
    ids = np.minimum(rng.geometric(0.02, counts.sum()), symbols) - 1
    lengths = code_lengths(np.bincount(ids, minlength=symbols + 3))
    codes, _ = canonical(lengths)
    data, n_bytes, steps, n_steps = encode(ids, counts, lengths, codes)
    assert n_bytes.sum() == len(data) and n_steps.sum() == len(steps)
    assert np.array_equal(decode(data, steps, counts, lengths), ids)


@pytest.mark.parametrize("part_tokens", [50, 10**7])
def test_files_against_the_tokenizer(spark, tmp_path, part_tokens):
    from tokenizers import Tokenizer

    rng = random.Random(43)
    texts = [None, "", "x" * 50_000, "a b", "a b"] + [
        " ".join(rng.choices(["the", "Éa", "of", "\n", "12"], k=rng.randint(0, 90))) for _ in range(60)
    ]
    rows = [(i * 3 - 20, t, "n") for i, t in enumerate(texts)] + [(None, "no id", "n"), (5, "again", "n")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    path = str(tmp_path / "tokens")
    write_tokens(docs.repartition(3), path, part_tokens=part_tokens, block_tokens=100)
    got = read_tokens(spark, path).collect()
    tok = Tokenizer.from_file(default_tokenizer())
    want = sorted(
        ((d is not None, d or 0, tok.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, _ in rows),
        key=lambda r: (r[0], r[1], len(r[2])),
    )
    got = sorted(got, key=lambda r: r["start"])
    at = 0
    for r, (has, d, ids) in zip(got, want, strict=True):
        assert r["doc_id"] == (d if has else None) and r["start"] == at and r["n_tokens"] == len(ids)
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        at += len(ids)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), path)
    assert read_tokens(spark, path).count() == 0
