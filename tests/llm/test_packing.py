import itertools
import random

import numpy as np
import pytest

from eventloom.llm.packing import complete_bins, lower_bound, pack, place
from eventloom.llm.tokens import ChunkEncoder, default_tokenizer

import pyarrow as pa


def fewest(sizes, capacity):
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= capacity and bins[b] not in bins[:b]:
                go(i + 1, bins[:b] + [bins[b] + sizes[i]] + bins[b + 1 :])
        go(i + 1, bins + [sizes[i]])

    go(0, [])
    return best[0]


def test_bins_are_valid_and_few():
    rng = random.Random(1)
    worse = 0
    for _ in range(150):
        sizes = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        bins = complete_bins(np.array(sizes), 20)
        assert sorted(itertools.chain(*bins)) == sorted(sizes)
        assert all(sum(b) <= 20 for b in bins)
        least = fewest(sizes, 20)
        assert lower_bound(np.bincount(sizes, minlength=21), 20) <= least <= len(bins)
        worse += len(bins) - least
    assert worse == 0


def test_search_beats_best_fit():
    # best fit takes 11 bins of 10; pairs and triples fill 10 exactly
    sizes = np.array([6, 4] * 3 + [5, 3, 2] * 4 + [7, 3] * 3)
    assert len(complete_bins(sizes, 10)) == 10


def test_many_sizes_reach_the_bound():
    sizes = np.random.default_rng(2).integers(1, 1025, 3000)
    bins, _, free = place(sizes, 1024)
    least = lower_bound(np.bincount(sizes, minlength=1025), 1024)
    assert len(free) - least <= max(2, least // 200)
    assert np.bincount(bins, sizes).max() <= 1024


def check_layout(rows, length):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= length
    return len(by_sequence)


def test_pack_whole_texts(spark):
    texts = [None, "", "One two three.", "word " * 700, "a\n\nb  c \t d<|endoftext|> e", "x" * 3000]
    texts += ["One two three."] * 3
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "no id", "clash"), (2, texts[2], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    got = pack(docs.repartition(3), length=64, window_tokens=200, carry_bins=2).collect()
    check_layout(got, 64)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_tokenizer())
    want = sorted(
        ((d, tok.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _ in rows), key=repr
    )
    pieces = {}
    for r in sorted(got, key=lambda r: (r["piece"])):
        pieces.setdefault((r["doc_id"]), []).append(r)
    found = []
    for d, parts in pieces.items():
        if d == 2:  # a repeated row
            assert len(parts) == 2
            found += [(d, np.frombuffer(p["ids"], "<u4").tolist()) for p in parts]
            continue
        ids = []
        for k, p in enumerate(parts):
            assert p["piece"] == k and p["start"] == len(ids) and p["length"] * 4 == len(p["ids"])
            assert k == 0 or p["length"] == 64
            ids += np.frombuffer(p["ids"], "<u4").tolist()
        found.append((d, ids))
    assert sorted(found, key=repr) == want
    tokens = sum(len(i) for _, i in want)
    assert len({r["sequence_id"] for r in got}) <= -(-tokens // 64) + 2


def test_pack_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack(docs).count() == 0


@pytest.mark.parametrize("most", [10, 10_000])
def test_chunks_equal_whole_texts(most):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_tokenizer())
    rng = random.Random(3)
    parts = ["a", "Hello", " ", "  ", "\n", "\t", " ", "é", "12", "'s", "...", "<|endoftext|>", "中", "\x1c",
             "\x00", "\r\n", "ﬁ", "x'll", "²", " the"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)] + [None, "don't stop"]
    ids, counts = ChunkEncoder(default_tokenizer(), most).encode(pa.array(texts, pa.string()))
    want = [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_second_round_packs_a_task_whatever_its_batches(spark):
    rng = random.Random(17)
    texts = [" ".join(rng.choices("alpha beta gamma delta".split(), k=rng.randint(1, 200))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    sequences = []
    for rows in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        try:
            got = pack(docs, length=256, carry_bins=10_000).select("sequence_id").distinct().count()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        sequences.append(got)
    assert sequences[0] == sequences[1]
