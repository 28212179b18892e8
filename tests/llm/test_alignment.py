import hashlib
import random
from collections import Counter

import pytest
import pyarrow as pa

from eventloom.llm.alignment import Aligner, CrossAlignment, byte_of_character, default_pieces, op13_cross_alignment
from eventloom.llm.tokens import default_tokenizer


@pytest.fixture(scope="module")
def both():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(default_tokenizer())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=default_pieces())


def spans(pieces):
    at, out = 0, []
    for i, b in pieces:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def brute(both, text):
    """Whole text by both libraries: tokens, groups and links by their byte ranges."""
    if not text:
        return 0, 0, [], []
    a, b = both
    byte = byte_of_character()
    whole = (" " + text).encode()
    left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    if any(b"".join(x for _, x in side) != whole for side in (left, right)):
        return 0, 0, [], []
    left, right = spans(left), spans(right)
    links = [(i, j) for i, s, e in left for j, u, v in right if s < v and u < e]
    cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
    groups, last = [], 0
    for cut in cuts:
        inside = [",".join(str(i) for i, s, e in side if last <= s and e <= cut) for side in (left, right)]
        groups.append("|".join(inside))
        last = cut
    return len(left), len(right), groups, links


def expected(both, rows):
    found = [brute(both, t) for _, t in rows]
    counts = Counter(x for f in found for x in f[3])
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for (doc_id, _), (n_a, n_b, groups, links) in zip(rows, found):
        best = sum(counts[x] == most[x[1]] for x in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), sha))
    return out, counts


def texts():
    rng = random.Random(13)
    words = "the token tokenizer naïve Übergröße 北京 😀 don't <|endoftext|> <s> 2024-01-05 x" .split()
    rows = [
        (1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "a▁b"), (6, "a\nb\n\nc\r\nd\te"), (7, "x\x00y"),
        (8, "nb\xa0sp 　wide"), (None, "no id"), (9, "\n"), (10, "long " * 4000), (11, "tail "), (12, "▁ end"),
    ]
    rows += [(100 + i, rng.choice([" ", "\n", " "]).join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(150)]
    return rows + rows[:40] + [(500, "the same text")] * 60


@pytest.mark.parametrize("window", [8_000_000, 300])
def test_against_brute_force(spark, both, window):
    rows = texts()
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "doc_id long, text string, key string, `a.b` int, n_a int")
    made = CrossAlignment(docs.repartition(6), window_bytes=window)
    want, counts = expected(both, rows)
    assert sorted((tuple(r) [:7] + (r[7],) for r in made.documents().collect()), key=repr) == sorted(want, key=repr)
    assert {(r.a_id, r.b_id): r["count"] for r in made.pair_counts().collect()} == dict(counts)


def test_group_strings(spark, both):
    docs = spark.createDataFrame([(1, "Hello unbelievable wörld"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r.groups for r in CrossAlignment(docs, with_groups=True).documents().collect()}
    assert got == {1: ";".join(brute(both, "Hello unbelievable wörld")[2]), 2: ""}


def test_the_memory_of_chunks_is_only_a_cache(both):
    small, large = (Aligner(default_tokenizer(), default_pieces(), n) for n in (3, 100_000))
    for part in range(3):
        batch = pa.array([t for _, t in texts() if t][part::3])
        x, y = small.align(batch), large.align(batch)
        assert x.groups.to_pylist() == y.groups.to_pylist() and (small.pairs[x.links] == large.pairs[y.links]).all() and (x.n_links == y.n_links).all()


def test_empty_tables(spark, tmp_path):
    for rows in ([], [(1, None)]):
        path = str(tmp_path / f"t{len(rows)}")
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
        got = op13_cross_alignment(spark, path)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert got.count() == len(rows)
