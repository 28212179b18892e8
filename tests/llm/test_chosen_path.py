import random

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm.chosen_path import drop_near_copies, least_matches, runs_for, similarity_join
from eventloom.llm.components import components
from eventloom.llm.words import shingles, word_hashes


def brute(rows, width=5, threshold=0.8):
    """(doc_id, text) -> sorted (doc_id, class_id, copy_id, n_links) by comparing all pairs."""

    def tokens(text):
        words = (text or "").lower().split()
        if not words:
            return frozenset()
        return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))

    sets = {}
    for d, t in rows:
        sets.setdefault(tokens(t), []).append(d)
    keys = list(sets)
    least = {k: min((d for d in ds if d is not None), default=None) for k, ds in sets.items()}
    links = {k: set() for k in keys}
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if a and b and len(a & b) / len(a | b) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, ds in sets.items():
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        group = min((least[s] for s in seen if least[s] is not None), default=None)
        out += [(d, group, least[k], len(links[k])) for d in ds]
    return sorted(out, key=repr)


def corpus(seed, n=30, hot=0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, texts = [], []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.choice([3, 40, 80, 200]))
        for _ in range(rng.randint(1, 4)):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    base = rng.choices(vocabulary, k=150)
    for _ in range(hot):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    rows += [(900, None), (901, ""), (902, " \n"), (903, texts[0].upper()), (None, texts[5]), (904, "one"),
             (905, "one"), (0, texts[0])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [0, 400])
def test_against_brute_force(spark, hot):
    rows = corpus(11, hot=hot)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, class string")
    got = similarity_join(docs.repartition(4)).select("doc_id", "class_id", "copy_id", "n_links").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_drop_near_copies(spark):
    rows = corpus(12, n=12)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string")
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    want = {d for d, g, _, _ in brute(rows) if d is None or d == g}
    assert {r["doc_id"] for r in left.collect()} == want


def test_empty_table_and_long_text(spark):
    schema = "doc_id long, text string"
    assert similarity_join(spark.createDataFrame([], schema)).count() == 0
    long = " ".join(f"w{i}" for i in range(100_000))
    docs = spark.createDataFrame([(1, long), (2, long + " more"), (3, "else")], schema)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in similarity_join(docs).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["group"] for r in got} == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


def test_shingles_stay_within_texts():
    texts = ["a b c", "", "a b c d e f", None, " a  b\tc\nd e f "]
    found, counts = shingles(*word_hashes(pa.array(texts)), 5)
    assert counts.tolist() == [1, 0, 2, 0, 2]
    assert np.array_equal(found[1:3], found[3:5])


def test_runs_reach_the_recall():
    assert 1 - (1 - 0.8**3) ** runs_for(0.9999, 0.8) >= 0.9999
    assert 10 < least_matches(42, 0.8) < 30


def test_drop_near_copies_carries_columns_of_any_name(spark):
    names = ["doc_id", "text", "a-b", "a.b", "source url", "__id", "__hash", "id", "hash", "row"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names[2:])
    texts = ["one two three four five six"] * 3 + ["seven eight nine ten eleven twelve", None]
    rows = [(i, t, *[f"{c}{i}" for c in names[2:]]) for i, t in enumerate(texts)]
    got = drop_near_copies(spark.createDataFrame(rows, schema))
    assert got.columns == names
    assert {tuple(r) for r in got.collect()} == {rows[0], rows[3], rows[4]}
