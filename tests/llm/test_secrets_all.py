import random
import string
from collections import Counter

import numpy as np

from eventloom.llm.secrets import PREFIX, SYMBOLS, UNIT, Automaton, classes_of, prefix_moves, scan_secrets

ALNUM = string.ascii_letters + string.digits


def test_prefixes_are_counted():
    rng = random.Random(71)
    tokens = ["".join(rng.choices("ab1-", k=rng.randint(1, 5))) for _ in range(300)]
    keys, n = prefix_moves(tokens, np.full(len(tokens), UNIT))
    want = Counter()
    for t in tokens:
        symbols = [*classes_of(t).tolist(), SYMBOLS]
        want.update((tuple(symbols[:i]), s) for i, s in enumerate(symbols))
    assert sorted(n // UNIT) == sorted(want.values()) and len(set(keys.tolist())) == len(want)
    # the automaton of all prefixes is that of the tokens
    table = {}
    for key, times in zip(keys.tolist(), n.tolist()):
        table.setdefault(key >> 4 & PREFIX, [0.0] * (SYMBOLS + 1))[key & 15] = times / UNIT
    a, b = Automaton.of_prefixes(table), Automaton([classes_of(t) for t in tokens])
    assert np.array_equal(a.to, b.to) and np.array_equal(a.cost, b.cost) and np.array_equal(a.end, b.end)
    b.reckon(b.moves(tokens, np.ones(len(tokens), np.int64)))
    assert np.array_equal(a.to, b.to) and np.array_equal(a.cost, b.cost)


def corpus(seed):
    """Many credentials of one format, fewer of another, of both some without a label."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 14)))
    usual = lambda: "".join(rng.choices(string.digits + "abcdef", k=32)) + "Z"
    other = lambda: "sk_live_" + "".join(rng.choices(ALNUM, k=24))
    rows, hidden = [], {}
    for i in range(800):
        words = [word() for _ in range(30)]
        if i < 600:
            words += [f"api_key = {usual()}" for _ in range(5)]
            words += [f"api_key = {other()}"] * (i % 4 == 0)
        elif i >= 700:
            value, at = other(), len(" ".join(words)) + 1
            hidden[i] = f"format:{at}:{at + len(value)}"
            words.append(value)
        rows.append((i, " ".join(words)))
    return rows, hidden


def test_every_credential_teaches_however_many_there_are(spark):
    for seed in (72, 73):
        rows, hidden = corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: r["spans"].split(",") for r in scan_secrets(docs, most_labelled=200).collect()}
        assert sum(hidden[i] in got[i] for i in hidden) >= 0.9 * len(hidden)
        assert [s for i in got for s in got[i] if s.startswith("format") and s != hidden.get(i)] == []


def test_no_ordinary_token_is_left_out(spark):
    """One token in a stratum without credentials, held out, keeps others of its format unmarked."""
    rng = random.Random(75)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(6, 14)))
    number = lambda: "".join(rng.choices(string.digits, k=24))
    rows = []
    for i in range(400):
        words = [word() for _ in range(30)] + ["-".join(rng.choices(string.digits, k=9)) for _ in range(3)]
        if i % 2:
            words += [f"token = {rng.choice('ab')}{number()}"]
        if i % 100 == 0:
            words += [f"{number()}-{number()}"]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = scan_secrets(docs, most_labelled=40).collect()
    assert sum(r["n_format"] for r in got) == 0
