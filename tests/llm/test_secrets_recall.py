import random
import string

import pytest

from eventloom.llm.secrets import Automaton, classes_of, scan_secrets, strata

ALNUM = string.ascii_letters + string.digits


def clean_tokens(rng):
    digits = lambda n: "".join(rng.choices(string.digits, k=n))
    octet = lambda: str(rng.randint(1, 255))
    return [
        ".".join(octet() for _ in range(4)),
        f"{digits(3)}-{digits(4)}",
        f"+1-{digits(3)}-{digits(3)}-{digits(4)}",
        digits(16),
        "-".join(digits(4) for _ in range(4)),
        f"20{digits(2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
        f"v{rng.randint(0, 20)}.{rng.randint(0, 30)}.{rng.randint(0, 99)}",
        f"{rng.randint(0, 20)}.{rng.randint(0, 30)}.{rng.randint(0, 99)}-rc{rng.randint(1, 9)}",
        f"mail{rng.randint(1, 9)}.example.com",
    ]


@pytest.mark.parametrize("n_labelled", [15, 400])
@pytest.mark.parametrize(
    "make",
    [
        lambda rng: "".join(rng.choices(ALNUM, k=32)),
        lambda rng: "sk_live_" + "".join(rng.choices(ALNUM, k=24)),
        lambda rng: "".join(rng.choices(string.ascii_uppercase + string.digits, k=20)),
    ],
)
def test_hidden_credentials_are_found_and_clean_tokens_left(spark, make, n_labelled):
    rng = random.Random(64)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 14)))
    rows, hidden = [], {}
    for i in range(800):
        words = [word() for _ in range(30)] + [word().title(), word().upper(), word() + "."]
        words += rng.sample(clean_tokens(rng), 3)
        rng.shuffle(words)
        if i < n_labelled:
            words.append(f"api_key = {make(rng)}")
        elif i >= 600:
            value = make(rng)
            at = len(" ".join(words)) + 1
            hidden[i] = f"format:{at}:{at + len(value)}"
            words.append(value)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"].split(",") for r in scan_secrets(docs).collect()}
    found = sum(hidden[i] in got[i] for i in hidden)
    assert found >= 0.9 * len(hidden), found
    others = [s for i in got for s in got[i] if s.startswith("format") and s != hidden.get(i)]
    assert others == []


def test_few_credentials_teach_nothing(spark):
    rng = random.Random(65)
    value = lambda: "".join(rng.choices(ALNUM, k=32))
    rows = [(i, f"some text api_key = {value()} and {value()}") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all("format" not in r["spans"] for r in scan_secrets(docs).collect())


def test_strata():
    got = strata(["abc", "xyz", "a1", "A.b"]).tolist()
    assert got == [1, 2, 1 | 8, 4 | 1 << 8 - 1 | 1] and strata([]).tolist() == []


def test_states_with_cycles_are_compared_to_the_end():
    rng = random.Random(66)
    a = Automaton([classes_of("".join(rng.choices("ab1", k=rng.randint(6, 60)))) for _ in range(800)])
    assert len(a.states) < 200
