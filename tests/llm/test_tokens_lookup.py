import random

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm.tokens import ChunkEncoder, default_tokenizer


@pytest.mark.parametrize("most", [50, 100_000])
def test_known_chunks_stay_in_arrow_and_only_new_ones_are_learned(most, monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(76)
    words = ["".join(rng.choices("abcdeé中", k=rng.randint(1, 6))) for _ in range(400)]
    batches = [[" ".join(rng.choices(words[:n], k=60)) for _ in range(20)] + ["", None, "  a\n"] for n in (40, 400, 40)]
    learned = []
    learn = ChunkEncoder._learn
    monkeypatch.setattr(ChunkEncoder, "_learn", lambda self, new: learned.append(new) or learn(self, new))
    code, tok = ChunkEncoder(default_tokenizer(), most), Tokenizer.from_file(default_tokenizer())
    for texts in batches:
        ids, counts = code.encode(pa.array(texts, pa.string()))
        want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert isinstance(code.known, pa.Array) and len(code.known.unique()) == len(code.known)
    if most > 50:  # nothing was dropped, so nothing is learned twice
        flat = [c for new in learned for c in new]
        assert len(flat) == len(set(flat)) == len(code.known)
        before = len(learned)
        code.encode(pa.array(batches[1], pa.string()))
        assert len(learned) == before


def test_no_texts_and_only_empty_ones():
    code = ChunkEncoder(default_tokenizer())
    for texts in ([], [None], ["", None], ["a"], []):
        ids, counts = code.encode(pa.array(texts, pa.string()))
        assert len(counts) == len(texts) and len(ids) == counts.sum()
        assert np.array_equal(counts, [bool(t) for t in texts])
