import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_cover_tree import brute

from eventloom.llm import cover_tree
from eventloom.llm.cover_tree import Best, CoverTree, _packed, _unpacked, in_cone, search_chunk, top_k


def clustered(n, dim, seed, size=100):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, size, (8, dim))
    return np.rint(centres[rng.integers(0, 8, n)] + rng.normal(0, size / 10, (n, dim))).astype(np.int64)


@pytest.mark.parametrize("size", [50, 5_000, 2_000_000_000])
def test_all_groups_meet_all_blocks_at_once(size):
    points = clustered(700, 6, 81, size)
    blocks = [CoverTree(np.arange(i, i + 100), points[i : i + 100]) for i in range(0, 700, 100)]
    blocks = [pickle.loads(pickle.dumps(b)) for b in blocks]
    groups = [CoverTree(np.arange(i, i + 30), points[i : i + 30]) for i in range(0, 120, 30)]
    own = np.concatenate([g.ids for g in groups])
    best = Best(len(own), 4, np.full(len(own), -np.inf))
    search_chunk(groups, np.array([3, -1, -1, 3]), enumerate(blocks), best)
    for i, q in enumerate(own.tolist()):
        left_out = range(300, 400) if q < 30 or q >= 90 else ()
        scores = [(-sum(int(a) * int(b) for a, b in zip(points[q], x)), j) for j, x in enumerate(points)]
        want = sorted((max(s, -(2**63 - 1)), j) for s, j in scores if j != q and j not in left_out)[:4]
        assert [(-int(s), int(j)) for s, j in zip(best.scores[i], best.ids[i])] == want


def test_nothing_in_a_cone_is_above_its_bound():
    points = clustered(400, 5, 82)
    tree = CoverTree(np.arange(400), points[np.argsort(points[:, 0])][:400])
    for part in (tree, CoverTree(np.arange(60), points[np.argsort(points @ points[0])][-60:])):
        asked = np.random.default_rng(83).normal(0, 90, (500, 5))
        lengths = np.sqrt((asked**2).sum(1))
        bound = in_cone(asked @ part.centres[0], lengths, part)
        assert ((asked @ part.points.T).max(1) <= bound + 1e-6 * lengths * part.longest).all()


def test_packed_vectors_come_back():
    import pyarrow as pa

    rows = [[1, -128], [1, 128], [2**40, -(2**63)], [5], [2**31, 0], [-(2**15), 3], [7, 7, 7], [2**63 - 1]]
    batch = pa.record_batch([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["vec_id", "v"])
    got, packed = {}, []
    for b in _packed([batch.slice(1), batch.slice(0, 1)]):
        packed += b.column(1).to_pylist()
        for at, points in _unpacked(b.column(1)):
            got |= {b.column(0)[i].as_py(): p for i, p in zip(at.tolist(), points.tolist())}
    assert got == dict(enumerate(rows)) and sorted(map(len, packed)) == [2, 3, 4, 5, 5, 9, 17, 17]


def test_many_chunks_and_parts_move_each_tree_once_per_task(spark, monkeypatch):
    rng = random.Random(84)
    rows = [(i, tuple(rng.randint(-90, 90) for _ in range(4))) for i in range(900)] + [(7, (1, 2)), (3000, (3, 4))]
    df = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, v array<long>")
    monkeypatch.setattr(cover_tree, "CHUNK_BYTES", 800)
    monkeypatch.setattr(cover_tree, "PART_BYTES", 30_000)
    moved = []
    dealt = cover_tree._dealt

    def watched(blocks, groups, n_chunks, n_parts):
        out = dealt(blocks, groups, n_chunks, n_parts)
        if "tree" in blocks.columns:
            moved.append((n_chunks, n_parts, groups.count(), blocks.count(), out.count()))
        return out

    monkeypatch.setattr(cover_tree, "_dealt", watched)
    got = top_k(df, df.where(F.col("vec_id") % 10 == 0), 5, block_size=64, group_size=16, n_pivots=8)
    assert sorted(map(tuple, got.collect())) == brute(rows, [r for r in rows if r[0] % 10 == 0], 5)
    [(n_chunks, n_parts, n_groups, n_blocks, n_moved)] = moved
    assert n_chunks > 1 and n_parts > 1 and n_moved == n_groups * n_parts + n_blocks * n_chunks < n_groups * n_blocks
