import random

import pytest

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, docs, labels):
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )


def row(i, text, source="a"):
    return (i, text, "en", source, len(text or ""))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(31)
    words = [a + b + c for a in "bcdfg" for b in "aeiou" for c in "lmnrs"]
    docs, labels = [], []
    for i in range(400):
        text = " ".join(rng.choices(words, k=rng.randint(30, 200)))
        bad = i % 5 == 4
        if bad:
            text = " ".join(w + "%%%" for w in text.split())
        docs.append(row(i, text, rng.choice(["a", "b", "c"])))
        if i % 2:
            labels.append((i, int(not bad), 0))
    docs.append(row(1000, docs[0][1].replace(" ", "  ", 1)))  # exact but for a space, and longer
    base = next(d for d in docs if d[0] % 5 != 4 and len(d[1].split()) > 150)
    near = base[1].split()
    near[len(near) // 2] = "changed"
    docs.append(row(1001, " ".join(near + ["more", "words"])))
    docs += [row(1002, None, None), row(1003, "", "b"), docs[2], (None, docs[3][1] + " tail", None, None, None)]
    return docs, labels, base[0]


def test_each_stage_decides(spark, tmp_path, corpus):
    docs, labels, base = corpus
    folder = str(tmp_path)
    write(spark, folder, docs, labels)
    data, ids = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = data
        out = f"{folder}/{len(ids)}"
        stage(spark, data, folder).write.parquet(out)
        data = spark.read.parquet(out)
        ids[name] = [r["doc_id"] for r in data.select("doc_id").collect()]
        if name != "best-fit packing":
            assert data.columns == before.columns
    classified, exact, near, mixed, packed = ids.values()
    good = [i for i in range(400) if i % 5 != 4]
    assert len(set(good) & set(classified)) > 0.97 * len(good)
    assert not {i for i in range(400) if i % 5 == 4} & set(classified)
    assert 0 not in exact and 1000 in exact and exact.count(2) <= 1
    assert base in near and 1001 not in near
    assert len(exact) - len(near) <= 3
    assert set(mixed) <= set(near) and max(mixed.count(i) for i in set(mixed)) <= 2
    assert set(packed) == set(mixed)
    total = data.agg({"length": "sum"}).first()[0]
    assert data.select("sequence_id").distinct().count() <= total / 1024 * 1.02 + 2


def test_run_on_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
