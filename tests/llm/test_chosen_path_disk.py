import os
import random

from test_backoff_parts import shuffle_files
from test_chosen_path import brute, corpus

from eventloom.llm import common
from eventloom.llm.chosen_path import similarity_join


def test_only_what_the_result_reads_stays_on_disk(spark, monkeypatch):
    rows, tables = corpus(13), []
    random.Random(13).shuffle(rows)
    path = common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda s, label: tables.append(path(s, label)) or tables[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    files = shuffle_files(spark)
    joined = similarity_join(docs)
    there = {os.path.basename(t).rsplit("-", 1)[0] for t in tables if os.path.exists(t)}
    assert {"join-sketches", "join-result"} <= there
    assert there <= {"join-sketches", "join-result", "graph-edges", "graph-labels"}
    left = [f for f in shuffle_files(spark) - files if os.path.exists(f)]
    assert sum(map(os.path.getsize, left)) < 20_000
    got = joined.select("doc_id", "class_id", "copy_id", "n_links").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
