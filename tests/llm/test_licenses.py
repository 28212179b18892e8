import re

import duckdb
import pytest

from eventloom.llm.licenses import HINT, RULES, SENTENCES, SQL, scan_licenses

TEXTS = {
    1: ("Some prose. Licensed under the Apache License, Version 2.0.\nMore prose", "apache_2", "Apache-2.0"),
    2: ("# Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\n"
        "// The above copyright notice and this permission notice shall be included in all copies.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND; in no event shall the authors or '
        "copyright holders be liable.", "mit_grant,mit_notice,mit_as_is,mit_liability", "MIT"),
    3: ("under the terms of the GNU General Public License; either version 3 of the Licence, or (at your option) any later version",
        "gpl,version_3", "GPL"),
    4: ("GNU General Public License, version 3. Or, at your option, any later version.", "gpl_3,later", "GPL-3.0-or-later"),
    5: ("This work is licensed under the GNU General Public License, version 3.", "gpl_3", "GPL-3.0-only"),
    6: ("Licensed under CC BY-NC 4.0. Unknown words. All rights reserved.", "cc_by_nc_4,all_rights", "CC-BY-NC-4.0,proprietary"),
    7: ("Released under the MIT License.\nReleased under the MIT License.", "mit_name,mit_name", "MIT"),
    8: ("Copyright (c) 2020 Somebody. Chatter here. All rights reserved!", "copyright,all_rights", "proprietary"),
    9: ("Redistributions in binary form must reproduce the above copyright notice.\nRedistribution and use in source and binary forms,"
        " with or without modification, are permitted", "bsd_binary,bsd_grant", ""),
    10: ("nothing of the kind, licence or not", "", ""),
    11: (None, "", ""),
    12: ("", "", ""),
    13: ("word " * 100_000 + "\nLicensed under the Apache License 2.0", "apache_2", "Apache-2.0"),
}


def test_against_expectation_and_sql(spark):
    rows = [(i, t[0], "x", 1) for i, t in TEXTS.items()] + [(None, TEXTS[1][0], "x", 1), (1, TEXTS[1][0], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses string, ids int")
    got = scan_licenses(docs.repartition(3)).collect()
    for r in got:
        want = TEXTS[r["doc_id"] or 1]
        assert (r["sentence_ids"], r["licenses"]) == want[1:], r["doc_id"]
        assert r["n_licenses"] == len([x for x in want[2].split(",") if x])
    assert len(got) == len(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    sql = con.execute(SQL["op4_license_sentences"]).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(sql, key=repr)


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name,pattern", SENTENCES)
def test_hint_covers_every_sentence(name, pattern):
    hint = re.compile(HINT)
    for choice in re.sub(r"\((?:[^()|]*\|)*([^()|]*)\)\??", r"\1", pattern).split("|"):
        plain = choice.replace("\\", "").replace("^", "").replace("?", "")
        assert hint.search(plain), plain


def test_rules_use_known_sentences_and_stricter_come_first():
    names = [n for n, _ in SENTENCES]
    assert len(set(names)) == len(names)
    for i, (_, chain) in enumerate(RULES):
        assert set(chain) <= set(names)
        for _, later in RULES[i + 1 :]:
            ours, theirs = ("".join(f";{x};" for x in c) for c in (chain, later))
            assert ours not in theirs
