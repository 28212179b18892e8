import duckdb
import pytest

from eventloom.llm.licenses import SQL, scan_licenses

GNU = """This library is free software; you can redistribute it and/or modify it under the terms of the
GNU {0} General Public License as published by the Free Software Foundation; either
version {1} of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY. See the GNU {0}
General Public License for more details.

You should have received a copy of the GNU {0} General Public License along with this library."""
BSD_4 = """Redistribution and use in source and binary forms, with or without modification, are permitted.
1. Redistributions of source code must retain the above copyright notice, this list.
2. Redistributions in binary form must reproduce the above copyright notice, this list.
3. All advertising materials mentioning features or use of this software must display the following text.
4. Neither the name of the owner nor the names of its contributors may be used to endorse products."""
TEXTS = [
    (GNU.format("Lesser", "2.1"), "LGPL-2.1-or-later"),
    (GNU.format("Lesser", "3"), "LGPL-3.0-or-later"),
    (GNU.format("Affero", "3"), "AGPL-3.0-or-later"),
    ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT"),
    ("# SPDX-License-Identifier: MIT-0", "MIT-0"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0 OR MIT"),
    (
        "Licensed under the Apache License, Version 2.0 <LICENSE-APACHE or\n"
        "https://www.apache.org/licenses/LICENSE-2.0> or the MIT license <LICENSE-MIT>, at your option.",
        "Apache-2.0 OR MIT",
    ),
    (
        "Permission is granted to anyone to use this software for any purpose,\nincluding commercial "
        "applications, and to alter it and redistribute it freely.",
        "Zlib",
    ),
    (
        "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of "
        "charge, to any person or organization\nobtaining a copy of the software covered by this license",
        "BSL-1.0",
    ),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    (
        "This program and the accompanying materials are made available under the terms of the\n"
        "Eclipse Public License 2.0 which is available at a site.",
        "EPL-2.0",
    ),
    ("You may use this under the Artistic License 2.0.", "Artistic-2.0"),
    (BSD_4, "BSD-4-Clause"),
    ("The licence of the Eclipse car is public. A boost for software.", ""),
]


def test_notices(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in scan_licenses(docs, unwrap=True).collect()}
    assert got == {i: want for i, (_, want) in enumerate(TEXTS)}


def test_sql_agrees_with_the_form_that_is_cut_at_line_ends(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in scan_licenses(docs).collect())
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(duck.execute(SQL["op4_license_sentences"]).fetchall())


@pytest.mark.parametrize("unwrap", [False, True])
def test_empty_and_null(spark, unwrap):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r["licenses"] for r in scan_licenses(docs, unwrap=unwrap).collect()] == ["", ""]
