import pytest

from eventloom.llm.licenses import RULES, WRAPPED_RULES, op4_license_sentences, scan_licenses

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_HEAD = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES.
"""
ISC = """Copyright (c) 2020, Somebody

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE.
"""
APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
BSD_IDS = "copyright,all_rights,bsd_grant,bsd_source,bsd_binary,"
WHOLE = [
    (MIT, "copyright,mit_grant,mit_notice,mit_as_is,mit_liability", "MIT"),
    (BSD_HEAD + BSD_END, BSD_IDS + "bsd_as_is", "BSD-2-Clause"),
    (BSD_HEAD + BSD_NAMES + BSD_END, BSD_IDS + "bsd_names,bsd_as_is", "BSD-3-Clause"),
    (ISC, "copyright,isc_grant", "ISC"),
    (APACHE, "copyright,apache_2,apache_terms,apache_copy", "Apache-2.0"),
    (GPL.format(3), "gpl,version_3,later,gpl,gpl", "GPL-3.0-or-later"),
    (GPL.format(2), "gpl,version_2,later,gpl,gpl", "GPL-2.0-or-later"),
]
OTHERS = [
    ("Released into the public\ndomain", "public_domain", "public-domain"),
    ("Under the MIT or so\nLicensed under the MIT\nlicense and available under the BSD license", "mit_name,bsd_name", "MIT,BSD"),
    ("Some module\nCopyright (c) 2019 A\nCopyright (c) 2020 B\nAll rights reserved", "copyright,copyright,all_rights", "proprietary"),
    ("This software is provided by us, released under the MIT license, as is and any express or implied warranties go",
     "bsd_as_is,mit_name", "MIT"),
    ("one licence\n\nor\nanother", "", ""),
    (None, "", ""),
]


def commented(text, first, each, last):
    return "\n".join([first, *[f"{each} {line}".rstrip() for line in text.splitlines()], last])


def test_wrapped_texts(spark, tmp_path):
    cases = list(OTHERS)
    for text, ids, name in WHOLE:
        cases += [(t, ids, name) for t in (
            text, text.replace("\n", "\r\n"), commented(text, "/*", " *", " */"), commented(text, "#", "#", "#"), commented(text, "", "//", ""),
        )]
    rows = [(i, t) for i, (t, _, _) in enumerate(cases)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op4_license_sentences(spark, str(tmp_path)).collect()}
    for i, (_, ids, name) in enumerate(cases):
        assert (got[i]["sentence_ids"], got[i]["licenses"]) == (ids, name), cases[i][0]
        assert got[i]["n_licenses"] == len([x for x in name.split(",") if x])


def test_long_sentence(spark):
    docs = spark.createDataFrame([(1, "word\n" * 100_000 + "Licensed under the Apache\nLicense 2.0")], "doc_id long, text string")
    assert scan_licenses(docs, unwrap=True).first()["licenses"] == "Apache-2.0"


@pytest.mark.parametrize("at", range(len(WRAPPED_RULES)))
def test_stricter_rules_come_first(at):
    ours = "".join(f";{x};" for x in WRAPPED_RULES[at][1])
    assert not any(ours in "".join(f";{x};" for x in c) for _, c in WRAPPED_RULES[at + 1 :])
    assert set(RULES) <= set(WRAPPED_RULES)
