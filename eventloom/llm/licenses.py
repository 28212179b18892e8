"""Licence scans by sentence rules, in DataFrame functions alone.

A text is cut into sentences, each normalised and mapped to the identifiers of known licence
sentences.  The identifiers of a text, in order, are matched against ordered licence rules;
what a rule matches is used up, so a shorter rule does not fire on it again.

With ``unwrap``, which the query uses, sentences go on over line ends and give all their
identifiers.  Without it they end at each line end and give one, which is what the SQL does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

# Identifiers of licence sentences and what their normalised text looks like
# (lower case; all but letters, digits, dots, plus and minus are one space).  First match wins.
SENTENCES = (
    ("mit_grant", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit_notice", "the above copyright notice and this permission notice shall be included"),
    ("mit_as_is", "the software is provided as is without warranty of any kind"),
    ("mit_liability", "in no event shall the authors or copyright holders be liable"),
    ("bsd_grant", "redistribution and use in source and binary forms with or without modification"),
    ("bsd_source", "redistributions of source code must retain the above copyright notice"),
    ("bsd_binary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd_advert", "all advertising materials mentioning features or use of this software must display"),
    ("bsd_names", "neither the name of .* nor the names of its contributors may be used"),
    ("bsd_as_is", "this software is provided by .* as is and any express or implied warranties"),
    ("isc_grant", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee"),
    ("zlib_grant", "permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("boost_grant", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("boost_name", "boost software license( -)?( version)? 1\\.0"),
    ("apache_or_mit", "licensed under (either (of )?)?(the )?apache license( version)? 2\\.0 .*or (the )?mit license"),
    ("apache_2", "licensed under (the )?apache license( version)? 2\\.0"),
    ("apache_terms", "you may not use this file except in compliance with the license"),
    ("apache_copy", "you may obtain a copy of the license at"),
    ("lgpl_3", "gnu lesser general public license( version| v) ?3"),
    ("lgpl_2_1", "gnu lesser general public license( version| v) ?2\\.1"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl_3", "gnu affero general public license( version| v) ?3"),
    ("agpl", "gnu affero general public license"),
    ("gpl_3", "gnu general public license( version| v) ?3"),
    ("gpl_2", "gnu general public license( version| v) ?2"),
    ("gpl", "gnu general public license"),
    ("version_3", "^either version 3 of the license"),
    ("version_2_1", "^either version 2\\.1 of the license"),
    ("version_2", "^either version 2 of the license"),
    ("later", "or at your option any later version"),
    ("mpl_2", "mozilla public license( version| v)?\\.? ?2\\.0"),
    ("epl_2", "eclipse public license( -)?( version| v)?\\.? ?2\\.0"),
    ("epl_1", "eclipse public license( -)?( version| v)?\\.? ?1\\.0"),
    ("artistic_2", "artistic license( version)? 2\\.0"),
    ("cc_by_nc_nd_4", "cc by-nc-nd 4\\.0"),
    ("cc_by_nc_sa_4", "cc by-nc-sa 4\\.0"),
    ("cc_by_nc_4", "cc by-nc 4\\.0|creative commons attribution-noncommercial 4\\.0"),
    ("cc_by_sa_4", "cc by-sa 4\\.0|creative commons attribution-sharealike 4\\.0"),
    ("cc_by_4", "cc by 4\\.0|creative commons attribution 4\\.0"),
    ("cc0", "cc0 1\\.0|creative commons zero"),
    ("mit_name", "(released|licensed|available|distributed) under the (terms of the )?mit license"),
    ("bsd_name", "(released|licensed|available|distributed) under the (terms of the )?bsd license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("public_domain", "(released into|dedicated to|placed in) the public domain"),
    ("all_rights", "all rights reserved"),
    ("copyright", "^copyright( c)? [0-9]{4}"),
)

# Licences named in a line "SPDX-License-Identifier: ...".
SPDX = (
    "Apache-2.0 OR MIT", "MIT OR Apache-2.0",
    "MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "Zlib", "BSL-1.0",
    "Unlicense", "MPL-2.0", "EPL-1.0", "EPL-2.0", "Artistic-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0-only", "AGPL-3.0-or-later",
)

# Licences and the sentences they need in this order, stricter rules first.
RULES = (
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is")),
    ("BSD-4-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_advert", "bsd_names", "bsd_as_is")),
    ("BSD-4-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_advert", "bsd_names")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("ISC", ("isc_grant",)),
    ("Zlib", ("zlib_grant",)),
    ("BSL-1.0", ("boost_name", "boost_grant")),
    ("BSL-1.0", ("boost_name",)),
    ("BSL-1.0", ("boost_grant",)),
    ("Apache-2.0 OR MIT", ("apache_or_mit",)),
    ("Apache-2.0", ("apache_2", "apache_terms", "apache_copy")),
    ("Apache-2.0", ("apache_2",)),
    ("GPL-3.0-or-later", ("gpl", "version_3", "later")),
    ("GPL-2.0-or-later", ("gpl", "version_2", "later")),
    ("GPL-3.0-or-later", ("gpl_3", "later")),
    ("GPL-2.0-or-later", ("gpl_2", "later")),
    ("GPL-3.0-only", ("gpl_3",)),
    ("GPL-2.0-only", ("gpl_2",)),
    ("LGPL-3.0-or-later", ("lgpl", "version_3", "later")),
    ("LGPL-2.1-or-later", ("lgpl", "version_2_1", "later")),
    ("LGPL-3.0-or-later", ("lgpl_3", "later")),
    ("LGPL-2.1-or-later", ("lgpl_2_1", "later")),
    ("LGPL-3.0-only", ("lgpl_3",)),
    ("LGPL-2.1-only", ("lgpl_2_1",)),
    ("LGPL", ("lgpl",)),
    ("AGPL-3.0-or-later", ("agpl", "version_3", "later")),
    ("AGPL-3.0-or-later", ("agpl_3", "later")),
    ("AGPL-3.0-only", ("agpl_3",)),
    ("AGPL", ("agpl",)),
    ("GPL", ("gpl",)),
    ("MPL-2.0", ("mpl_2",)),
    ("EPL-2.0", ("epl_2",)),
    ("EPL-1.0", ("epl_1",)),
    ("Artistic-2.0", ("artistic_2",)),
    ("CC-BY-NC-ND-4.0", ("cc_by_nc_nd_4",)),
    ("CC-BY-NC-SA-4.0", ("cc_by_nc_sa_4",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_4",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_4",)),
    ("CC-BY-4.0", ("cc_by_4",)),
    ("CC0-1.0", ("cc0",)),
    ("MIT", ("mit_name",)),
    ("BSD", ("bsd_name",)),
    ("Unlicense", ("unlicense", "public_domain")),
    ("Unlicense", ("unlicense",)),
    ("public-domain", ("public_domain",)),
    ("proprietary", ("copyright", "all_rights")),
    ("proprietary", ("all_rights",)),
)



def _spdx_id(name: str) -> str:
    return "spdx_" + name.lower().replace("-", "_").replace(".", "_").replace(" ", "_")


# A named licence ends at a blank: of expressions that are not listed the first one counts.
SENTENCES += tuple(
    (_spdx_id(n), "spdx-license-identifier " + n.lower().replace(".", "\\.") + "( |$)") for n in SPDX
)
RULES += tuple(
    ("Apache-2.0 OR MIT" if " OR " in n else n, (_spdx_id(n),)) for n in SPDX
)

# Every known sentence holds one of these words; a text without any is not cut at all.
HINT = "(?i)licen[sc]e|copyright|permission|redistribut|cc0|cc by|warranty|public domain|rights reserved|no event|any later|neither the name|as is|creative commons|advertising materials"
# With unwrap: the words of a hint may be on two lines, a version may follow other words.
WRAPPED_HINT = HINT.replace(" ", "[^a-z0-9]+")
WRAPPED_SENTENCES = tuple(
    (n, p.removeprefix("^") if n.startswith("version_") else p) for n, p in SENTENCES
)


def _wrapped_rules() -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Rules of whole notices, stricter first: headers of grants, later mentions of a GPL."""
    out = []
    for name, chain in RULES:
        if chain[0] in ("mit_grant", "bsd_grant", "isc_grant"):
            out += [(name, ("copyright", "all_rights", *chain)), (name, ("all_rights", *chain))]
        family = name.split("-")[0].lower()
        if family in ("gpl", "lgpl", "agpl") and "-" in name and not chain[0].startswith("spdx"):
            out += [(name, (*chain, family, family)), (name, (*chain, family))]
        out.append((name, chain))
    return tuple(out)


WRAPPED_RULES = _wrapped_rules()
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SENTENCE_END = "([.!?;])[ \\t\\r\\f]+"
NOISE = "[^a-z0-9.+-]+"
EDGES = "^[ .+-]+|[ .+-]+$"
# With unwrap: comment leaders, and what ends a sentence.
LEADERS = "(?dm)^[ \\t]*(?:/\\*+|\\*+/?|//+|#+|--+|;+|%+|<!--|>+)"
WRAPPED_END = (
    "([.!?;])[ \\t\\r\\f\\n]+|\\n[ \\t\\r\\f\\n]*\\n"
    "|\\n(?=[ \\t]*copyright[^a-z0-9.+-]+(?:c[^a-z0-9.+-]+)?[0-9]{4})"
)


def _sentences(text: Column, unwrap: bool) -> Column:
    """Normalised sentences.

    They end at a line end, or at a mark before white space.  With ``unwrap`` a line end alone
    ends none: a mark, a blank line or a next line with a copyright notice does.
    """
    lower = F.translate(text, UPPER, UPPER.lower())
    if unwrap:
        marked = F.regexp_replace(F.regexp_replace(lower, LEADERS, ""), WRAPPED_END, "$1\n\n")
        parts = F.split(marked, "\n\n+")
    else:
        parts = F.split(F.regexp_replace(lower, SENTENCE_END, "$1\n"), "\n")

    def clean(s: Column) -> Column:
        s = F.regexp_replace(F.regexp_replace(s, NOISE, " "), EDGES, "")
        return F.regexp_replace(s, "licence", "license")

    return F.transform(parts, clean)


def _identifier(sentence: Column, sentences: tuple[tuple[str, str], ...] = SENTENCES) -> Column:
    found = F.lit(None).cast("string")
    for name, pattern in reversed(sentences):
        found = F.when(sentence.rlike(pattern), name).otherwise(found)
    return found


def _identifiers(sentence: Column) -> Column:
    """All known sentences in a long one by place; of those at one place the first."""
    patterns = [(n, p.replace("(", "(?:").replace(".*", ".*?")) for n, p in WRAPPED_SENTENCES]
    any_of = "|".join(p for _, p in patterns)
    # a look ahead takes nothing, so one may begin within another
    places = F.regexp_extract_all(sentence, F.lit(f"(?=({any_of}))"), F.lit(1))
    starting = tuple((n, f"^(?:{p})") for n, p in patterns)
    return F.transform(places, lambda s: _identifier(s, starting))


def _matched(chain: Column, known: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """Licences of a chain of identifiers like ``;a;;b;``: rules by their order."""
    rules = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), F.lit("".join(f";{i};" for i in chain_)).alias("chain")
            )
            for name, chain_ in known
        ]
    )
    start = F.struct(chain.alias("rest"), F.array().cast("array<string>").alias("found"))
    state = F.aggregate(
        rules,
        start,
        lambda s, r: F.when(
            F.contains(s["rest"], r["chain"]),
            F.struct(
                F.replace(s["rest"], r["chain"], F.lit("|")).alias("rest"),
                F.concat(s["found"], F.array(r["name"])).alias("found"),
            ),
        ).otherwise(s),
    )
    return F.array_distinct(state["found"])


def scan_licenses(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", unwrap: bool = False
) -> DataFrame:
    """Per row doc_id, sentence_ids, licenses, n_licenses.

    ``sentence_ids`` are the known sentences of the text in order, ``licenses`` the distinct
    licences in the order of the rules, both joined by commas; unknown sentences between known
    ones do not matter.  With ``unwrap`` sentences may be wrapped over lines, with or without
    comment leaders, and give all they hold; else each line is cut and gives one.  A text without any has empty strings.  Null or empty text has none; a
    null id is kept, repeated rows give repeated results, an empty table gives none, other
    columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<string>")
    hinted = text.rlike(WRAPPED_HINT if unwrap else HINT)
    sentences = F.when(hinted, _sentences(text, unwrap)).otherwise(none)
    if unwrap:
        known = F.flatten(F.transform(sentences, _identifiers))
    else:
        known = F.transform(sentences, lambda s: _identifier(s))
    ids = F.filter(known, lambda i: i.isNotNull())
    rules = WRAPPED_RULES if unwrap else RULES
    chain = F.concat_ws("", F.transform("ids", lambda i: F.concat(F.lit(";"), i, F.lit(";"))))
    return (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), ids.alias("ids"))
        .select("doc_id", "ids", F.when(F.size("ids") > 0, _matched(chain, rules)).otherwise(none).alias("l"))
        .select(
            "doc_id",
            F.concat_ws(",", "ids").alias("sentence_ids"),
            F.concat_ws(",", "l").alias("licenses"),
            F.size("l").alias("n_licenses"),
        )
    )


def op4_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir), unwrap=True)


def _sql() -> str:
    identify = " ".join(f"WHEN regexp_matches(s, '{p}') THEN '{n}'" for n, p in SENTENCES)
    steps, previous = [], "c0"
    for i, (name, chain) in enumerate(RULES):
        joined = "".join(f";{x};" for x in chain)
        steps.append(
            f"c{i + 1} AS (SELECT doc_id, ids, replace(rest, '{joined}', '|') AS rest, "
            f"CASE WHEN contains(rest, '{joined}') AND NOT list_contains(found, '{name}') "
            f"THEN list_append(found, '{name}') ELSE found END AS found FROM {previous})"
        )
        previous = f"c{i + 1}"
    return f"""
WITH cut AS (
  SELECT doc_id, list_transform(
    string_split(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
      '([.!?;])[ \\t\\r\\f]+', '\\1' || chr(10), 'g'), chr(10)),
    lambda s: replace(regexp_replace(regexp_replace(s, '{NOISE}', ' ', 'g'), '{EDGES}', '', 'g'),
                 'licence', 'license')) AS sentences
  FROM documents),
known AS (
  SELECT doc_id, list_filter(list_transform(sentences, lambda s: CASE {identify} END), lambda x: x IS NOT NULL) AS ids
  FROM cut),
c0 AS (
  SELECT doc_id, ids, coalesce(array_to_string(list_transform(ids, lambda i: ';' || i || ';'), ''), '') AS rest,
         CAST([] AS VARCHAR[]) AS found FROM known),
{", ".join(steps)}
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(found, ','), '') AS licenses, CAST(len(found) AS INTEGER) AS n_licenses
FROM {previous}
"""


QUERIES = {"op4_license_sentences": op4_license_sentences}
SQL = {"op4_license_sentences": _sql()}
