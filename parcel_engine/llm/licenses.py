"""License scans: licences recognised by the sequence of their known sentences.

Texts are cut into paragraphs at blank lines, and each paragraph into sentences twice: with line ends
as ends, as notices stand in lists, and without, as licence texts are wrapped. Of the two the reading
that knows more sentences counts, the first if both know as many. Sentences end at full stops,
semicolons, question and exclamation marks before white space. They are normalised (lower case, runs
of other characters than letters and digits become one space, so marks of comments do not matter),
and known ones become identifiers. The identifiers of a document, in order, are matched against
ordered rules: a rule names a licence and the identifiers that must follow one another, with
nothing known between them. The first rule that matches is the document's licence; the others
that match are listed as well.

Known are the sentences that tell these licences: MIT, ISC, BSD-2-Clause, BSD-3-Clause, zlib, BSL-1.0,
Apache-2.0, MPL-2.0, GPL-2.0, GPL-3.0, LGPL-2.1, LGPL-3.0, AGPL-3.0, Unlicense, CC0-1.0 and CC 4.0 in its six
kinds, as full texts, as the headers that files carry, and as notices of one line.

Defined cases: a null or empty text has no sentence and no licence; a sentence that occurs twice
counts twice; repeated rows are scanned one by one; long texts and long sentences are read whole.
Columns that have the names of the result's are replaced, all others return as they were. Everything
is one projection: nothing is shuffled, so a hot source or a sentence that every document has costs
what others cost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import numbered

_CC = {
    "by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
_FREE = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
_LATER = "either version {} of the License, or (at your option) any later version."

#: Known sentences by identifier: fixed values, in the words of the licences.
SENTENCES = {
    "mit-release": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "mit-title": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    ],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-as-is": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    ],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "bsd-grant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2.",
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "bsd-endorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.",
    ],
    "zlib-grant": ["This software is provided 'as-is', without any express or implied warranty."],
    "bsl-title": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "bsl-notice": ["Distributed under the Boost Software License, Version 1.0."],
    "apache-2-title": ["Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "apache-2-notice": ["Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License");'],
    "apache-2-condition": ["you may not use this file except in compliance with the License."],
    "mpl-2-notice": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    ],
    "gpl-3-notice": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is licensed under the GNU General Public License, version 3.",
    ],
    "gpl-2-notice": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl-free": [_FREE.format("General Public License")],
    "gpl-3-header": ["This program is free software: " + _FREE.format("General Public License") + ", " + _LATER.format(3)],
    "lgpl-free": [_FREE.format("Lesser General Public License")],
    "lgpl-3-header": [
        "This program is free software: " + _FREE.format("Lesser General Public License") + ", " + _LATER.format(3),
        "This library is free software: " + _FREE.format("Lesser General Public License") + ", " + _LATER.format(3),
    ],
    "agpl-3-header": ["This program is free software: " + _FREE.format("Affero General Public License") + ", " + _LATER.format(3)],
    "or-later-2": [_LATER.format(2)],
    "or-later-2.1": [_LATER.format("2.1")],
    "gpl-later": [_LATER.format(3)],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc0": ["To the extent possible under law, the author has waived all copyright.", "CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal"],
} | {
    f"cc-{kind}-4": [
        f"Licensed under CC {kind.upper()} 4.0.", f"This work is licensed under CC {kind.upper()} 4.0.",
        f"This work is licensed under a Creative Commons {name} 4.0 International License.",
        f"This work is licensed under the Creative Commons {name} 4.0 International License.",
    ]
    for kind, name in _CC.items()
} | {"reserved": ["All rights reserved."]}


@dataclass(frozen=True)
class Rule:
    licence: str
    sequence: tuple[str, ...]


#: Most specific first.
RULES = [
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-endorse")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("BSD-2-Clause", ("bsd-grant",)),
    Rule("MIT", ("mit-title", "mit-grant")),
    Rule("MIT", ("mit-grant",)),
    Rule("MIT", ("mit-release",)),
    Rule("MIT", ("mit-title", "mit-notice")),
    Rule("ISC", ("isc-grant",)),
    Rule("Zlib", ("zlib-grant",)),
    Rule("BSL-1.0", ("bsl-title",)),
    Rule("BSL-1.0", ("bsl-notice",)),
    Rule("Apache-2.0", ("apache-2-notice", "apache-2-condition")),
    Rule("Apache-2.0", ("apache-2-notice",)),
    Rule("Apache-2.0", ("apache-2-title",)),
    Rule("MPL-2.0", ("mpl-2-notice",)),
    Rule("AGPL-3.0-or-later", ("agpl-3-header",)),
    Rule("LGPL-3.0-or-later", ("lgpl-3-header",)),
    Rule("LGPL-2.1-or-later", ("lgpl-free", "or-later-2.1")),
    Rule("GPL-3.0-or-later", ("gpl-3-header",)),
    Rule("GPL-3.0-or-later", ("gpl-free", "gpl-later")),
    Rule("GPL-2.0-or-later", ("gpl-free", "or-later-2")),
    Rule("GPL-3.0-or-later", ("gpl-3-notice", "gpl-later")),
    Rule("GPL-3.0-only", ("gpl-3-notice",)),
    Rule("GPL-2.0-only", ("gpl-2-notice",)),
    Rule("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    Rule("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    Rule("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    Rule("CC-BY-4.0", ("cc-by-4",)),
    Rule("CC0-1.0", ("cc0",)),
    Rule("Unlicense", ("unlicense",)),
    Rule("All rights reserved", ("reserved",)),
]

PARAGRAPHS = r"\n[ \t\r]*\n"
LINES = r"\n|(?<=[.;!?])[ \t\r]+"
WRAPPED = r"(?<=[.;!?])[ \t\r\n]+"
OTHER = r"[^\p{L}\p{N}]+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), OTHER, " "))


def known_sentences(sentences: dict[str, list[str]] = SENTENCES) -> dict[str, str]:
    """Normalised sentence to identifier. The parameters are a few hundred fixed texts."""
    import re

    clean = lambda s: re.sub(r"[\W_]+", " ", s.lower()).strip()
    return {clean(s): name for name, texts in sentences.items() for s in texts}


def license_scan(docs: DataFrame, *, text_column: str = "text", sentences: dict[str, list[str]] = SENTENCES,
                 rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with ``n_known``, ``sentence_ids``, ``license`` (null if none) and ``licenses``."""
    known = known_sentences(sentences)
    renamed, columns, _ = numbered(docs)
    text = F.coalesce(F.col(columns[text_column]), F.lit(""))
    names = F.create_map([F.lit(x) for pair in known.items() for x in pair])

    def ids(paragraph, ends):
        clean = F.transform(F.split(paragraph, ends), normalised)
        return F.transform(F.filter(clean, lambda s: s.isin(list(known))), lambda s: F.element_at(names, s))

    nothing = F.array().cast("array<string>")
    readings = F.transform(
        F.split(text, PARAGRAPHS),
        lambda p: F.struct(ids(p, LINES).alias("lines"), F.when(F.contains(p, F.lit("\n")), ids(p, WRAPPED)).otherwise(nothing).alias("wrapped")),
    )
    chosen = F.transform(readings, lambda r: F.when(F.size(r["wrapped"]) > F.size(r["lines"]), r["wrapped"]).otherwise(r["lines"]))
    joined = F.concat(F.lit(","), F.array_join(F.col("ids"), ","), F.lit(","))
    hit = lambda r: joined.contains("," + ",".join(r.sequence) + ",")
    every = F.array_distinct(F.array_compact(F.array(*(F.when(hit(r), F.lit(r.licence)) for r in rules))))
    results = {
        "n_known": F.size("ids").cast("long"), "sentence_ids": F.array_join("ids", ","),
        "license": F.try_element_at("every", F.lit(1)), "licenses": F.array_join("every", ","),
    }
    found = renamed.withColumn("ids", F.flatten(chosen)).withColumn("every", every)
    kept = [F.col(k).alias(name) for name, k in columns.items() if name not in results]
    return found.select(*kept, *(value.alias(name) for name, value in results.items()))


def oracle() -> str:
    """The same scan in DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = known_sentences()
    values = ", ".join(f"({quote(s)}, {quote(n)})" for s, n in known.items())
    cases = ", ".join(
        f"CASE WHEN contains(j, {quote(',' + ','.join(r.sequence) + ',')}) THEN {quote(r.licence)} END" for r in RULES
    )
    first = "COALESCE(" + cases + ")"
    cut = lambda space: f"string_split(regexp_replace(p, '([.;!?])[{space}]+', '\\1' || chr(1), 'g'), chr(1))"
    lines = cut(" \\t\\r").replace("regexp_replace(", "replace(regexp_replace(", 1).replace("'g'), chr(1))", "'g'), chr(10), chr(1)), chr(1))")
    wrapped = cut(" \\t\\r\\n")
    return f"""
WITH known(s, name) AS (VALUES {values}),
paragraphs AS (
  SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '\\n[ \\t\\r]*\\n')) AS p,
         generate_subscripts(string_split_regex(coalesce(text, ''), '\\n[ \\t\\r]*\\n'), 1) AS i FROM documents),
sentences AS (
  SELECT doc_id, i, 1 AS reading, unnest({lines}) AS x, generate_subscripts({lines}, 1) AS k FROM paragraphs
  UNION ALL
  SELECT doc_id, i, 2, unnest({wrapped}), generate_subscripts({wrapped}, 1) FROM paragraphs WHERE contains(p, chr(10))),
read AS (
  SELECT doc_id, i, reading, string_agg(name, ',' ORDER BY k) AS ids, count(*) AS n
  FROM sentences JOIN known ON trim(regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) = s GROUP BY ALL),
chosen AS (SELECT * FROM read QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY n DESC, reading) = 1),
found AS (SELECT doc_id, string_agg(ids, ',' ORDER BY i) AS ids, CAST(sum(n) AS BIGINT) AS n FROM chosen GROUP BY doc_id),
all_docs AS (
  SELECT d.doc_id, coalesce(ids, '') AS ids, coalesce(n, 0) AS n, ',' || coalesce(ids, '') || ',' AS j
  FROM documents d LEFT JOIN found USING (doc_id))
SELECT doc_id, n AS n_known, ids AS sentence_ids, {first} AS license,
       array_to_string(list_distinct_ordered, ',') AS licenses
FROM (SELECT *, list_filter([{cases}], lambda x: x IS NOT NULL) AS hits FROM all_docs),
     LATERAL (SELECT list_transform(list_filter(range(1, len(hits) + 1), lambda q: list_position(hits, hits[q]) = q), lambda q: hits[q]) AS list_distinct_ordered)
"""
