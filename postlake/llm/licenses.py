r"""Licence scans by sentence rules. DataFrame functions only.

A text is cut into sentences: at `.`, `;`, `!` or `?` before white space or the end, at a colon that ends a line or stands
before a word, at the phrases of LEADS, which a title, a name or the next sentence may run into, and at lines without letters
or digits (blank ones, comment marks). The known sentences are cut in the same way, so one of them may be several
identifiers, which a rule wants one right after the other. Line ends inside a paragraph are taken once as white space
(hard-wrapped licences) and once as ends of sentences (notices between other lines); the reading that recognises more
sentences counts, the first one on a tie. A sentence is normalised to lower-case letters and digits with single spaces and
looked up among the known ones. The identifiers found, in order of the text, are held against the rules in their order: a
rule matches if its identifiers occur in this order, with anything between them, and if what NOT_AFTER names for it does not
follow. A licence is reported once, by its first matching rule.

Defined results: null and empty texts have no sentences and no licence; a licence given twice is reported once; repeated
rows give equal rows; the length of a text doesn't matter, since sentences are mapped one by one; an empty table gives an
empty result. Input columns never clash: only id and text are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of licences and licence notices by identifier.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "mit-title": "The MIT License (MIT)",
    "mit-name": "MIT License",
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-project": "This project is licensed under the MIT License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "isc-released": "Released under the ISC License",
    "isc-licensed": "Licensed under the ISC License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission",
    "bsd-endorse-author": "The name of the author may not be used to endorse or promote products derived from this software "
    "without specific prior written permission",
    "bsd-3-title": "BSD 3-Clause License",
    "bsd-2-title": "BSD 2-Clause License",
    "bsd-3-released": "Released under the BSD 3-Clause License",
    "bsd-3-licensed": "Licensed under the BSD 3-Clause License",
    "bsd-2-released": "Released under the BSD 2-Clause License",
    "bsd-2-licensed": "Licensed under the BSD 2-Clause License",
    "apache-2-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-2-released": "Released under the Apache License, Version 2.0",
    "apache-2-compliance": "you may not use this file except in compliance with the License",
    "apache-2-disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl-3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl-2-work": "This work is licensed under the GNU General Public License, version 2",
    "gpl-3-or-later": "free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version",
    "gpl-2-or-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-2-later-tail": "either version 2 of the License, or (at your option) any later version",
    "gpl-2-later-head": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-details": "See the GNU General Public License for more details",
    "lgpl-details": "See the GNU Lesser General Public License for more details",
    "agpl-3-or-later": "free software: you can redistribute it and/or modify it under the terms of the "
    "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version",
    "agpl-3-work": "This work is licensed under the GNU Affero General Public License, version 3",
    "lgpl-3-work": "This work is licensed under the GNU Lesser General Public License, version 3",
    "mpl-2-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/",
    "mpl-2-copy-http": "If a copy of the MPL was not distributed with this file, You can obtain one at "
    "http://mozilla.org/MPL/2.0/",
    "mpl-2-licensed": "Licensed under the Mozilla Public License, Version 2.0",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0-dedication": "To the extent possible under law, the author has waived all copyright and related or neighboring "
    "rights to this work",
    "unlicense-domain": "This is free and unencumbered software released into the public domain",
    "mit-file": "This file is licensed under the MIT License",
    "mit-software": "This software is licensed under the MIT License",
    "mit-distributed": "Distributed under the MIT License",
    "apache-2-file": "This file is licensed under the Apache License, Version 2.0",
    "apache-2-project": "This project is licensed under the Apache License 2.0",
    "apache-2-head": "Apache License Version 2.0, January 2004",
    "apache-name": "Apache License",
    "apache-2-version": "Version 2.0, January 2004",
    "apache-2-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "gpl-3-head": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl-2-head": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl-3-head": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl-2.1-head": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "agpl-3-head": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "lgpl-2.1-later-head": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
    "License as published by the Free Software Foundation",
    "lgpl-2.1-later-tail": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl-3-or-later": "free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
    "and to alter it and redistribute it freely, subject to the following restrictions",
    "zlib-origin": "The origin of this software must not be misrepresented",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
    "original software",
    "boost-head": "Boost Software License - Version 1.0 - August 17th, 2003",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0",
    "epl-2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
    "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "all-rights": "All rights reserved",
}

# Identifiers that a tag line may name, in the order in which they are reported.
SPDX = (
    "AGPL-3.0-or-later", "AGPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0-only", "GPL-2.0-or-later", "GPL-2.0-only",
    "LGPL-3.0-or-later", "LGPL-3.0-only", "LGPL-2.1-or-later", "LGPL-2.1-only", "MPL-2.0", "EPL-2.0", "Apache-2.0",
    "BSD-3-Clause", "BSD-2-Clause", "0BSD", "BSL-1.0", "Zlib", "ISC", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0",
    "Unlicense", "MIT",
)
SENTENCES |= {f"spdx-{name.lower()}": f"SPDX-License-Identifier: {name}" for name in SPDX}

# Rules in order; whole licences come before notices and names.
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-author")),
    ("BSD-2-Clause", ("bsd-2-title", "bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-2-header", "apache-2-compliance", "apache-2-disclaimer")),
    ("Apache-2.0", ("apache-2-header",)),
    ("Apache-2.0", ("apache-2-licensed",)),
    ("Apache-2.0", ("apache-2-released",)),
    ("Apache-2.0", ("apache-2-head", "apache-2-terms")),
    ("Apache-2.0", ("apache-2-file",)),
    ("Apache-2.0", ("apache-2-project",)),
    ("Apache-2.0", ("apache-2-head",)),
    ("Apache-2.0", ("apache-name", "apache-2-version")),
    ("AGPL-3.0-or-later", ("agpl-3-or-later",)),
    ("GPL-3.0-or-later", ("gpl-3-or-later", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-3-or-later",)),
    ("GPL-2.0-or-later", ("gpl-2-or-later",)),
    ("GPL-2.0-or-later", ("gpl-2-later-head", "gpl-2-later-tail")),
    ("GPL-3.0-only", ("gpl-3-work",)),
    ("GPL-2.0-only", ("gpl-2-work",)),
    ("AGPL-3.0-only", ("agpl-3-work",)),
    ("LGPL-3.0-only", ("lgpl-3-work",)),
    ("MPL-2.0", ("mpl-2-terms", "mpl-2-copy")),
    ("MPL-2.0", ("mpl-2-terms",)),
    ("MPL-2.0", ("mpl-2-copy",)),
    ("MPL-2.0", ("mpl-2-copy-http",)),
    ("MPL-2.0", ("mpl-2-licensed",)),
    ("CC-BY-4.0", ("cc-by-4-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-work",)),
    ("CC0-1.0", ("cc0-dedication",)),
    ("Unlicense", ("unlicense-domain",)),
    ("Unlicense", ("unlicense-anyone",)),
    ("LGPL-2.1-or-later", ("lgpl-2.1-later-head", "lgpl-2.1-later-tail")),
    ("LGPL-3.0-or-later", ("lgpl-3-or-later",)),
    ("AGPL-3.0-only", ("agpl-3-head",)),
    ("LGPL-3.0-only", ("lgpl-3-head",)),
    ("LGPL-2.1-only", ("lgpl-2.1-head",)),
    ("GPL-3.0-only", ("gpl-3-head",)),
    ("GPL-2.0-only", ("gpl-2-head",)),
    ("Zlib", ("zlib-grant", "zlib-origin", "zlib-altered")),
    ("Zlib", ("zlib-grant", "zlib-origin")),
    ("BSL-1.0", ("boost-head",)),
    ("BSL-1.0", ("boost-notice",)),
    ("EPL-2.0", ("epl-2-terms",)),
    *((name, (f"spdx-{name.lower()}",)) for name in SPDX),
    ("MIT", ("mit-file",)),
    ("MIT", ("mit-software",)),
    ("MIT", ("mit-distributed",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-project",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-name",)),
    ("ISC", ("isc-released",)),
    ("ISC", ("isc-licensed",)),
    ("BSD-3-Clause", ("bsd-3-released",)),
    ("BSD-3-Clause", ("bsd-3-licensed",)),
    ("BSD-3-Clause", ("bsd-3-title",)),
    ("BSD-2-Clause", ("bsd-2-released",)),
    ("BSD-2-Clause", ("bsd-2-licensed",)),
    ("BSD-2-Clause", ("bsd-2-title",)),
)

# Sentences that must not follow a rule's own before its first one comes again.
NOT_AFTER = {("bsd-grant", "bsd-source", "bsd-binary"): ("bsd-endorse", "bsd-endorse-author")}

# Every known sentence holds one of these; a text without any is not cut up.
HINT = (
    "(?i)licen[sc]|copyright|permission|warranty|redistribut|liab|public[^a-z0-9]+domain|rights|published[^a-z0-9]+by|"
    "later[^a-z0-9]+version|mpl|2[^a-z0-9]+[01]([^a-z0-9]|$)|misrepresented|terms[^a-z0-9]+and[^a-z0-9]+conditions|"
    "free[^a-z0-9]+to[^a-z0-9]+copy|software[^a-z0-9]+foundation"
)
GAP = "[^A-Za-z0-9]+"
LEADS = ("following conditions( are met)?", "free software", "nor the names of", "[Pp]ermission (is hereby granted|to use)")
SENTENCE_END = (
    r"[.;!?]+([ \t-\r]+|\z)|:[^A-Za-z0-9\n]*\n|\n[^A-Za-z0-9\n]*\n|"
    r"([^r]|[^e]r|[^i]er|[^f]ier):[ \t]+\b|"  # not after Identifier, whose value is no sentence by itself
    rf"\b({'|'.join(LEADS).replace(' ', GAP)})\b"
)
MARK = "\x01"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def cut(sentence: str) -> list[str]:
    """The normalised sentences that a text is cut into."""
    marked = re.sub(SENTENCE_END.replace(r"\z", r"\Z"), MARK, sentence)
    return [part for part in map(normal, marked.split(MARK)) if part]


def numbered_parts() -> tuple[dict[str, str], dict[str, tuple[str, ...]]]:
    """Identifiers by normalised sentence, and for each name in SENTENCES its identifiers in order."""
    parts = {name: cut(sentence) for name, sentence in SENTENCES.items()}
    known = {part: name for name, (part, *more) in parts.items() if not more}
    for name, several in parts.items():
        for at, part in enumerate(several, 1):
            known.setdefault(part, f"{name}-{at}")
    return known, {name: tuple(known[part] for part in several) for name, several in parts.items()}


KNOWN, PARTS = numbered_parts()


def rule_pattern(names: tuple[str, ...]) -> str:
    """Over identifiers, each between commas."""
    pattern = "," + ",(?:[^,]+,)*".join(",".join(PARTS[name]) for name in names) + ","
    if names not in NOT_AFTER:
        return pattern
    again = PARTS[names[0]][0]
    others = sorted(set(KNOWN.values()) - {again, *(PARTS[name][0] for name in NOT_AFTER[names])})
    return f"{pattern}(?:(?:{'|'.join(others)}),)*({again},|$)"


def identifiers(marked: Column) -> Column:
    known = F.create_map(*[F.lit(part) for pair in KNOWN.items() for part in pair])
    longest = max(map(len, KNOWN))
    sentences = F.transform(
        F.split(marked, MARK, -1), lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    )
    likely = F.filter(sentences, lambda s: F.length(s).between(1, longest))
    return F.filter(F.transform(likely, lambda s: F.try_element_at(known, s)), lambda name: name.isNotNull())


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_sentences (recognised), sentences (identifiers in order, comma-joined), licenses (comma-joined)."""
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    marked = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.when(body.rlike(HINT), F.regexp_replace(body, SENTENCE_END, MARK)).alias("marked"),
    )
    read = marked.select(
        "doc_id",
        F.coalesce(identifiers(F.col("marked")), none).alias("joined_lines"),
        F.coalesce(identifiers(F.translate("marked", "\n", MARK)), none).alias("own_lines"),
    )
    names = F.when(F.size("own_lines") > F.size("joined_lines"), F.col("own_lines")).otherwise(F.col("joined_lines"))
    found = read.select("doc_id", names.alias("names")).withColumn(
        "path", F.concat(F.lit(","), F.array_join("names", ","), F.lit(","))
    )
    hits = F.array(*[F.when(F.col("path").rlike(rule_pattern(rule)), license) for license, rule in RULES])
    matched = F.array_distinct(F.filter(hits, lambda license: license.isNotNull()))
    return found.select(
        "doc_id",
        F.size("names").cast("long").alias("n_sentences"),
        F.array_join("names", ",").alias("sentences"),
        F.when(F.size("names") > 0, F.array_join(matched, ",")).otherwise("").alias("licenses"),
    )


def oracle() -> str:
    known = ", ".join(f"('{sentence}', '{name}')" for sentence, name in KNOWN.items())
    # Licences come in the order of their first matching rule, which the number of the rule gives.
    firsts = ", ".join(
        f"CASE WHEN regexp_matches(path, '{rule_pattern(rule)}') THEN {at} END" for at, (_, rule) in enumerate(RULES)
    )
    names = ", ".join(f"({at}, '{license}')" for at, (license, _) in enumerate(RULES))
    return rf"""
WITH known(sentence, name) AS (VALUES {known}),
rules(place, license) AS (VALUES {names}),
marked AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{SENTENCE_END}', chr(1), 'g') AS marked FROM documents
),
cut AS (
  SELECT doc_id, 0 AS own, string_split(marked, chr(1)) AS parts FROM marked
  UNION ALL SELECT doc_id, 1, string_split(replace(marked, chr(10), chr(1)), chr(1)) FROM marked
),
sentences AS (
  SELECT doc_id, own, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS place FROM cut
),
named AS (
  SELECT s.doc_id, s.own, s.place, k.name
  FROM sentences s JOIN known k ON trim(regexp_replace(lower(s.sentence), '[^a-z0-9]+', ' ', 'g')) = k.sentence
),
read AS (
  SELECT doc_id, own, count(*) AS n, string_agg(name, ',' ORDER BY place) AS names FROM named GROUP BY doc_id, own
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, own) AS best_place FROM read
),
chosen AS (
  SELECT d.doc_id, coalesce(b.n, 0) AS n_sentences, coalesce(b.names, '') AS sentences, ',' || coalesce(b.names, '') || ',' AS path
  FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id AND b.best_place = 1
),
matched AS (
  SELECT doc_id, unnest([{firsts}]) AS place FROM chosen
),
firsts AS (
  SELECT m.doc_id, r.license, min(m.place) AS place FROM matched m JOIN rules r ON m.place = r.place GROUP BY m.doc_id, r.license
),
licenses AS (
  SELECT doc_id, string_agg(license, ',' ORDER BY place) AS licenses FROM firsts GROUP BY doc_id
)
SELECT c.doc_id, c.n_sentences, c.sentences, coalesce(l.licenses, '') AS licenses
FROM chosen c LEFT JOIN licenses l ON c.doc_id = l.doc_id
"""
