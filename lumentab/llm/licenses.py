"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences (at line ends and at . ; : ! ? before white space), each is brought to lower case with
single spaces between its letters and digits, and looked up in a table of known licence sentences.  A known sentence
may run over line ends, with or without comment signs, but not over an empty line; the longest one counts.  One that
holds ends itself, such as an SPDX tag, is found where all its parts follow each other.  The identifiers found, in order, are matched against licence rules: the first rules are the most specific, and what a rule has
matched is taken out of the sequence before the next looks at it.  Identifiers that no rule takes are reported.

Everything is worked out row by row; nothing is shuffled.

Defined results: a null or empty text has no sentence; repeated rows are answered one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of published licences and of the usual references to them.
SENTENCES = {
    "MIT_REF": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
                "This software is released under the MIT License", "MIT License", "The MIT License", "The MIT License (MIT)", "SPDX-License-Identifier: MIT"],
    "MIT_GRANT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
                  "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                  "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "MIT_NOTICE": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "MIT_AS_IS": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
                  "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "MIT_LIABILITY": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
                      "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "APACHE2_REF": ["Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")", "Released under the Apache License, Version 2.0",
                    "Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "APACHE2_COMPLY": ["you may not use this file except in compliance with the License"],
    "APACHE2_COPY": ["You may obtain a copy of the License at"],
    "APACHE2_AS_IS": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                      "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "GPL3_REF": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
                 "Released under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "GPL2_REF": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2",
                 "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "GPL_FREE": ["This program is free software"],
    "GPL3_LATER": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                   "either version 3 of the License, or (at your option) any later version"],
    "GPL2_LATER": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
                   "either version 2 of the License, or (at your option) any later version"],
    "GPL_NO_WARRANTY": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"],
    "GPL_MERCHANT": ["without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "GPL_DETAILS": ["See the GNU General Public License for more details"],
    "LGPL_REF": ["Licensed under the GNU Lesser General Public License, version 3", "This work is licensed under the GNU Lesser General Public License, version 3",
                 "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "AGPL_REF": ["Licensed under the GNU Affero General Public License, version 3", "This work is licensed under the GNU Affero General Public License, version 3",
                 "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "BSD_REF": ["Released under the BSD License", "Licensed under the BSD License"],
    "BSD2_REF": ["Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD3_REF": ["Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "BSD_GRANT": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "BSD_SOURCE": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
                   "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "BSD_BINARY": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
                   "and/or other materials provided with the distribution",
                   "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
                   "and/or other materials provided with the distribution"],
    "BSD_ENDORSE": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
                    "without specific prior written permission",
                    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
                    "without specific prior written permission"],
    "MPL2_REF": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0",
                 "SPDX-License-Identifier: MPL-2.0"],
    "ISC_GRANT": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
                  "notice and this permission notice appear in all copies"],
    "ISC_REF": ["Released under the ISC License", "Licensed under the ISC License", "SPDX-License-Identifier: ISC"],
    "UNLICENSE": ["This is free and unencumbered software released into the public domain", "SPDX-License-Identifier: Unlicense"],
    "PUBLIC_DOMAIN": ["This work is in the public domain", "Released into the public domain"],
    "CC0_REF": ["Licensed under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"],
    "CC_BY_REF": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC_BY_SA_REF": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC_BY_NC_REF": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC_BY_ND_REF": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC_BY_NC_SA_REF": ["Licensed under CC BY-NC-SA 4.0"],
    "CC_BY_NC_ND_REF": ["Licensed under CC BY-NC-ND 4.0"],
    "ALL_RIGHTS": ["All rights reserved"],
}
#: Ordered rules: a licence and the identifiers that show it, "?" after one that may be missing.
RULES = [
    ("MIT", ["MIT_REF?", "MIT_GRANT", "MIT_NOTICE", "MIT_AS_IS?", "MIT_LIABILITY?"]),
    ("BSD-3-Clause", ["BSD3_REF?", "BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE"]),
    ("BSD-2-Clause", ["BSD2_REF?", "BSD_GRANT", "BSD_SOURCE", "BSD_BINARY"]),
    ("Apache-2.0", ["APACHE2_REF", "APACHE2_COMPLY?", "APACHE2_COPY?", "APACHE2_AS_IS?"]),
    ("GPL-3.0-or-later", ["GPL_FREE", "GPL3_LATER", "GPL_NO_WARRANTY?", "GPL_MERCHANT?", "GPL_DETAILS?"]),
    ("GPL-2.0-or-later", ["GPL_FREE", "GPL2_LATER", "GPL2_LATER?", "GPL_NO_WARRANTY?", "GPL_MERCHANT?", "GPL_DETAILS?"]),
    ("GPL-3.0", ["GPL3_REF"]),
    ("GPL-2.0", ["GPL2_REF"]),
    ("LGPL-3.0", ["LGPL_REF"]),
    ("AGPL-3.0", ["AGPL_REF"]),
    ("MIT", ["MIT_REF"]),
    ("BSD-3-Clause", ["BSD3_REF"]),
    ("BSD-2-Clause", ["BSD2_REF"]),
    ("BSD", ["BSD_REF"]),
    ("MPL-2.0", ["MPL2_REF"]),
    ("ISC", ["ISC_REF?", "ISC_GRANT"]),
    ("ISC", ["ISC_REF"]),
    ("Unlicense", ["UNLICENSE"]),
    ("CC0-1.0", ["CC0_REF"]),
    ("CC-BY-NC-SA-4.0", ["CC_BY_NC_SA_REF"]),
    ("CC-BY-NC-ND-4.0", ["CC_BY_NC_ND_REF"]),
    ("CC-BY-NC-4.0", ["CC_BY_NC_REF"]),
    ("CC-BY-SA-4.0", ["CC_BY_SA_REF"]),
    ("CC-BY-ND-4.0", ["CC_BY_ND_REF"]),
    ("CC-BY-4.0", ["CC_BY_REF"]),
    ("public-domain", ["PUBLIC_DOMAIN"]),
]

#: Sentence ends, and what stands between the words of a normalised sentence.
ENDS, BETWEEN = r"[.;:!?][\x20\x09-\x0D]+|[\x0A\x0D]+", r"[^a-z0-9\x01]+"
#: Ends that no sentence runs over: punctuation, and lines without a letter or digit.
HARD_ENDS = r"[.;:!?][\x20\x09-\x0D]+|\x0A[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\x0A"


def sentence_parts(sentence: str) -> list[str]:
    """The normalised sentences of a known sentence: it may hold ends itself."""
    import re

    return [p for x in re.sub(BETWEEN, " ", re.sub(ENDS, "\x01", sentence).lower()).split("\x01") if (p := x.strip())]


def known_sentences() -> dict[str, str]:
    """Known sentence -> identifier: all its normalised parts, with an end between them."""
    table: dict[str, str] = {}
    for name, own in SENTENCES.items():
        for key in ("\x01".join(sentence_parts(s)) for s in own):
            assert table.setdefault(key, name) == name, f"{table[key]} and {name} share {key!r}"
    return table


def known_pattern() -> str:
    """Any known sentence between two ends, the longest first; its words may stand on several lines."""
    own = [s.replace(" ", r"[ \x02]").replace("\x01", r"\x01") for s in sorted(known_sentences(), key=lambda s: (-len(s), s))]
    return rf"(?<![^\x01\x02])(?:{'|'.join(own)})(?![^\x01\x02])"


def rule_patterns() -> list[tuple[str, str]]:
    """Each rule as a pattern over "<A><B>"."""
    return [(name, "".join(f"(?:<{x[:-1]}>)?" if x.endswith("?") else f"<{x}>" for x in own)) for name, own in RULES]


def marked_text(text: Column) -> Column:
    """Normalised sentences with \\x01 between them, or \\x02 where only a line ends."""
    lines = F.regexp_replace(F.translate(text, "\x02", " "), F.lit(r"\x0D\x0A?"), F.lit("\n"))
    ended = F.translate(F.regexp_replace(lines, F.lit(HARD_ENDS), F.lit("\x01")), "\n", "\x02")
    words = F.regexp_replace(F.lower(ended), F.lit(r"[^a-z0-9\x01\x02]+"), F.lit(" "))
    return F.trim(F.regexp_replace(words, F.lit(r" ?([\x01\x02]) ?"), F.lit("$1")))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_sentences, n_known, sentence_ids, licenses, n_licenses, unmatched_ids) of every row."""
    table = F.create_map(*[F.lit(x) for pair in sorted(known_sentences().items()) for x in pair])
    rows = docs.select(F.col(key).alias("doc_id"), marked_text(F.coalesce(F.col(text), F.lit(""))).alias("marked"))
    found = rows.select("doc_id", F.size(F.array_remove(F.split("marked", "[\x01\x02]"), "")).cast("long").alias("n_sentences"),
                        F.transform(F.regexp_extract_all("marked", F.lit(known_pattern()), F.lit(0)), lambda s: table[F.translate(s, "\x02", " ")]).alias("ids"))
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("pattern")) for n, p in rule_patterns()])
    tagged = F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">"))
    matched = F.when(F.size("ids") > 0, F.aggregate(
        rules, F.struct(tagged.alias("rest"), F.array().cast("array<string>").alias("names")),
        lambda a, r: F.struct(
            F.regexp_replace(a["rest"], r["pattern"], F.lit("")).alias("rest"),
            F.when(F.regexp_like(a["rest"], r["pattern"]), F.concat(a["names"], F.array(r["name"]))).otherwise(a["names"]).alias("names"))))
    names = F.array_sort(F.array_distinct(F.coalesce(F.col("matched.names"), F.array().cast("array<string>"))))
    rest = F.coalesce(F.col("matched.rest"), F.lit(""))
    return found.withColumn("matched", matched).select(
        F.col("doc_id").alias(key), "n_sentences", F.size("ids").cast("long").alias("n_known"), F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(names, ",").alias("licenses"), F.size(names).cast("long").alias("n_licenses"),
        F.regexp_replace(F.trim(F.translate(rest, "<>", "  ")), F.lit(" +"), F.lit(",")).alias("unmatched_ids"))


def oracle() -> str:
    """The scan as SQL.

    Its regular expressions look neither back nor ahead.  So every sentence end is doubled: a known sentence takes one
    copy before and one after it, and its neighbour finds the other.
    """
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k.replace(chr(1), '|'))}, {quote(v)})" for k, v in sorted(known_sentences().items()))
    own = "|".join(k.replace(" ", r"(?: |\x02\x02)").replace("\x01", r"\x01\x01") for k in sorted(known_sentences(), key=lambda s: (-len(s), s)))
    ctes, last = [], "seq"
    for n, (name, pattern) in enumerate(rule_patterns()):
        ctes.append(f"s{n} AS (SELECT doc_id, regexp_replace(rest, {quote(pattern)}, '', 'g') AS rest, "
                    f"CASE WHEN regexp_matches(rest, {quote(pattern)}) THEN list_append(names, {quote(name)}) ELSE names END AS names FROM {last})")
        last = f"s{n}"
    return rf"""
    WITH known(s, id) AS (VALUES {known}),
         lines AS (SELECT doc_id, regexp_replace(replace(coalesce(text, ''), chr(2), ' '), '\x0D\x0A?', chr(10), 'g') AS t FROM documents),
         ended AS (SELECT doc_id, replace(regexp_replace(t, '{HARD_ENDS}', chr(1), 'g'), chr(10), chr(2)) AS t FROM lines),
         words AS (SELECT doc_id, regexp_replace(regexp_replace(lower(t), '[^a-z0-9\x01\x02]+', ' ', 'g'), ' ?([\x01\x02]) ?', '\1', 'g') AS t FROM ended),
         parts AS (SELECT doc_id, trim(t) AS t, len([x for x in string_split(replace(trim(t), chr(2), chr(1)), chr(1)) if x <> '']) AS n_sentences FROM words),
         hits AS (SELECT doc_id, regexp_extract_all(chr(1) || regexp_replace(t, '([\x01\x02])', '\1\1', 'g') || chr(1),
                         '[\x01\x02]({own})[\x01\x02]', 1) AS h FROM parts),
         found AS (SELECT doc_id, string_agg(id, ',' ORDER BY k) AS ids, count(*) AS n FROM (
                     SELECT doc_id, replace(replace(unnest(h), chr(2) || chr(2), ' '), chr(1) || chr(1), '|') AS s, unnest(range(len(h))) AS k FROM hits)
                   JOIN known USING (s) GROUP BY doc_id),
         seq AS (SELECT doc_id, '<' || replace(ids, ',', '><') || '>' AS rest, CAST([] AS VARCHAR[]) AS names FROM found),
         {", ".join(ctes)}
    SELECT doc_id, n_sentences, coalesce(n, 0) AS n_known, coalesce(ids, '') AS sentence_ids,
           coalesce(array_to_string(list_sort(list_distinct(names)), ','), '') AS licenses, coalesce(len(list_distinct(names)), 0) AS n_licenses,
           coalesce(regexp_replace(trim(translate(rest, '<>', '  ')), ' +', ',', 'g'), '') AS unmatched_ids
    FROM parts LEFT JOIN found USING (doc_id) LEFT JOIN {last} USING (doc_id)
    """
