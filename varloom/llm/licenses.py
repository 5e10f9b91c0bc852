"""Licences recognised by sentences: known sentences become identifiers, rules match their order.

A text is cut into sentences, each is brought to a plain form, and those that are known
licence sentences leave their identifiers in order. Ordered rules then look for runs of
identifiers; the first rule that fits takes its run away from those after it. A run ends
where more than ``GAP`` other sentences lie between two known ones. The sentence right
behind an SPDX tag is an expression, whose parts are names of their own. Everything is
column expressions.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sentences of licence texts and notices, by identifier.
SENTENCES = {
    "apache-use": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "gpl-free": "This program is free software",
    "gpl2-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    "gpl3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "bsd-use": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "gpl3-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "either-2": "either version 2 of the License, or (at your option) any later version",
    "either-2.1": "either version 2.1 of the License, or (at your option) any later version",
    "either-3": "either version 3 of the License, or (at your option) any later version",
    "lgpl-free": "This library is free software",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl2.1-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "agpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "mpl-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
}
TAG = "SPDX-License-Identifier"

# Names that notices give to a licence.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "MIT": ["MIT License", "MIT"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL-3.0", "GPL-3.0-only"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL-2.0", "GPL-2.0-only"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "ISC": ["ISC License", "ISC"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0", "CC0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
}
# Further names that stand behind a tag.
TAGGED = [
    "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.0", "LGPL-2.1", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later",
    "0BSD", "BSL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "CDDL-1.0", "Artistic-2.0", "Unlicense", "WTFPL", "Zlib", "PostgreSQL",
]
TAGGED_ONLY = {"LGPL-2.0": "LGPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3.0": "LGPL-3.0-only", "AGPL-3.0": "AGPL-3.0-only"}
SUBJECTS = ["", "this work is", "this software is", "this program is", "this project is", "this file is", "this code is", "this document is"]
VERBS = ["licensed under", "released under", "distributed under", "available under", "published under"]
ARTICLES = ["", "the", "the terms of the"]

# Rules in the order in which they are tried.
RULES = [
    ("Apache-2.0", ["apache-use", "apache-comply", "apache-copy", "apache-basis", "apache-see"]),
    ("Apache-2.0", ["apache-use", "apache-comply"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later", "gpl-hope", "gpl-implied", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later", "gpl-hope", "gpl-implied", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later"]),
    ("GPL-2.0", ["gpl-free", "gpl2-only"]),
    ("GPL-3.0", ["gpl-free", "gpl3-only"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-terms", "either-2"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-terms", "either-3"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl2.1-later"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl-terms", "either-2.1"]),
    ("LGPL-3.0-or-later", ["lgpl-free", "lgpl3-later"]),
    ("LGPL-3.0-or-later", ["lgpl-free", "lgpl-terms", "either-3"]),
    ("LGPL-2.1-or-later", ["gpl-free", "lgpl2.1-later"]),
    ("LGPL-3.0-or-later", ["gpl-free", "lgpl3-later"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-later"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl-terms", "either-3"]),
    ("BSD-3-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-use", "bsd-source", "bsd-binary"]),
    ("MPL-2.0", ["mpl-terms", "mpl-copy"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense-free"]),
    ("Apache-2.0", ["apache-use"]),
]


#: Other sentences that may lie between two neighbours of a run, such as numbers of items or an address.
GAP = 3


def plain(sentence: str) -> str:
    """A known sentence in the form that ``sentences`` gives to those of a text."""
    cut = re.sub(r"[.!?:;]+([ \t\r\n]+|$)", " ", sentence.lower())
    return re.sub(r"[^a-z0-9.]+", " ", cut).strip(" .")


def joined(name: str) -> str:
    """A plain name whose ``or later`` cannot be taken for the ``or`` of an expression."""
    return name.replace(" or later", " orlater")


def known() -> dict[str, str]:
    """Plain sentence to identifier: the fixed sentences, every notice, and ``tag:`` with each name after a tag."""
    out = {}
    for licence in TAGGED:
        out["tag:" + joined(plain(licence))] = f"name:{licence}"
    for licence, name in TAGGED_ONLY.items():
        out["tag:" + joined(plain(name))] = f"name:{licence}"
    for licence, names in NAMES.items():
        for name in names:
            out["tag:" + joined(plain(name))] = f"name:{licence}"
            for subject in SUBJECTS:
                for verb in VERBS:
                    for article in ARTICLES:
                        out[plain(f"{subject} {verb} {article} {name}")] = f"notice:{licence}"
    return out | {plain(text): name for name, text in SENTENCES.items()}


def rules() -> list[tuple[str, str]]:
    """(licence, run of identifiers as text) in order; each identifier stands between commas."""
    tried = [*RULES]
    tried += [(licence, [f"name:{licence}"]) for licence in (*NAMES, *TAGGED)]
    tried += [(licence, [f"notice:{licence}"]) for licence in NAMES]
    return [(licence, "".join(f",{i}," for i in run)) for licence, run in tried]


#: Every known sentence holds one of these; so does the tag, without which no bare name counts.
ANCHORS = ("under", "licen", "copyright", "permission", "warrant", "software", "redistribut", "liable", "mozilla")


def sentences(text: Column) -> Column:
    """Plain sentences that are not empty: cut at line ends and after sentence marks, letters and digits kept."""
    cut = F.regexp_replace(text, r"[.!?:;]+([ \t\r\n]+|$)", "\n")
    pieces = F.split(F.regexp_replace(cut, r"[^a-z0-9.\n]+", " "), r" *\.*\n[ .]*")
    return F.filter(F.transform(pieces, lambda piece: F.trim(piece)), lambda piece: piece != "")


def expression_parts(sentence: Column) -> Column:
    """Names joined by ``or`` and ``and`` behind a tag, each without its exception."""
    parts = F.split(F.replace(sentence, F.lit(" or later"), F.lit(" orlater")), " or | and ")
    return F.transform(parts, lambda part: F.concat(F.lit("tag:"), F.substring_index(part, " with ", 1)))


def known_table(spark: SparkSession) -> DataFrame:
    """(sentence, id) of all known sentences: a table of fixed, small size."""
    table = F.from_json(F.lit(json.dumps(known())), "map<string,string>")
    return spark.range(1).select(F.explode(table).alias("sentence", "id"))


def unwrapped(text: Column) -> Column:
    """The text with single line ends as spaces; empty lines still end a sentence."""
    marked = F.regexp_replace(text, r"\n[ \t\r]*\n", "\u0001")
    return F.translate(marked, "\n\u0001", " \n")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, license, matches): the licences each text names, and how often.

    Texts are read twice, with line ends as ends of sentences and as plain spaces; the
    greater count of both is given. Of ``A OR B WITH C`` behind a tag A and B count. Null and empty texts, and those without a known
    sentence, have no row. Rows with equal keys are taken together, null keys too.
    """
    lowered = F.lower(F.col(text))
    likely = df.select(F.col(key), lowered.alias("t")).filter(
        " or ".join(f"contains(t, '{anchor}')" for anchor in ANCHORS)
    )
    read = likely.select(
        key,
        F.monotonically_increasing_id().alias("row"),
        F.posexplode(F.array(F.col("t"), unwrapped(F.col("t")))).alias("reading", "t"),
    )
    cut = read.select(key, "row", "reading", sentences(F.col("t")).alias("s"))
    # Each sentence with the one before it.
    pairs = F.arrays_zip(F.col("s").alias("sentence"), F.concat(F.array(F.lit("")), "s").alias("before"))
    pieces = cut.select(key, "row", "reading", F.posexplode(pairs).alias("place", "p"))
    pieces = pieces.filter("p.sentence IS NOT NULL").select(key, "row", "reading", "place", "p.*")
    tagged = F.col("before") == plain(TAG)
    parts = F.when(tagged, expression_parts(F.col("sentence"))).otherwise(F.array("sentence"))
    pieces = pieces.select(key, "row", "reading", "place", F.explode(parts).alias("sentence"))
    named = pieces.join(F.broadcast(known_table(df.sparkSession)), "sentence")
    in_order = F.sort_array(F.collect_list(F.struct("place", F.concat(F.lit(","), "id", F.lit(",")).alias("id"))))
    placed = named.groupBy(key, "row", "reading").agg(in_order.alias("o"))
    far = lambda x, i: (i > 0) & (x["place"] - F.get("o", i - 1)["place"] > GAP + 1)
    marked = F.transform("o", lambda x, i: F.concat(F.when(far(x, i), "|").otherwise(""), x["id"]))
    runs = placed.select(key, "row", "reading", F.array_join(marked, "").alias("run"))
    tried = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(p).alias("pattern")) for n, p in rules()])

    def take(state: Column, rule: Column) -> Column:
        left = F.replace(state["run"], rule["pattern"], F.lit("#"))
        # Each match leaves one mark in place of its identifiers.
        hits = (F.length(state["run"]) - F.length(left)) / (F.length(rule["pattern"]) - 1)
        entry = F.struct(rule["license"].alias("license"), hits.cast("long").alias("matches"))
        none = F.array().cast("array<struct<license:string,matches:bigint>>")
        found = F.concat(state["found"], F.when(hits > 0, F.array(entry)).otherwise(none))
        return F.struct(left.alias("run"), found.alias("found"))

    begin = F.struct(
        F.col("run").alias("run"), F.array().cast("array<struct<license:string,matches:bigint>>").alias("found")
    )
    found = runs.select(key, "row", "reading", F.explode(F.aggregate(tried, begin, take)["found"]).alias("f"))
    counted = found.groupBy(key, "row", "reading", "f.license").agg(F.sum("f.matches").alias("matches"))
    return counted.groupBy(key, "license").agg(F.max("matches").alias("matches"))


def oracle() -> str:
    """The same in DuckDB's SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    table = ", ".join(f"({quoted(s)}, {quoted(i)})" for s, i in sorted(known().items()))
    steps, columns = [], []
    for n, (licence, pattern) in enumerate(rules()):
        steps.append(f"replace(s{n}, {quoted(pattern)}, '#') AS s{n + 1}")
        count = f"(length(s{n}) - length(s{n + 1})) // {len(pattern) - 1}"
        columns.append(f"{{'license': {quoted(licence)}, 'matches': {count}}}")
    return f"""
WITH known(sentence, id) AS (VALUES {table}),
texts AS (
  SELECT doc_id, lower(text) AS t FROM documents
  WHERE {" OR ".join(f"contains(lower(text), '{a}')" for a in ANCHORS)}),
readings AS (
  SELECT doc_id, 0 AS reading, t FROM texts UNION ALL
  SELECT doc_id, 1, translate(regexp_replace(t, '\\n[ \\t\\r]*\\n', chr(1), 'g'), chr(10) || chr(1), ' ' || chr(10)) FROM texts),
cut AS (
  SELECT doc_id, reading, regexp_split_to_array(regexp_replace(
    regexp_replace(t, '[.!?:;]+([ \\t\\r\\n]+|$)', chr(10), 'g'), '[^a-z0-9.\\n]+', ' ', 'g'), ' *\\.*\\n[ .]*') AS pieces
  FROM readings),
pieces AS (
  SELECT doc_id, reading, trim(unnest(pieces), ' ') AS piece, generate_subscripts(pieces, 1) AS piece_no FROM cut),
numbered AS (
  SELECT doc_id, reading, piece, row_number() OVER (PARTITION BY doc_id, reading ORDER BY piece_no) AS place
  FROM pieces WHERE piece <> ''),
follows AS (
  SELECT *, lag(piece) OVER (PARTITION BY doc_id, reading ORDER BY place) AS before FROM numbered),
names AS (
  SELECT doc_id, reading, place, piece FROM follows WHERE before IS DISTINCT FROM {quoted(plain(TAG))} UNION ALL
  SELECT doc_id, reading, place, 'tag:' || split_part(part, ' with ', 1) FROM (
    SELECT doc_id, reading, place, unnest(regexp_split_to_array(replace(piece, ' or later', ' orlater'), ' or | and ')) AS part
    FROM follows WHERE before = {quoted(plain(TAG))})),
named AS (SELECT doc_id, reading, place, ',' || id || ',' AS id FROM names JOIN known ON piece = sentence),
marked AS (
  SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY doc_id, reading ORDER BY place, id) > {GAP + 1} THEN '|' ELSE '' END AS mark
  FROM named),
runs AS (
  SELECT doc_id, reading, string_agg(mark || id, '' ORDER BY place, id) AS s0 FROM marked GROUP BY doc_id, reading),
taken AS (SELECT doc_id, reading, s0, {", ".join(steps)} FROM runs),
found AS (SELECT doc_id, reading, unnest([{", ".join(columns)}]) AS f FROM taken),
counted AS (
  SELECT doc_id, reading, f.license AS license, sum(f.matches) AS matches FROM found
  WHERE f.matches > 0 GROUP BY ALL)
SELECT doc_id, license, CAST(max(matches) AS BIGINT) AS matches FROM counted GROUP BY doc_id, license
"""
