"""Licence recognition by sentences and rules.

A text is cut into sentences, each is normalised and looked up among known licence sentences,
and the identifiers found, in their order, are held against an ordered list of rules: a rule
is a sequence of identifiers, and the first rule that fits takes its sentences out of the
sequence. Sentences that are not known part the sequence, so a rule only fits sentences that
stand together.

Everything is a column expression over one row; nothing is shuffled or exploded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of licences as they are written, by identifier.
NAMES = {
    "MIT": ["MIT License", "MIT Licence", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2", "GNU GPL version 2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3", "GNU GPL version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-clause BSD license", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-clause BSD license", "New BSD License", "Modified BSD License"],
    "ISC": ["ISC License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
# Ways to say that a work is under a licence.
FORMS = [
    "Licensed under {}",
    "This work is licensed under {}",
    "This project is licensed under {}",
    "This software is licensed under {}",
    "This file is licensed under {}",
    "Released under {}",
    "This software is released under {}",
    "Distributed under {}",
    "Distributed under the terms of {}",
    "Available under {}",
    "Published under {}",
    "License: {}",
    "SPDX-License-Identifier: {}",
]
# Sentences of licence texts and notices, by identifier.
SENTENCES = {
    "MITGrant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "MITNotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "AsIs": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "NoLiability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "ApacheUnder": ["Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "ApacheComply": ["you may not use this file except in compliance with the License."],
    "ApacheCopy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "ApacheAsIs": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "ApacheSee": ["See the License for the specific language governing permissions and limitations under the License."],
    "GPLFree": ["This program is free software:", "This program is free software;"],
    "GPL2Only": ["you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."],
    "GPL2Later": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"],
    "Later2": ["either version 2 of the License, or (at your option) any later version."],
    "Later3": ["either version 3 of the License, or (at your option) any later version."],
    "GPL3Later": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "AGPL3Later": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL3Later": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPLHope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "GPLFitness": ["without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "GPLSee": ["See the GNU General Public License for more details."],
    "MPLSubject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "MPLCopy": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "BSDPre": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSDSource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BSDBinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "BSDName": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "ISCGrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "AllRights": ["All rights reserved."],
}
# Rules in the order in which they are tried.
RULES = [
    ("MIT", ["MITGrant", "MITNotice", "AsIs", "NoLiability"]),
    ("MIT", ["MITGrant", "MITNotice", "AsIs"]),
    ("MIT", ["MITGrant", "MITNotice"]),
    ("Apache-2.0", ["ApacheUnder", "ApacheComply", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheUnder", "ApacheComply", "ApacheCopy"]),
    ("Apache-2.0", ["ApacheUnder", "ApacheComply"]),
    ("GPL-2.0-or-later", ["GPLFree", "GPL2Later", "Later2", "GPLHope", "GPLFitness", "GPLSee"]),
    ("GPL-2.0-or-later", ["GPLFree", "GPL2Later", "Later2"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL2Later", "Later3", "GPLHope", "GPLFitness", "GPLSee"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL2Later", "Later3"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL3Later", "GPLHope", "GPLFitness", "GPLSee"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL3Later"]),
    ("AGPL-3.0-or-later", ["GPLFree", "AGPL3Later"]),
    ("LGPL-3.0-or-later", ["GPLFree", "LGPL3Later"]),
    ("GPL-2.0", ["GPLFree", "GPL2Only"]),
    ("MPL-2.0", ["MPLSubject", "MPLCopy"]),
    ("MPL-2.0", ["MPLSubject"]),
    ("BSD-3-Clause", ["BSDPre", "BSDSource", "BSDBinary", "BSDName"]),
    ("BSD-2-Clause", ["BSDPre", "BSDSource", "BSDBinary"]),
    ("ISC", ["ISCGrant"]),
    ("Unlicense", ["Unlicense"]),
]
# Fixed value: every known sentence holds one of these, with anything but letters and digits between
# two words, so a text that in lower case has none of them needs no cutting.
CUES = (
    r"(?i)licen[sc]e|copyright|permission|warranty|redistribut|free[^a-z0-9]+software|rights[^a-z0-9]+reserved"
    r"|public[^a-z0-9]+domain|spdx|merchantability|later[^a-z0-9]+version|authors[^a-z0-9]+or|mozilla"
    r"|(?:released|distributed|available|published)[^a-z0-9]+under"
)
BOUNDARY = "\x1e"
END = r"([.!?:;])\s+|\n\s*\n"
JUNK = r"[^a-z0-9]+"


def _normal(sentence: str) -> str:
    return re.sub(JUNK, " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Identifier of each known sentence in normal form; those that name a licence follow a rule."""
    out = {}
    for licence, names in NAMES.items():
        for name in [*names, licence]:
            for form in FORMS:
                for article in ("", "the "):
                    # A name with a full stop before a space is cut like any text.
                    parts = re.split(r"(?<=[.!?:;])\s+", form.format(article + name))
                    out[_normal(" ".join(parts))] = licence
    for identifier, texts in SENTENCES.items():
        for text in texts:
            out[_normal(text)] = identifier
    return out


def sentences(text: Column) -> Column:
    """The normalised sentences of a text; a sentence that is not known as a whole is cut into its lines."""
    marked = F.regexp_replace(F.regexp_replace(text, END, f"$1{BOUNDARY}"), rf"(?i)(license|spdx-license-identifier|licence): ?{BOUNDARY}", "$1: ")
    return F.split(marked, BOUNDARY)


def _normalised(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), JUNK, " "))


def recognise(docs: DataFrame) -> DataFrame:
    """``doc_id, licenses, sentence_ids, n_licenses``, one row per row of ``docs (doc_id, text)``.

    ``licenses`` names the licences found, in the order of their first place, separated by
    commas; ``sentence_ids`` those of sentences that no rule took. Both are empty, and the
    number 0, for NULL and empty texts and texts without a known sentence. Texts of any
    length are read whole; equal rows get equal results; no rows give no rows; other columns
    are not read.
    """
    known = known_sentences()
    table = F.map_from_arrays(F.array(*map(F.lit, known)), F.array(*map(F.lit, known.values())))

    def token(normal: Column) -> Column:
        return F.element_at(table, normal)

    def tokens(unit: Column) -> Column:
        return F.when(token(_normalised(unit)).isNotNull(), F.array(unit)).otherwise(F.split(unit, "\n"))

    units = F.flatten(F.transform(sentences(F.col("text")), tokens))
    named = F.filter(F.transform(units, _normalised), lambda s: s != "")
    sequence = F.array_join(F.transform(named, lambda s: F.coalesce(F.concat(F.lit("<"), token(s), F.lit(">")), F.lit("|"))), "")
    cued = F.coalesce(F.lower(F.col("text").cast("string")).rlike(CUES), F.lit(False))
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn(
        "sequence", F.when(cued, sequence).otherwise("")
    )
    matched = F.col("sequence")
    for licence, steps in _ordered_rules():
        matched = F.replace(matched, F.lit("".join(f"<{s}>" for s in steps)), F.lit(f"{{{licence}}}"))
    return found.select("doc_id", matched.alias("matched")).select(
        "doc_id",
        F.array_join(F.array_distinct(F.regexp_extract_all("matched", F.lit(r"\{([^}]*)\}"), 1)), ",").alias("licenses"),
        F.array_join(F.regexp_extract_all("matched", F.lit("<([^>]*)>"), 1), ",").alias("sentence_ids"),
        F.size(F.array_distinct(F.regexp_extract_all("matched", F.lit(r"\{([^}]*)\}"), 1))).alias("n_licenses"),
    )


def _ordered_rules() -> list[tuple[str, list[str]]]:
    """The rules, and after them each sentence that names its licence by itself."""
    return [*RULES, *((licence, [licence]) for licence in NAMES)]


def _sql() -> str:
    entries = ", ".join("('" + k + "', '" + v + "')" for k, v in known_sentences().items())
    matched = "seq"
    for licence, steps in _ordered_rules():
        matched = f"replace({matched}, '{''.join(f'<{s}>' for s in steps)}', '{{{licence}}}')"
    return rf"""
WITH known(s, id) AS (VALUES {entries}),
dict AS (SELECT map_from_entries(list((s, id))) AS m FROM known),
units AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '([.!?:;])\s+|\n\s*\n', '\1' || chr(30), 'g'),
    '(license|spdx-license-identifier|licence): ?' || chr(30), '\1: ', 'gi'), chr(30)) AS u FROM documents
), lines AS (
  SELECT doc_id, r, list_filter(list_transform(flatten(list_transform(u, lambda x: CASE WHEN m[trim(regexp_replace(lower(x), '{JUNK}', ' ', 'g'))] IS NOT NULL
    THEN [x] ELSE string_split(x, chr(10)) END)), lambda x: trim(regexp_replace(lower(x), '{JUNK}', ' ', 'g'))), lambda x: x <> '') AS n, m FROM units, dict
), seqs AS (
  SELECT doc_id, array_to_string(list_transform(n, lambda x: coalesce('<' || m[x] || '>', '|')), '') AS seq FROM lines
), matched AS (SELECT doc_id, {matched} AS seq FROM seqs),
found AS (
  SELECT doc_id, regexp_extract_all(seq, '\{{([^}}]*)\}}', 1) AS l, regexp_extract_all(seq, '<([^>]*)>', 1) AS s FROM matched
)
SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS licenses,
  array_to_string(s, ',') AS sentence_ids, len(list_distinct(l))::INTEGER AS n_licenses FROM found
"""


SQL = _sql()
